"""SimHash near-dedup by meet-in-the-middle ball hashing.

A fingerprint has a bit set if more than half of the shingles' hashes have it.
Two fingerprints link if they differ in at most RADIUS bits. Every distinct
fingerprint emits all variants within half the radius; if two are within the
radius, some variant is common to both, and two that share a variant are within
the radius, as each is within half of it from the variant. So colliding pairs
need no second look, yet they are verified when joined to the least of a group.

Variants are shuffled by their leading bits: a fingerprint goes once to each
bucket that one of its variants falls into, and the bucket's task makes the
variants that belong there, meets equal ones by sorting, and keeps a spanning
forest of the links, so neither variants nor pairs of a group are ever stored.
Buckets follow the number of distinct fingerprints.

Null, empty and blank texts have no shingles and fingerprint zero, which links
like any other. Equal texts and repeated rows share a fingerprint. Other
columns aren't read by digest(). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage
from .components import components

RADIUS = 4
SHINGLE_WORDS = 4
SEED = 42
#: Distinct fingerprints for each bucket, about; the leading bits by which variants are dealt follow from it.
BUCKET_FINGERPRINTS = 2_000
#: Variants that a task makes at once, about.
VARIANTS_AT_ONCE = 2_000_000
#: A fingerprint of more than one in so many rows is hot.
HOT_PARTS = 1_000
#: Shingles hashed at once within a text, so that memory doesn't follow its length.
CHUNK = 65_536

_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, width: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of a text as uint64; texts of fewer words are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).translate(_SPACES).split(b" ")
    words = [w for w in words if w]
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if more than half of the hashes have it; 0 for none. As a signed 64-bit number."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = np.ascontiguousarray(hashes[at : at + CHUNK]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """docs (without the text) with the fingerprint of each text."""
    kept = [c for c in docs.columns if c not in (text, out)]
    slim = docs.select(*kept, F.col(text).alias("__text"))
    schema = slim.drop("__text").withColumn(out, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text")
            prints = pa.array([fingerprint(shingle_hashes(t.as_py())) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], prints], [*kept, out])

    return slim.mapInArrow(run, schema)


def ball(radius: int, low: int, high: int) -> np.ndarray:
    """All masks of at most radius bits among bits low to high - 1."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(low, high), n)]
    return np.array(masks, np.uint64)


def leading_bits(count: int) -> int:
    """So many that a bucket holds about BUCKET_FINGERPRINTS."""
    return max(4, min(24, int(np.ceil(np.log2(max(count, 1) / BUCKET_FINGERPRINTS + 1)))))


def _forest(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Links (owner, least owner of the same key) as rows, each once."""
    if len(keys) < 2:
        return np.empty((0, 2), np.uint64)
    order = np.argsort(keys)
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    met = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    keys, owner = keys[met], owner[order[met]]
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
    head = owner[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
    return np.unique(np.stack([owner, head], axis=1)[head != owner], axis=0)


def bucket_links(fp: np.ndarray, top: int, bits: int, half: int) -> np.ndarray:
    """Links among the fingerprints (uint64) by their variants with the leading bits `top`.

    The bucket is worked through by further leading bits, so many that about
    VARIANTS_AT_ONCE variants are in memory, however full it is.
    """
    rest = 64 - bits
    flips = np.bitwise_count((fp >> np.uint64(rest)) ^ np.uint64(top)).astype(np.int64)
    low = fp & np.uint64((1 << rest) - 1)
    home, more = low[flips == 0], 0
    while more < 16 and len(home) and np.bincount((home >> np.uint64(rest - more)).astype(np.int64)).max() * len(ball(half, 0, rest - more)) > VARIANTS_AT_ONCE:
        more += 1
    rest -= more
    balls = [ball(half - n, 0, rest) for n in range(half + 1)]
    tail = low & np.uint64((1 << rest) - 1)
    found = [np.empty((0, 2), np.uint64)]
    for part in range(1 << more):
        spent = flips + np.bitwise_count((low >> np.uint64(rest)) ^ np.uint64(part))
        keys, owner = [], []
        for n, masks in enumerate(balls):
            own = np.flatnonzero(spent == n)
            keys.append((tail[own][:, None] ^ masks[None, :]).ravel())
            owner.append(np.repeat(fp[own], len(masks)))
        found.append(_forest(np.concatenate(keys), np.concatenate(owner)))
    return np.unique(np.concatenate(found), axis=0)


def links(prints: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """prints: distinct fp (long). Returns a, b: links whose components are those of all pairs within the radius."""
    half = radius // 2
    if radius % 2:
        raise ValueError("the radius must be even to be split in two halves")
    bits = leading_bits(count)
    rest = 64 - bits
    tops = [int(m) for m in ball(half, 0, bits)]
    shift = F.shiftrightunsigned(F.col("fp"), rest)
    dealt = prints.select("fp", F.explode(F.transform(F.array(*[F.lit(m) for m in tops]), lambda m: shift.bitwiseXOR(m.cast("long")))).alias("bucket"))

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp = np.concatenate([b.column("fp").to_numpy() for b in batches]).view(np.uint64)
        found = bucket_links(fp, key[0].as_py(), bits, half)
        found = found[np.bitwise_count(found[:, 0] ^ found[:, 1]) <= radius]  # holds by construction
        columns = [pa.array(np.ascontiguousarray(found[:, k]).view(np.int64)) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return dealt.groupBy("bucket").applyInArrow(run, "a long, b long").distinct()


def _handed(rows: DataFrame, given: DataFrame, key: str, out: str, total: int) -> DataFrame:
    """rows with the column out of given, which has one row for each key and n, the rows that have it.

    Keys of more than a HOT_PARTS-th of total, so fewer than HOT_PARTS, hand it
    on by a broadcast; the others by a shuffle.
    """
    is_hot = F.col("n") * HOT_PARTS > total
    slim = given.select(F.col(key).alias("__own"), F.col(out).alias("__out"), "n")
    hot = slim.where(is_hot).select("__own", "__out", F.lit(True).alias("__hot"))
    met = rows.join(F.broadcast(hot), rows[key] == hot["__own"], "left")
    rest = met.where("__hot is null").select(*rows.columns)
    cold = slim.where(~is_hot).select("__own", "__out")
    dealt = rest.join(cold, rest[key] == cold["__own"], "left")
    return met.where("__hot").select(*rows.columns, F.col("__out").alias(out)).unionByName(dealt.select(*rows.columns, F.col("__out").alias(out)))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """key, fp and component (the least key that the document reaches by links, itself included)."""
    prints = cut_lineage(fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("__source")), "__source"))
    distinct = prints.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    count, rows = distinct.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = components(links(distinct.select("fp"), count, radius))
    rooted = found.join(distinct, found["node"] == distinct["fp"]).select("fp", "root", "least")
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("n"))
    linked = _handed(rooted.select("fp", "root"), lowest, "root", "component", count).select(F.col("fp").alias("__fp"), F.col("component").alias("__linked"))
    known = distinct.join(linked, F.col("fp") == F.col("__fp"), "left").select("fp", "n", F.coalesce("__linked", "least").alias("component"))
    return _handed(prints, known, "fp", "component", rows)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One document of each group, that of the least key, with all its columns.

    Rows that share a key count as one document. Null keys are told apart by the
    text's hash and come after all others.
    """
    own = F.coalesce(F.col(key), F.lit(2**62) + F.pmod(F.xxhash64(text), F.lit(2**61)))
    keyed = docs.withColumn("__key", own)
    stay = groups(keyed, "__key", text, radius).where("key = component").select(F.col("key").alias("__stays")).distinct()
    met = keyed.join(stay, F.col("__key") == F.col("__stays"))
    first = Window.partitionBy("__key").orderBy(F.xxhash64(text))
    return met.withColumn("__n", F.row_number().over(first)).where("__n = 1").select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    found = groups(docs)
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
