"""Near-dedup of texts whose sets of word shingles have a Jaccard similarity of at least LEAST.

Candidates come by SimHash and meet-in-the-middle ball hashing, as in simhash.
One fingerprint of 64 bits can't do it: at similarity 0.8 two differ in 9.7 bits
on average. So every distinct shingle set gets PRINTS fingerprints, and a pair
need only meet in one of their halves: in a half's LEAD leading bits, by which
sets are dealt, and within RADIUS of its other bits. Every set emits the variants
within half the radius in its bucket's task; two that share a variant are within
the radius, and any two within it share one. Pairs that meet are linked if the
fingerprint and the next one differ in at most CHECK_BITS bits altogether, and
all fingerprints in at most WHOLE_BITS, which drops chance meetings and most pairs
below similarity 0.6. Bits differ with probability 0.15 at similarity 0.8, so a
pair meets with probability 0.9999 (computed; 0.995 for sets of 4 and 5 shingles,
0.9999 for 5 and 6). Each candidate group is then searched exactly: sets are
linked by single linkage on exact Jaccard, so that nothing below LEAST is linked
and no pair that met is missed. Pairs are never stored; a set that is linked
leaves the search, so a group of near copies costs a few passes over it.

A group of up to GROUP_SETS sets is searched in one task. Of a larger one no task
holds more than about that many. Sets that are linked in a bucket share a key;
they first meet a head of their keys, a part at a time, which links nearly all
true copies; then the keys whose sets are not yet all linked are searched in
pairs of blocks, but for pairs within the largest linked class. Keys overlap, so
the sets of a candidate group's open keys are dealt once as a whole wherever that
makes fewer rows than dealing each key. So only a group of very many sets that
meet without being copies costs more than in proportion: a row goes to as many
tasks as there are blocks of sets outside that class.

Null, empty and blank texts have no shingles and count as copies of each other.
Texts of fewer words than a shingle are one shingle. A document is its doc_id
and text: rows that repeat both count once, rows that only share a doc_id are
told apart. Null doc_ids come after all others. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, flagged, partitions_of, stored
from .components import components
from .simhash import RADIUS, VARIANTS_AT_ONCE, ball, shingle_hashes

SHINGLE_WORDS = 5
#: Least Jaccard similarity of near copies, as numerator and denominator.
LEAST = (4, 5)
#: Fingerprints of a set; each is met by its upper and its lower half.
PRINTS = 15
#: Bits of a half, and the leading ones of them that must be equal.
HALF, LEAD = 32, 4
#: Differing bits, of 128, up to which a pair that met is linked.
CHECK_BITS = 34
#: Differing bits, of all 64 * PRINTS, up to which it is linked.
WHOLE_BITS = 240
#: Sets that share a variant, up to which all their pairs are checked at once.
FEW = 16
SEED = 42
#: Sets that one task searches, about.
GROUP_SETS = 1_000
#: Rounds in which the sets of larger groups meet heads.
ROUNDS = 2
#: Shingles counted at once within a text, so that memory doesn't follow its length.
CHUNK = 2_048

_FACTORS = np.random.default_rng(SEED).integers(0, 2**64, PRINTS, np.uint64, endpoint=False) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingle hashes of a text in order."""
    return np.unique(shingle_hashes(text, SHINGLE_WORDS))


def fingerprints(own: np.ndarray) -> list[int]:
    """PRINTS SimHash fingerprints of a set of shingle hashes, as signed 64-bit numbers; none for an empty set."""
    if not len(own):
        return []
    ones = np.zeros(64 * PRINTS, np.int64)
    for at in range(0, len(own), CHUNK):
        h = own[at : at + CHUNK, None] * _FACTORS
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        ones += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * ones > len(own), bitorder="little").view(np.int64).tolist()


def _variants(value: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The values' variants of `bits` bits within half the radius, sorted, each with its owner's place in the low 32 bits.

    They come by leading bits, so many that about VARIANTS_AT_ONCE are in memory.
    """
    half, more, rest = RADIUS // 2, 0, bits
    while more < 16 and np.bincount((value >> np.uint64(rest)).astype(np.int64)).max() * len(ball(half, 0, rest)) > VARIANTS_AT_ONCE:
        more, rest = more + 1, rest - 1
    balls = [ball(half - n, 0, rest) for n in range(half + 1)]
    tail, head, place = value & np.uint64((1 << rest) - 1), value >> np.uint64(rest), np.arange(len(value), dtype=np.uint64)
    for part in range(1 << more):
        flips = np.bitwise_count(head ^ np.uint64(part))
        made = [(((tail[own, None] ^ balls[n]) << np.uint64(32)) | place[own, None]).ravel() for n in range(half + 1) if (own := np.flatnonzero(flips == n)).size]
        if made:
            yield np.sort(np.concatenate(made))


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The labels (each set's least linked place), once a and b are linked too."""
    while (label[a] != label[b]).any():
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
    return label


def ball_classes(prints: np.ndarray, following: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
    """For each set of a bucket the least place that it reaches by links.

    prints: fingerprints (uint64) with the half that is met in the upper bits,
    of which LEAD are equal; following: each set's next fingerprint; whole: all
    fingerprints of each set as a row, without which WHOLE_BITS is not checked.
    """

    def near(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
        hit = np.bitwise_count(prints[a] ^ prints[b]) + np.bitwise_count(following[a] ^ following[b]) <= CHECK_BITS
        if whole is not None:
            hit[hit] = np.bitwise_count(whole[a[hit]] ^ whole[np.broadcast_to(b, a.shape)[hit]]).sum(axis=1, dtype=np.int64) <= WHOLE_BITS
        return hit

    bits = HALF - LEAD
    label = np.arange(len(prints))
    mixed = np.random.default_rng(SEED).integers(0, 2**64, len(prints), np.uint64, endpoint=False)
    for made in _variants((prints >> np.uint64(64 - HALF)) & np.uint64((1 << bits) - 1), bits):
        keys = made >> np.uint64(32)
        same = keys[1:] == keys[:-1]
        met = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        keys, who = keys[met], (made[met] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        if not len(who):
            continue
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(who)))
        # Variants of the same sets count once.
        own = np.unique(np.add.reduceat(mixed[who], starts), return_index=True)[1]
        few = own[sizes[own] <= FEW]
        pairs = [np.empty(0, np.int64)]
        for gap in range(1, FEW):
            for first in range(FEW - gap):
                at = starts[few[sizes[few] > first + gap]] + first
                pairs.append((who[at] << 32) | who[at + gap])
        pairs = np.unique(np.concatenate(pairs))
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        hit = near(a, b)
        label = _united(label, a[hit], b[hit])
        for g in own[sizes[own] > FEW].tolist():
            all_of = who[starts[g] : starts[g] + sizes[g]]
            if (label[all_of] == label[all_of[0]]).all():
                continue
            found = all_of[near(all_of, all_of[0])]
            label = _united(label, found, np.full_like(found, all_of[0]))
            classes, times = np.unique(label[all_of], return_counts=True)
            bulk = classes[times.argmax()]
            for one in all_of[label[all_of] != bulk].tolist():  # pairs within the bulk are linked already
                found = all_of[near(all_of, one)]
                if (label[found] != label[one]).any():
                    label = _united(label, found, np.full_like(found, one))
    return label


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """For each of the non-empty sets the first one that it reaches by pairs of LEAST or more."""
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    label, marked = np.full(len(sets), -1), np.zeros(ids.max() + 1, bool)
    rest, flat = np.arange(len(sets)), ids
    stack: list[int] = []
    while len(rest):
        if not stack:
            stack, label[rest[0]] = [int(rest[0])], rest[0]
            flat, rest = flat[sizes[rest[0]] :], rest[1:]
            continue
        one = stack.pop()
        marked[parts[one]] = True
        common = np.add.reduceat(marked[flat], np.cumsum(sizes[rest]) - sizes[rest], dtype=np.int64)
        marked[parts[one]] = False
        near = LEAST[1] * common >= LEAST[0] * (sizes[one] + sizes[rest] - common)
        if near.any():
            label[rest[near]] = label[one]
            stack += rest[near].tolist()
            flat, rest = flat[np.repeat(~near, sizes[rest])], rest[~near]
    return label


def prints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, hash (of the text), node (hash of the shingle set) and prints (its fingerprints) of every row."""
    slim = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    schema = slim.select("key", "hash").withColumn("node", F.lit(0).cast("long")).withColumn("prints", F.array().cast("array<long>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, found = [], []
            for t in batch.column("text"):
                own = shingles(t.as_py())
                nodes.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                found.append(fingerprints(own))
            made = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("hash"), *made], ["key", "hash", "node", "prints"])

    return slim.mapInArrow(run, schema)


def ball_keys(found: DataFrame) -> DataFrame:
    """node, head and band of the sets linked with another by ball hashing: those linked in a bucket share band and head, one of them."""
    sets = found.where("size(prints) > 0").dropDuplicates(["node"]).select("node", "prints", F.explode(F.sequence(F.lit(0), F.lit(2 * PRINTS - 1))).alias("piece"))
    at = F.floor(F.col("piece") / 2).cast("int")
    own = F.get("prints", at)
    half = F.when(F.col("piece") % 2 == 0, F.shiftrightunsigned(own, HALF)).otherwise(own.bitwiseAND(F.lit((1 << HALF) - 1)))
    bucket = F.col("piece") * (1 << LEAD) + F.shiftrightunsigned(half, HALF - LEAD).cast("int")
    dealt = sets.select(bucket.alias("bucket"), "node", "prints")

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, flat = (np.concatenate(c) for c in zip(*((b.column("node").to_numpy(), b.column("prints").flatten().to_numpy()) for b in batches), strict=True))
        whole, at = flat.view(np.uint64).reshape(-1, PRINTS), key[0].as_py() >> LEAD
        own, following = (np.ascontiguousarray(whole[:, k % PRINTS]) for k in (at // 2, at // 2 + 1))
        label = ball_classes(own if at % 2 == 0 else (own << np.uint64(HALF)) | (own >> np.uint64(64 - HALF)), following, whole)
        met = np.flatnonzero(np.bincount(label, minlength=len(label))[label] > 1)
        yield pa.RecordBatch.from_arrays([pa.array(node[met]), pa.array(node[label[met]]), pa.array(np.full(len(met), key[0].as_py()), pa.int32())], ["node", "head", "bucket"])

    # A bucket's work is far greater than its bytes, by which partitions would be merged.
    links = dealt.repartition(partitions_of(found.sparkSession), "bucket").groupBy("bucket").applyInArrow(run, "node long, head long, bucket int")
    return links.select("node", "head", F.xxhash64("bucket", "head").alias("band"))


def candidates(keys: DataFrame) -> DataFrame:
    """node and root (of its candidate group) of the sets of ball_keys()."""
    return components(keys.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())


def searched(rows: DataFrame, by: list[str]) -> DataFrame:
    """__node and __group, the least node that it is linked with among the rows (by, node, __text) of its group."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        for batch in batches:
            for node, t in zip(batch.column("node").to_pylist(), batch.column("__text"), strict=True):
                if node not in sets:
                    sets[node] = shingles(t.as_py())
        order = sorted(sets)
        label = linked([sets[n] for n in order])
        yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array([order[k] for k in label], pa.int64())], ["__node", "__group"])

    return rows.select(*by, "node", "__text").groupBy(*by).applyInArrow(run, "__node long, __group long")


def _parts(rows: Column, size: int) -> Column:
    return F.ceil(rows / size).cast("int")


def star_parts(met: DataFrame, texts: DataFrame, turn: int) -> DataFrame:
    """head, part, node, __text: every set of met (node, band, label) with the first head, by this turn's draw, that is not linked with it."""
    rank = F.xxhash64("node", F.lit(turn))
    heads = met.groupBy("band").agg(F.min(F.struct(rank.alias("rank"), F.col("node").alias("head"), F.col("label").alias("other"))).alias("first"))
    edges = met.join(heads.select("band", "first.*"), "band").where("label <> other").groupBy("node").agg(F.min(F.struct("rank", "head")).alias("first"))
    edges = cut_lineage(edges.select("node", "first.head"))
    counts = edges.groupBy("head").agg(F.count("*").alias("n"))
    dealt = edges.join(counts, "head").select("head", F.pmod(F.xxhash64("node"), _parts(F.col("n"), GROUP_SETS)).alias("part"), "node")
    with_heads = dealt.unionByName(dealt.select("head", "part", F.col("head").alias("node")).distinct())
    return with_heads.join(texts, "node")


def block_pairs(met: DataFrame, texts: DataFrame) -> DataFrame:
    """band, low, high, node, __text: the sets of every key of met (node, band, label) that are not all linked, in pairs of blocks.

    Keys with the same sets are searched once. If met has the root of each set's
    candidate group, all sets of a group's open keys are dealt together, by the
    root for a key, unless its keys make fewer rows one by one. Sets of the
    largest linked class have blocks of their own, which don't meet each other.
    """
    met = met if "root" in met.columns else met.withColumn("root", F.col("band"))
    same = [F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y")]
    spread = met.groupBy("root", "band").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), *same)
    mixed = spread.where("lo <> hi").groupBy("root", "n", "x", "y").agg(F.min("band").alias("band"))
    by_key = met.join(mixed.select("root", "band"), ["root", "band"]).select("root", "band", "node", "label", F.lit(False).alias("together"))
    by_group = by_key.select("root", F.col("root").alias("band"), "node", "label", F.lit(True).alias("together")).distinct()
    dealt, key = cut_lineage(by_key.unionByName(by_group)), ["root", "together", "band"]
    classes = dealt.groupBy(*key, "label").agg(F.count("*").alias("m"))
    sizes = classes.groupBy(*key).agg(F.sum("m").alias("n"), F.max(F.struct("m", "label")).alias("top")).select(*key, "n", F.col("top.m").alias("m"), F.col("top.label").alias("bulk"))
    one, half = F.col("n") <= GROUP_SETS, max(1, GROUP_SETS // 2)
    few = F.when(one, F.lit(1)).otherwise(_parts(F.col("n") - F.col("m"), half))
    many = F.when(one, F.lit(0)).otherwise(_parts(F.col("m"), half))
    plan = sizes.withColumns({"few": few, "many": many})
    made = F.when(F.col("many") == 0, F.col("n") * F.col("few")).otherwise(F.col("n") * F.col("few") + (F.col("n") - F.col("m")) * F.col("many"))
    least = plan.groupBy("root", "together").agg(F.sum(made).alias("made")).groupBy("root").agg(F.min(F.struct("made", "together")).alias("least")).select("root", "least.together")
    rows = dealt.join(plan.join(least, ["root", "together"]).select(*key, "bulk", "few", "many"), key)
    at_bulk = (F.col("label") == F.col("bulk")) & (F.col("many") > 0)
    deal = F.xxhash64("node")
    block = F.when(at_bulk, F.col("few") + F.pmod(deal, F.greatest("many", F.lit(1)))).otherwise(F.pmod(deal, F.col("few")))
    others = F.when(at_bulk, F.col("few")).otherwise(F.col("few") + F.col("many"))
    pairs = rows.select("band", "node", (F.col("few") + F.col("many")).alias("blocks"), block.alias("block"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other"))
    pairs = pairs.where("block <> other or blocks = 1")
    return pairs.select("band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node").join(texts, "node")


def split_groups(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """__node and __group of the sets of texts (node, __text) that are linked by pairs that share a key of keys (node, band, and root for block_pairs)."""
    links, met = None, keys.withColumn("label", F.col("node"))
    for turn in range(ROUNDS + 1):
        parts = star_parts(met, texts, turn) if turn < ROUNDS else block_pairs(met, texts)
        new = stored(searched(parts, ["head", "part"] if turn < ROUNDS else ["band", "low", "high"]).where("__node <> __group").distinct())
        links = new if links is None else links.unionByName(new)
        labels = components(links.select(F.col("__node").alias("a"), F.col("__group").alias("b"))).select("node", F.col("root").alias("label"))
        met = cut_lineage(keys.join(labels, "node", "left").select(*keys.columns, F.coalesce("label", "node").alias("label"))) if turn < ROUNDS else met
    return labels.select(F.col("node").alias("__node"), F.col("label").alias("__group"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies, that of the least key (then text hash), with all its columns."""
    found = cut_lineage(prints(docs, key, text))
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "hash"))
    nodes = found.groupBy("node").agg(first.alias("least"))
    met = stored(ball_keys(found))
    member = candidates(met)
    large = member.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_SETS).select("root", F.lit(True).alias("large"))
    sized = member.join(large, "root", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    sources = stored(sized.join(nodes, "node").select("node", "root", "large", F.col("least.key").alias("__key"), F.col("least.hash").alias("__hash")))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    texts = docs.select(F.col(key).alias("__own"), F.xxhash64(text).alias("__text_hash"), F.col(text).alias("__text"))
    near = flagged(texts, ["__own", "__text_hash"], sources, ["__key", "__hash"]).where("__hit")
    groups = near.join(sources.hint("merge"), same("__own", "__key") & same("__text_hash", "__hash")).select("root", "node", "large", "__text")
    if sources.where("large").isEmpty():
        verified = searched(groups, ["root"])
    else:
        groups = stored(groups)
        keys = met.join(sources.where("large").select("node", "root"), "node").select("node", "band", "root")
        split = split_groups(groups.where("large").select("node", "__text").dropDuplicates(["node"]), stored(keys))
        verified = searched(groups.where("not large"), ["root"]).unionByName(split)
    grouped = nodes.join(verified, F.col("node") == F.col("__node"), "left").groupBy(F.coalesce("__group", "node").alias("__group"))
    stay = grouped.agg(F.min("least").alias("__least")).select(F.col("__least.key").alias("__key"), F.col("__least.hash").alias("__hash"))
    # Documents that go, or whose rows repeat; all others stay where they are.
    counted = found.groupBy(F.col("key").alias("__k"), F.col("hash").alias("__h")).agg(F.count("*").alias("n"))
    judged = counted.join(stay.withColumn("__stays", F.lit(True)), same("__k", "__key") & same("__h", "__hash"), "left")
    marked = stored(judged.where("n > 1 or __stays is null").select("__k", "__h", F.coalesce("__stays", F.lit(False)).alias("__stays")))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("__own"), F.xxhash64(text).alias("__text_hash"))
    known = flagged(own, ["__own", "__text_hash"], marked, ["__k", "__h"])
    met = known.where("__hit").join(marked.hint("merge"), same("__own", "__k") & same("__text_hash", "__h"), "left").where("coalesce(__stays, true)")
    rows = Window.partitionBy("__own", "__text_hash").orderBy("__text_hash")
    once = met.withColumn("__n", F.row_number().over(rows)).where("__n = 1")
    return once.select("row.*").unionByName(known.where("not __hit").select("row.*"))
