"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are lower-cased and white space becomes one blank. An item of m
characters is in a document if some stretch of the document is within e edits,
e = BUDGET * m. Such a stretch shares at least m + 1 - q * (e + 1) q-grams with
the item, on diagonals that span at most e + 1. Three steps, each keeping all
true places: windows of the document with too few q-grams of any item go;
shared q-grams are counted for each item in overlapping bands of diagonals,
and bands under the bound go; a banded alignment settles the rest.

Items shorter than q characters are sought as they stand, between blanks; for
other short items e shrinks until the bound is positive. Empty and null items
match nothing; null and empty documents have no places. Equal items and
repeated rows are matched each by itself. Other columns aren't read. Empty
tables give an empty result. Documents are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

Q = 8
BUDGET = 0.08
#: Characters of benchmark text that are indexed and broadcast at once; more is worked through in blocks.
BLOCK_CHARS = 8_000_000
_P = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of every q characters in a row, by doubling; q a power of two."""
    h, width = chars.astype(np.uint64) * _P, 1
    h ^= h >> np.uint64(29)
    while width < q:
        if len(h) <= width:
            return np.empty(0, np.uint64)
        h = h[:-width] * np.uint64(0xBF58476D1CE4E5B9 + 2 * width) + h[width:]
        width *= 2
    return h


@dataclass
class Index:
    """Postings of the items' q-grams, sorted by hash, and what the filters need."""

    ids: list
    texts: list[str]
    edits: np.ndarray
    bound: np.ndarray
    grams: np.ndarray
    item: np.ndarray
    at: np.ndarray
    table: np.ndarray
    short: list[int]
    windows: list[tuple[int, int]]
    reach: int


def budget_of(m: int, q: int = Q, budget: float = BUDGET) -> int:
    return max(0, min(int(budget * m), m // q - 1))


def build(rows: list[tuple], q: int = Q, budget: float = BUDGET) -> Index:
    """rows: (item id, text)."""
    kept = [(i, t) for i, t in ((i, normal(t)) for i, t in rows) if t]
    texts = [t for _, t in kept]
    edits = np.array([budget_of(len(t), q, budget) for t in texts], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    bound = sizes + 1 - q * (edits + 1)
    hashes = [gram_hashes(codes(t), q) for t in texts]
    item = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
    at = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
    grams = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    order = np.argsort(grams, kind="stable")
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[(grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
    long = sizes >= q
    spans, windows = (sizes + edits)[long], []
    order_by_span = np.argsort(spans)
    spans, bounds = spans[order_by_span], bound[long][order_by_span]
    while len(spans):  # classes of items of like length: their longest span and least bound
        inside = spans <= 1.2 * spans[0]
        windows.append((int(spans[inside].max()), int(max(1, bounds[inside].min()))))
        spans, bounds = spans[~inside], bounds[~inside]
    reach = int((sizes + edits)[long].max()) if long.any() else 0
    return Index([i for i, _ in kept], texts, edits, bound, grams[order], item[order], at[order].astype(np.int64), table, np.flatnonzero(~long).tolist(), windows, reach)


def regions(hit: np.ndarray, index: Index) -> list[tuple[int, int]]:
    """Stretches (of gram positions) around windows with enough q-grams of any item."""
    n = len(hit)
    total = np.zeros(n + 1, np.int32)
    np.cumsum(hit, out=total[1:])
    enough = []
    for size, least in index.windows:
        size = min(size, n)
        starts = np.flatnonzero(total[size:] - total[: n + 1 - size] >= least)
        if len(starts):
            enough += [starts, starts + size]
    if not enough:
        return []
    enough = np.unique(np.concatenate(enough))
    cut = np.flatnonzero(np.diff(enough) > 2 * index.reach) + 1
    return [(max(0, int(part[0]) - index.reach), min(n, int(part[-1]) + index.reach)) for part in np.split(enough, cut)]


def align(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int] | None:
    """Least edits of the item against any stretch of text that ends in it, and that end; None if over most.

    Row by row over the item; the columns are the band. Insertions along a row
    are a running minimum.
    """
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, char in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = k
        new[1:] = np.minimum(row[:-1] + (text != char), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
        if row.min() > most:
            return None
    end = int(row.argmin())
    return int(row[end]), end


def begin_of(item: np.ndarray, text: np.ndarray) -> int:
    """Where the best stretch that ends with text begins: the item against it from the end, with that end fixed."""
    steps = np.arange(len(text) + 1)
    row, text = steps.copy(), text[::-1]
    for k, char in enumerate(item[::-1], 1):
        new = np.empty_like(row)
        new[0] = k
        new[1:] = np.minimum(row[:-1] + (text != char), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return len(text) - int(row.argmin())


def matches(text: str | None, index: Index, q: int = Q) -> list[tuple]:
    """(number of the item, edits, start, stop) of the best place of each item in the text, offsets in the normal text."""
    line = normal(text)
    found: dict[int, tuple] = {}
    for k in index.short:
        own = index.texts[k]
        at = f" {line} ".find(f" {own} ")
        if at >= 0:
            found[k] = (0, at, at + len(own))
    chars = codes(line)
    grams = gram_hashes(chars, q)
    if not len(grams) or not len(index.grams):
        return [(k, *v) for k, v in sorted(found.items())]
    hit = index.table[(grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
    for low, high in regions(hit, index):
        spots = low + np.flatnonzero(hit[low:high])
        left, right = (np.searchsorted(index.grams, grams[spots], side) for side in ("left", "right"))
        count = right - left
        where = np.repeat(left - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        item, diagonal = index.item[where], np.repeat(spots, count) - index.at[where]
        width = index.edits[item] + 1
        band = diagonal // width  # a band covers two widths: this and the next
        if not len(band):  # the table has only the hashes' leading bits
            continue
        lowest = int(band.min()) - 1
        bands = int(band.max()) - lowest + 1
        code = item * bands + band - lowest
        code = np.sort(np.concatenate([code, code - 1]))
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        counts, code = np.diff(np.append(starts, len(code))), code[starts]
        for one in code[counts >= index.bound[code // bands]]:
            k, b = int(one // bands), int(one % bands) + lowest
            own, e = codes(index.texts[k]), int(index.edits[k])
            begin = max(0, int(b) * (e + 1) - e)
            end = min(len(chars), (int(b) + 2) * (e + 1) + len(own) + e)
            best = align(own, chars[begin:end], e)
            if best is not None:
                stop = begin + best[1]
                if best[0] < found.get(int(k), (e + 1,))[0]:
                    low = max(begin, stop - len(own) - e)
                    found[int(k)] = (best[0], low + begin_of(own, chars[low:stop]), stop)
    return [(k, *v) for k, v in sorted(found.items())]


def item_blocks(benchmark: DataFrame) -> list:
    """The benchmark's rows as broadcasts of BLOCK_CHARS at most (longer only where one hash part holds more)."""
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(size // BLOCK_CHARS) + 1
    out = []
    for number in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        out.append(benchmark.sparkSession.sparkContext.broadcast([tuple(r) for r in part.select("item_id", "text").collect()]))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", q: int = Q, budget: float = BUDGET) -> DataFrame:
    """key, item_id, edits, start, stop: one row for each document row and item found in it. Each block of items is sought in all documents."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    id_type = benchmark.schema["item_id"].dataType
    schema = f"key {dict(slim.dtypes)['key']}, item_id {id_type.simpleString()}, edits int, start long, stop long"

    def of_block(rows) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = build(rows.value, q, budget)
            for batch in batches:
                source, out = [], []
                for n, t in enumerate(batch.column("text")):
                    for place in matches(t.as_py(), index, q):
                        source.append(n)
                        out.append((index.ids[place[0]], *place[1:]))
                columns = [batch.column("key").take(pa.array(source, pa.int64()))]
                kinds = (to_arrow_type(id_type), pa.int32(), pa.int64(), pa.int64())
                columns += [pa.array([row[c] for row in out], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "item_id", "edits", "start", "stop"])

        return slim.mapInArrow(run, schema)

    return reduce(DataFrame.unionByName, [of_block(rows) for rows in item_blocks(benchmark)])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", q: int = Q, budget: float = BUDGET) -> DataFrame:
    """The documents in which no item is found, with all their columns and without a shuffle."""

    def without(docs: DataFrame, rows) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = build(rows.value, q, budget)
            for batch in batches:
                yield batch.filter(pa.array([not matches(t.as_py(), index, q) for t in batch.column(text)], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)

    return reduce(without, item_blocks(benchmark), docs)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contaminated(docs, benchmark)
    return found.select(F.col("key").alias("doc_id"), "item_id", "edits", "start", "stop")
