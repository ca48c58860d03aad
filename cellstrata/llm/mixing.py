"""Mixing sources to target weights by blocks of words.

The words of each source, documents in a pseudorandom but fixed order, are
packed into blocks of fixed length (the last may be shorter). A source is due
`target` words: so many slots, of which the last takes only the words that are
still due. How many of a source's slots each output shard gets is a multinomial
draw, given the source's total; the shards take the slots in order, each its
count. Slot k of a source is mapped through that source's pseudorandom permutation of its blocks
(a new one for each pass over the source), and blocks join slots by index. A
target is at most twice a source's size, so no block is drawn more than twice.

Sources go by code point, null last. Null and empty texts have no words and
take none; a source without words gets target 0. Repeated rows are separate
documents with equal keys; which of them takes which words is then open, but
they are alike. Very long texts lie in many blocks and are read whole. Columns
that aren't named here aren't read, or come through unchanged. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RUN, cut_lineage, parts_for, with_offsets, word_count

BLOCK_WORDS = 64
OUTPUT_SHARDS = 64
SEED = 7
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """sizes: one row a source (source, source_size). Adds number (from 0) and target.

    Shares by weight, where what is above cap * size is shared again by weight,
    end at one level: target = least of cap * size and level * weight. The level
    follows from running sums over the sources by cap * size / weight.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    options = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("number", F.row_number().over(by_name) - 1)
    weighed = weighed.withColumn("weight", F.element_at(options, F.col("number") % len(weights) + 1)).withColumn("most", cap * F.col("source_size"))
    by_fill = everything.orderBy(F.col("most") / F.col("weight"), "number")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    due = F.sum("source_size").over(everything) * share
    level = (due - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    open_level = F.when(level <= F.col("most") / F.col("weight"), level)
    found = weighed.withColumn("open_level", open_level).withColumn("level", F.max("open_level").over(everything))  # the first that is open is the highest
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return found.select("source", "source_size", "number", target.alias("target"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(size) for each key: four Feistel rounds over the next even number of bits; results beyond the size are put through again."""
    size = np.maximum(size.astype(np.int64), 1)
    half = np.maximum((np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2, 1).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64).copy(), np.arange(len(index))
    key = key.astype(np.int64).astype(np.uint64)
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (_mix(right + k * np.uint64(4) + np.uint64(turn)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.xxhash64("text").alias("__text"), word_count(F.col("text")).alias("size"))


def shard_counts(n: int, number: int, shards: int, seed: int) -> list[int]:
    """Slots of each output shard: a multinomial draw of a source's n slots over equally likely shards."""
    return np.random.default_rng([seed, number]).multinomial(n, np.full(shards, 1 / shards)).tolist()


def slots(goals: DataFrame, block_words: int, shards: int, seed: int) -> DataFrame:
    """number, slot, turn (the pass over the source), shard, block and take (words of the block, from its start) of every slot of every source.

    Runs of slots are expanded after they are dealt out, so no task makes all
    slots of a large source or shard.
    """
    run = 4096
    due = goals.where((F.col("source_size") > 0) & (F.round("target") > 0)).select(
        "number", F.col("source_size").alias("size"), F.round("target").cast("long").alias("due")
    )
    blocks = F.ceil(F.col("size") / block_words)
    passes = F.floor(F.col("due") / F.col("size"))
    rest = F.col("due") - passes * F.col("size")
    counted = due.withColumn("blocks", blocks).withColumn("n", (passes * blocks + F.ceil(rest / block_words)).cast("long"))

    @F.pandas_udf("array<long>")
    def counts_of(n: pd.Series, number: pd.Series) -> pd.Series:
        return pd.Series([shard_counts(int(a), int(b), shards, seed) for a, b in zip(n, number, strict=True)])

    drawn = counted.select("*", F.posexplode(counts_of("n", "number")).alias("shard", "count"))
    before = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    laid = drawn.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0))).where("count > 0")
    runs = laid.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("count") - 1) / run))))
    dealt = runs.repartition("number", "shard", "run")
    within = F.sequence(F.col("run") * run, F.least((F.col("run") + 1) * run, F.col("count")) - 1)
    each = dealt.withColumn("slot", F.explode(within)).withColumn("slot", F.col("first") + F.col("slot"))

    @F.pandas_udf("long")
    def block_of(slot: pd.Series, size: pd.Series, blocks: pd.Series, number: pd.Series) -> pd.Series:
        turn, at = slot // blocks, slot % blocks
        full = size // block_words  # a shorter last block stays last in each pass
        spot = permuted(np.minimum(at, np.maximum(full - 1, 0)).to_numpy(), full.to_numpy(), (number * 1_000_003 + turn * 101 + seed).to_numpy())
        return pd.Series(np.where(at < full, spot, at))

    turn, at = F.floor(F.col("slot") / F.col("blocks")), F.col("slot") % F.col("blocks")
    left = F.col("due") - turn * F.col("size") - at * block_words
    return each.select(
        "number", "slot", turn.cast("int").alias("turn"), "shard", block_of("slot", "size", "blocks", "number").alias("block"),
        F.least(left, F.lit(block_words)).cast("long").alias("take"),
    )


def pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """doc, number, block, start and stop (in the block): the words of each document in each block it touches. placed has doc columns, number, size and offset."""
    some = placed.where(F.col("size") > 0)
    first, last = F.floor(F.col("offset") / block_words), F.floor((F.col("offset") + F.col("size") - 1) / block_words)
    each = some.withColumn("block", F.explode(F.sequence(first, last)))
    base = F.col("block") * block_words
    return each.withColumn("start", F.greatest(F.col("offset") - base, F.lit(0))).withColumn(
        "stop", F.least(F.col("offset") + F.col("size") - base, F.lit(block_words))
    )


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, __text, size, source_size, target, number, offset) and draws (number, offset, shard, slot, block, start, stop, words).

    A document is known by its source's number and its offset there. draws has
    one row for each piece of a document in each slot that takes of it.
    """
    docs = cut_lineage(sized(docs))
    goals = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")))
    named = goals.withColumnRenamed("source", "__source")
    known = docs.join(F.broadcast(named) if _few(goals) else named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    order = [F.xxhash64(F.lit(seed), F.col("doc_id")), F.col("doc_id"), F.col("__text"), F.col("size")]
    placed = with_offsets(known, "number", order, F.col("size"), "offset", parts_for(docs.count()))
    parts = pieces(placed.select("number", "size", "offset"), block_words).drop("size")
    # Both sides are expanded from few rows, so their size is underrated: never broadcast.
    drawn = parts.join(slots(goals, block_words, shards, seed).hint("merge"), ["number", "block"])
    words = F.least(F.col("stop"), F.col("take")) - F.col("start")
    return placed, drawn.withColumn("words", words.cast("long")).where(F.col("words") > 0)


#: Sources up to which their table (a few dozen bytes a row) is broadcast.
FEW_SOURCES = 10_000


def _few(goals: DataFrame) -> bool:
    return goals.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES


def digest(docs: DataFrame) -> DataFrame:
    """The words that the mix takes of every document, repeats counted, and over how many output shards they go."""
    placed, draws = mixed(docs)
    met = F.expr("bit_or(shiftleft(1L, shard))")  # a bit for each of OUTPUT_SHARDS, which are 64
    taken = draws.groupBy("number", "offset").agg(F.sum("words").alias("taken"), met.alias("met"))
    own = F.col("size") > 0  # a document without words shares its offset with the next
    return placed.join(taken, ["number", "offset"], "left").select(
        "doc_id", "size", "source_size", "target", F.when(own, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken"),
        F.when(own, F.bit_count(F.coalesce("met", F.lit(0).cast("long")))).otherwise(0).cast("long").alias("n_shards"),
    )


def taken_text(text: str, pieces: list[tuple[int, int]]) -> str:
    """The words of the pieces (first, stop), in order: the text itself if these are all, else its stretches joined by blanks."""
    spans = [m.span() for m in re.finditer(WORD_RUN, text)]
    runs: list[list[int]] = []
    for first, stop in sorted(pieces):
        if runs and runs[-1][1] == first:
            runs[-1][1] = stop
        else:
            runs.append([first, stop])
    if runs == [[0, len(spans)]]:
        return text
    return " ".join(text[spans[a][0] : spans[b - 1][1]] for a, b in runs)


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS, seed: int = SEED) -> DataFrame:
    """The mix as documents: for each pass over its source, a document with the words taken of it, if any.

    All columns stay; text becomes the words taken and n_chars, where there is
    such a column, its length.
    """
    placed, draws = mixed(docs, block_words, shards, seed)
    size = F.col("start") + F.col("block") * block_words - F.col("offset")
    piece = F.struct(F.col("turn").alias("turn"), size.alias("first"), (size + F.col("words")).alias("stop"))
    lists = draws.groupBy("number", "offset").agg(F.collect_list(piece).alias("pieces"))
    own = placed.where("size > 0").join(lists, ["number", "offset"])
    plans = own.groupBy("doc_id", "__text").agg(F.sort_array(F.collect_list(F.struct("number", "offset", "pieces"))).alias("__copies"))
    plans = plans.select(F.col("doc_id").alias("__id"), F.col("__text").alias("__plan"), "__copies")
    keyed = docs.withColumn("__hash", F.xxhash64("text"))
    met = keyed.join(plans, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__plan")))
    copy = Window.partitionBy("doc_id", "__hash").orderBy("source")
    ready = met.withColumn("__pieces", F.get("__copies", F.row_number().over(copy) - 1)["pieces"]).where("__pieces is not null")
    columns = docs.columns
    at, counts = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, texts = [], []
            for n, (text, pieces) in enumerate(zip(batch.column("text"), batch.column("__pieces"), strict=True)):
                turns: dict[int, list[tuple[int, int]]] = {}
                for p in pieces.as_py():
                    turns.setdefault(p["turn"], []).append((p["first"], p["stop"]))
                for turn in sorted(turns):
                    source.append(n)
                    texts.append(taken_text(text.as_py(), turns[turn]))
            rows = batch.select(columns).take(pa.array(source, pa.int64()))
            rows = rows.set_column(at, "text", pa.array(texts, rows.schema.field("text").type))
            if counts is not None:
                rows = rows.set_column(counts, "n_chars", pa.array([len(t) for t in texts]).cast(rows.schema.field("n_chars").type))
            yield rows

    return ready.select(*columns, "__pieces").mapInArrow(run, docs.schema)
