"""Exact substring dedup: bytes under repeated strings of LENGTH bytes go, by suffix arrays.

Candidates. Every string of LENGTH bytes has an anchor: its GRAM-byte substring
of least hash. Strings with equal content have equal anchors at equal offsets,
so the starts of a text fall into segments of one anchor each, and equal strings
meet in the group of their anchor. Equal segments are merged before any shuffle
of text; a segment that occurs twice is a repeat as a whole. Groups in which
segments differ and some are single send one copy of each segment to a task.

Suffix arrays. In a group, each segment is first cut to what its left and right
context around the anchor can share with any other. The rest is sorted by
linear grouping: suffixes are grouped by first byte, groups are taken in
descending order, and each group is appended to the suffixes to which its
members' previous-smaller pointers lead, which split off by how many lead there;
then, in ascending order, each suffix places those of which it is the next
smaller. Strings of LENGTH bytes are repeats if suffixes next to each other in
the order share them.

Groups of more than GROUP_SEGMENTS segments aren't put into one task. Their
segments are cut into parts by where the anchor stands in a string, and parts
meet by the bytes that all strings of a part share. Equal parts are merged, and
what is left of a group is sorted as above, or cut finer if it is still large.

Null and empty texts, and texts shorter than LENGTH bytes, lose nothing. Equal
texts and repeated rows count as occurrences of each other. Very long texts are
read whole, in stretches. Other columns aren't read, so their names can't clash.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, flagged, stored

LENGTH = 400
GRAM = 128
#: Segments of a group that one task sorts (under 2 * LENGTH bytes each).
GROUP_SEGMENTS = 2_000
#: Bytes of a text whose anchors are found at once; positions must fit in the low bits of a key.
STRETCH = 1 << 22
_LOW = np.uint64((1 << 24) - 1)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every `size` bytes in a row, by doubling; size a power of two."""
    h, width = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    h ^= h >> np.uint64(31)
    while width < size:
        h = h[:-width] * np.uint64(0x94D049BB133111EB + 2 * width) + h[width:]
        width *= 2
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` values in a row, in time that doesn't depend on the width."""
    n = len(x)
    rows = np.full(-(-n // width) * width, _TOP)
    rows[:n] = x
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(data: bytes, length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int, int]]:
    """(anchor, segment, starts, offset of the anchor): hashes and sizes of the segments, which cover all starts in order."""
    n, out = len(data) - length + 1, []
    for low in range(0, max(n, 0), STRETCH):
        high = min(n, low + STRETCH)
        part = np.frombuffer(data, np.uint8, high - low + length - 1, low)
        hashes = gram_hashes(part, gram)
        keys = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        spots = (window_least(keys, length - gram + 1) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], spots[1:] != spots[:-1]]))
        sizes = np.diff(np.append(first, len(spots)))
        anchors = hashes[spots[first]].view(np.int64)
        for anchor, at, size, spot in zip(anchors.tolist(), first.tolist(), sizes.tolist(), spots[first].tolist(), strict=True):
            begin = low + at
            own = xxhash.xxh3_64_intdigest(data[begin : begin + size + length - 1])
            out.append((anchor, _long(own), size, spot - at))
    return out


def suffix_array(text: bytes) -> list[int]:
    """All suffixes of text in order, by linear grouping."""
    n = len(text)
    if n < 2:
        return list(range(n))
    # Groups by first byte, linked in ascending order; a member that has left its group is skipped.
    members: dict[int, list[int]] = {}
    for i, byte in enumerate(text):
        members.setdefault(byte, []).append(i)
    firsts = sorted(members)
    lists = [members[b] for b in firsts]
    number = {b: g for g, b in enumerate(firsts)}
    group = [number[b] for b in text]
    below = list(range(-1, len(lists) - 1))
    above = [*range(1, len(lists)), -1]
    smaller, skip = [-1] * n, list(range(n))  # skip: towards the nearest suffix at or before whose group is yet to come
    order: list[list[int]] = []
    at = len(lists) - 1
    while at >= 0:
        own = [i for i in lists[at] if group[i] == at]
        for i in own:
            skip[i] = i - 1
        led: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and skip[j] != j:
                up = skip[j]
                if up >= 0:
                    skip[j] = skip[up]
                j = up
            skip[i] = j
            smaller[i] = j
            if j >= 0:
                led[j] = led.get(j, 0) + 1
        order.append(own)
        if led:
            parts: dict[tuple[int, int], list[int]] = {}
            for j, times in led.items():
                parts.setdefault((group[j], times), []).append(j)
            for (old, _), moved in sorted(parts.items(), reverse=True):  # each goes right above its old group: more times end up higher
                new = len(lists)
                lists.append(moved)
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = new
                if up >= 0:
                    below[up] = new
                for j in moved:
                    group[j] = new
        at = below[at]
    # Ascending: every suffix places, at the head of their groups, those of which it is the next smaller.
    free, place = 0, [0] * len(lists)
    for own in reversed(order):
        if own:
            place[group[own[0]]] = free
            free += len(own)
    found, placed = [0] * n, bytearray(n)
    for s in range(-1, n):
        j = (n if s < 0 else found[s]) - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            g = group[j]
            found[place[g]] = j
            place[g] += 1
            j = smaller[j]
    return found


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


def _reach(contexts: list[bytes]) -> list[int]:
    """For each context, the longest prefix that it shares with any other."""
    order = sorted(range(len(contexts)), key=contexts.__getitem__)
    out = [0] * len(contexts)
    for a, b in zip(order, order[1:], strict=False):
        n = _shared(contexts[a], contexts[b])
        out[a], out[b] = max(out[a], n), max(out[b], n)
    return out


def repeats(group: list[tuple[bytes, int]], length: int = LENGTH) -> list[np.ndarray]:
    """group: (segment, offset of the anchor), all different. For each, the starts of strings that another segment or another place has."""
    left = _reach([data[:at][::-1] for data, at in group])
    right = _reach([data[at:] for data, at in group])
    pieces: dict[bytes, list[tuple[int, int]]] = {}
    for k, (data, at) in enumerate(group):
        if left[k] + right[k] >= length:
            pieces.setdefault(data[at - left[k] : at + right[k]], []).append((k, at - left[k]))
    # Equal pieces: two copies stand for all.
    text, spots = bytearray(), []
    for piece, owners in pieces.items():
        for copy in range(min(2, len(owners))):
            if not copy:
                spots.append((len(text), len(piece), owners))
            text += piece.translate(None) + b"\xff"  # a byte that UTF-8 doesn't have
    out = [np.empty(0, np.int64) for _ in group]
    if not spots:
        return out
    text = bytes(text)
    hit = np.zeros(len(text), bool)
    order = suffix_array(text)
    last, before = None, -1
    for i in order:
        now = text[i : i + length]
        if now == last and len(now) == length and b"\xff" not in now:
            hit[i] = hit[before] = True
        last, before = now, i
    for begin, size, owners in spots:
        found = np.flatnonzero(hit[begin : begin + size])
        for k, shift in owners:
            out[k] = found + shift
    return out


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of runs of following numbers."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist(), strict=True))


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tid (hash of the text) and data: together doc_id and tid name a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("tid"), F.encode(text, "UTF-8").alias("data"))


def occurrences(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """One row for each segment of each text: doc_id, tid, start, anchor, segment, starts, spot (the anchor's offset)."""
    schema = texts.select("doc_id", "tid").schema.simpleString()[7:-1].replace(":", " ")
    long, plain = pa.int64(), pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, rows = [], []
            for n, data in enumerate(batch.column("data")):
                start = 0
                for anchor, own, starts, spot in segments(data.as_py(), length, gram):
                    source.append(n)
                    rows.append((start, anchor, own, starts, spot))
                    start += starts
                if len(rows) > 200_000 or n + 1 == batch.num_rows:
                    keys = pa.array(source, pa.int64())
                    rest = _batch(rows, ["start", "anchor", "segment", "starts", "spot"], [plain, long, long, plain, plain])
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(keys), batch.column("tid").take(keys), *rest.columns], ["doc_id", "tid", *rest.schema.names])
                    source, rows = [], []

    return texts.mapInArrow(run, f"{schema}, start int, anchor long, segment long, starts int, spot int")


def _long(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def repeated_runs(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, group_segments: int = GROUP_SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """occurrences() of anchors that occur again, and anchor, segment, first, last: runs of starts within a segment whose strings occur again."""
    every = stored(occurrences(texts, length, gram))
    often = every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    # Anchors that occur once go, but for a few; no row moves for it, so a hot anchor's rows stay spread.
    found = stored(flagged(every, ["anchor"], often, ["anchor"]).where("__hit").drop("__hit"))
    holder = F.min(F.struct("doc_id", "tid", "start")).alias("holder")
    distinct = found.groupBy("anchor", "segment").agg(F.count("*").alias("times"), holder, F.first("starts").alias("starts"), F.first("spot").alias("spot"))
    distinct = cut_lineage(distinct.withColumn("single", F.col("times") == 1))
    groups = distinct.groupBy("anchor").agg(F.count("*").alias("segments"), F.max("single").alias("any_single"))
    runs = distinct.where("times > 1").select("anchor", "segment", F.lit(0).alias("first"), (F.col("starts") - 1).alias("last"))
    mixed = groups.where("segments > 1 and any_single").select("anchor", "segments")
    wanted = distinct.join(mixed.hint("merge"), "anchor").select("holder.doc_id", "holder.tid", F.struct(F.col("holder.start").alias("start"), "anchor", "segment", "starts", "spot", "single", "segments").alias("want"))
    per_text = stored(wanted.groupBy("doc_id", "tid").agg(F.collect_list("want").alias("wants")).select(F.col("doc_id").alias("__id"), F.col("tid").alias("__tid"), "wants"))
    # Without the hint the plan would broadcast on small tables and shuffle on others.
    near = flagged(texts, ["doc_id", "tid"], per_text, ["__id", "__tid"]).where("__hit").join(per_text.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tid") == F.col("__tid")))
    met = near.select("data", F.explode("wants").alias("w"))
    cut = F.substring(F.col("data"), F.col("w.start") + 1, F.col("w.starts") + length - 1)
    sent = met.select(F.col("w.anchor").alias("key"), "w.spot", "w.single", "w.anchor", "w.segment", F.lit(0).alias("shift"), cut.alias("data"), "w.segments")
    sent = stored(sent)
    most, width = mixed.agg(F.max("segments")).first()[0] or 0, length - gram + 1
    while most > group_segments:
        runs = runs.unionByName(_by_suffix_arrays(sent.where(F.col("segments") <= group_segments), length))
        width = max(1, width // 8)
        parts = cut_lineage(_split(sent.where(F.col("segments") > group_segments), width, length))
        owner = [F.min(c).alias(c) for c in ("anchor", "segment", "shift", "spot")]
        own = parts.groupBy("key", "own").agg(F.count("*").alias("times"), F.max("single").alias("single"), F.min("data").alias("data"), *owner)
        own = cut_lineage(own)
        again = own.where("times > 1").select("key", "own")
        whole = parts.where("single").join(again.hint("merge"), ["key", "own"])
        runs = runs.unionByName(whole.select("anchor", "segment", F.col("shift").alias("first"), (F.col("shift") + F.octet_length("data") - length).alias("last")))
        rest = own.withColumn("single", F.col("single") & (F.col("times") == 1))
        sizes = rest.groupBy("key").agg(F.count("*").alias("segments"), F.max("single").alias("any_single")).where("segments > 1 and any_single").select("key", "segments")
        most = sizes.agg(F.max("segments")).first()[0] or 0
        sent = rest.join(sizes.hint("merge"), "key").select("key", "spot", "single", "anchor", "segment", "shift", "data", "segments")
    return found, runs.unionByName(_by_suffix_arrays(sent, length))


def _by_suffix_arrays(sent: DataFrame, length: int) -> DataFrame:
    """Runs of repeated strings in the single segments of each group (key): one suffix array a group."""

    def of_group(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("data", "spot", "single", "anchor", "segment", "shift")), strict=True)]
        out = []
        for (_, _, single, anchor, segment, shift), starts in zip(rows, repeats([(data, spot) for data, spot, *_ in rows], length), strict=True):
            if single:  # the others are repeats as a whole
                out += [(anchor, segment, shift + a, shift + b) for a, b in _runs(starts)]
        yield _batch(out, ["anchor", "segment", "first", "last"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()])

    return sent.drop("segments").groupBy("key").applyInArrow(of_group, "anchor long, segment long, first int, last int")


def _split(sent: DataFrame, width: int, length: int) -> DataFrame:
    """The segments cut into parts whose strings have their anchor at one of `width` neighbouring offsets.

    All strings of a part share its core: what lies between the last start and
    the first end. Equal strings have equal offsets, so equal cores, and meet
    in the group of their core (key); at width 1 that is the string itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["key", "own", "spot", "single", "anchor", "segment", "shift", "data"], [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            out = []
            for data, spot, single, anchor, segment, shift in zip(*(batch.column(c).to_pylist() for c in ("data", "spot", "single", "anchor", "segment", "shift")), strict=True):
                starts = len(data) - length + 1
                for low in range((spot - starts + 1) // width * width, spot + 1, width):
                    first, last = max(0, spot - low - width + 1), min(starts - 1, spot - low)
                    core, part = data[spot - low : spot + length - low - width + 1], data[first : last + length]
                    key = xxhash.xxh3_64_intdigest(core, low)
                    out.append((_long(key), _long(xxhash.xxh3_64_intdigest(part)), spot - first, single, anchor, segment, shift + first, part))
                if len(out) > 20_000:
                    yield _batch(out, names, kinds)
                    out = []
            yield _batch(out, names, kinds)

    return sent.mapInArrow(run, "key long, own long, spot int, single boolean, anchor long, segment long, shift int, data binary")


def removals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """doc_id, data and starts (first, last) of the repeated strings of each document, as many rows as docs."""
    texts = keyed(docs)
    found, runs = repeated_runs(texts, length, gram, group_segments)
    spans = found.join(runs.hint("merge"), ["anchor", "segment"]).select(
        "doc_id", "tid", F.struct((F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last")).alias("run")
    )
    own = stored(spans.groupBy("doc_id", "tid").agg(F.collect_set("run").alias("runs")).select(F.col("doc_id").alias("__id"), F.col("tid").alias("__tid"), "runs"))
    known = flagged(texts, ["doc_id", "tid"], own, ["__id", "__tid"])
    hit = known.where("__hit").join(own.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tid") == F.col("__tid")), "left").select("doc_id", "data", "runs")
    return hit.unionByName(known.where("not __hit").select("doc_id", "data", F.lit(None).cast(own.schema["runs"].dataType).alias("runs")))


def digest(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """Bytes, removed bytes, removed runs, and hash and code points of what is left of every document.

    kept_chars leaves out bytes of characters that a removal cut in two.
    """
    found = removals(docs, length, gram, group_segments)
    kind = dict(found.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, runs in zip(batch.column("data"), batch.column("runs"), strict=True):
                data = data.as_py()
                kept, end, removed, n = bytearray(), 0, 0, 0
                stop = -1
                for x in sorted(runs.as_py() or [], key=lambda x: (x["first"], x["last"])):
                    begin, until = x["first"], x["last"] + length
                    if begin > stop:
                        kept += data[end:begin]
                        n += 1
                    begin = max(begin, end)
                    removed += max(0, until - begin)
                    end = stop = max(end, until)
                kept += data[end:]
                rows.append((len(data), removed, n, hashlib.sha256(kept).hexdigest(), len(kept.decode("utf-8", "ignore"))))
            rest = _batch(rows, ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_chars"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *rest.columns], ["doc_id", *rest.schema.names])

    return found.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_chars long")
