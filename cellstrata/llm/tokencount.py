"""Edit-aware token counts: a segment tree over each document's pre-tokens.

A byte-level BPE never merges across pre-tokens, so a text's tokens are the sum
over its pre-tokens. The leaves of a document's tree are runs of pre-tokens with
their characters and tokens; inner nodes hold the sums. An edit re-encodes from
the leaf that ends safely before it (the pattern looks ahead a few characters)
until a new pre-token ends where an old leaf ended after the edit: from there on
both texts are cut alike. Only the touched leaves and their paths to the root
change.

Trees are kept: with_trees() gives each document's leaves as a column of its row,
to be stored, and edited() takes rows with leaves and edits and gives the rows
after them, leaves included, for the next edits. A document's text, leaves and
edits stand in one row, so neither step shuffles.

Null and empty texts have a tree without leaves and no tokens. Repeated rows
and ties get equal results. Special tokens' strings are ordinary text. Further
columns come through; those of the names that a step adds are replaced. An empty
table gives an empty result. Very long texts are read whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

#: Where the ranks of the vocabulary are, and the pattern that cuts pre-tokens (fixed with the vocabulary).
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 64
#: Characters past its end on which the cut of a pre-token can depend: the rest of a contraction, or a blank and the character after it.
CONTEXT = 4
CACHED = 500_000


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Counter:
    """Counts the tokens of pre-tokens; short ones are remembered."""

    def __init__(self, path: str = RANKS):
        self.encode, self.cut, self.known = encoding(path).encode_ordinary, regex.compile(PATTERN), {}

    def of(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(piece) <= 48:
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[piece] = n
        return n

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known.get
        return [known(p) or self.of(p) for p in pieces]


class Tree:
    """Sums of characters and tokens: node 1 is the root, the leaves start at `base`."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.leaves = len(chars)
        self.base = 1 << max(0, int(self.leaves - 1).bit_length())
        self.chars, self.tokens = (np.zeros(2 * self.base, np.int64) for _ in range(2))
        for sums, leaves in ((self.chars, chars), (self.tokens, tokens)):
            sums[self.base : self.base + self.leaves] = leaves
            level = self.base
            while level > 1:
                half = level // 2
                sums[half:level] = sums[level : 2 * level : 2] + sums[level + 1 : 2 * level : 2]
                level = half

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        at = self.base + leaf
        more = (chars - self.chars[at], tokens - self.tokens[at])
        while at:
            self.chars[at] += more[0]
            self.tokens[at] += more[1]
            at //= 2

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds the character and the characters before that leaf; the last leaf for positions past the end."""
        at, before = 1, 0
        position = min(position, int(self.chars[1]) - 1)
        while at < self.base:
            at *= 2
            if position - before >= self.chars[at]:
                before += int(self.chars[at])
                at += 1
        return at - self.base, before

    @property
    def total(self) -> int:
        return int(self.tokens[1])


def build(text: str | None, counter: Counter) -> Tree:
    pieces = counter.cut.findall(text or "")
    if not pieces:
        return Tree(np.zeros(0, np.int64), np.zeros(0, np.int64))
    starts = np.arange(0, len(pieces), LEAF)
    return Tree(np.add.reduceat([len(p) for p in pieces], starts), np.add.reduceat(counter.counts(pieces), starts))


def edit(tree: Tree, text: str, at: int, removed: int, inserted: str, counter: Counter) -> tuple[Tree, str, int]:
    """Tree and text after text[at:at + removed] became inserted, and the characters encoded anew."""
    at = max(0, min(at, len(text)))
    removed = max(0, min(removed, len(text) - at))
    new = text[:at] + inserted + text[at + removed :]
    if not tree.leaves:
        return build(new, counter), new, len(new)
    first, begin = tree.find(max(0, at - CONTEXT - 1))
    if first and begin + CONTEXT > at:  # the leaf before may end otherwise
        first -= 1
        begin -= int(tree.chars[tree.base + first])
    shift = len(inserted) - removed
    last, end = first, begin  # old leaves from first up to last are replaced; end: where leaf last begins
    pieces, done = [], begin
    for piece in counter.cut.finditer(new, begin):
        if pieces and done - shift >= at + removed and done >= at + len(inserted):
            while last < tree.leaves and end < done - shift:
                end += int(tree.chars[tree.base + last])
                last += 1
            if end == done - shift:
                break
        pieces.append(piece.group())
        done = piece.end()
    else:
        last = tree.leaves
    lengths, tokens = [len(p) for p in pieces], counter.counts(pieces)
    slots = last - first
    if not slots or len(pieces) > 4 * LEAF * slots:  # the leaves would grow too large
        return build(new, counter), new, len(new)
    cuts = np.linspace(0, len(pieces), slots + 1).astype(int)
    for k in range(slots):
        tree.set(first + k, sum(lengths[cuts[k] : cuts[k + 1]]), sum(tokens[cuts[k] : cuts[k + 1]]))
    return tree, new, sum(lengths)


LEAVES = "array<struct<chars:int,tokens:int>>"


def leaves_of(tree: Tree) -> list[dict]:
    own = slice(tree.base, tree.base + tree.leaves)
    return [{"chars": c, "tokens": t} for c, t in zip(tree.chars[own].tolist(), tree.tokens[own].tolist(), strict=True)]


def tree_of(leaves: pa.ListScalar) -> Tree:
    """The tree of stored leaves; nothing is encoded."""
    own = leaves.values
    if own is None or not len(own):
        return Tree(np.zeros(0, np.int64), np.zeros(0, np.int64))
    return Tree(*(own.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("chars", "tokens")))


def with_trees(docs: DataFrame, path: str = RANKS, text: str = "text", out: str = "tree") -> DataFrame:
    """docs with the leaves of each text's tree; store it, so that later edits needn't encode the texts again."""
    kept = [c for c in docs.columns if c != out]
    schema = docs.select(*kept).withColumn(out, F.lit(None).cast(LEAVES)).schema
    kind = to_arrow_type(schema[out].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            made = pa.array([leaves_of(build(t.as_py(), counter)) for t in batch.column(text)], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*kept, out])

    return docs.select(*kept).mapInArrow(run, schema)


def edited(docs: DataFrame, edits: str = "edits", path: str = RANKS, text: str = "text", tree: str = "tree") -> DataFrame:
    """docs with text and tree after the edits, and n_tokens, n_leaves (before), n_tokens_after and n_reencoded (characters).

    docs has the leaves that with_trees() or an earlier edited() gave, and
    `edits`: an array of structs (at, removed, inserted), applied in order; null
    for none. Only what edits touch is encoded. Store the result for the next.
    """
    names = ["n_tokens", "n_leaves", "n_tokens_after", "n_reencoded"]
    kept = [c for c in docs.columns if c not in (edits, text, tree, *names)]
    schema = docs.select(*kept, text, tree).withColumns({n: F.lit(0).cast("long") for n in names}).schema
    kind = to_arrow_type(schema[tree].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            texts, trees, rows = [], [], []
            for own, leaves, changes in zip(batch.column(text), batch.column(tree), batch.column(edits), strict=True):
                now, old = tree_of(leaves), own.as_py()
                before, n_leaves, anew, new = now.total, now.leaves, 0, old
                for change in changes.as_py() or []:
                    now, new, n = edit(now, new or "", change["at"] or 0, change["removed"] or 0, change["inserted"] or "", counter)
                    anew += n
                texts.append(new)
                trees.append(leaves_of(now))
                rows.append((before, n_leaves, now.total, anew))
            counts = [pa.array([r[c] for r in rows], pa.int64()) for c in range(4)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string()), pa.array(trees, kind), *counts], [*kept, text, tree, *names])

    return docs.select(*kept, text, tree, edits).mapInArrow(run, schema)


#: The edit that digest() makes to every document: some characters at a place that its id gives become these.
EDIT_REMOVES, EDIT_INSERTS = 7, " an edited passage, 2nd version "


def digest(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """Token counts of every document from its stored tree, before and after one edit."""
    at = F.pmod(F.xxhash64("doc_id"), F.length(F.coalesce("text", F.lit(""))) + 1).cast("int")
    change = F.struct(at.alias("at"), F.lit(EDIT_REMOVES).alias("removed"), F.lit(EDIT_INSERTS).alias("inserted"))
    trees = stored(with_trees(docs.select("doc_id", "text"), path))
    found = edited(trees.withColumn("edits", F.array(change)), path=path)
    return found.select("doc_id", "n_tokens", "n_leaves", "n_tokens_after", "n_reencoded")
