"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws
-ln(u) / weight, u a hash of doc_id and the child's name in (0, 1), and the
least draw wins, so children win in proportion to their weights. If a weight
grows, rows move only into that child's subtree; other draws don't change.

doc_id alone places a row: equal texts go where their ids say. A null doc_id
is hashed as no value, so all such rows share a shard. Repeated rows share a
shard and get slots of their own; ties are broken by the text's hash. Null
texts count as no bytes, very long ones like any other. Columns other than doc_id and text aren't read by
digest(); assign() replaces a column of the name it adds. An empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, with_offsets

OVERHEAD = 16


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. Leaves have a shard number and a weight; other weights are the sum of their children's."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(regions: int = 4, racks: int = 2, shards: int = 5) -> Node:
    """A tree of regions * racks * shards shards of equal weight, numbered from 0."""
    number = iter(range(regions * racks * shards))
    return Node("root", tuple(
        Node(f"region{r}", tuple(
            Node(f"region{r}/rack{k}", tuple(Node(f"shard{n}", shard=n) for n in (next(number) for _ in range(shards))))
            for k in range(racks)))
        for r in range(regions)))


def leaves(node: Node) -> list[Node]:
    return [x for c in node.children for x in leaves(c)] if node.children else [node]


def grown(root: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region and rack of its own, so that no older subtree's weight changes and rows move only into it."""
    n, r = len(leaves(root)), len(root.children)
    leaf = Node(f"shard{n}", shard=n, own_weight=weight)
    return Node("root", (*root.children, Node(f"region{r}", (Node(f"region{r}/rack0", (leaf,)),))))


def _levels(root: Node) -> list[list[Node]]:
    found = [[root]]
    while any(n.children for n in found[-1]):
        found.append([c for n in found[-1] for c in n.children])
    return found


def placed(docs: DataFrame, key: str, root: Node, out: str) -> DataFrame:
    """docs with the shard of each row: level by level, the child with the least draw.

    All leaves stand on one level. The tree is a literal: for each node of a
    level the (name, weight, number) of its children, numbered over the next.
    """
    levels, at = _levels(root), "__node"
    docs = docs.withColumn(at, F.lit(0))
    for level in levels[:-1]:
        number, nodes = 0, []
        for node in level:
            nodes.append(F.array(*[F.struct(F.lit(c.name).alias("name"), F.lit(float(c.weight)).alias("weight"), F.lit(number + i).alias("number")) for i, c in enumerate(node.children)]))
            number += len(node.children)

        def draw(child: Column) -> Column:
            u = (F.shiftrightunsigned(F.xxhash64(F.col(key), child["name"]), 11).cast("double") + 0.5) / float(2**53)
            return F.struct((-F.ln(u) / child["weight"]).alias("draw"), child["number"].alias("number"))

        docs = docs.withColumn(at, F.array_min(F.transform(F.element_at(F.array(*nodes), F.col(at) + 1), draw))["number"])
    shards = F.array(*[F.lit(leaf.shard) for leaf in levels[-1]])
    return docs.withColumn(out, F.element_at(shards, F.col(at) + 1).cast("int")).drop(at)


def assign(docs: DataFrame, root: Node, out: str = "shard", key: str = "doc_id") -> DataFrame:
    return placed(docs, key, root, out)


def digest(docs: DataFrame, root: Node | None = None) -> DataFrame:
    """Shard, slot and the shard after growth of every document."""
    root = root or tree()
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    both = assign(assign(slim, root), grown(root), "grown_shard")
    slots = with_offsets(both, "shard", [F.col("doc_id"), F.col("text_crc32"), F.col("size")], F.lit(1).cast("long"), "slot", parts_for(docs.count()))
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
