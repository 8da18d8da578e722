"""Sharding by a hierarchical weighted hash tree.

A key descends from region to rack to shard. At every level each child draws a number from a hash
of the key and the child's own name, scaled by the child's weight (an exponential
variate of that rate), and the smallest draw wins. A child's draw does not depend on its siblings,
so changing a weight moves keys only into or out of the subtree whose weight changed. A
shard added as a region of its own therefore takes keys from everywhere, only into itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, stage_once, with_slots

SHARDS = 40
REGIONS = 5
RACKS = 2  # in each region
ROW_BYTES = 16  # fixed value: added to the text's bytes


class Leaf(NamedTuple):
    """A shard, its place and its weight."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int = SHARDS, regions: int = REGIONS, racks: int = RACKS) -> list[Leaf]:
    """Shards of weight one, dealt in order over the racks of the regions."""
    nests = regions * racks
    return [Leaf(i * nests // shards // racks, i * nests // shards, i) for i in range(shards)]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region and rack of its own, so that no other shard gains a key."""
    new = Leaf(
        1 + max(x.region for x in tree),
        1 + max(x.rack for x in tree),
        1 + max(x.shard for x in tree),
        weight,
    )
    return [*tree, new]


def _draw(key: Column, level: str, child: Column, weight: Column) -> Column:
    """An exponential variate of rate ``weight`` for this key and child."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), key, child), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / weight


def _choose(key: Column, level: str, children: Column) -> Column:
    """The child of least draw; of equal draws the least child."""
    drawn = F.transform(
        children,
        lambda c: F.struct(
            _draw(key, level, c["id"], c["weight"]).alias("draw"), c["id"].alias("id")
        ),
    )
    return F.array_min(drawn)["id"]


def shard_of(tree: list[Leaf], key: Column) -> Column:
    """The shard of a key; all null keys go to one shard."""
    weight: dict[tuple, float] = {}
    below: dict[tuple, set[int]] = {}
    for leaf in tree:
        path = (leaf.region, leaf.rack, leaf.shard)
        for depth in range(1, 4):
            weight[path[:depth]] = weight.get(path[:depth], 0.0) + leaf.weight
            below.setdefault(path[: depth - 1], set()).add(path[depth - 1])

    def children(path: tuple) -> Column:
        return F.array(
            *(
                F.struct(F.lit(c).alias("id"), F.lit(weight[*path, c]).alias("weight"))
                for c in sorted(below[path])
            )
        )

    def by_parent(depth: int) -> Column:
        """Children of each node of a level, by the node's number."""
        paths = {path[-1]: path for path in below if len(path) == depth}
        pairs = [x for n in sorted(paths) for x in (F.lit(n), children(paths[n]))]
        return F.create_map(*pairs)

    region = _choose(key, "region", children(()))
    rack = _choose(key, "rack", F.element_at(by_parent(1), region))
    return _choose(key, "shard", F.element_at(by_parent(2), rack)).cast("int")


def assign(docs: DataFrame, tree: list[Leaf] | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``key``: ``doc_id`` and the tree decide, whatever the text. ``size`` is
    the text's UTF-8 bytes and 16 more; a null text counts as empty. Rows of equal or null
    ``doc_id`` share a shard and have slots of their own. Other columns are ignored;
    an empty table gives no rows. Texts are read once and never shuffled; a shard's slots are
    numbered in buckets, so no task holds a whole shard.
    """
    tree = even_tree() if tree is None else tree
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(tree, F.col("doc_id")).alias("shard"),
        shard_of(grown(tree), F.col("doc_id")).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row"),
    )
    staged = stage_once(rows, "shards")
    return with_slots(staged, ["shard"], ["row"], staged.count()).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
