"""Helpers the text operators share: exact column choice, components, gapless slots."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import discard, scratch_path, stage_at

FOLDS = 5  # fixed value: one fold in five is held out
SLICE_ROWS = 400  # documents whose terms are counted at a time
BLOCK_ROWS = 4096  # members of a group compared in one task
BROADCAST_GROUPS = 100_000  # keys of large groups sent to every task; beyond, a join shuffles
DRAW_BITS = 62  # of a hash, drawn to choose rows
SLOT_ROWS = 200_000  # rows ranked in one task


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns, whatever other columns exist.

    An exact name wins over one that differs in case, the first of equal names
    over later ones, so clashing extra columns are never ambiguous.
    """
    columns = df.columns
    lower = [c.lower() for c in columns]
    plain = df.toDF(*(f"c{i}" for i in range(len(columns))))
    places = [
        columns.index(n) if n in columns else lower.index(n.lower()) for n in names
    ]
    return plain.select(*(F.col(f"c{p}").alias(n) for p, n in zip(places, names)))


class Carried:
    """A table under plain column names, so that columns can be added without clashes.

    ``plain`` is the table, ``name`` gives a column's plain name (chosen as in
    :func:`pick`), ``back`` restores all columns, names and order.
    """

    def __init__(self, df: DataFrame) -> None:
        self.names = df.columns
        self.keys = [f"c{i}" for i in range(len(self.names))]
        self.plain = df.toDF(*self.keys)

    def name(self, column: str) -> str:
        lower = [c.lower() for c in self.names]
        exact = column in self.names
        return self.keys[self.names.index(column) if exact else lower.index(column.lower())]

    def back(self, df: DataFrame, **changed: str) -> DataFrame:
        """``df`` with the original columns; ``changed`` maps a column to its new source."""
        swap = {self.name(c): source for c, source in changed.items()}
        return df.select(*(F.col(swap.get(k, k)) for k in self.keys)).toDF(*self.names)


def held_out(doc_id: Column) -> Column:
    """True for the fold no learner sees; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), FOLDS) == 0


def share_bound(wanted: int, n: int) -> int:
    """The bound below which ``DRAW_BITS`` random bits are for about ``wanted`` of ``n`` rows.

    It is above 0 for any number of rows that a table can have.
    """
    return (1 << DRAW_BITS) * min(wanted, max(n, 1)) // max(n, 1)


def stage_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the caller's result depends on it."""
    return stage_at(df, scratch_path(df.sparkSession, name))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, to bound what a task holds at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
        pa.default_memory_pool().release_unused()


def text_slices(values: pa.Array, rows: int = SLICE_ROWS) -> Iterator[list]:
    """Python values of an Arrow array, a few at a time; what Arrow held goes back to the system."""
    for low in range(0, len(values), rows):
        yield values.slice(low, rows).to_pylist()
    pa.default_memory_pool().release_unused()


# ---------------------------------------------------------------- groups in blocks


def in_blocks(
    rows: DataFrame,
    keys: list[str],
    member: str,
    limit: int = BLOCK_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``rows`` with ``block_a``, ``block_b``: tasks in which members of a group meet.

    A group of up to ``limit`` rows is one block. A larger one is dealt into
    ``g`` chunks by a hash of ``member`` and every pair of chunks is a block, so
    each row is repeated ``g`` times, no task gets more than about two chunks, and
    every two members meet in at least one block. Nothing is dropped. ``counted``
    may give the keys of all rows without their other columns.
    """
    large = stage_once(
        (rows if counted is None else counted)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_group"))
        .where(F.col("n_group") > limit)
        .select(*keys, F.ceil(F.col("n_group") / limit).cast("int").alias("n_chunks")),
        "large-groups",
    )
    n_large = large.count()
    if n_large == 0:
        return rows.select(
            "*", *(F.lit(0).alias(c) for c in ("chunk", "block_a", "block_b"))
        )
    if n_large <= BROADCAST_GROUPS:
        large = F.broadcast(large)
    chunk = F.pmod(F.xxhash64(F.lit(7), F.col(member)), F.col("n_chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("other")
    return (
        rows.join(large, keys, "left")
        .withColumn("n_chunks", F.coalesce("n_chunks", F.lit(1)))
        .withColumn("chunk", F.when(F.col("n_chunks") > 1, chunk).otherwise(F.lit(0)))
        .select("*", other)
        .withColumn("block_a", F.least("chunk", "other"))
        .withColumn("block_b", F.greatest("chunk", "other"))
        .drop("n_chunks", "other")
    )


def sorted_groups(
    batches: Iterator[pa.RecordBatch], n_keys: int
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows sorted by their first ``n_keys`` columns.

    Yields a table and the start of each group in it, plus its length. A group
    that crosses Arrow batches is put together first.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:
            last = held[-1]
            same = all(
                last.column(k)[-1].as_py() == batch.column(k)[-1].as_py() for k in range(n_keys)
            )
            if same:  # still inside one group
                held.append(batch)
                continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        starts = group_starts(table, n_keys)
        cut = int(starts[-1])
        if cut:
            yield table.slice(0, cut), starts
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.append(group_starts(table, n_keys), table.num_rows)


def group_starts(table: pa.Table, n_keys: int) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for k in range(n_keys):
        values = table.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def spanning_links(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of ``n`` members; ``near(i, left)`` says which of ``left`` i links."""
    left = np.arange(n)
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = near(i, left)
            if hit.any():
                found = left[hit]
                left = left[~hit]
                queue.extend(found.tolist())
                yield from ((i, j) for j in found.tolist())


# ---------------------------------------------------------------- components


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``links`` (columns ``a``, ``b``, long).

    The label is the smallest node reachable. Alternates large-star and small-star
    steps until nothing changes. Each step groups by node with a combinable
    minimum and joins it back, so a hub is one row per task in the aggregation.
    Every round is written to the shared folder, and the one before it deleted.
    """
    spark = links.sparkSession
    one = (
        links.where("a <> b")
        .select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .distinct()
    )
    path = scratch_path(spark, "links")
    state = stage_at(one, path)
    before = _fingerprint(state)
    while before[0]:
        nxt = scratch_path(spark, "links")
        state = stage_at(_small_star(_large_star(state)), nxt)
        now = _fingerprint(state)
        discard(spark, path)
        path = nxt
        if now == before:
            break
        before = now
    roots = state.select(F.col("low").alias("node"), F.col("low").alias("label")).distinct()
    return state.select(F.col("high").alias("node"), F.col("low").alias("label")).union(roots)


def _fingerprint(links: DataFrame) -> tuple:
    mixed = F.xxhash64("low", "high")
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftright(mixed, 20)).alias("s"),
        F.bit_xor(mixed).alias("x"),
    ).first()
    return (row["n"], row["s"], row["x"])


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    both = links.select(F.col("low").alias("u"), F.col("high").alias("v")).union(
        links.select(F.col("high").alias("u"), F.col("low").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.least("m", "u").alias("low"), F.col("v").alias("high"))
        .where("low < high")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
    moved = links.join(least, links["high"] == least["u"]).where("low <> m")
    return (
        moved.select(F.col("m").alias("low"), F.col("low").alias("high"))
        .union(least.select(F.col("m").alias("low"), F.col("u").alias("high")))
        .distinct()
    )


# ---------------------------------------------------------------- slots


def with_slots(df: DataFrame, keys: list[str], order: list[str], rows: int) -> DataFrame:
    """``df`` with ``slot``: 0, 1, 2, … without gaps within each value of ``keys``.

    ``rows`` is the number of rows of ``df``. A group of any size is ranked in buckets
    of at most about ``SLOT_ROWS`` rows dealt by a hash of ``order``, as many as shuffle partitions at
    least; bucket sizes are then summed per group (one row per bucket). ``order`` must name rows up to
    repeats of equal rows, so a task that runs again gives the same slots.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(partitions, math.ceil(rows / SLOT_ROWS))
    dealt = df.withColumn("slot_bucket", F.pmod(F.xxhash64(F.lit(11), *order), n).cast("int"))
    sizes = dealt.groupBy(*keys, "slot_bucket").agg(F.count(F.lit(1)).alias("slot_n"))
    before = Window.partitionBy(*keys).orderBy("slot_bucket")
    offsets = sizes.select(
        *keys,
        "slot_bucket",
        (F.sum("slot_n").over(before) - F.col("slot_n")).alias("slot_offset"),
    )
    within = Window.partitionBy(*keys, "slot_bucket").orderBy(*order)
    ranked = dealt.withColumn("slot_rank", F.row_number().over(within).cast("long") - 1)
    return (
        ranked.join(offsets, [*keys, "slot_bucket"])
        .withColumn("slot", F.col("slot_rank") + F.col("slot_offset"))
        .drop("slot_bucket", "slot_rank", "slot_offset")
    )
