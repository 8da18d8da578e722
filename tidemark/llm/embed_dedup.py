"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks.

A table hashes a normalised vector v to ``floor((a . v + b) / WIDTH)`` for several random
normal directions a. Vectors of cosine 0.95 are 0.316 apart and agree in one direction
with probability 0.874, orthogonal ones with 0.486. The number of directions grows with the
logarithm of the number of vectors, so that a bucket holds few strangers at any size, and the
number of tables is what makes a pair at the very threshold meet with probability 0.999;
closer pairs are surer still. Pairs that meet are checked exactly, in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from tidemark.llm.common import (
    connected_components,
    in_blocks,
    pick,
    sorted_groups,
    spanning_links,
    stage_once,
)

MIN_COSINE = 0.95
WIDTH = 2.0  # of a cell
MISS = 1e-3  # probability that a pair at the threshold meets in no table
STRANGERS = 4  # unrelated vectors expected in a bucket
SEED = 42
TILE = 1024  # vectors compared at a time


def agreement(distance: float, width: float = WIDTH) -> float:
    """Probability that vectors this far apart fall into one cell of one direction."""
    r = width / distance
    tail = math.erfc(r / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(n: int, cosine: float = MIN_COSINE, miss: float = MISS) -> tuple[int, int]:
    """Directions in a table and number of tables for ``n`` vectors."""
    far, near = agreement(math.sqrt(2)), agreement(math.sqrt(2 - 2 * cosine))
    width = max(6, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    return width, max(1, math.ceil(math.log(miss) / math.log1p(-(near**width))))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _keys(vectors: np.ndarray, width: int, tables: int) -> np.ndarray:
    """The bucket of each vector in each table: one number for table, size and cells."""
    dim = vectors.shape[1]
    draw = np.random.default_rng([SEED, dim])
    directions = draw.standard_normal((dim, tables * width))
    shifts = draw.uniform(0, WIDTH, tables * width)
    mix = draw.integers(1, 1 << 63, tables * width, dtype=np.int64) | 1
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64)
    with np.errstate(over="ignore"):
        mixed = (cells * mix).reshape(-1, tables, width).sum(axis=2)
        salt = draw.integers(0, 1 << 62, tables, dtype=np.int64)
        mixed = (mixed + salt) * np.int64(-7046029254386353131)
    return mixed ^ (mixed >> np.int64(29))


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = pa.compute.list_value_length(batch.column("vec")).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        yield int(dim), batch.filter(pa.array(sizes == dim))


def _send_keys(batches: Iterator[pa.RecordBatch], width: int, tables: int) -> Iterator:
    for batch in batches:
        for dim, part in _by_size(batch):
            keys = _keys(_matrix(part.column("vec"), dim), width, tables)
            yield pa.record_batch({"bucket": keys.ravel()})


def _send(batches: Iterator[pa.RecordBatch], width: int, tables: int) -> Iterator:
    """Each vector to its bucket in each table, with its buckets in all tables."""
    for whole in batches:
        for low in range(0, whole.num_rows, TILE):
            for dim, part in _by_size(whole.slice(low, TILE)):
                vectors = part.column("vec")
                keys = _keys(_matrix(vectors, dim), width, tables)
                short = pa.array(
                    [r.tobytes() for r in keys.astype(np.int32)], type=pa.binary()
                )
                for t in range(tables):
                    yield pa.record_batch(
                        {
                            "bucket": keys[:, t],
                            "tab": np.full(len(keys), t, dtype=np.int32),
                            "node": part.column("node"),
                            "n": part.column("n"),
                            "vec": vectors,
                            "keys": short,
                        }
                    )


def _compare(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Counts (``a``, null, links) and spanning links (``a``, ``b``, 0) of each block.

    A pair that meets in several tables counts in the first of them only.
    """
    for table, starts in sorted_groups(batches, 3):
        out_a, out_b, out_n = [], [], []
        sizes = np.diff(starts)
        for g in np.flatnonzero(sizes > 1):
            rows = table.slice(int(starts[g]), int(sizes[g])).combine_chunks()
            lengths = pa.compute.list_value_length(rows["vec"]).to_numpy()
            for dim in np.unique(lengths):
                part = rows.filter(pa.array(lengths == dim)) if len(set(lengths)) > 1 else rows
                a, b, n = _compare_block(part.combine_chunks(), int(dim), cosine)
                out_a += a
                out_b += b
                out_n += n
        if out_a:
            yield pa.record_batch(
                {
                    "a": pa.array(out_a, type=pa.int64()),
                    "b": pa.array(out_b, type=pa.int64()),
                    "n": pa.array(out_n, type=pa.int64()),
                }
            )


def _compare_block(rows: pa.Table, dim: int, cosine: float) -> tuple[list, list, list]:
    first, tab = rows["block_a"][0].as_py(), rows["tab"][0].as_py()
    crossing = first != rows["block_b"][0].as_py()
    chunk = rows["chunk"].to_numpy()
    node, weight = rows["node"].to_numpy(), rows["n"].to_numpy()
    vectors = _matrix(rows["vec"].combine_chunks(), dim)
    norms = np.linalg.norm(vectors, axis=1)
    keys = np.frombuffer(b"".join(rows["keys"].to_pylist()), dtype=np.int32).reshape(len(node), -1)
    m = len(node)
    links = np.zeros(m, dtype=np.int64)
    a, b, n = [], [], []
    near_rows = []
    for low in range(0, m, TILE):
        own = slice(low, min(m, low + TILE))
        near = vectors[own] @ vectors.T >= cosine * norms[own, None] * norms[None, :]
        near[np.arange(own.stop - low), np.arange(low, own.stop)] = False
        if not near.any():
            continue
        if crossing:
            near &= chunk[own, None] != chunk[None, :]
        for t in range(tab):  # met before
            if not near.any():
                break
            near &= keys[own, t][:, None] != keys[None, :, t]
        links[own] += near @ weight
        near_rows += [(low + i, row) for i, row in enumerate(near) if row.any()]
    for i in np.flatnonzero(links):
        a.append(int(node[i]))
        b.append(None)
        n.append(int(links[i]))
    # A forest of the pairs that count here is enough: the others met in their own table.
    rows_of = dict(near_rows)
    none = np.zeros(m, dtype=bool)
    members = np.array(sorted(rows_of), dtype=np.int64)
    for i, j in spanning_links(
        len(members), lambda i, left: rows_of.get(int(members[i]), none)[members[left]]
    ):
        a.append(int(node[members[i]]))
        b.append(int(node[members[j]]))
        n.append(0)
    return a, b, n


def _valid(vector: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.forall(vector, number) & some, F.lit(False))


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = MIN_COSINE,
    miss: float = MISS,
) -> DataFrame:
    """One row per vector: the key, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts the other rows with cosine of at least ``cosine``. Equal vectors
    are compared once, so any number of copies costs one vector. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing and are
    their own component; vectors of different lengths never link. Rows with a null key
    count as links; a component whose keys are all null has a null id. Repeated rows come
    back as often as given and link with each other. Other columns are ignored. An
    empty table gives an empty result.
    """
    rows = pick(vectors, key, vector).toDF("id", "vec")
    if rows.schema["vec"].dataType != ArrayType(FloatType()):
        rows = rows.withColumn("vec", F.col("vec").cast(ArrayType(DoubleType())))
    rows = rows.withColumn("vec", F.when(_valid(F.col("vec")), F.col("vec")))
    classes = stage_once(
        rows.where("vec is not null")
        .groupBy("vec")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    width, tables = table_plan(classes.count(), cosine, miss)
    kind = classes.schema["vec"].dataType.simpleString()
    slim = classes.select("node", "n", "vec")
    sent = slim.mapInArrow(
        partial(_send, width=width, tables=tables),
        f"bucket long, tab int, node long, n long, vec {kind}, keys binary",
    )
    counted = slim.mapInArrow(partial(_send_keys, width=width, tables=tables), "bucket long")
    blocks = in_blocks(sent, ["bucket"], "node", counted=counted)
    found = stage_once(
        blocks.select("bucket", "block_a", "block_b", "tab", "chunk", "node", "n", "vec", "keys")
        .repartition("bucket", "block_a", "block_b")
        .sortWithinPartitions("bucket", "block_a", "block_b")
        .mapInArrow(partial(_compare, cosine=cosine), "a long, b long, n long"),
        "links",
    )
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    nodes = connected_components(found.where("b is not null").select("a", "b"))
    labelled = (
        classes.join(counts, F.col("node") == F.col("a"), "left")
        .drop("a")
        .join(nodes.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left")
        .select(
            "vec",
            "first_id",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("label", "node").alias("label"),
        )
    )
    first = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = labelled.join(first, "label").select("vec", "n_links", "component_id")
    lone = F.col("vec").isNull()
    return rows.join(of_class.withColumnRenamed("vec", "of"), F.col("vec") == F.col("of"), "left").select(
        F.col("id").alias(key),
        F.when(lone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(lone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(
            F.col("id") == F.when(lone, F.col("id")).otherwise(F.col("component_id")),
            F.lit(False),
        ).alias("kept"),
    )
