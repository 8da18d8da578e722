"""Category indexing (most frequent first) and one-hot encoding.

Up to a size limit a column's categories are kept as a list on the driver and
looked up without a shuffle. A column beyond the limit is ranked, and later
looked up, by distributed jobs with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shuffle_partitions, stage, staging
from tidemark.spec import ENCODED, INDEXED

MAX_CATEGORIES = 10_000  # longest list kept on the driver and broadcast
MAX_CATEGORY_BYTES = 8 << 20  # and the most text such a list may hold
MAX_TOTAL_BYTES = 64 << 20  # and the most text of all columns' lists together
INLINE_CATEGORIES = 32  # lists up to here become literals in the expression
HEAD_CATEGORIES = 1_000  # most frequent values of a wide column, looked up by broadcast
TRACKED_KEYS = 16_384  # values a task follows to find the frequent ones

INVALID_POLICIES = ("keep", "error", "skip")


@dataclass(frozen=True)
class CategoryIndex:
    """Fitted categories, most frequent first.

    ``labels`` holds the bounded columns; ``wide`` holds, for each column beyond
    the bound, a staged table ``(value, n, index)``.
    """

    labels: dict[str, list[str]]
    wide: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.labels, *self.wide]

    def sizes(self) -> dict[str, int]:
        """Number of categories of each column."""
        sizes = {column: len(values) for column, values in self.labels.items()}
        return {**sizes, **{column: table.count() for column, table in self.wide.items()}}


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, n)`` for all columns from one scan; nulls are no category."""
    names = F.array(*[F.lit(c) for c in columns])
    values = F.array(*[F.col(c).cast("string") for c in columns])
    return (
        df.select(F.posexplode(values).alias("__at", "value"))
        .where(F.col("value").isNotNull())
        .groupBy("__at", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.get(names, F.col("__at")).alias("feature"), "value", "n")
    )


def _by_frequency() -> list[Column]:
    return [F.col("n").desc(), F.col("value").asc()]


def top_categories(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """``(feature, value, n, index)`` of the ``limit`` most frequent values of each column.

    Spark limits each task's values before the shuffle only for limits below
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000 by default); larger ones are
    refused. :func:`rank_categories` ranks any number.
    """
    bound = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if limit >= bound:
        raise ValueError(f"limit must be below {bound}; rank_categories has none")
    window = Window.partitionBy("feature").orderBy(*_by_frequency())
    return (
        category_counts(df, columns)
        .withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= limit)
        .select("feature", "value", "n", (F.col("rank") - 1).cast("bigint").alias("index"))
    )


def rank_categories(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, index)`` of one column, however many values it has."""
    return _rank(category_counts(df, [column]).select("value", "n"), shuffle_partitions(df))


def _rank(counts: DataFrame, blocks: int) -> DataFrame:
    """``counts`` (``value``, ``n``) with their places by frequency.

    They are range-partitioned by (n descending, value) and staged, so a
    value's index is its place within its block plus the sizes of the blocks
    before it. No block holds more than its share of the distinct values.
    """
    staged = stage(
        counts.repartitionByRange(blocks, *_by_frequency()).withColumn(
            "block", F.spark_partition_id()
        ),
        "ranked-categories",
    )
    # One row per block, at most `blocks` rows in all.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        staged.groupBy("block")
        .agg(F.count(F.lit(1)).alias("size"))
        .select("block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("block").orderBy(*_by_frequency())
    return (
        staged.withColumn("place", F.row_number().over(within))
        .join(F.broadcast(starts), "block")
        .select("value", "n", (F.col("start") + F.col("place") - 1).alias("index"))
    )


def fit_index(
    df: DataFrame,
    columns: Sequence[str],
    max_categories: int = MAX_CATEGORIES,
    max_bytes: int = MAX_CATEGORY_BYTES,
    max_total_bytes: int = MAX_TOTAL_BYTES,
) -> CategoryIndex:
    """Learn every column's categories: by frequency, ties in text order.

    The values of all columns are counted once and staged. One row per column then says
    which columns have at most ``max_categories`` values and ``max_bytes`` of text; the
    smallest of these, ``max_total_bytes`` in all, are collected. The others are
    ranked from the staged counts.
    """
    if not columns:
        return CategoryIndex({})
    with staging(df.sparkSession, keep="category-index"):
        counts = stage(category_counts(df, columns), "category-counts")
        sizes = {
            r["feature"]: (r["n_bytes"], r["n"])
            for r in counts.groupBy("feature")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.octet_length("value").cast("bigint")).alias("n_bytes"),
            )
            .collect()
        }
        empty = [c for c in columns if c not in sizes]
        if empty:
            raise ValueError(f"columns without any value: {', '.join(empty)}")
        listed, room = [], max_total_bytes
        for n_bytes, n, c in sorted((*sizes[c], c) for c in set(columns)):
            if n <= max_categories and n_bytes <= min(max_bytes, room):
                listed.append(c)
                room -= n_bytes
        rows = counts.where(F.col("feature").isin(listed)).collect()
        found: dict[str, list[str]] = {c: [] for c in columns if c in listed}
        for row in sorted(rows, key=lambda r: (-r["n"], r["value"])):
            found[row["feature"]].append(row["value"])
        blocks = shuffle_partitions(df)
        wide = {
            c: stage(
                _rank(counts.where(F.col("feature") == c).select("value", "n"), blocks),
                "category-index",
            )
            for c in columns
            if c not in listed
        }
    return CategoryIndex(found, wide)


def _require(policy: str) -> None:
    if policy not in INVALID_POLICIES:
        raise ValueError(f"invalid must be one of {', '.join(INVALID_POLICIES)}")


def _resolve(index: Column, column: str, unseen_index: Column, policy: str) -> Column:
    """Double-typed index with the policy for nulls and unseen values applied."""
    if policy == "keep":
        index = F.coalesce(index, unseen_index)
    elif policy == "error":
        message = F.concat(
            F.lit(f"unseen category in {column}: "),
            F.coalesce(F.col(column).cast("string"), F.lit("NULL")),
        )
        index = F.coalesce(index, F.raise_error(message).cast("bigint"))
    return index.cast("double")


def _lookup_inline(df: DataFrame, column: str, values: list[str], policy: str) -> DataFrame:
    place = F.array_position(F.array(*map(F.lit, values)), F.col(column).cast("string"))
    index = F.nullif(place, F.lit(0).cast("bigint")) - 1
    return df.withColumn(column + INDEXED, _resolve(index, column, F.lit(len(values)), policy))


def _lookup_broadcast(df: DataFrame, column: str, values: list[str], policy: str) -> DataFrame:
    # At most MAX_CATEGORIES rows and MAX_CATEGORY_BYTES of text: checked when fitted.
    table = df.sparkSession.createDataFrame(
        pa.table({"__index": pa.array(range(len(values)), pa.int64()), "__value": values})
    )
    joined = df.join(
        F.broadcast(table), F.col(column).cast("string") == F.col("__value"), "left"
    )
    index = _resolve(F.col("__index"), column, F.lit(len(values)), policy)
    return joined.withColumn(column + INDEXED, index).drop("__index", "__value")


def _short_key(value: Column) -> Column:
    """The text itself or, if long, its SHA-256: never more than 65 bytes."""
    return F.when(F.octet_length(value) <= 64, F.concat(F.lit("="), value)).otherwise(
        F.concat(F.lit("#"), F.sha2(value, 256))
    )


def _frequent_keys(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Per column the short keys of its values in at least 1 of HEAD_CATEGORIES rows, from one pass.

    A sketch of frequent items finds them: each task keeps TRACKED_KEYS keys a column, and a
    value in more than about 4 of TRACKED_KEYS rows is never missed.
    """
    sketches = [
        F.expr(f"approx_top_k(k{i}, {HEAD_CATEGORIES}, {TRACKED_KEYS})").alias(f"k{i}")
        for i in range(len(columns))
    ]
    keys = [_short_key(F.col(c).cast("string")).alias(f"k{i}") for i, c in enumerate(columns)]
    *found, n = df.select(*keys).agg(*sketches, F.count(F.lit(1))).first()
    return {
        c: [item for item, seen in tops or () if item is not None and seen * HEAD_CATEGORIES >= n]
        for c, tops in zip(columns, found)
    }


def _lookup_wide(
    df: DataFrame, column: str, ranked: DataFrame, policy: str, frequent: Sequence[str]
) -> DataFrame:
    """Look up a column with too many categories to broadcast, in one pass over ``df``.

    The values most frequent when fitted, those ``frequent`` in ``df`` (seen when fitted or not),
    and nulls, are resolved by a broadcast of at most 2 * HEAD_CATEGORIES short keys. Rows so
    settled, with all others, go through a left join to the rest of the table, but under keys that
    match nothing and differ from row to row (equal rows share one); what else is left has no
    value more frequent than 1/HEAD_CATEGORIES of the rows.
    """
    table = ranked.select(_short_key(F.col("value")).alias("__key"), F.col("index").alias("__index"))
    known = dict(table.where(F.col("__key").isin(list(frequent))).collect()) if frequent else {}
    more = [(k, known.get(k)) for k in frequent if known.get(k, HEAD_CATEGORIES) >= HEAD_CATEGORIES]
    head = F.broadcast(
        table.where(F.col("__index") < HEAD_CATEGORIES)
        .unionAll(df.sparkSession.createDataFrame(more, "__key string, __index bigint"))
        .toDF("__head_key", "__head")
    )
    tail = table.where(F.col("__index") >= HEAD_CATEGORIES).toDF("__tail_key", "__tail")
    total = ranked.count()
    value = F.col(column)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.concat(F.lit("~"), F.xxhash64(*plain).cast("string"))
    own = _short_key(value.cast("string"))
    first = df.withColumn("__own", own).join(head, F.col("__own") == F.col("__head_key"), "left")
    settled = F.col("__head_key").isNotNull() | value.isNull()
    keyed = first.withColumn("__own", F.when(settled, spread).otherwise(F.col("__own")))
    joined = keyed.join(tail, F.col("__own") == F.col("__tail_key"), "left")
    index = _resolve(F.coalesce("__head", "__tail"), column, F.lit(total), policy)
    return joined.withColumn(column + INDEXED, index).drop(
        "__own", "__head_key", "__head", "__tail_key", "__tail"
    )


def apply_index(df: DataFrame, index: CategoryIndex, invalid: str = "keep") -> DataFrame:
    """Add ``<column>_indexed`` (double) for every fitted column.

    Nulls and values not seen when fitting get the next free index (``keep``),
    fail the query (``error``) or drop the row (``skip``).
    """
    _require(invalid)
    for column, values in index.labels.items():
        lookup = _lookup_inline if len(values) <= INLINE_CATEGORIES else _lookup_broadcast
        df = lookup(df, column, values, invalid)
    frequent = _frequent_keys(df, list(index.wide)) if index.wide else {}
    for column, ranked in index.wide.items():
        df = _lookup_wide(df, column, ranked, invalid, frequent[column])
    if invalid == "skip" and index.columns:
        df = df.na.drop("any", subset=[c + INDEXED for c in index.columns])
    return df


def one_hot(
    df: DataFrame, sizes: dict[str, int], invalid: str = "error"
) -> tuple[DataFrame, list[str]]:
    """Add sparse ``<column>_encoded`` vectors; the last category is all zeros.

    Returns the table and the columns left out because they have a single
    category, which has no encoding. With ``invalid="keep"`` every fitted
    category has a slot and unseen values are the all-zero vector.
    """
    encodable = [c for c, size in sizes.items() if size > 1]
    skipped = [c for c in sizes if c not in encodable]
    if not encodable:
        return df, skipped
    # Stating the number of categories saves the encoder a pass over the data.
    sized = df.withColumns(
        {
            c + INDEXED: F.col(c + INDEXED).alias(
                c + INDEXED,
                metadata={"ml_attr": {"type": "nominal", "num_vals": sizes[c]}},
            )
            for c in encodable
        }
    )
    encoder = OneHotEncoder(
        inputCols=[c + INDEXED for c in encodable],
        outputCols=[c + ENCODED for c in encodable],
        handleInvalid=invalid,
    )
    return encoder.fit(sized).transform(sized), skipped
