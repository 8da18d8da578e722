"""Class balancing and train/test splits that give the same rows every time."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.functions import digest, drawn, hex_bound, values_hash
from tidemark.session import shuffle_partitions, stage, staging

TRAIN = "train"
TEST = "test"
MAX_CLASSES = 1_000  # label values whose counts are brought to the driver
POISSON_PART = 16.0  # largest mean number of copies settled by one draw
COPIES_PER_BLOCK = 64  # copies one input row may become within one task
_RADIX_HEX = 4  # hex digits settled per pass of the exact split
_DIGEST_HEX = 32  # digits of a whole digest
_LISTED = 100_000  # rows few enough to order by their whole digests


def _identity(df: DataFrame, key: Sequence[str]) -> list[str | Column]:
    """What a row's draw hangs on: its key or, without one, all its values."""
    return list(key) or [values_hash(df.columns)]


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """``(label, n)`` for every class in one aggregation."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def oversampling_ratios(
    df: DataFrame, label: str, max_classes: int = MAX_CLASSES
) -> dict[object, float]:
    """Per class, how often each row must appear to match the largest class.

    The classes come to the driver; more than ``max_classes`` of them are refused. Rows
    with a null label belong to no class.
    """
    labelled = df.where(F.col(label).isNotNull())
    rows = class_counts(labelled, label).limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} values: not a class label")
    if len(rows) < 2:
        raise ValueError(f"{label} has {len(rows)} class(es): nothing to balance")
    largest = max(row["n"] for row in rows)
    return {row[label]: largest / row["n"] for row in rows}


def _per_class(label: str, values: dict[object, object], default: object) -> Column:
    """``values[class]`` as a CASE expression over the label."""
    chain = F  # the first ``when`` is a function, the following are methods of its result
    for value, result in values.items():
        chain = chain.when(F.col(label) == F.lit(value), F.lit(result))
    return chain.otherwise(F.lit(default))


def balance(
    df: DataFrame,
    label: str,
    key: Sequence[str] = (),
    salt: str = "balance",
    ratios: dict[object, float] | None = None,
    copy_column: str | None = None,
    only: Column | None = None,
    null_labels: str = "drop",
) -> DataFrame:
    """Bring every class up to the size of the largest by repeating its rows.

    Each row of a class with ratio r appears floor(r) times and, for a share of
    rows chosen by key hash, once more; a ratio below 1 so thins its class. All rows of
    the largest class are kept once. ``copy_column``, if given, numbers a row's copies from 1. Rows for which
    ``only`` does not hold, or whose class has no ratio, are passed through once.
    Rows with a null label belong to no class: they are left out (``drop``), passed through
    once (``keep``) or fail the query (``error``).

    Where a class must be repeated more than COPIES_PER_BLOCK times, the table is staged
    first, so that what it is computed from is read once.
    """
    ratios = oversampling_ratios(df, label) if ratios is None else ratios
    if any(not r >= 0 for r in ratios.values()):
        raise ValueError("ratios must not be negative")
    whole = _per_class(label, {k: int(math.floor(r)) for k, r in ratios.items()}, 1)
    bounds = {k: hex_bound(r - math.floor(r)) for k, r in ratios.items()}
    extra = drawn(_identity(df, key), salt, _per_class(label, bounds, hex_bound(0.0)))
    copies = whole + extra.cast("int")
    if only is not None:
        copies = F.when(only, copies).otherwise(1)
    refused = F.raise_error(F.lit(f"a row without {label} cannot be balanced")).cast("int")
    of_null = {"drop": F.lit(0), "keep": F.lit(1), "error": refused}
    if null_labels not in of_null:
        raise ValueError(f"null_labels must be one of {', '.join(of_null)}")
    copies = F.when(F.col(label).isNull(), of_null[null_labels]).otherwise(copies)
    sized = df.withColumn("__copies", copies).where(F.col("__copies") >= 1)
    name = copy_column or "__copy"
    rare = [value for value, ratio in ratios.items() if ratio > COPIES_PER_BLOCK]
    if rare:
        sized = stage(sized, "sized")
    is_rare = F.col(label).isin(rare)
    usual = sized.where(~is_rare) if rare else sized
    out = usual.withColumn(name, F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    if rare:
        out = out.unionByName(_spread_copies(sized.where(is_rare), name, shuffle_partitions(df)))
    out = out.drop("__copies")
    return out if copy_column else out.drop(name)


def _spread_copies(sized: DataFrame, name: str, parts: int) -> DataFrame:
    """Number ``__copies`` copies of few rows, so that no task makes all copies of one.

    Only blocks of copies are shuffled, evenly; the rows of usual classes are not.
    """
    last_block = F.floor((F.col("__copies") - 1) / COPIES_PER_BLOCK).cast("int")
    blocks = sized.withColumn("__block", F.explode(F.sequence(F.lit(0), last_block)))
    first = F.col("__block") * COPIES_PER_BLOCK + 1
    last = F.least(first + (COPIES_PER_BLOCK - 1), F.col("__copies"))
    spread = blocks.repartition(parts)
    return spread.withColumn(name, F.explode(F.sequence(first, last))).drop("__block")


def poisson_bounds(mean: float) -> list[float]:
    """The chances of at most 0, 1, 2, … copies, up to where a 32-bit draw tells no more."""
    bounds, term, total = [], math.exp(-mean), 0.0
    while not bounds or 1.0 - total > 2.0**-33 and len(bounds) < 40 + 3 * mean:
        total += term
        bounds.append(total)
        term *= mean / len(bounds)
    return bounds


def _poisson_copies(key: Sequence[str | Column], salt: str, mean: float) -> Column:
    """How many copies of a row there are, by the inverse distribution of its draw.

    A large mean is made up of equal parts of at most POISSON_PART, each with a draw of its own.
    """
    parts = max(1, math.ceil(mean / POISSON_PART))
    bounds = F.array(*map(F.lit, poisson_bounds(mean / parts)))

    def one(part: Column) -> Column:
        told = F.concat_ws("|", digest(key, salt), part.cast("string"))
        draw = F.conv(F.substring(F.md5(told), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
        return F.size(F.filter(bounds, lambda bound: bound <= draw))

    if parts == 1:
        return one(F.lit(0))
    each = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), one)
    return F.aggregate(each, F.lit(0), lambda total, n: total + n)


def balance_by_sampling(
    df: DataFrame,
    label: str,
    seed: int,
    ratios: dict[object, float] | None = None,
    key: Sequence[str] = (),
) -> DataFrame:
    """Balance by Poisson sampling with replacement from each smaller class.

    How often a row appears is drawn from its key or, without one, its values (so that equal rows
    have equal numbers of copies): repartitioned or run again, the same rows come out. Sizes
    are right on average only; those of :func:`balance` vary less. Rows of classes with
    ratio 1 are kept as they are, those without a ratio or a label are left out.
    """
    ratios = oversampling_ratios(df, label) if ratios is None else ratios
    if any(not r >= 0 for r in ratios.values()):
        raise ValueError("ratios must not be negative")
    copies = F
    for value, ratio in ratios.items():
        drawn_copies = F.lit(1) if ratio == 1.0 else _poisson_copies(_identity(df, key), f"poisson{seed}", ratio)
        copies = copies.when(F.col(label) == F.lit(value), drawn_copies)
    if copies is F:
        return df.limit(0)
    sized = df.withColumn("__copies", copies.otherwise(F.lit(0))).where(F.col("__copies") >= 1)
    rare = [value for value, ratio in ratios.items() if ratio > COPIES_PER_BLOCK / 2]
    if not rare:
        return sized.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).drop("__copies", "__copy")
    sized = stage(sized, "sized")
    is_rare = F.col(label).isin(rare)
    usual = sized.where(~is_rare).withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies")))
    spread = _spread_copies(sized.where(is_rare), "__copy", shuffle_partitions(df))
    return usual.unionByName(spread).drop("__copies", "__copy")


def split(
    df: DataFrame,
    key: Sequence[str] = (),
    test_size: float = 0.2,
    salt: str = "split",
    column: str = "split",
) -> DataFrame:
    """Mark each row ``train`` or ``test`` by key hash, without a shuffle.

    Rows with equal keys stay on one side. The test share is ``test_size`` up
    to sampling error; :func:`split_exact` meets it exactly.
    """
    chosen = drawn(_identity(df, key), salt, hex_bound(test_size))
    return df.withColumn(column, F.when(chosen, TEST).otherwise(TRAIN))


def _cutoff_digest(df: DataFrame, mark: Column, test_size: float) -> str | None:
    """The ceil(test_size * n)-th smallest digest, found a few hex digits per pass.

    A pass counts rows by the next digits among those sharing the prefix settled
    so far: at most 16 ** 4 counts, whatever the table's size. The digests left
    at the end are few, even if many rows carry the same one.
    """
    hashed = stage(df.select(mark.alias("d")), "digests")

    def step(prefix: str, next_part: Column, target: Column) -> Row | None:
        counts = (
            hashed.where(F.col("d").startswith(prefix))
            .groupBy(next_part.alias("part"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        upto = F.sum("n").over(Window.orderBy("part"))
        return (
            counts.select("part", "n", upto.alias("upto"), target.alias("target"))
            .where((F.col("target") > 0) & (F.col("upto") >= F.col("target")))
            .orderBy("part")
            .first()
        )

    # The first pass also learns the number of rows.
    target = F.ceil(F.lit(test_size) * F.sum("n").over(Window.partitionBy()))
    prefix = ""
    while len(prefix) < _DIGEST_HEX:
        row = step(prefix, F.substring("d", len(prefix) + 1, _RADIX_HEX), target)
        if row is None:
            return None
        prefix += row["part"]
        target = F.lit(row["target"] - (row["upto"] - row["n"]))
        if row["n"] <= _LISTED:
            return step(prefix, F.col("d"), target)["part"]
    return prefix


def split_exact(
    df: DataFrame,
    key: Sequence[str],
    test_size: float = 0.2,
    salt: str = "split",
    column: str = "split",
) -> DataFrame:
    """Mark exactly ceil(test_size * n) rows ``test``, for unique keys.

    Where keys repeat, equal keys stay together and the test side is the
    smallest such set that is not short. Finding the cutoff takes a few counting
    passes over the key columns; marking is then a comparison per row.
    """
    mark = digest(list(key), salt)
    with staging(df.sparkSession):  # the digests; they are all that is read again
        cutoff = _cutoff_digest(df, mark, test_size)
    if cutoff is None:
        return df.withColumn(column, F.lit(TRAIN))
    return df.withColumn(column, F.when(mark <= cutoff, TEST).otherwise(TRAIN))


def split_random(
    df: DataFrame, test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Independent draw per row; ``(train, test)``. Depends on the partitioning."""
    train, test = df.randomSplit([1.0 - test_size, test_size], seed=seed)
    return train, test


def merge_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both sides of a split as one table again, matched by column name."""
    return train.unionByName(test)
