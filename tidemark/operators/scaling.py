"""Z-score scaling of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.spec import SCALED


@dataclass(frozen=True)
class Scaling:
    """Mean and divisor per column; one entry per column, so always small."""

    stats: dict[str, tuple[float, float]]


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, n, mean, stddev)`` for all columns from one pass over ``df``."""
    one_row = df.agg(
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"n{i}").alias("n"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("stddev"),
        )
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Learn mean and sample standard deviation of every column in one job.

    A constant column, or one with a single row, gets divisor 1.
    """
    if not columns:
        return Scaling({})
    fitted = {}
    for row in numeric_stats(df, columns).collect():
        if row["mean"] is None:
            raise ValueError(f"column {row['feature']} has no values to scale by")
        fitted[row["feature"]] = (row["mean"], row["stddev"] or 1.0)
    return Scaling(fitted)


def apply_scaler(df: DataFrame, scaling: Scaling) -> DataFrame:
    """Add ``<column>_scaled`` for every fitted column, in one projection."""
    if not scaling.stats:
        return df
    return df.withColumns(
        {
            column + SCALED: (F.col(column).cast("double") - F.lit(mean)) / F.lit(divisor)
            for column, (mean, divisor) in scaling.stats.items()
        }
    )
