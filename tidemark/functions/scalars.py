"""Small scalar expressions that behave under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyyMMddHHmmss"  # fixed value: the snapshot id format


def lenient_double(column: Column | str) -> Column:
    """Text to double, NULL where the text is no number."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("double")


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """``numerator / denominator``, or ``default`` where that is undefined."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(default))


def snapshot_stamp(moment: Column | None = None) -> Column:
    """Snapshot id of a timestamp (now by default), to the second."""
    return F.date_format(F.current_timestamp() if moment is None else moment, STAMP_FORMAT)


def edge_grid(lo: float, hi: float, bins: int) -> list[float]:
    """``bins + 1`` equally spaced edges from ``lo`` to exactly ``hi``."""
    if bins < 1:
        raise ValueError("bins must be at least 1")
    step = (hi - lo) / bins
    return [lo + i * step for i in range(bins)] + [hi]
