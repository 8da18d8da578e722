"""Value ranges and fixed-edge histograms of many columns at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import edge_grid

# Stand-ins for a bin number.
OUTSIDE = -1
MISSING = -2
GROUPS_HELD = 1000  # groups whose counts a task holds

Ranges = dict[str, tuple[float, float] | None]


def _number(column: str) -> Column:
    """The column as double with NaN as NULL."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _finite(column: str) -> Column:
    """The column as double with NaN and infinities as NULL."""
    number = _number(column)
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def range_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, lo, hi)`` of all columns' finite values from one pass; NULL where there are none.

    An infinity would make every edge NaN; it has no place in a range and so is
    counted as outside.
    """
    one_row = df.agg(
        *[F.min(_finite(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(_finite(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"lo{i}").alias("lo"),
            F.col(f"hi{i}").alias("hi"),
        )
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def feature_ranges(df: DataFrame, columns: Sequence[str]) -> Ranges:
    """:func:`range_table` on the driver: one entry per column."""
    if not columns:
        return {}
    return {
        row["feature"]: None if row["lo"] is None else (row["lo"], row["hi"])
        for row in range_table(df, columns).collect()
    }


def _group_codes(batch: pa.RecordBatch, n_by: int) -> tuple[np.ndarray, list[tuple]]:
    """A number for each row's values of the first ``n_by`` columns, and the values by number."""
    code = np.zeros(batch.num_rows, dtype=np.int64)
    values = []
    for k in range(n_by):
        column = batch.column(k).dictionary_encode(null_encoding="encode")
        code = code * len(column.dictionary) + column.indices.to_numpy()
        values.append(column)
    _, first, group = np.unique(code, return_index=True, return_inverse=True)
    return group, [tuple(v[int(i)].as_py() for v in values) for i in first]


def histogram(
    df: DataFrame, ranges: Ranges, bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """``(*by, feature, bin, n)``: rows per bin of every column in ``ranges``.

    Bins are half-open, the last one closed. Values outside the range count as
    bin OUTSIDE and missing ones (null, NaN) as bin MISSING: nothing goes unreported.
    Tasks take the columns as they are and add up one vector of counts for all of them (and
    each of the ``by`` values, a thousand at a time); rows are not multiplied by the number of columns, and
    the shuffle carries one row per (by, column, bin) and task.
    """
    columns = [c for c, r in ranges.items() if r is not None]
    if not columns:
        raise ValueError("no column has a value range")
    # A value lying on an edge opens the bin to its right: searching the actual edges
    # guarantees that, dividing by the bin width would not.
    grids = [np.array(edge_grid(*ranges[c], bins)) for c in columns]
    n_by, width = len(by), bins + 2
    numbers = np.array([*range(bins), OUTSIDE, MISSING])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, np.ndarray] = {}

        def told() -> pa.RecordBatch:
            rows = [(key, *np.nonzero(t), t[np.nonzero(t)]) for key, t in totals.items()]
            keys = [
                pa.array([key[k] for key, at, *_ in rows for _ in at], types[k]) for k in range(n_by)
            ]
            parts = list(zip(*(r[1:] for r in rows))) or [[np.empty(0, np.int64)]] * 3
            at, place, n = (np.concatenate(p) for p in parts)
            return pa.RecordBatch.from_arrays(
                [*keys, pa.array(at.astype(np.int32)), pa.array(numbers[place].astype(np.int32)), pa.array(n)],
                [*(f"b{k}" for k in range(n_by)), "at", "bin", "n"],
            )

        types: list[pa.DataType] = []
        for batch in batches:
            types = [batch.column(k).type for k in range(n_by)]
            group, keys = _group_codes(batch, n_by)
            cells = np.empty((len(columns), len(keys) * width), dtype=np.int64)
            for i, edges in enumerate(grids):
                values = batch.column(n_by + i).to_numpy(zero_copy_only=False)
                place = np.searchsorted(edges[1:-1], values, side="right")
                place[(values < edges[0]) | (values > edges[-1])] = bins
                place[np.isnan(values)] = bins + 1
                cells[i] = np.bincount(group * width + place, minlength=cells.shape[1])
            for g, key in enumerate(keys):
                part = cells[:, g * width : (g + 1) * width]
                totals[key] = totals[key] + part if key in totals else part.copy()
            if len(totals) > GROUPS_HELD:
                yield told()
                totals.clear()
        if totals:
            yield told()

    kinds = [df.select(c).schema.fields[0].dataType.simpleString() for c in by]
    schema = ", ".join([*(f"b{k} {kind}" for k, kind in enumerate(kinds)), "at int, bin int, n bigint"])
    needed = df.select(
        *(F.col(c).alias(f"b{k}") for k, c in enumerate(by)),
        *(_number(c).alias(f"v{i}") for i, c in enumerate(columns)),
    )
    keys = [f"b{k}" for k in range(n_by)]
    counted = needed.mapInArrow(count, schema).groupBy(*keys, "at", "bin").agg(F.sum("n").alias("n"))
    names = F.array(*[F.lit(c) for c in columns])
    return counted.select(
        *(F.col(k).alias(c) for k, c in zip(keys, by)), F.get(names, F.col("at")).alias("feature"), "bin", "n"
    )


def with_empty_bins(counts: DataFrame, bins: int, side: str = "n") -> DataFrame:
    """``(feature, bin, n)`` with every bin 0..bins-1 present; empty ones count 0."""
    per_feature = counts.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", side))).alias("found")
    )
    bin_ = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    return per_feature.select("feature", bin_, "found").select(
        "feature", "bin", F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0).cast("bigint")).alias(side)
    )
