"""Summaries of a baseline that can be binned anew, over any range, without the baseline.

A summary counts a feature's values in cells whose width is a power of two and whose edges are whole
multiples of it, at most ``CELLS`` of them, and keeps each cell's smallest and largest value. Cells of a smaller width lie wholly within those of a larger one, so
summaries of parts of a table merge exactly. Binned over another range, a cell whose values lie on
both sides of an edge is shared out by length (a cell of one value never is); how far the result can then be off is stated.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import edge_grid
from tidemark.operators.drift import (
    BINS,
    COMPARED,
    EMPTY_BIN,
    NO_BASELINE,
    NO_NEW,
    PSI_SCHEMA,
    densities,
)
from tidemark.operators.histograms import (
    MISSING,
    OUTSIDE,
    Ranges,
    _number,
    feature_ranges,
    histogram,
)

CELLS = 4096  # of a feature
# ``cell`` is null for missing values and infinities; the width of a cell is 2 ** exponent.
SUMMARY_SCHEMA = (
    "feature string, lo double, hi double, exponent int, cell bigint, kind string, n bigint, "
    "cell_lo double, cell_hi double"
)
COUNTED = ("cell", "kind", "n", "cell_lo", "cell_hi")
IN_CELL, IS_MISSING, IS_OUTSIDE = "cell", "missing", "outside"


def exponent_for(lo: float, hi: float, cells: int = CELLS) -> int:
    """The smallest power of two whose multiples cut [lo, hi] into at most ``cells`` cells."""
    size = max(abs(lo), abs(hi))
    # No finer than doubles of that size are, so that numbers of cells are exact.
    least = math.frexp(size)[1] - 53 if size else -1074
    span = hi - lo
    e = max(least, (math.frexp(span)[1] - cells.bit_length() - 1) if span else least, -1000)
    while math.floor(math.ldexp(hi, -e)) - math.floor(math.ldexp(lo, -e)) >= cells:
        e += 1
    return e


def summarize(df: DataFrame, columns: Sequence[str], cells: int = CELLS) -> DataFrame:
    """The summary of each column: a pass for the ranges, one for the counts."""
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], SUMMARY_SCHEMA)
    ranges = feature_ranges(df, columns)
    spans = [ranges[c] or (0.0, 0.0) for c in columns]
    exponents = [exponent_for(*span, cells) for span in spans]
    known = [ranges[c] is not None for c in columns]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = [math.floor(math.ldexp(lo, -e)) for (lo, _), e in zip(spans, exponents)]
        sizes = [math.floor(math.ldexp(hi, -e)) - s + 1 for (_, hi), e, s in zip(spans, exponents, starts)]
        totals = [np.zeros(size + 2, dtype=np.int64) for size in sizes]
        least = [np.full(size, np.inf) for size in sizes]
        most = [np.full(size, -np.inf) for size in sizes]
        for batch in batches:
            for i, total in enumerate(totals):
                values = batch.column(i).to_numpy(zero_copy_only=False)
                inside = np.isfinite(values) & known[i]
                place = np.floor(np.ldexp(values[inside], -exponents[i])).astype(np.int64) - starts[i]
                np.minimum.at(least[i], place, values[inside])
                np.maximum.at(most[i], place, values[inside])
                total[:-2] += np.bincount(place, minlength=sizes[i])
                total[-2] += np.count_nonzero(np.isnan(values))
                total[-1] += np.count_nonzero(np.isinf(values))
        rows = []
        for i, total in enumerate(totals):
            for at in np.flatnonzero(total).tolist():
                kind = IN_CELL if at < sizes[i] else IS_MISSING if at == sizes[i] else IS_OUTSIDE
                told = (at + starts[i], least[i][at], most[i][at]) if kind == IN_CELL else (None,) * 3
                rows.append((i, kind, int(total[at]), *told))
        columns_ = list(zip(*rows)) if rows else [()] * 6
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns_, kinds)], ["at", "kind", "n", "cell", "cell_lo", "cell_hi"]
        )

    needed = df.select(*(_number(c).alias(f"v{i}") for i, c in enumerate(columns)))
    counted = (
        needed.mapInArrow(
            count, "at int, kind string, n bigint, cell bigint, cell_lo double, cell_hi double"
        )
        .groupBy("at", "cell", "kind")
        .agg(*_added_up())
    )
    about = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(span[0] if there else None).cast("double").alias("lo"),
            F.lit(span[1] if there else None).cast("double").alias("hi"),
            F.lit(e).alias("exponent"),
        )
        for c, span, e, there in zip(columns, spans, exponents, known)
    ]
    of = F.get(F.array(*about), F.col("at")).alias("of")
    return counted.select(of, *COUNTED).select("of.*", *COUNTED)


def _added_up() -> list[Column]:
    """Counts and values of cells that are put together."""
    return [F.sum("n").alias("n"), F.min("cell_lo").alias("cell_lo"), F.max("cell_hi").alias("cell_hi")]


def merge_summaries(*parts: DataFrame) -> DataFrame:
    """The summary of tables from the summaries of each, exactly; of the coarsest width among them.

    It may have a few times ``CELLS`` cells if the parts lie far apart.
    """
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    spans = both.groupBy("feature").agg(
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        # A feature without values has no say in the width.
        F.coalesce(F.max(F.when(F.col("lo").isNotNull(), F.col("exponent"))), F.max("exponent")).alias("e"),
    )
    moved = both.drop("lo", "hi").join(F.broadcast(spans), "feature")
    cell = F.expr("shiftright(cell, e - exponent)")
    return (
        moved.withColumn("cell", F.when(F.col("kind") == IN_CELL, cell))
        .groupBy("feature", "lo", "hi", F.col("e").alias("exponent"), "cell", "kind")
        .agg(*_added_up())
        .select(*(part.split()[0] for part in SUMMARY_SCHEMA.split(", ")))
    )


def rebin(summary: DataFrame, ranges: Ranges, bins: int = BINS) -> DataFrame:
    """``(feature, expected, least, most)``: the counts of each bin, and between what they lie.

    One task bins the cells of one feature.
    """
    grids = {c: edge_grid(*span, bins) for c, span in ranges.items() if span is not None}

    def binned(table: pa.Table) -> pa.Table:
        feature = table["feature"][0].as_py()
        n = table["n"].to_numpy().astype(float)
        low, high = table["cell_lo"].to_numpy(), table["cell_hi"].to_numpy()
        inner = np.array(grids[feature])[1:-1]
        first = np.searchsorted(inner, low, side="right")
        last = np.searchsorted(inner, high, side="right")
        least = np.bincount(first[first == last], n[first == last], bins)
        expected, most = least.copy(), least.copy()
        for i in np.flatnonzero(first != last):
            marks = np.concatenate([[low[i]], inner[first[i] : last[i]], [high[i]]])
            shares = np.diff(marks) / max(high[i] - low[i], 5e-324)
            expected[first[i] : last[i] + 1] += n[i] * shares
            most[first[i] : last[i] + 1] += n[i]
        listed = [[feature], [expected], [least], [most]]
        kinds = [pa.string(), *[pa.list_(pa.float64())] * 3]
        return pa.table([pa.array(v, k) for v, k in zip(listed, kinds)], ["feature", "expected", "least", "most"])

    wanted = summary.where((F.col("kind") == IN_CELL) & F.col("feature").isin(list(grids)))
    return wanted.groupBy("feature").applyInArrow(
        binned, "feature string, expected array<double>, least array<double>, most array<double>"
    )


def _filled(count: Column) -> Column:
    return F.when(count > 0, count).otherwise(F.lit(EMPTY_BIN))


def psi_against_summary(
    summary: DataFrame, new: DataFrame, bins: int = BINS, combined_range: bool = True
) -> DataFrame:
    """PSI of ``new`` against a summary, with ``max_error``: how far at most it is from the exact one.

    The bins span the values of both tables or, without ``combined_range``, of the baseline. The baseline
    itself is not read. Columns are those of a drift report, and ``max_error``.
    """
    spans = summary.groupBy("feature").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    base: Ranges = {
        r["feature"]: None if r["lo"] is None else (r["lo"], r["hi"]) for r in spans if r["feature"] in new.columns
    }
    if not base:
        return new.sparkSession.createDataFrame([], f"{PSI_SCHEMA}, max_error double")
    fresh = feature_ranges(new, list(base)) if combined_range else dict.fromkeys(base)
    ranges: Ranges = {}
    for c, span in base.items():
        every = [v for v in (span, fresh[c]) if v is not None]
        ranges[c] = (min(v[0] for v in every), max(v[1] for v in every)) if every else None
    binned_in = {c: (0.0, 0.0) if span is None else span for c, span in ranges.items()}
    n = F.col("n")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0).cast("bigint"))

    # At most bins + 2 rows per feature.
    seen = histogram(new, binned_in, bins).groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("bin") >= 0, F.struct("bin", "n")))).alias("found"),
        F.sum("n").alias("n_new"),
        total(F.col("bin") == OUTSIDE).alias("out"),
        total(F.col("bin") == MISSING).alias("lacking"),
    )
    told = summary.groupBy("feature").agg(
        F.sum("n").alias("n_base"),
        total(F.col("kind") == IN_CELL).alias("binned"),
        total(F.col("kind") == IS_MISSING).alias("base_missing"),
        total(F.col("kind") == IS_OUTSIDE).alias("base_out"),
    )
    both = (
        told.where(F.col("feature").isin(list(base)))
        .join(seen, "feature", "left")
        .join(rebin(summary, ranges, bins), "feature", "left")
        .fillna(0, ["n_new", "out", "lacking"])
    )
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)),
        lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0).cast("bigint")),
    )
    shares = both.withColumns({"q": densities(counts), "p": densities(F.col("expected"))})

    def term(p: Column, q: Column) -> Column:
        return (q - p) * F.ln(q / p)

    def off(i: Column) -> Column:
        """How far a bin's term can be off: it is convex in the baseline's share, and 0 at equal shares."""
        p, q = F.get("p", i), F.get("q", i)
        low = _filled(F.get("least", i)) / (F.col("binned") + bins * EMPTY_BIN)
        high = _filled(F.get("most", i)) / F.col("binned")
        here = term(p, q)
        inside = F.when((low <= q) & (q <= high), here).otherwise(F.lit(0.0))
        return F.greatest(F.abs(term(low, q) - here), F.abs(term(high, q) - here), inside)

    numbers = F.sequence(F.lit(0), F.lit(bins - 1))
    summed = lambda values: F.aggregate(values, F.lit(0.0), lambda t, v: t + v)
    psi = summed(F.transform(numbers, lambda i: term(F.get("p", i), F.get("q", i))))
    status = (
        F.when(F.col("binned") == 0, NO_BASELINE)
        .when((F.col("n_new") > 0) & (F.col("lacking") == F.col("n_new")), NO_NEW)
        .otherwise(COMPARED)
    )
    compared = F.col("status") == COMPARED
    return shares.withColumn("status", status).select(
        "feature",
        F.when(compared, psi).alias("psi"),
        "n_base",
        "n_new",
        F.when(F.col("status") == NO_BASELINE, 0).otherwise(F.col("out")).cast("bigint").alias("n_out_of_range"),
        (F.col("lacking") + F.col("base_missing")).alias("n_missing"),
        "status",
        F.when(compared, summed(F.transform(numbers, off))).alias("max_error"),
    )
