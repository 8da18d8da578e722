"""Population stability, drift reports, the retrain decision and shift injection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import standard_normal
from tidemark.operators.histograms import MISSING, OUTSIDE, Ranges, feature_ranges, histogram
from tidemark.spec import schema_differences

# Number of bins, alarm level (strictly above), stand-in for an empty bin.
BINS = 10
THRESHOLD = 0.25
EMPTY_BIN = 0.0001

# Outcomes of the gate.
RETRAIN = "train_model"
KEEP = "no_model_drift"
HALT = "halt"

BASE = "base"
NEW = "new"


def tag_sides(base: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both populations as one table with a ``side`` column."""
    return base.select(*columns, F.lit(BASE).alias("side")).unionByName(
        new.select(*columns, F.lit(NEW).alias("side"))
    )


def smoothed(count: Column) -> Column:
    """A bin count as double, with the stand-in for an empty bin."""
    return F.when(count > 0, count.cast("double")).otherwise(F.lit(EMPTY_BIN))


def densities(counts: Column) -> Column:
    """An array of bin counts as shares of their (smoothed) sum."""
    filled = F.transform(counts, smoothed)
    total = F.aggregate(filled, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(filled, lambda x: x / total)


def _bin_array(found: str, bins: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)),
        lambda i: F.coalesce(F.try_element_at(F.col(found), i), F.lit(0).cast("bigint")),
    )


PSI_SCHEMA = (
    "feature string, psi double, n_base bigint, n_new bigint, n_out_of_range bigint, "
    "n_missing bigint, status string"
)
COMPARED = "compared"
NO_BASELINE = "no_baseline_values"
NO_NEW = "no_new_values"


def psi_from_counts(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """PSI and ``status`` per feature from ``(side, feature, bin, n)`` histogram rows.

    Also reports how many rows each side had, and how many of their values were out
    of the binned range or missing: those take no part in the PSI, and a side
    entirely out of range would otherwise pass for an even spread. A feature without a
    finite value in the baseline, or whose new rows lack every value, has no
    PSI and says so.
    """
    n = F.col("n")

    def on(side: str) -> Column:
        return F.col("side") == side

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0).cast("bigint"))

    def found(side: str) -> Column:
        # At most `bins` entries per feature.
        entry = F.when(on(side) & (F.col("bin") >= 0), F.struct("bin", "n"))
        return F.map_from_entries(F.collect_list(entry))

    grouped = counts.groupBy("feature").agg(
        found(BASE).alias("__base"),
        found(NEW).alias("__new"),
        total(on(BASE)).alias("n_base"),
        total(on(NEW)).alias("n_new"),
        total(on(BASE) & (F.col("bin") >= 0)).alias("__binned"),
        total(on(NEW) & (F.col("bin") == MISSING)).alias("__lacking"),
        total(on(NEW) & (F.col("bin") == OUTSIDE)).alias("n_out_of_range"),
        total(F.col("bin") == MISSING).alias("n_missing"),
    )
    lost = (F.col("n_new") > 0) & (F.col("__lacking") == F.col("n_new"))
    shares = grouped.withColumns(
        {
            "__p": densities(_bin_array("__base", bins)),
            "__q": densities(_bin_array("__new", bins)),
            "status": F.when(F.col("__binned") == 0, NO_BASELINE)
            .when(lost, NO_NEW)
            .otherwise(COMPARED),
        }
    )
    terms = F.zip_with("__p", "__q", lambda p, q: (q - p) * F.ln(q / p))
    psi = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + F.nanvl(x, F.lit(0.0)))
    return shares.select(
        "feature",
        F.when(F.col("status") == COMPARED, psi).alias("psi"),
        "n_base",
        "n_new",
        F.when(F.col("status") == NO_BASELINE, 0)
        .otherwise(F.col("n_out_of_range"))
        .cast("bigint")
        .alias("n_out_of_range"),
        "n_missing",
        "status",
    )


def _all_ranges(ranges: Ranges) -> Ranges:
    """A place on the axis also for features without values, so that their rows are counted."""
    return {c: (0.0, 0.0) if span is None else span for c, span in ranges.items()}


def psi_by_side(
    tagged: DataFrame, columns: Sequence[str], bins: int = BINS, combined_range: bool = False
) -> DataFrame:
    """PSI of the ``new`` against the ``base`` rows of a tagged table.

    The bins span the base rows' values or, with ``combined_range``, everyone's.
    One pass finds the ranges and one counts, however many features there are.
    Every feature has a row, unless the table has none.
    """
    if not columns:
        return tagged.sparkSession.createDataFrame([], PSI_SCHEMA)
    ranged = tagged if combined_range else tagged.where(F.col("side") == BASE)
    ranges = feature_ranges(ranged, columns)
    counts = histogram(tagged, _all_ranges(ranges), bins, by=["side"])
    # Of a feature without a range nothing can be in a bin.
    unknown = F.col("feature").isin([c for c, span in ranges.items() if span is None])
    place = F.when(unknown & (F.col("bin") >= 0), OUTSIDE).otherwise(F.col("bin"))
    return psi_from_counts(_regrouped(counts.withColumn("bin", place)), bins)


def _regrouped(counts: DataFrame) -> DataFrame:
    """One row per bin again after bins were put together."""
    return counts.groupBy("side", "feature", "bin").agg(F.sum("n").alias("n"))


def psi(
    base: DataFrame,
    new: DataFrame,
    columns: Sequence[str],
    bins: int = BINS,
    combined_range: bool = False,
) -> DataFrame:
    """PSI per feature of table ``new`` against table ``base``."""
    return psi_by_side(tag_sides(base, new, columns), columns, bins, combined_range)


PROFILE_SCHEMA = "feature string, lo double, hi double, bins int, bin int, n bigint"


def profile(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """``(feature, lo, hi, bins, bin, n)``: a baseline's bins, to be stored and compared later.

    At most ``bins + 2`` rows per feature, and one at least unless the table is
    empty; ``lo`` and ``hi`` are NULL where there is no finite value. Checking against a stored
    profile reads only the new table.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    ranges = feature_ranges(df, columns)
    spans = df.sparkSession.createDataFrame(
        [(c, *(span or (None, None))) for c, span in ranges.items()],
        "of string, lo double, hi double",
    )
    counted = histogram(df, _all_ranges(ranges), bins)
    # One row per feature on the right: a few, as in the ranges above.
    return counted.join(F.broadcast(spans), F.col("feature") == F.col("of")).select(
        "feature",
        "lo",
        "hi",
        F.lit(bins).alias("bins"),
        F.when(F.col("lo").isNull() & (F.col("bin") >= 0), OUTSIDE)
        .otherwise(F.col("bin"))
        .alias("bin"),
        "n",
    )


def psi_against_profile(stored: DataFrame, new: DataFrame) -> DataFrame:
    """PSI of ``new`` against a stored :func:`profile`, in its bins, without the baseline rows."""
    spans = stored.select("feature", "lo", "hi", "bins").distinct().collect()
    counts = {r["bins"] for r in spans}
    if not any(r["feature"] in new.columns for r in spans):
        return new.sparkSession.createDataFrame([], PSI_SCHEMA)
    if len(counts) != 1:
        raise ValueError(f"the profile has {len(counts)} numbers of bins")
    (bins,) = counts
    spans = [r for r in spans if r["feature"] in new.columns]
    ranges: Ranges = {
        r["feature"]: None if r["lo"] is None else (r["lo"], r["hi"]) for r in spans
    }
    fresh = histogram(new, _all_ranges(ranges), bins).withColumn("side", F.lit(NEW))
    kept = stored.where(F.col("feature").isin(list(ranges))).select(
        "feature", "bin", "n", F.lit(BASE).alias("side")
    )
    return psi_from_counts(_regrouped(kept.unionByName(fresh)), bins)


def flag(psi_table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``drifted``: PSI strictly above the threshold, NULL where there is none."""
    flagged = psi_table.withColumn("drifted", F.col("psi") > F.lit(threshold))
    if "status" in psi_table.columns:
        return flagged
    return flagged.withColumn("status", F.lit(COMPARED))


def _absent_features(
    spark: SparkSession, wanted: Sequence[str], base: Sequence[str], new: Sequence[str]
) -> DataFrame | None:
    absent = [(c, "missing_in_new") for c in wanted if c not in new]
    absent += [(c, "missing_in_base") for c in wanted if c not in base]
    if not absent:
        return None
    return spark.createDataFrame(absent, "feature string, status string")


def drift_report(
    base: DataFrame,
    new: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float = THRESHOLD,
    bins: int = BINS,
    combined_range: bool = False,
) -> DataFrame:
    """PSI, flag and counts: one row per feature.

    What cannot be compared has a NULL PSI and its own status: ``missing_in_new`` or
    ``missing_in_base`` for a column only one table has, ``no_new_values`` or
    ``no_baseline_values`` for one that is empty on a side.
    """
    if columns is None:
        columns = list(dict.fromkeys([*base.columns, *new.columns]))
    shared = [c for c in columns if c in base.columns and c in new.columns]
    report = flag(psi(base, new, shared, bins, combined_range), threshold)
    absent = _absent_features(base.sparkSession, columns, base.columns, new.columns)
    return report if absent is None else report.unionByName(absent, allowMissingColumns=True)


def drift_report_from_profile(
    stored: DataFrame, new: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """:func:`drift_report` with the baseline given as a stored profile."""
    known = [r["feature"] for r in stored.select("feature").distinct().collect()]
    return with_absent(flag(psi_against_profile(stored, new), threshold), known, new)


def with_absent(report: DataFrame, known: Sequence[str], new: DataFrame) -> DataFrame:
    """``report`` with a row for every column that only the baseline (``known``) or only ``new`` has."""
    absent = _absent_features(
        new.sparkSession, list(dict.fromkeys([*known, *new.columns])), known, new.columns
    )
    return report if absent is None else report.unionByName(absent, allowMissingColumns=True)


def schema_report(base: DataFrame, new: DataFrame) -> DataFrame:
    """``(feature, status, n_values)`` for columns the two tables do not share.

    ``n_values`` is the number of non-null values on the side that has the
    column: what a comparison silently skipping the column would ignore.
    """
    problems = schema_differences(base.schema, new.schema)
    parts = []
    for side, table in (("missing_in_new", base), ("type_changed", new), ("missing_in_base", new)):
        names = [name for name, problem in problems if problem == side]
        if names:
            one_row = table.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(names)])
            rows = [
                F.struct(
                    F.lit(c).alias("feature"),
                    F.lit(side).alias("status"),
                    F.col(f"n{i}").alias("n_values"),
                )
                for i, c in enumerate(names)
            ]
            parts.append(one_row.select(F.inline(F.array(*rows))))
    if not parts:
        return base.sparkSession.createDataFrame(
            [], "feature string, status string, n_values bigint"
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def retrain_gate(report: DataFrame) -> DataFrame:
    """One row ``(decision, reason, n_drifted, max_psi)`` from a drift report.

    Any drifted feature means retraining. A feature the new table lacks, or lacks every
    value of, halts the run: there is nothing sound to train on. A feature that the
    baseline has no values of cannot have been learnt from and means retraining too.
    """
    missing = F.count_if(F.col("status").isin("missing_in_new", NO_NEW))
    unknown = F.count_if(F.col("status") == NO_BASELINE)
    drifted = F.count_if(F.coalesce(F.col("drifted"), F.lit(False)))
    summary = report.agg(
        missing.alias("n_missing_features"),
        drifted.alias("n_drifted"),
        unknown.alias("n_unknown"),
        F.max("psi").alias("max_psi"),
    )
    lacking, drift = F.col("n_missing_features") > 0, F.col("n_drifted") > 0
    new_to_model = F.col("n_unknown") > 0
    return summary.select(
        F.when(lacking, HALT).when(drift | new_to_model, RETRAIN).otherwise(KEEP).alias("decision"),
        F.when(lacking, "missing_feature")
        .when(drift, "drift")
        .when(new_to_model, NO_BASELINE)
        .otherwise("stable")
        .alias("reason"),
        "n_drifted",
        "max_psi",
    )


def gate_without_baseline(spark: SparkSession) -> DataFrame:
    """The decision when no model has been promoted yet: train."""
    return spark.createDataFrame(
        [(RETRAIN, "no_baseline", 0, None)],
        "decision string, reason string, n_drifted bigint, max_psi double",
    )


def inject_shift(
    df: DataFrame,
    source: str,
    target: str,
    factor: float = 1.5,
    key: Sequence[str] | None = None,
    seed: int = 0,
    salt: str = "shift",
) -> DataFrame:
    """Overwrite ``target`` with ``source * factor`` plus N(0, 1) noise.

    With a ``key`` the noise is a function of the row's key and repeats exactly;
    without one it comes from Spark's seeded generator.
    """
    noise = standard_normal(list(key), salt) if key else F.randn(seed)
    return df.withColumn(target, F.col(source) * F.lit(factor) + noise)
