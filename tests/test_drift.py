import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift
from tidemark.operators.histograms import feature_ranges, histogram, with_empty_bins


def column(spark, values, name="v"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def numpy_psi(base, new, bins=10, combined=False):
    span = np.concatenate([base, new]) if combined else base
    edges = np.linspace(span.min(), span.max(), bins + 1)
    p, q = (np.where(c == 0, 1e-4, c) for c in (np.histogram(x, edges)[0] for x in (base, new)))
    p, q = p / p.sum(), q / q.sum()
    return float(((q - p) * np.log(q / p)).sum())


def psi_of(spark, base, new, **options):
    table = drift.psi(column(spark, base), column(spark, new), ["v"], **options)
    return table.first().asDict()


@pytest.mark.parametrize("bins", [1, 2, 3, 7, 10, 33, 100])
def test_histogram_agrees_with_numpy(spark, bins):
    rng = np.random.default_rng(bins)
    values = np.concatenate([rng.normal(size=400), np.round(rng.uniform(-2, 2, 400), 1)])
    df = column(spark, values)
    counts = with_empty_bins(histogram(df, feature_ranges(df, ["v"]), bins), bins)
    got = [r["n"] for r in counts.orderBy("bin").collect()]
    want = np.histogram(values, np.linspace(values.min(), values.max(), bins + 1))[0]
    assert got == want.tolist()


def test_values_on_edges_go_right_and_the_last_bin_is_closed(spark):
    df = column(spark, [i / 100 for i in range(11)])
    counts = histogram(df, feature_ranges(df, ["v"])).orderBy("bin").collect()
    want = np.histogram([i / 100 for i in range(11)], np.linspace(0, 0.1, 11))[0]
    assert [r["n"] for r in counts] == [n for n in want if n]


def test_histogram_reports_outside_and_missing(spark):
    df = column(spark, [None, float("nan"), -1, 0, 5, 10, 11])
    counts = {r["bin"]: r["n"] for r in histogram(df, {"v": (0.0, 10.0)}, 2).collect()}
    assert counts == {-2: 2, -1: 2, 0: 1, 1: 2}


def test_ranges_skip_missing_values(spark):
    df = column(spark, [None, float("nan"), 3, 1])
    assert feature_ranges(df, ["v"]) == {"v": (1.0, 3.0)}
    assert feature_ranges(column(spark, [None]), ["v"]) == {"v": None}
    with pytest.raises(ValueError, match="value range"):
        histogram(df, {"v": None})


@pytest.mark.parametrize("combined", [False, True])
def test_psi_agrees_with_numpy(spark, combined):
    rng = np.random.default_rng(5)
    base, new = rng.normal(size=700), rng.normal(0.4, 1.3, size=500)
    got = psi_of(spark, base, new, combined_range=combined)["psi"]
    assert got == pytest.approx(numpy_psi(base, new, combined=combined), rel=1e-12)
    assert got > 0


def test_equal_populations_do_not_drift(spark):
    values = np.random.default_rng(1).normal(size=300)
    assert psi_of(spark, values, values)["psi"] == 0.0


def test_constant_baseline(spark):
    row = psi_of(spark, [3] * 8, [3, 3, 4, 5])
    assert row["n_out_of_range"] == 2
    assert row["psi"] == pytest.approx(numpy_psi(np.array([3.0] * 8), np.array([3.0, 3, 4, 5])))


def test_new_side_out_of_range_is_reported(spark):
    row = psi_of(spark, range(20), range(100, 130))
    assert row["n_out_of_range"] == 30 == row["n_new"]
    assert row["psi"] == pytest.approx(
        numpy_psi(np.arange(20.0), np.arange(100.0, 130.0))
    )


def test_empty_new_side(spark):
    row = psi_of(spark, range(20), [])
    assert row["n_new"] == 0 and row["psi"] is not None


def two(spark, shift):
    rng = np.random.default_rng(9)
    rows = [(float(a), float(a + shift), float(b)) for a, b in rng.normal(size=(400, 2))]
    return spark.createDataFrame(rows, "a double, b double, c double")


def test_report_and_gate(spark):
    base, new = two(spark, 0.0), two(spark, 3.0)
    report = drift.drift_report(base, new)
    flags = {r["feature"]: r["drifted"] for r in report.collect()}
    assert flags == {"a": False, "b": True, "c": False}
    gate = drift.retrain_gate(report).first()
    assert (gate["decision"], gate["reason"], gate["n_drifted"]) == ("train_model", "drift", 1)
    stable = drift.retrain_gate(drift.drift_report(base, base)).first()
    assert (stable["decision"], stable["reason"]) == ("no_model_drift", "stable")


def test_threshold_is_strict(spark):
    table = spark.createDataFrame([("a", 0.25), ("b", 0.2500001)], "feature string, psi double")
    assert [r["drifted"] for r in drift.flag(table).collect()] == [False, True]


def test_missing_features_are_never_silent(spark):
    base, new = two(spark, 0.0), two(spark, 0.0).drop("c").withColumn("d", F.lit(1.0))
    report = drift.drift_report(base, new)
    status = {r["feature"]: r["status"] for r in report.collect()}
    assert status == {"a": "compared", "b": "compared", "c": "missing_in_new", "d": "missing_in_base"}
    assert drift.retrain_gate(report).first()["decision"] == "halt"


def test_profile_gives_the_same_report(spark):
    base, new = two(spark, 0.0), two(spark, 1.0)
    stored = drift.profile(base, base.columns)
    assert stored.count() <= 3 * 12
    direct = {r["feature"]: r["psi"] for r in drift.drift_report(base, new).collect()}
    profiled = drift.drift_report_from_profile(stored, new).collect()
    assert {r["feature"]: r["psi"] for r in profiled} == pytest.approx(direct)
    lacking = drift.drift_report_from_profile(stored, new.drop("a"))
    assert {r["feature"]: r["status"] for r in lacking.collect()}["a"] == "missing_in_new"


def test_no_baseline(spark):
    row = drift.gate_without_baseline(spark).first()
    assert (row["decision"], row["reason"]) == ("train_model", "no_baseline")


def test_injected_shift_repeats_and_has_unit_noise(spark):
    df = spark.range(4000).select("id", (F.col("id") % 7).cast("double").alias("x"))
    shifted = drift.inject_shift(df, "x", "y", 2.0, key=["id"])
    again = drift.inject_shift(df.repartition(9), "x", "y", 2.0, key=["id"])
    assert sorted(shifted.collect()) == sorted(again.collect())
    noise = shifted.select((F.col("y") - 2 * F.col("x")).alias("e"))
    mean, deviation = noise.agg(F.avg("e"), F.stddev("e")).first()
    assert abs(mean) < 0.06 and abs(deviation - 1) < 0.04
    unkeyed = drift.inject_shift(df, "x", "y", seed=3).agg(F.avg(F.col("y") - 1.5 * F.col("x")))
    assert abs(unkeyed.first()[0]) < 0.06


def test_schema_report_counts_values(spark):
    base = spark.createDataFrame([(1, 2.0), (None, 3.0)], "a int, b double")
    new = spark.createDataFrame([(1.0, "x")], "b double, c string")
    rows = sorted(tuple(r) for r in drift.schema_report(base, new).collect())
    assert rows == [("a", "missing_in_new", 1), ("c", "missing_in_base", 1)]
    assert drift.schema_report(base, base).count() == 0


def test_empty_sides_have_their_own_status(spark):
    gap = lambda df, c: df.withColumn(c, F.lit(None).cast("double"))
    base, new = two(spark, 0.0), two(spark, 0.0)
    for stored in (False, True):
        compare = lambda b, n: (
            drift.drift_report_from_profile(drift.profile(b, b.columns), n)
            if stored
            else drift.drift_report(b, n)
        )
        report = compare(gap(base, "a"), new)
        assert {r["feature"]: r["status"] for r in report.collect()}["a"] == "no_baseline_values"
        gate = drift.retrain_gate(report).first()
        assert (gate["decision"], gate["reason"]) == ("train_model", "no_baseline_values")
        report = compare(base, gap(new, "b"))
        assert {r["feature"]: r["status"] for r in report.collect()}["b"] == "no_new_values"
        assert drift.retrain_gate(report).first()["decision"] == "halt"
    only = drift.drift_report(gap(base, "a").select("a"), new.select("a")).collect()
    assert [r["status"] for r in only] == ["no_baseline_values"]


def test_infinities_are_out_of_range(spark):
    row = psi_of(spark, [*range(20), float("inf")], [*range(20), float("-inf"), float("inf")])
    assert row["n_out_of_range"] == 2 and row["psi"] == 0.0
    moved = psi_of(spark, [*range(20), float("inf")], [19.0] * 20)
    assert moved["psi"] > 0.25


def test_profile_brings_its_bins(spark):
    base, new = two(spark, 0.0), two(spark, 0.0)
    for bins in (10, 20):
        stored = drift.profile(base, base.columns, bins)
        assert {r["psi"] for r in drift.psi_against_profile(stored, new).collect()} == {0.0}
