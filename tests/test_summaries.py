"""Baseline summaries: exact merges, and a PSI as near to the exact one as they say."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, summaries
from tidemark.operators.summaries import exponent_for, merge_summaries, psi_against_summary, rebin, summarize


def table(spark, seed, n=3000, scale=1.0, shift=0.0):
    rng = random.Random(seed)
    rows = [
        (
            rng.gauss(shift, scale),
            float(rng.randint(0, 5)),
            1e9 + rng.random() * 1e-3 * scale,
            None if rng.random() < 0.1 else rng.expovariate(1.0) + shift,
            rng.choice([float("inf"), float("nan"), 2.0 + shift]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)


@pytest.mark.parametrize(
    ("lo", "hi"), [(0.0, 0.0), (0.0, 1.0), (-5.0, 1e12), (1e9, 1e9 + 1e-3), (7.5, 7.5), (-1e300, 1e300), (0.0, 5e-324)]
)
def test_cells_are_few_and_no_coarser_than_needed(lo, hi):
    import math

    def cells(e):
        return math.floor(math.ldexp(hi, -e)) - math.floor(math.ldexp(lo, -e)) + 1

    e = exponent_for(lo, hi)
    assert cells(e) <= summaries.CELLS
    assert hi == lo or cells(e) >= summaries.CELLS // 4 or math.ulp(hi) >= 2.0 ** (e - 2) or e == -1000


def test_error_covers_the_exact_psi(spark):
    base = table(spark, 1)
    for seed, scale, shift in ((2, 1.0, 0.0), (3, 1.7, 0.4), (4, 0.2, 30.0)):
        new = table(spark, seed, 2000, scale, shift)
        for cells in (4096, 50):
            for combined in (True, False):
                summary = summarize(base, base.columns, cells)
                found = {r["feature"]: r for r in psi_against_summary(summary, new, 10, combined).collect()}
                for row in drift.psi(base, new, base.columns, combined_range=combined).collect():
                    got = found[row["feature"]]
                    assert abs(got["psi"] - row["psi"]) <= got["max_error"] + 1e-9, (row, got)
                    assert all(got[c] == row[c] for c in ("n_base", "n_new", "n_out_of_range", "n_missing", "status"))
                    if cells == 4096 and row["feature"] != "c" and shift < 10:
                        assert got["max_error"] < 0.05
        assert found["b"]["feature"] == "b"


def test_bins_lie_between_their_bounds(spark):
    base = table(spark, 5)
    ranges = {"a": (-6.1, 7.3), "b": (-1.0, 6.5)}
    exact = {c: [0] * 7 for c in ranges}
    from tidemark.operators.histograms import histogram

    for r in histogram(base, ranges, 7).collect():
        if r["bin"] >= 0:
            exact[r["feature"]][r["bin"]] = r["n"]
    for row in rebin(summarize(base, ["a", "b"], 64), ranges, 7).collect():
        want = exact[row["feature"]]
        assert all(low <= n <= high for low, n, high in zip(row["least"], want, row["most"]))
        assert sum(row["expected"]) == pytest.approx(3000)


def test_merged_parts_equal_the_whole(spark):
    parts = [table(spark, k, 500, scale=1.0 + 30 * k) for k in range(4)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    merged = merge_summaries(*(summarize(p, p.columns) for p in parts))
    told = {r["feature"]: r for r in merged.select("feature", "exponent", "lo", "hi").distinct().collect()}
    direct = {r["feature"]: r for r in summarize(whole, whole.columns).select("feature", "exponent", "lo", "hi").distinct().collect()}
    counts = {}
    for r in merged.collect():
        counts.setdefault(r["feature"], {})[r["cell"], r["kind"]] = r["n"]
    values = {c: [r[c] for r in whole.collect()] for c in whole.columns}
    for c, row in told.items():
        assert (row["lo"], row["hi"]) == (direct[c]["lo"], direct[c]["hi"])
        want = {}
        for v in values[c]:
            kind = "missing" if v is None or v != v else "outside" if abs(v) == float("inf") else "cell"
            cell = int(v * 2.0 ** -row["exponent"] // 1) if kind == "cell" else None
            want[cell, kind] = want.get((cell, kind), 0) + 1
        assert counts[c] == want


def test_empty_and_missing(spark):
    schema = "a double, b double"
    none = spark.createDataFrame([(None, 1.0)] * 5, schema)
    some = spark.createDataFrame([(1.0, 1.0)] * 5, schema)
    found = {r["feature"]: r for r in psi_against_summary(summarize(none, ["a", "b"]), some).collect()}
    assert found["a"]["status"] == drift.NO_BASELINE and found["a"]["psi"] is None
    assert found["b"]["psi"] == pytest.approx(0.0) and found["b"]["max_error"] < 1e-3
    found = {r["feature"]: r for r in psi_against_summary(summarize(some, ["a", "b"]), none).collect()}
    assert found["a"]["status"] == drift.NO_NEW
    assert psi_against_summary(summarize(some, ["a"]), none.select("b")).count() == 0
    assert summarize(some, []).count() == 0


def test_the_baseline_is_not_read_for_a_combined_range(spark, tmp_path):
    import shutil

    from test_registry import FAST, LABEL, SPEC, customers

    from tidemark.plans import lifecycle
    from tidemark.plans.prepare import prepare_snapshot
    from tidemark.sources.ledgers import Registry

    registry = Registry(spark, str(tmp_path / "registry"))
    prepare_snapshot(registry, customers(spark), SPEC, "m", "20240101000000")
    lifecycle.train_and_promote(registry, "m", LABEL, ["forest"], FAST)
    prepare_snapshot(registry, customers(spark, shift=9.0), SPEC, "m", "20240102000000")
    want = registry.snapshot("20240101000000")["table_path"]
    exact, gate = lifecycle.check_drift(registry, "m", LABEL, combined_range=True)
    exact = {r["feature"]: (r["psi"], r["drifted"]) for r in exact.collect()}
    shutil.rmtree(want)
    again, gate = lifecycle.check_drift(registry, "m", LABEL, combined_range=True, bins=8)
    rows = {r["feature"]: r for r in again.collect()}
    assert {f for f, r in rows.items() if r["drifted"]} == {f for f, (_, d) in exact.items() if d} != set()
    assert gate.first()["n_drifted"] == 1
    assert F is not None
