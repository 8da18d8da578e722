"""Work that must not pile up, be repeated or go unseen: hot values, wide tables, copies, fits, scores."""

import math
import os
import threading
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import categories, clean, histograms, models
from tidemark.operators.sampling import balance_by_sampling, poisson_bounds
from tidemark.plans import lifecycle
from tidemark.session import session_setting, stage
from tidemark.sources.ledgers import Registry
from tidemark.spec import FeatureSpec


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- values unseen when fitting


def test_a_hot_unseen_value_meets_in_no_task(spark):
    fitted = spark.range(4000).select(F.concat(F.lit("k"), F.col("id") % 3000).alias("c"))
    index = categories.fit_index(fitted, ["c"], max_categories=10)
    n = 40_000
    new = spark.range(n).select(
        "id",
        F.when(F.col("id") % 5 < 2, "unseen")
        .when(F.col("id") % 5 == 2, "k2999")  # rare when fitted, hot now
        .otherwise(F.concat(F.lit("k"), F.col("id") % 3000))
        .alias("c"),
    )
    assert set(categories._frequent_keys(new, ["c"])["c"]) >= {"=unseen", "=k2999"}
    with session_setting(spark, "spark.sql.adaptive.enabled", "false"):
        with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            found = categories.apply_index(new, index)
            assert "SortMergeJoin" in executed(found)
            parts = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert len(parts) == 8 and max(r["count"] for r in parts) < 1.3 * n / 8
            sizes = dict(found.groupBy("c_indexed").count().collect())
    assert sizes[3000.0] == 0.4 * n
    place = {r["value"]: r["index"] for r in index.wide["c"].collect()}
    assert sizes[float(place["k2999"])] == new.where("c = 'k2999'").count() > 0.2 * n


@pytest.mark.parametrize("policy", ["error", "skip"])
def test_policies_hold_for_hot_unseen_values(spark, policy):
    fitted = spark.range(100).select(F.col("id").cast("string").alias("c"))
    index = categories.fit_index(fitted, ["c"], max_categories=10)
    new = spark.createDataFrame([("x",)] * 50 + [("7",)] * 50 + [(None,)], "c string")
    if policy == "error":
        with pytest.raises(Exception, match="unseen category in c: x"):
            categories.apply_index(new, index, "error").collect()
    else:
        assert categories.apply_index(new, index, "skip").count() == 50


# ---- histograms of wide tables


def test_rows_are_not_multiplied_by_features(spark):
    df = spark.range(1000).select(*((F.col("id") % (k + 2)).cast("double").alias(f"c{k}") for k in range(30)))
    counted = histograms.histogram(df, {f"c{k}": (0.0, float(k + 1)) for k in range(30)}, 5)
    assert "Generate" not in executed(counted) and "Expand" not in executed(counted)
    assert counted.groupBy("feature").agg(F.sum("n").alias("n")).where("n <> 1000").count() == 0


def test_many_features_cost_no_more_each(spark):
    rows = stage(
        spark.range(60_000).select(*(F.rand(k).alias(f"c{k}") for k in range(200))).repartition(4), "wide"
    )

    def seconds(n):
        ranges = {f"c{k}": (0.0, 1.0) for k in range(n)}
        histograms.histogram(rows, ranges).count()
        began = time.perf_counter()
        histograms.histogram(rows, ranges).count()
        return time.perf_counter() - began

    assert seconds(200) / 200 <= 2 * seconds(20) / 20


def test_groups_nulls_and_many_groups(spark, monkeypatch):
    rows = [(k % 7 if k % 5 else None, f"g{k % 3}", k / 10, None if k % 4 == 0 else float(k)) for k in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, x double, y double")
    ranges = {"x": (0.0, 20.0), "y": (5.0, 300.0), "none": None}
    want = Counter()
    for a, b, x, y in rows:
        for name, v, (lo, hi) in (("x", x, ranges["x"]), ("y", y, ranges["y"])):
            edges = histograms.edge_grid(lo, hi, 4)
            bin_ = -2 if v is None else -1 if not lo <= v <= hi else min(3, sum(v >= e for e in edges[1:]))
            want[a, b, name, bin_] += 1
    for held in (1000, 2):
        monkeypatch.setattr(histograms, "GROUPS_HELD", held)
        got = histograms.histogram(df, ranges, 4, by=["a", "b"]).collect()
        assert {(r["a"], r["b"], r["feature"], r["bin"]): r["n"] for r in got} == want


# ---- copies


ROWS = [(k, "x" * 50, None, float("nan")) for k in range(300)] + [(1, None, 2, 0.0), (1, None, 2, -0.0)] * 40


def test_digests_find_the_same_rows(spark):
    df = spark.createDataFrame(ROWS + ROWS[:30], "a int, `b.c` string, d int, e double")
    want = sorted(map(str, df.distinct().collect()))
    assert sorted(map(str, clean.drop_duplicates(df, by_digest=True).collect())) == want


def test_without_copies_only_digests_move(spark):
    df = spark.range(2000).select("id", F.repeat(F.col("id").cast("string"), 200).alias("text"))
    kept = clean.drop_duplicates(df, by_digest=True)
    assert kept.count() == 2000
    text = kept.select("text").where("length(text) > 0")
    moved = [line for line in executed(text).splitlines() if "hashpartitioning" in line]
    assert all("text" in line for line in moved)  # of rows with a repeated digest only: none here
    assert kept.where("id < 0").count() == 0


def test_colliding_digests_are_compared(spark, monkeypatch):
    monkeypatch.setattr(clean.F, "xxhash64", lambda *columns: F.lit(1))
    df = spark.createDataFrame([(1,), (2,), (2,)], "a int")
    assert sorted(r["a"] for r in clean.drop_duplicates(df, by_digest=True).collect()) == [1, 2]


def test_many_copies_are_shuffled_whole(spark, monkeypatch):
    monkeypatch.setattr(clean, "REPEATED_DIGESTS", 3)
    df = spark.range(100).select((F.col("id") % 50).alias("a"))
    assert clean.drop_duplicates(df, by_digest=True).count() == 50


def test_losses_of_every_step(spark):
    rows = [("1.5", "k", 1.0)] * 3 + [(" ", "k", 1.0), ("x", "l", 2.0), (None, "m", 1.0), ("2", None, 1.0),
            ("3", "n", float("nan")), ("4", "n", 5.0)]
    df = spark.createDataFrame(rows, "amount string, kind string, y double")
    spec = FeatureSpec(label="kind", to_double=["amount", "absent"])
    losses = clean.Losses()
    kept = stage(clean.clean(df, spec, losses), "cleaned")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, clean.clean(df, spec).collect()))
    told = {(r["step"], r["column"]): r["n"] for r in losses.table(spark).collect()}
    assert told == {
        ("unparsable", "amount"): 2, ("read", None): 9, ("incomplete", None): 5, ("duplicate", None): 2,
        ("kept", None): 2,
    }


def test_observed_sessions_can_still_score(spark):
    """Training summaries hold the session, which cannot be sent once a table was observed."""
    df = spark.range(200).select((F.col("id") / 200).alias("x"), (F.col("id") > 90).cast("double").alias("y"))
    losses = clean.Losses()
    stage(clean.clean(df, FeatureSpec(label="y"), losses), "cleaned")
    for algorithm in ("logistic", "forest", "svc"):
        model = models.train(df, "y", algorithm, **({"numTrees": 3} if algorithm == "forest" else {"maxIter": 8}))
        assert model.transform(df).where("prediction = y").count() > 150


# ---- Poisson copies


def test_poisson_copies_hang_on_the_row_alone(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"))
    first = Counter(map(tuple, balance_by_sampling(df, "y", 5, key=["id"]).collect()))
    for other in (df.repartition(7), df.coalesce(1)):
        assert Counter(map(tuple, balance_by_sampling(other, "y", 5, key=["id"]).collect())) == first
    assert Counter(map(tuple, balance_by_sampling(df, "y", 6, key=["id"]).collect())) != first
    assert Counter(map(tuple, balance_by_sampling(df.where("id < 100"), "y", 5, {"a": 2.0}, ["id"]).collect())) == {
        row: n for row, n in first.items() if row[0] < 100 and row[1] == "a"
    }


@pytest.mark.parametrize("mean", [0.3, 1.7, 15.0, 200.0])
def test_poisson_sizes_and_spread(spark, mean):
    n = 3000
    df = spark.range(n).select("id", F.lit("a").alias("y"))
    counts = Counter(r["id"] for r in balance_by_sampling(df, "y", 1, {"a": mean}, ["id"]).collect())
    total = sum(counts.values())
    assert abs(total - n * mean) <= 5 * math.sqrt(n * mean)
    variance = sum((counts.get(k, 0) - mean) ** 2 for k in range(n)) / n
    assert abs(variance - mean) < 6 * math.sqrt((mean + 2 * mean**2) / n)


def test_poisson_bounds_are_a_distribution():
    for mean in (0.0, 0.5, 16.0):
        bounds = poisson_bounds(mean)
        assert bounds == sorted(bounds) and 1 - bounds[-1] < 2**-32
        assert bounds[0] == pytest.approx(math.exp(-mean))


# ---- fits side by side


def test_fits_run_at_the_same_time(spark):
    inside, most, lock = [0], [0], threading.Lock()

    def work(name):
        with lock:
            inside[0] += 1
            most[0] = max(most[0], inside[0])
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == name
        n = spark.range(1000).count()
        time.sleep(0.3)
        with lock:
            inside[0] -= 1
        return f"{name}{n}"

    assert lifecycle.side_by_side(spark, work, ["a", "b", "c"]) == ["a1000", "b1000", "c1000"]
    assert most[0] == 3
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_the_first_error_cancels_the_others(spark):
    def work(name):
        if name == "bad":
            time.sleep(1)
            raise ValueError("no convergence")
        slow = F.expr("java_method('java.lang.Thread', 'sleep', cast(id * 0 + 60000 as bigint))")
        return spark.range(0, 2, 1, 2).select(slow).collect()

    began = time.monotonic()
    with pytest.raises(ValueError, match="no convergence"):
        lifecycle.side_by_side(spark, work, ["slow", "bad", "slow too"])
    assert time.monotonic() - began < 30
    assert spark.range(10).count() == 10


# ---- scoring that goes on


@pytest.fixture
def scoring(spark, tmp_path):
    registry = Registry(spark, f"{tmp_path}/registry")
    df = spark.range(400).select("id", (F.col("id") / 400).alias("x"), (F.col("id") > 150).cast("double").alias("y"))
    model = models.train(df.select("x", "y"), "y", "tree")
    run_id = registry.record_run(model, "s", "tree", {"accuracy": 1.0}, models.input_schema(df.select("x", "y"), "y"))
    registry.promote(registry.run(run_id), "m")
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    df.drop("y").repartition(6, "id").write.parquet(source)
    return registry, df, source, target


def test_a_restart_scores_only_the_rest(spark, scoring):
    registry, df, source, target = scoring
    with pytest.raises(ValueError, match="scored nothing"):
        lifecycle.read_scored(registry, "m", target)
    first = lifecycle.score_new_files(registry, "m", source, target, files_at_once=2, at_most=1)
    files = sorted(Path(source).glob("*.parquet"))
    assert len(files) == 6
    for f in files[:2]:  # what is scored already is not read again
        os.truncate(f, 0)
    rest = spark.read.parquet(*map(str, files[2:])).count()
    assert lifecycle.score_new_files(registry, "m", source, target, files_at_once=3) == rest == 400 - first
    rows = lifecycle.read_scored(registry, "m", target)
    assert rows.count() == rows.select("id").distinct().count() == 400
    assert rows.join(df.select("id", "y"), "id").where("prediction <> y and abs(x - 0.375) > 0.05").count() == 0
    assert lifecycle.score_new_files(registry, "m", source, target) == 0


def test_a_part_without_its_record_does_not_count(spark, scoring, monkeypatch):
    registry, _, source, target = scoring
    from tidemark.sources.ledgers import Ledger

    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "append", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            lifecycle.score_new_files(registry, "m", source, target)
    assert lifecycle.score_new_files(registry, "m", source, target) == 400
    assert lifecycle.read_scored(registry, "m", target).count() == 400


def test_of_two_scorers_one_counts(spark, scoring, monkeypatch):
    registry, _, source, target = scoring
    plain = models.score

    def overtaken(*args):
        result = plain(*args)
        monkeypatch.setattr(models, "score", plain)
        assert lifecycle.score_new_files(registry, "m", source, target) == 400
        return result

    monkeypatch.setattr(models, "score", overtaken)
    assert lifecycle.score_new_files(registry, "m", source, target) == 0
    assert lifecycle.read_scored(registry, "m", target).count() == 400
    assert len(os.listdir(f"{target}/parts")) == 1
