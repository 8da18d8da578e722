from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.sampling import split
from tidemark.plans import lifecycle
from tidemark.plans.prepare import FeatureState, prepare, prepare_snapshot, to_features
from tidemark.sources import snapshots
from tidemark.sources.csv import read_csv, write_csv
from tidemark.sources.ledgers import Ledger, Registry, champions, read_json_ledger, recent
from tidemark.spec import FeatureSpec

SPEC = FeatureSpec(label="left", drop=["customer"], to_double=["total"])
LABEL = "left_indexed"
FAST = {"forest": {"numTrees": 5}}


def customers(spark, n=900, shift=0.0):
    """Customers, a quarter of whom leave; the short-tenured more often."""
    i = F.col("id")
    tenure = (i * 37 % 72).cast("int")
    return spark.range(n).select(
        F.concat(F.lit("c"), i).alias("customer"),
        tenure.alias("tenure"),
        ((i * 53 % 100) / 1.0 + shift + tenure * shift).alias("monthly"),
        F.when(i % 97 == 0, " ").otherwise((tenure * 20 + i % 7).cast("string")).alias("total"),
        F.when(i % 3 == 0, "year").when(i % 3 == 1, "month").otherwise("two years").alias("contract"),
        F.when(tenure < 18, "yes").otherwise("no").alias("left"),
    )


def test_ledger_appends_and_keeps_order(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), "seq bigint, snapshot_id string")
    assert ledger.read().count() == 0 and ledger.last("snapshot_id") is None
    for stamp in ("20240103", "20240101", "20240102"):
        ledger.append(snapshot_id=stamp)
    assert [r["seq"] for r in ledger.read().orderBy("seq").collect()] == [1, 2, 3]
    assert ledger.last("snapshot_id") == "20240102"


def test_simultaneous_writers_lose_nothing(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), "seq bigint, snapshot_id string")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: ledger.append(snapshot_id=f"s{k}"), range(12)))
    rows = ledger.read().orderBy("seq", "record").collect()
    assert sorted(r["snapshot_id"] for r in rows) == sorted(f"s{k}" for k in range(12))
    assert [r["seq"] for r in rows] == list(range(1, 13))
    assert ledger.last("snapshot_id") == rows[-1]["snapshot_id"]


def test_simultaneous_promotions_have_their_own_versions(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    runs = [{"run_id": f"r{k}", "snapshot_id": "s"} for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda r: registry.promote(r, "m"), runs))
    assert sorted(r["version"] for r in registry.promoted("m").collect()) == [1, 2, 3, 4, 5, 6]
    assert registry.current("m")["version"] == 6


def test_json_ledger(spark, tmp_path):
    path = tmp_path / "timestamps.json"
    assert read_json_ledger(spark, str(path)).count() == 0
    path.write_text('[\n {"timestamp": "20240103000000"},\n {"timestamp": "20240102000000"}\n]')
    rows = read_json_ledger(spark, str(path)).orderBy("seq").collect()
    assert [tuple(r) for r in rows] == [(1, "20240103000000"), (2, "20240102000000")]
    for broken in ("", "[{", "[]"):
        path.write_text(broken)
        assert read_json_ledger(spark, str(path)).count() == 0


def test_feature_files(spark, tmp_path):
    for side, rows in (("train", "a,b\n1,2.5\n"), ("test", "a,b\n3,4.5\n")):
        (tmp_path / f"20240101000000_x_{side}.csv").write_text(rows)
    df = snapshots.read_feature_files(spark, str(tmp_path), "20240101000000")
    assert sorted(map(tuple, df.collect())) == [(1, 2.5), (3, 4.5)]


def test_recent_and_champion(spark):
    runs = spark.createDataFrame(
        [(1, 0.9), (2, 0.5), (3, None), (4, 0.5)], "started int, accuracy double"
    )
    recency = [F.col("started").desc()]
    assert [r["started"] for r in recent(runs, 2, recency).collect()] == [4, 3]

    def best_of(k):
        return champions(runs, F.col("accuracy"), recency, k).first()["started"]

    assert [best_of(2), best_of(3), best_of(4)] == [4, 4, 1]
    only_missing = runs.where("started = 3")
    assert champions(only_missing, F.col("accuracy"), recency, 2).count() == 1


def test_champion_needs_a_run(spark, tmp_path):
    with pytest.raises(ValueError, match="no run"):
        Registry(spark, str(tmp_path)).champion("20240101000000")


def test_snapshot_is_written_once(spark, tmp_path):
    df = split(spark.range(500).withColumn("x", F.col("id") * 2), ["id"])
    snapshots.write_snapshot(df, str(tmp_path), "20240101000000")
    with pytest.raises(AnalysisException):
        snapshots.write_snapshot(df, str(tmp_path), "20240101000000")
    both = snapshots.read_snapshot(spark, str(tmp_path), "20240101000000")
    assert sorted(both.collect()) == sorted(df.select("id", "x", "split").collect())
    test_side = snapshots.read_snapshot(spark, str(tmp_path), "20240101000000", "test")
    assert test_side.columns == ["id", "x"]
    assert test_side.count() == df.where("split = 'test'").count()
    assert len(snapshots.new_snapshot_id(spark)) == 14


def test_csv_with_and_without_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.1), (2, None, 2.5)], "i int, s string, d double")
    path = str(tmp_path / "csv")
    write_csv(df, path)
    for read in (read_csv(spark, path), read_csv(spark, path, "i int, s string, d double")):
        assert read.dtypes == df.dtypes
        assert sorted(map(str, read.collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("order", ["split_first", "balance_first"])
def test_prepared_columns_and_balance(spark, order):
    prepared = prepare(customers(spark), SPEC, order)
    table = prepared.table.persist()
    assert prepared.label == LABEL
    assert sorted(table.columns) == sorted(
        ["tenure_scaled", "monthly_scaled", "total_scaled", "contract_indexed", LABEL]
        + ["split", "copy_no"]
    )
    train = {r[LABEL]: r["count"] for r in table.where("split = 'train'").groupBy(LABEL).count().collect()}
    assert set(train) == {0.0, 1.0} and abs(train[0.0] - train[1.0]) < 0.15 * train[0.0]
    copied_test_rows = table.where("split = 'test' and copy_no > 1").count()
    assert (copied_test_rows > 0) == (order == "balance_first")
    originals = table.where("copy_no = 1").count()
    assert originals == customers(spark).where("total <> ' '").drop("customer").distinct().count()


def test_no_copy_of_a_train_row_is_tested(spark):
    table = prepare(customers(spark), SPEC).table
    features = [c for c in table.columns if c not in ("split", "copy_no")]
    sides = table.groupBy(*features).agg(F.count_distinct("split").alias("sides"))
    assert sides.where("sides > 1").count() == 0


def test_state_survives_saving(spark, tmp_path):
    df = customers(spark)
    prepared = prepare(df, SPEC)
    prepared.state.save(spark, str(tmp_path / "state"))
    loaded = FeatureState.load(spark, str(tmp_path / "state"))
    assert loaded.scaling == prepared.state.scaling
    assert loaded.index.labels == prepared.state.index.labels
    again = prepare(df, SPEC, state=loaded).table
    assert sorted(map(str, again.collect())) == sorted(map(str, prepared.table.collect()))


def test_wide_state_survives_saving(spark, tmp_path):
    from tidemark.operators.categories import fit_index
    from tidemark.operators.scaling import Scaling

    df = customers(spark)
    state = FeatureState(Scaling({}), fit_index(df, ["customer", "contract"], max_categories=10))
    state.save(spark, str(tmp_path / "state"))
    loaded = FeatureState.load(spark, str(tmp_path / "state"))
    assert list(loaded.index.wide) == ["customer"]
    wanted = to_features(df, state).select("customer", "customer_indexed").collect()
    assert sorted(to_features(df, loaded).select("customer", "customer_indexed").collect()) == sorted(wanted)


def test_new_label_classes_are_never_merged(spark):
    state = prepare(customers(spark), SPEC).state
    other = customers(spark).withColumn(
        "left", F.when(F.col("tenure") < 9, "c1").when(F.col("tenure") < 18, "c2").otherwise("no")
    )
    with pytest.raises(Exception, match="unseen category in left"):
        prepare(other, SPEC, state=state).table.collect()


def test_unseen_feature_values_follow_the_policy(spark):
    state = prepare(customers(spark), SPEC).state
    new = customers(spark).withColumn(
        "contract", F.when(F.col("tenure") == 5, "decade").otherwise(F.col("contract"))
    )
    kept = prepare(new, SPEC, state=state).table
    assert kept.where("contract_indexed = 3").count() > 0
    skipped = prepare(new, SPEC, state=state, invalid="skip").table
    assert 0 < skipped.count() < kept.count()
    with pytest.raises(Exception, match="unseen category in contract"):
        prepare(new, SPEC, state=state, invalid="error").table.collect()


def test_nothing_staged_is_left(spark, tmp_path):
    from pathlib import Path

    from tidemark.session import shared_folder

    def left():
        return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).iterdir()}

    before = left()
    registry = Registry(spark, str(tmp_path / "registry"))
    prepare_snapshot(registry, customers(spark), SPEC, "departures", "20240101000000")
    assert left() == before
    with pytest.raises(ValueError):
        prepare_snapshot(registry, customers(spark).withColumn("left", F.lit("no")), SPEC, "departures")
    assert left() == before
    prepared = prepare(customers(spark), SPEC)
    assert left() > before
    prepared.discard()
    assert left() == before


def test_unknown_order(spark):
    with pytest.raises(ValueError, match="order must be"):
        prepare(customers(spark), SPEC, "sideways")


def test_whole_life(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "registry"))

    # Nothing promoted yet: train.
    prepare_snapshot(registry, customers(spark), SPEC, "departures", "20240101000000")
    assert lifecycle.retrain_if_needed(registry, "departures", LABEL, overrides=FAST) == (
        "train_model",
        "no_baseline",
    )
    first = registry.current("departures")
    assert (first["version"], first["snapshot_id"], first["stage"]) == (
        1,
        "20240101000000",
        "Production",
    )
    runs = registry.runs.read().collect()
    assert {r["algo"] for r in runs} == {"forest", "ridge_logistic"}
    assert first["run_id"] == max(runs, key=lambda r: (r["metrics"]["accuracy"], r["seq"]))["run_id"]

    # The same population again: keep the model.
    prepare_snapshot(registry, customers(spark), SPEC, "departures", "20240102000000")
    report, gate = lifecycle.check_drift(registry, "departures", LABEL)
    assert gate.first()["decision"] == "no_model_drift"
    assert {r["psi"] for r in report.collect()} == {0.0}
    assert lifecycle.retrain_if_needed(registry, "departures", LABEL) == ("no_model_drift", "stable")

    # A shifted one: its own scaling would hide the shift, the baseline's shows it.
    prepare_snapshot(registry, customers(spark, shift=9.0), SPEC, "departures", "20240103000000")
    report, _ = lifecycle.check_drift(registry, "departures", LABEL)
    assert {r["feature"] for r in report.collect() if r["drifted"]} == {"monthly_scaled"}
    combined, gate = lifecycle.check_drift(registry, "departures", LABEL, combined_range=True)
    assert gate.first()["n_drifted"] == 1
    assert lifecycle.retrain_if_needed(registry, "departures", LABEL, overrides=FAST)[1] == "drift"
    assert registry.current("departures")["version"] == 2

    # Score the test side with the model in force.
    features = snapshots.read_snapshot(
        spark, registry.snapshot_root, "20240103000000", "test"
    ).drop(LABEL)
    scored = lifecycle.score_with_current(registry, "departures", features)
    assert scored.count() == features.count()
    assert {r["prediction"] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}
    with pytest.raises(ValueError, match="missing_in_new"):
        lifecycle.score_with_current(registry, "departures", features.drop("tenure_scaled"))

    # A snapshot without a feature halts the run.
    lacking = FeatureSpec(label="left", drop=["customer", "monthly"], to_double=["total"])
    prepare_snapshot(registry, customers(spark), lacking, "departures", "20240104000000", refit=True)
    with pytest.raises(ValueError, match="lacks a feature"):
        lifecycle.retrain_if_needed(registry, "departures", LABEL)
