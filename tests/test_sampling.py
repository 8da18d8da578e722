import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions import drawn, hex_bound, uniform
from tidemark.operators.sampling import (
    balance,
    balance_by_sampling,
    class_counts,
    merge_splits,
    oversampling_ratios,
    split,
    split_exact,
    split_random,
)


def classes(spark, sizes):
    rows = [(f"{name}{i}", name) for name, size in sizes.items() for i in range(size)]
    return spark.createDataFrame(rows, "id string, y string")


def test_balancing_keeps_every_row_often_enough(spark):
    df = classes(spark, {"a": 1000, "b": 300, "c": 7})
    balanced = balance(df, "y", ["id"], copy_column="copy_no").collect()
    counts = Counter(r["id"] for r in balanced)
    ratios = {"a": 1.0, "b": 1000 / 300, "c": 1000 / 7}
    for (name, n) in counts.items():
        low = math.floor(ratios[name[0]])
        assert low <= n <= low + 1
    assert len(counts) == 1307
    sizes = Counter(r["y"] for r in balanced)
    assert sizes["a"] == 1000
    assert abs(sizes["b"] - 1000) < 60 and abs(sizes["c"] - 1000) < 8
    per_row = Counter((r["id"], r["copy_no"]) for r in balanced)
    assert set(per_row.values()) == {1}


def test_balancing_does_not_depend_on_partitions(spark):
    df = classes(spark, {"a": 500, "b": 90})
    one = balance(df.repartition(1), "y", ["id"]).collect()
    many = balance(df.repartition(13), "y", ["id"]).collect()
    assert Counter(r["id"] for r in one) == Counter(r["id"] for r in many)


def test_balancing_without_a_key_uses_the_values(spark):
    df = classes(spark, {"a": 50, "b": 20})
    assert Counter(balance(df, "y").collect()) == Counter(balance(df.repartition(5), "y").collect())


def test_balancing_only_some_rows(spark):
    df = classes(spark, {"a": 40, "b": 10})
    even = F.col("id").endswith("0")
    ratios = {"a": 1.0, "b": 4.0}
    out = balance(df, "y", ["id"], ratios=ratios, only=even)
    assert Counter(r["id"] for r in out.collect())["b0"] == 4
    assert out.where(~even).groupBy("id").count().where("count > 1").count() == 0


def test_a_rare_class_alone_is_redistributed(spark):
    # Many equal rows in a class to be repeated 100 times.
    rows = [("usual", i) for i in range(4000)] + [("rare", -1)] * 40
    df = spark.createDataFrame(rows, "y string, id int").coalesce(1)
    out = balance(df, "y", ["id"], copy_column="copy_no")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Union" in plan
    assert Counter(r["y"] for r in out.collect()) == {"usual": 4000, "rare": 4000}
    per_task = out.where("y = 'rare'").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) < 2000


def test_balancing_needs_two_classes(spark):
    with pytest.raises(ValueError, match="nothing to balance"):
        balance(classes(spark, {"a": 5}), "y")


def test_sampling_balances_on_average(spark):
    df = classes(spark, {"a": 2000, "b": 400})
    sizes = {r["y"]: r["n"] for r in class_counts(balance_by_sampling(df, "y", 7), "y").collect()}
    assert sizes["a"] == 2000 and abs(sizes["b"] - 2000) < 250


def test_null_labels_have_no_class(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "y string")
    assert oversampling_ratios(df, "y") == {"a": 1.0, "b": 2.0}
    assert Counter(r["y"] for r in balance(df, "y").collect()) == {"a": 2, "b": 2}


@pytest.mark.parametrize("share", [0.0, 0.2, 1 / 3, 0.999999, 1.0])
def test_text_comparison_equals_the_number(spark, share):
    df = spark.range(3000).select(
        (uniform(["id"], "s") < share).alias("a"), drawn(["id"], "s", hex_bound(share)).alias("b")
    )
    assert df.where("a <> b").count() == 0


def test_split_is_a_partition_and_stable(spark):
    df = spark.range(5000)
    first = {r["id"]: r["split"] for r in split(df.repartition(3), ["id"]).collect()}
    second = {r["id"]: r["split"] for r in split(df.repartition(11), ["id"]).collect()}
    assert first == second and len(first) == 5000
    share = sum(s == "test" for s in first.values()) / 5000
    assert abs(share - 0.2) < 0.03
    assert first != {r["id"]: r["split"] for r in split(df, ["id"], salt="other").collect()}


@pytest.mark.parametrize("n", [1, 4, 5, 11, 2003])
def test_exact_split_size(spark, n):
    out = split_exact(spark.range(n), ["id"]).groupBy("split").count().collect()
    sizes = {r["split"]: r["count"] for r in out}
    assert sizes["test"] == math.ceil(0.2 * n)
    assert sizes.get("train", 0) == n - math.ceil(0.2 * n)


def test_exact_split_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.sampling._LISTED", 2)
    assert split_exact(spark.range(3000), ["id"]).where("split = 'test'").count() == 600


def test_exact_split_keeps_equal_keys_together(spark):
    # One key holds a third of all rows.
    df = spark.createDataFrame([(0,)] * 500 + [(i,) for i in range(1, 1001)], "id int")
    marked = split_exact(df, ["id"])
    sides = marked.groupBy("id").agg(F.count_distinct("split").alias("k"))
    assert sides.where("k > 1").count() == 0
    assert marked.where("split = 'test'").count() >= 300


def test_exact_split_of_nothing(spark):
    assert split_exact(spark.range(0), ["id"]).count() == 0


def test_random_split_loses_no_row(spark):
    train, test = split_random(spark.range(1000), seed=42)
    assert sorted(r["id"] for r in merge_splits(train, test).collect()) == list(range(1000))


def test_ratios_below_one_thin_a_class(spark):
    df = spark.range(400).select("id", (F.col("id") % 2).alias("c"))
    for ratio, low, high in ((0.0, 0, 0), (0.5, 70, 130)):
        got = balance(df, "c", ["id"], ratios={0: 1.0, 1: ratio})
        sizes = {r["c"]: r["count"] for r in got.groupBy("c").count().collect()}
        assert sizes[0] == 200 and low <= sizes.get(1, 0) <= high


def test_null_labels_can_be_kept_or_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, c string")
    assert balance(df, "c", ["id"], null_labels="keep").where("c is null").count() == 1
    with pytest.raises(Exception, match="cannot be balanced"):
        balance(df, "c", ["id"], null_labels="error").collect()


def test_class_bound_is_a_parameter(spark):
    df = spark.range(30).select((F.col("id") % 5).alias("c"))
    with pytest.raises(ValueError, match="more than 4"):
        oversampling_ratios(df, "c", max_classes=4)


def test_exact_split_of_equal_keys(spark):
    df = spark.createDataFrame([(7,)] * 50, "id int")
    assert {r["split"] for r in split_exact(df, ["id"], 0.2).collect()} == {"test"}
