import math
import random
from collections import Counter

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators.categories import (
    apply_index,
    fit_index,
    one_hot,
    rank_categories,
)
from tidemark.operators.scaling import apply_scaler, fit_scaler


def test_scaled_column_has_mean_0_and_deviation_1(spark):
    df = spark.createDataFrame([(float(i * i), i) for i in range(50)], "a double, b int")
    scaled = apply_scaler(df, fit_scaler(df, ["a", "b"]))
    row = scaled.agg(
        F.avg("a_scaled"), F.stddev_samp("a_scaled"), F.avg("b_scaled"), F.stddev_samp("b_scaled")
    ).first()
    assert list(row) == pytest.approx([0.0, 1.0, 0.0, 1.0], abs=1e-12)


@pytest.mark.parametrize("values", [[4.5], [0.1] * 7])
def test_one_row_or_constant_column_scales_to_zero(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    scaled = apply_scaler(df, fit_scaler(df, ["a"]))
    assert [r["a_scaled"] for r in scaled.collect()] == pytest.approx([0.0] * len(values), abs=1e-15)


def test_scaler_needs_values(spark):
    with pytest.raises(ValueError, match="no values"):
        fit_scaler(spark.createDataFrame([], "a double"), ["a"])


def test_index_agrees_with_string_indexer(spark):
    random.seed(1)
    rows = [(random.choice("bbbaacdé"), random.randint(1, 4)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b int")
    ours = apply_index(df, fit_index(df, ["a", "b"]), "error")
    theirs = StringIndexer(inputCols=["a", "b"], outputCols=["x", "y"]).fit(df).transform(ours)
    assert theirs.where("a_indexed <> x or b_indexed <> y").count() == 0


def test_ties_are_alphabetical_and_index_is_a_permutation(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    assert fit_index(df, ["v"]).labels == {"v": ["c", "a", "b"]}


def test_boolean_and_date_columns_can_be_indexed(spark):
    df = spark.sql(
        "select * from values (true, date'2024-01-01'), (true, date'2024-01-02'), "
        "(false, date'2024-01-02') as t(flag, day)"
    )
    assert fit_index(df, ["flag", "day"]).labels == {
        "flag": ["true", "false"],
        "day": ["2024-01-02", "2024-01-01"],
    }


def test_unseen_and_null_values(spark):
    known = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    fitted = fit_index(known, ["v"])
    new = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    assert [r["v_indexed"] for r in apply_index(new, fitted, "keep").collect()] == [0.0, 2.0, 2.0]
    assert [r["v_indexed"] for r in apply_index(new, fitted, "skip").collect()] == [0.0]
    with pytest.raises(SparkRuntimeException, match="unseen category in v: (z|NULL)"):
        apply_index(new, fitted, "error").collect()
    with pytest.raises(ValueError, match="invalid must be"):
        apply_index(new, fitted, "whatever")


def test_lookups_of_every_size_agree(spark):
    random.seed(2)
    values = [f"v{int(random.paretovariate(0.6)) % 3000}" for _ in range(6000)]
    values += ["hot"] * 3000 + [None] * 500 + ["long " * 50] * 700 + ["long " * 51] * 3
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    as_list = fit_index(df, ["v"])
    as_table = fit_index(df, ["v"], max_categories=100)
    by_bytes = fit_index(df, ["v"], max_bytes=100)
    assert list(as_table.wide) == ["v"] and list(by_bytes.wide) == ["v"]
    want = {r["id"]: r["v_indexed"] for r in apply_index(df, as_list).collect()}
    got = apply_index(df, as_table).collect()
    assert len(got) == len(want)
    assert {r["id"]: r["v_indexed"] for r in got} == want
    unseen = spark.createDataFrame([(0, "never"), (1, "hot")], "id int, v string")
    k = len(as_list.labels["v"])
    indexed = apply_index(unseen, as_table).collect()
    assert sorted(r["v_indexed"] for r in indexed) == [0.0, float(k)]
    assert as_table.sizes() == as_list.sizes() == {"v": k}
    assert apply_index(unseen, as_table, "skip").count() == 1


def test_distributed_ranks_match_a_plain_sort(spark):
    random.seed(3)
    values = [f"k{random.randint(0, 500)}" for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    want = sorted(Counter(values).items(), key=lambda kv: (-kv[1], kv[0]))
    got = rank_categories(df, "v").orderBy("index").collect()
    assert [(r["value"], r["n"]) for r in got] == want
    assert [r["index"] for r in got] == list(range(len(want)))


def test_one_hot_drops_the_last_and_skips_single_categories(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", "x")], "v string, w string")
    fitted = fit_index(df, ["v", "w"])
    encoded, skipped = one_hot(apply_index(df, fitted), fitted.sizes())
    assert skipped == ["w"] and "w_encoded" not in encoded.columns
    dense = encoded.select("v", vector_to_array("v_encoded").alias("e")).distinct().collect()
    assert {r["v"]: r["e"] for r in dense} == {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [0.0, 0.0]}


def test_one_hot_keeps_unseen_as_zeros(spark):
    known = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    fitted = fit_index(known, ["v"])
    new = apply_index(spark.createDataFrame([("b",), ("z",)], "v string"), fitted)
    encoded, _ = one_hot(new, fitted.sizes(), invalid="keep")
    dense = encoded.select("v", vector_to_array("v_encoded").alias("e")).collect()
    assert {r["v"]: r["e"] for r in dense} == {"b": [0.0, 1.0], "z": [0.0, 0.0]}


def test_scaling_is_numerically_sound(spark):
    df = spark.createDataFrame([(1e9 + i,) for i in range(4)], "a double")
    mean, deviation = fit_scaler(df, ["a"]).stats["a"]
    assert mean == 1e9 + 1.5 and deviation == pytest.approx(math.sqrt(5 / 3))
