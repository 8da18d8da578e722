"""The forest of unlimited depth: upper levels over partitions, subtrees in tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import uniform
from tidemark.operators import deep_forest, models


@pytest.fixture(scope="module")
def noisy(spark):
    """Labels that only the exact values tell: a hash of the two features."""
    return spark.range(1200).select(
        "id", uniform(["id"], "a").alias("a"), (F.col("id") % 50).cast("double").alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(3))).cast("double").alias("y"),
    ).persist()


def accuracy(model, df):
    return model.transform(df).agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]


def depth(flat):
    deepest, work = 0, [(0, 0)]
    while work:
        node, d = work.pop()
        deepest = max(deepest, d)
        if flat.feature[node] >= 0:
            work += [(flat.left[node], d + 1), (flat.right[node], d + 1)]
    return deepest


def test_deep_trees_know_their_rows_by_heart(spark, noisy):
    """With labels without a rule a tree must part nearly every row, in one task or by upper levels."""
    for task_rows in (10_000, 100):
        model = deep_forest.fit(noisy, "y", ["a", "b"], trees=12, key=["id"], task_rows=task_rows)
        assert accuracy(model, noisy) > 0.93
        upper = sum(len(t.feature) for t in model.upper)
        assert upper == 12 if task_rows == 10_000 else upper > 12 * 15
        biggest = model.subtrees().agg(F.max(F.size("feature"))).first()[0]
        assert biggest < 2 * task_rows
        assert max(depth(f) for f in model._whole([0, 1])) > 10


def test_depth_has_no_limit(spark):
    """Alternating labels along one feature whose steps halve: each cut takes off one value."""
    rows = [(2.0**-k, float(k % 2)) for k in range(60)] * 3
    df = spark.createDataFrame(rows, "a double, y double")
    model = deep_forest.fit(df, "y", trees=3, seed=1)
    assert accuracy(model, df) == 1.0 or accuracy(model, df) > 0.9
    limited = deep_forest.fit(df, "y", trees=3, seed=1, max_depth=2)
    assert max(depth(f) for f in limited._whole([0, 1, 2])) == 2
    assert accuracy(limited, df) < 0.8


def test_partitions_and_reruns_do_not_matter(spark, noisy):
    settings = {"columns": ["a", "b"], "trees": 3, "key": ["id"], "task_rows": 200}
    first = deep_forest.fit(noisy, "y", **settings)
    second = deep_forest.fit(noisy.repartition(7, "b"), "y", **settings)
    want = sorted(map(tuple, first.transform(noisy).select("id", "probability").collect()))
    assert sorted(map(tuple, second.transform(noisy).select("id", "probability").collect())) == want


def test_saved_and_in_portions(spark, noisy, tmp_path, monkeypatch):
    model = models.train(noisy.drop("id"), "y", "deep_forest", numTrees=4)
    path = f"{tmp_path}/model"
    model.write().save(path)
    want = sorted(map(tuple, model.transform(noisy).collect()), key=str)
    assert len(want[0]) == 6
    monkeypatch.setattr(deep_forest, "MODEL_NODES", 1)
    again = models.load(spark, path)
    assert len(again._portions()) == 4
    assert sorted(map(tuple, again.transform(noisy).collect()), key=str) == want
    scored = models.score(path, noisy.drop("y", "id"), models.input_schema(noisy.drop("id"), "y"))
    assert scored.columns == ["a", "b", "prediction"] and scored.count() == 1200
    with pytest.raises(ValueError, match="there is a model"):
        model.write().save(path)


def test_a_rule_is_found_exactly(spark):
    df = spark.range(5000).select(
        (F.col("id") % 1000).cast("double").alias("a"), uniform(["id"], "u").alias("u"),
        (F.col("id") % 1000 >= 617).cast("double").alias("y"),
    )
    for task_rows in (100_000, 500):
        model = deep_forest.fit(df, "y", trees=10, task_rows=task_rows, features_per_split=2)
        assert accuracy(model, df) == 1.0


def test_odd_tables(spark):
    schema = "a double, y double"
    for rows, problem in (
        ([], "of 0 rows"), ([(None, 0.0)], "lack"), ([(float("nan"), 0.0)], "lack"), ([(1.0, None)], "class"),
        ([(1.0, -1.0)], "class"), ([(1.0, 0.5)], "class"), ([(1.0, 2000.0)], "more than"),
    ):
        with pytest.raises(ValueError, match=problem):
            deep_forest.fit(spark.createDataFrame(rows, schema), "y", trees=2)
    constant = spark.createDataFrame([(1.0, 0.0)] * 30 + [(1.0, 1.0)] * 10, schema)
    model = deep_forest.fit(constant, "y", trees=5, task_rows=4)
    row = model.transform(constant).first()
    assert row["prediction"] == 0.0 and row["probability"][0] > row["probability"][1] > 0
    with pytest.raises(Exception, match="lacks a feature"):
        model.transform(spark.createDataFrame([(None,)], "a double")).collect()


def test_bootstrap_copies_follow_poisson():
    counts = np.bincount(deep_forest.copies(np.arange(100_000), 3, 42), minlength=4) / 100_000
    assert np.allclose(counts[:4], [0.3679, 0.3679, 0.1839, 0.0613], atol=0.006)
    other = deep_forest.copies(np.arange(100_000), 4, 42)
    assert abs(np.corrcoef(other, deep_forest.copies(np.arange(100_000), 3, 42))[0, 1]) < 0.02


def test_best_cut_against_trying_all():
    rng = np.random.default_rng(1)
    for _ in range(50):
        values, y = rng.integers(0, 6, 12).astype(float), rng.integers(0, 3, 12)
        w = rng.integers(1, 4, 12).astype(float)
        found = deep_forest.best_cut(values, y, w, 3)
        scores = []
        for cut in np.unique(values)[:-1]:
            sides = [np.bincount(y[m], w[m], 3) for m in (values <= cut, values > cut)]
            scores.append(sum((s**2).sum() / s.sum() for s in sides))
        assert (found is None) == (not scores)
        if scores:
            assert found[0] == pytest.approx(max(scores))
