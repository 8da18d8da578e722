import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.functions import uniform

SMALL = {
    "forest": {"numTrees": 5},
    "deep_forest": {"numTrees": 5},
    "boosted": {"maxIter": 5},
    "svc": {"maxIter": 5},
}


@pytest.fixture(scope="module")
def sides(spark):
    """Two features that separate the classes but for a margin of noise; 3 : 1 classes."""
    noise = uniform(["id"], "noise")
    table = spark.range(600).select(
        "id", (F.col("id") % 4 == 0).cast("double").alias("y"), noise.alias("u")
    )
    table = table.select(
        (F.col("y") * 2 + F.col("u") * 1.2).alias("a"), (F.col("u") - F.col("y")).alias("b"), "y"
    )
    return table.where("u < 0.8").persist(), table.where("u >= 0.8").persist()


@pytest.mark.parametrize("algorithm", models.ALGORITHMS)
def test_beats_the_majority(spark, sides, algorithm):
    train_side, test_side = sides
    model = models.train(train_side, "y", algorithm, **SMALL.get(algorithm, {}))
    row = models.evaluate(model, test_side, "y").first()
    majority = test_side.agg(F.avg(1 - F.col("y"))).first()[0]
    assert row["accuracy"] > majority
    assert row["recall_1"] > 0.5


def test_same_seed_same_forest(spark, sides):
    train_side, test_side = sides
    scores = [
        models.score(models.train(train_side, "y", "forest", numTrees=5), test_side).collect()
        for _ in range(2)
    ]
    assert sorted(scores[0]) == sorted(scores[1])


def test_saved_model_scores_alike_and_checks_its_input(spark, sides, tmp_path):
    train_side, test_side = sides
    model = models.train(train_side, "y", "tree")
    path = str(tmp_path / "model")
    model.write().save(path)
    schema = models.input_schema(train_side, "y")
    features = test_side.drop("y")
    assert sorted(models.score(path, features, schema).collect()) == sorted(
        models.score(model, features).collect()
    )
    assert isinstance(PipelineModel.load(path), PipelineModel)
    with pytest.raises(ValueError, match="b: missing_in_new"):
        models.score(path, features.drop("b"), schema)


def test_ridge_penalty_follows_the_number_of_rows(spark, sides):
    train_side, _ = sides
    fitted = models.train(train_side, "y", "ridge_logistic").stages[-1]
    assert fitted.getRegParam() == pytest.approx(1 / train_side.count())
    assert fitted.getStandardization() is False


def test_unknown_algorithm():
    with pytest.raises(ValueError, match="unknown algorithm"):
        models.estimator("magic", "y")
