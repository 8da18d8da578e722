import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from tidemark.operators.metrics import accuracy, class_metrics, confusion, summary_metrics


def predictions(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")


CASES = {
    "binary": [(0, 0)] * 6 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(1, 1)] * 1,
    "three": [(0, 0)] * 5 + [(1, 2)] * 3 + [(2, 2)] * 4 + [(2, 0)] * 2 + [(1, 1)],
    "never_predicted": [(0, 0)] * 4 + [(1, 0)] * 2,
}


@pytest.mark.parametrize("case", CASES)
def test_agrees_with_the_evaluator(spark, case):
    df = predictions(spark, CASES[case])
    row = summary_metrics(confusion(df, "label")).first()

    def theirs(metric, **options):
        return MulticlassClassificationEvaluator(
            labelCol="label", metricName=metric, **options
        ).evaluate(df)

    assert row["accuracy"] == pytest.approx(theirs("accuracy"))
    assert row["recall_0"] == pytest.approx(theirs("recallByLabel", metricLabel=0.0))
    assert row["recall_1"] == pytest.approx(theirs("recallByLabel", metricLabel=1.0))
    assert row["f1_weighted"] == pytest.approx(theirs("f1"))
    assert accuracy(df, "label").first()[0] == pytest.approx(theirs("accuracy"))


def test_macro_and_weighted_f1_differ(spark):
    row = summary_metrics(confusion(predictions(spark, CASES["binary"]), "label")).first()
    per_class = {
        r["label"]: r["f1"]
        for r in class_metrics(confusion(predictions(spark, CASES["binary"]), "label")).collect()
    }
    assert row["f1_macro"] == pytest.approx(sum(per_class.values()) / 2)
    assert row["f1_macro"] < row["f1_weighted"]


def test_a_class_that_is_only_predicted_counts(spark):
    rows = class_metrics(confusion(predictions(spark, [(0, 0), (0, 1)]), "label")).collect()
    assert {r["label"]: (r["support"], r["recall"], r["precision"]) for r in rows} == {
        0.0: (2, 0.5, 1.0),
        1.0: (0, 0.0, 0.0),
    }
