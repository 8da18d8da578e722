"""Classifiers, their evaluation, and batch scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import deep_forest
from tidemark.operators.deep_forest import DeepForest
from tidemark.operators.metrics import confusion, summary_metrics
from tidemark.session import use_checkpoints
from tidemark.spec import require_schema

FEATURES = "features"
METRICS = ("accuracy", "recall_0", "recall_1", "f1_weighted", "f1_macro")

# Default parameters of each kind of model.
ALGORITHMS = {
    "logistic": (LogisticRegression, {"maxIter": 1000}),
    "tree": (DecisionTreeClassifier, {"maxDepth": 5, "impurity": "gini"}),
    "forest": (
        RandomForestClassifier,
        {
            "numTrees": 100,
            "maxDepth": 5,
            "impurity": "gini",
            "featureSubsetStrategy": "auto",
            "seed": 42,
        },
    ),
    "svc": (LinearSVC, {"maxIter": 100, "regParam": 0.1}),
    "boosted": (GBTClassifier, {"maxIter": 100, "maxDepth": 5, "lossType": "logistic"}),
    # Trees of unlimited depth, which Spark's own have not.
    "deep_forest": (deep_forest.fit, {"numTrees": 100, "seed": 42}),
    # The ridge penalty 1 / (C n) with C = 1: the counterpart of a C-penalised regression.
    "ridge_logistic": (LogisticRegression, {"maxIter": 1000, "standardization": False}),
}
BINARY_ONLY = ("svc", "boosted")


def assembler(columns: Sequence[str]) -> VectorAssembler:
    """All feature columns as one vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES)


def estimator(algorithm: str, label: str, **overrides: object):
    """An unfitted classifier with its default parameters, some overridden.

    ``deep_forest``, which is no stage of a pipeline, is had from :func:`train` only.
    """
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm}; have {', '.join(ALGORITHMS)}")
    kind, defaults = ALGORITHMS[algorithm]
    return kind(featuresCol=FEATURES, labelCol=label, **{**defaults, **overrides})


def feature_columns(df: DataFrame, label: str) -> list[str]:
    """Every column but the label."""
    return [c for c in df.columns if c != label]


def train(
    df: DataFrame,
    label: str,
    algorithm: str,
    columns: Sequence[str] | None = None,
    **overrides: object,
) -> PipelineModel | DeepForest:
    """Fit assembler and classifier. Persist ``df`` first when fitting several."""
    if algorithm == "deep_forest":
        settings = {**ALGORITHMS[algorithm][1], **overrides}
        named = {"numTrees": "trees", "maxDepth": "max_depth"}
        return deep_forest.fit(df, label, columns, **{named.get(k, k): v for k, v in settings.items()})
    return train_assembled(assemble(df, label, columns), algorithm, **overrides)


@dataclass(frozen=True)
class Assembled:
    """A training table whose features were assembled once, for any number of fits."""

    raw: DataFrame
    table: DataFrame  # the vector and the label
    label: str
    inputs: list[str]


def assemble(df: DataFrame, label: str, columns: Sequence[str] | None = None) -> Assembled:
    """Feature vector and label of a training table; persist its ``table`` when fitting several."""
    inputs = list(columns) if columns is not None else feature_columns(df, label)
    needed = df.select(*inputs, F.col(label).cast("double").alias(label))
    return Assembled(df, assembler(inputs).transform(needed).select(FEATURES, label), label, inputs)


def train_assembled(data: Assembled, algorithm: str, **overrides: object) -> PipelineModel | DeepForest:
    """Fit a classifier to an assembled table; the model takes tables that are not assembled."""
    if algorithm == "deep_forest":
        return train(data.raw, data.label, algorithm, data.inputs, **overrides)
    use_checkpoints(data.raw.sparkSession)
    if algorithm == "ridge_logistic" and "regParam" not in overrides:
        overrides["regParam"] = 1.0 / max(data.table.count(), 1)
    fitted = estimator(algorithm, data.label, **overrides).fit(data.table)
    if getattr(fitted, "hasSummary", False):
        # A training summary holds the session, which cannot be sent to tasks once it has observed a table.
        fitted._java_obj.setSummary(data.raw.sparkSession._jvm.scala.Option.apply(None))
    return PipelineModel([assembler(data.inputs), fitted])


def input_schema(df: DataFrame, label: str) -> T.StructType:
    """The columns and types a model trained on ``df`` expects, without the label."""
    return T.StructType(
        [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name != label]
    )


def load(spark: SparkSession, path: str) -> PipelineModel | DeepForest:
    """A saved model of either kind."""
    return DeepForest(spark, path) if DeepForest.is_at(spark, path) else PipelineModel.load(path)


def evaluate(model: PipelineModel | DeepForest, df: DataFrame, label: str) -> DataFrame:
    """One row of quality numbers on held-out rows; the rows are scored once."""
    return summary_metrics(confusion(model.transform(df), label))


def score(
    model: PipelineModel | DeepForest | str, df: DataFrame, schema: T.StructType | None = None
) -> DataFrame:
    """Add ``prediction`` to every row of a table, by a model or a saved one.

    ``schema``, if given, is the input the model was trained on; a table that
    does not meet it is refused.
    """
    if schema is not None:
        require_schema(schema, df)
    fitted = load(df.sparkSession, model) if isinstance(model, str) else model
    return fitted.transform(df).select(*df.columns, "prediction")
