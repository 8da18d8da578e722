"""From a raw table to a balanced, split feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import values_hash
from tidemark.operators.categories import CategoryIndex, apply_index, fit_index
from tidemark.operators.clean import clean, select_features
from tidemark.operators.drift import profile
from tidemark.operators.sampling import TRAIN, balance, oversampling_ratios, split
from tidemark.operators.scaling import Scaling, apply_scaler, fit_scaler
from tidemark.operators.summaries import summarize
from tidemark.session import discard, stage, staging
from tidemark.sources.ledgers import Registry
from tidemark.sources.snapshots import (
    COPY,
    SPLIT,
    read_snapshot,
    snapshot_path,
    write_snapshot,
)
from tidemark.spec import INDEXED, FeatureSpec

ORDERS = ("split_first", "balance_first")
_ROW = "__row"


@dataclass(frozen=True)
class FeatureState:
    """Everything learned from data that turning rows into features needs."""

    scaling: Scaling
    index: CategoryIndex

    def save(self, spark: SparkSession, path: str) -> None:
        """Write as small tables; wide categories keep a table of their own.

        ``at`` keeps the columns in order, which a table read back does not.
        """
        scaling = [(at, c, *stat) for at, (c, stat) in enumerate(self.scaling.stats.items())]
        labels = [
            (at, c, v, i)
            for at, (c, values) in enumerate(self.index.labels.items())
            for i, v in enumerate(values)
        ]
        wide = [(at, c, f"{path}/wide/{at}") for at, c in enumerate(self.index.wide)]
        for name, rows, schema in (
            ("scaler", scaling, "at int, feature string, mean double, divisor double"),
            ("categories", labels, "at int, feature string, value string, index bigint"),
            ("wide_names", wide, "at int, feature string, path string"),
        ):
            spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}")
        for _, column, where in wide:
            self.index.wide[column].write.parquet(where)

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureState:
        """Read back a saved state."""

        def rows(name: str, *order: str) -> list[Row]:
            return spark.read.parquet(f"{path}/{name}").orderBy(*order).collect()

        stats = {r["feature"]: (r["mean"], r["divisor"]) for r in rows("scaler", "at")}
        labels: dict[str, list[str]] = {}
        for row in rows("categories", "at", "index"):
            labels.setdefault(row["feature"], []).append(row["value"])
        wide = {r["feature"]: spark.read.parquet(r["path"]) for r in rows("wide_names", "at")}
        return FeatureState(Scaling(stats), CategoryIndex(labels, wide))


@dataclass(frozen=True)
class Prepared:
    """A feature table ready to be written, and the state that produced it."""

    table: DataFrame
    state: FeatureState
    label: str
    staged: list[str]  # paths of what the table is computed from

    def discard(self) -> None:
        """Delete what was staged, once the table has been written."""
        for path in self.staged:
            discard(self.table.sparkSession, path)


def fit_state(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> FeatureState:
    """Learn scaling and categories: one pass each, over the columns concerned."""
    return FeatureState(fit_scaler(df, numeric), fit_index(df, categorical))


def to_features(df: DataFrame, state: FeatureState, invalid: str = "keep") -> DataFrame:
    """Add the scaled and indexed columns of a fitted state."""
    return apply_index(apply_scaler(df, state.scaling), state.index, invalid)


def prepare(
    df: DataFrame,
    spec: FeatureSpec,
    order: str = "split_first",
    state: FeatureState | None = None,
    test_size: float = 0.2,
    invalid: str = "keep",
) -> Prepared:
    """Clean, scale, index, balance and split a raw table.

    ``split_first`` learns from the train side and balances only that, so no
    copy of a train row reaches the test side. ``balance_first`` learns from and
    balances everything and splits last. With a ``state`` nothing is learned
    anew and the features stay comparable with those it came from.

    ``invalid`` says what becomes of feature values a given state has not seen: as in
    :func:`apply_index`. A label it has not seen is always an error, as two new
    classes under one index would be balanced and trained on as one.

    The cleaned table is staged once; each later pass reads only its columns. What was
    staged is deleted if this fails; else it belongs to the result.
    """
    with staging(df.sparkSession, keep="") as paths:
        return _prepare(df, spec, order, state, test_size, invalid, paths)


def _prepare(
    df: DataFrame,
    spec: FeatureSpec,
    order: str,
    state: FeatureState | None,
    test_size: float,
    invalid: str,
    paths: list[str],
) -> Prepared:
    if order not in ORDERS:
        raise ValueError(f"order must be one of {', '.join(ORDERS)}")
    cleaned = clean(df, spec)
    numeric, categorical = spec.roles(cleaned)
    key = list(spec.key)
    if not key:
        cleaned = cleaned.withColumn(_ROW, values_hash(cleaned.columns))
        key = [_ROW]
    early = order == "split_first"
    staged = stage(split(cleaned, key, test_size) if early else cleaned, "cleaned")
    in_train = F.col(SPLIT) == TRAIN
    learn_from = staged.where(in_train) if early else staged
    if state is None:
        state = fit_state(learn_from, numeric, [*categorical, spec.label])
    if spec.label not in state.index.labels:
        raise ValueError(f"{spec.label} has too many values for a class label")
    label = spec.label + INDEXED

    kept = [*key, SPLIT] if early else key
    features = FeatureState(
        state.scaling,
        CategoryIndex(
            {c: v for c, v in state.index.labels.items() if c != spec.label}, state.index.wide
        ),
    )
    table = to_features(apply_index(staged, _label_index(spec.label, state), "error"), features, invalid)
    table = select_features(table, also=kept)
    ratios = _ratios_by_index(learn_from, spec.label, state)
    table = balance(
        table, label, key, ratios=ratios, copy_column=COPY, only=in_train if early else None
    )
    if not early:
        table = split(table, [*key, COPY], test_size)
    return Prepared(table.drop(*key), state, label, paths)


def _label_index(label: str, state: FeatureState) -> CategoryIndex:
    return CategoryIndex({label: state.index.labels[label]})


def _ratios_by_index(df: DataFrame, label: str, state: FeatureState) -> dict[object, float]:
    """Oversampling ratios keyed by the label's index, from a pass over the label only."""
    indexed = apply_index(df.select(label), _label_index(label, state), "error")
    return oversampling_ratios(indexed, label + INDEXED)


def prepare_snapshot(
    registry: Registry,
    df: DataFrame,
    spec: FeatureSpec,
    model_name: str,
    snapshot_id: str | None = None,
    order: str = "split_first",
    refit: bool = False,
    invalid: str = "keep",
    test_size: float = 0.2,
) -> str:
    """Prepare a table and publish it as a snapshot; returns the id.

    If a model is in force its snapshot's state is reused, so that a change of
    scale or of category frequencies shows up as drift; ``refit`` learns anew. ``test_size`` and
    ``invalid`` are passed on to :func:`prepare`. Table, state, profile and summary become visible together. After an
    error neither they nor anything staged is left behind.
    """
    spark = registry.spark
    promoted = None if refit else registry.current(model_name)
    state = (
        None
        if promoted is None
        else FeatureState.load(spark, registry.state_path(promoted["snapshot_id"]))
    )
    snapshot_id = registry.reserve(snapshot_id)
    root, state_path = registry.snapshot_root, registry.state_path(snapshot_id)
    profile_path, summary_path = registry.profile_path(snapshot_id), registry.summary_path(snapshot_id)
    try:
        with staging(spark):
            prepared = prepare(df, spec, order, state, test_size, invalid)
            write_snapshot(prepared.table, root, snapshot_id)
            prepared.state.save(spark, state_path)
        features = read_snapshot(spark, root, snapshot_id, originals_only=True).drop(prepared.label, SPLIT)
        profile(features, features.columns).write.parquet(profile_path)
        summarize(features, features.columns).write.parquet(summary_path)
        rows = read_snapshot(spark, root, snapshot_id).count()
    except BaseException:
        registry.abandon(snapshot_id)
        raise
    registry.publish(
        snapshot_id,
        rows,
        table_path=snapshot_path(root, snapshot_id),
        state_path=state_path,
        profile_path=profile_path,
        summary_path=summary_path,
    )
    return snapshot_id
