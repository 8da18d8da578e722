"""Drift check, retraining, promotion and scoring against the registry."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, CancelledError, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import drift, models
from tidemark.operators.sampling import TEST, TRAIN
from tidemark.operators.summaries import psi_against_summary
from tidemark.sources.ledgers import Ledger, Registry
from tidemark.sources.snapshots import SPLIT, read_snapshot
from tidemark.sources.store import delete_tree

T = TypeVar("T")
FILES_AT_ONCE = 500  # files scored by one job and recorded together
FITS_AT_ONCE = 4  # models fitted side by side
DEFAULT_ALGORITHMS = ("forest", "ridge_logistic")


def snapshot_features(
    registry: Registry, snapshot_id: str, label: str, originals_only: bool = True
) -> DataFrame:
    """Both sides of a snapshot, features only."""
    df = read_snapshot(
        registry.spark, registry.snapshot_root, snapshot_id, originals_only=originals_only
    )
    return df.drop(label, SPLIT)


def check_drift(
    registry: Registry,
    model_name: str,
    label: str,
    threshold: float = drift.THRESHOLD,
    combined_range: bool = False,
    originals_only: bool = True,
    bins: int | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """``(report, gate)`` for the last snapshot against the promoted model's.

    Uses the baseline's stored profile or, for a combined range or other ``bins`` than the profile's,
    its stored summary, so that only the new snapshot is read. A PSI from the summary comes with
    the error it may have (``max_error``); features whose flag that error leaves open are compared exactly, by
    reading these columns of both. Without a promoted model there is no report and the gate
    says to train. ``originals_only=False`` compares rows as balanced and reads both snapshots.
    """
    spark = registry.spark
    promoted = registry.current(model_name)
    if promoted is None:
        return None, drift.gate_without_baseline(spark)
    candidate = registry.last_snapshot()
    new = snapshot_features(registry, candidate, label, originals_only)
    manifest = registry.snapshot(promoted["snapshot_id"])
    rebinned = combined_range or bins is not None
    if rebinned and originals_only and manifest["summary_path"] is not None:
        summary = spark.read.parquet(manifest["summary_path"])
        report = _report_from_summary(
            registry, summary, new, promoted["snapshot_id"], label, threshold, bins or drift.BINS, combined_range
        )
    elif rebinned or not originals_only:
        base = snapshot_features(registry, promoted["snapshot_id"], label, originals_only)
        report = drift.drift_report(
            base,
            new,
            threshold=threshold,
            bins=bins or drift.BINS,
            combined_range=combined_range,
        )
    else:
        stored = spark.read.parquet(registry.profile_path(promoted["snapshot_id"]))
        report = drift.drift_report_from_profile(stored, new, threshold)
    return report, drift.retrain_gate(report)


def _report_from_summary(
    registry: Registry,
    summary: DataFrame,
    new: DataFrame,
    base_id: str,
    label: str,
    threshold: float,
    bins: int,
    combined_range: bool,
) -> DataFrame:
    found = psi_against_summary(summary, new, bins, combined_range)
    known = [r["feature"] for r in summary.select("feature").distinct().collect()]
    report = drift.with_absent(drift.flag(found, threshold), known, new)
    open_ = F.abs(F.col("psi") - threshold) <= F.col("max_error")
    unsure = [r["feature"] for r in report.where(open_).select("feature").collect()]
    if not unsure:
        return report
    base = snapshot_features(registry, base_id, label)
    exact = drift.drift_report(
        base, new, unsure, threshold=threshold, bins=bins, combined_range=combined_range
    ).withColumn("max_error", F.lit(0.0))
    return report.where(~F.col("feature").isin(unsure)).unionByName(exact)


def side_by_side(
    spark: SparkSession, work: Callable[[str], T], names: Sequence[str], at_once: int = FITS_AT_ONCE
) -> list[T]:
    """``work`` for every name, in threads whose jobs run in pools of these names; results in order.

    The first error cancels all other jobs and is raised.
    """
    context = spark.sparkContext
    tag = f"tidemark-{uuid.uuid4().hex}"
    stop = threading.Event()

    def run(name: str) -> T:
        if stop.is_set():
            raise CancelledError
        context.setLocalProperty("spark.scheduler.pool", name)
        context.addJobTag(tag)
        try:
            return work(name)
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, min(len(names), at_once))) as pool:
        futures = [pool.submit(inheritable_thread_target(run), name) for name in names]
        done, left = wait(futures, return_when=FIRST_EXCEPTION)
        failed = [f for f in futures if f in done and f.exception() is not None]
        if failed:
            stop.set()
            while left:  # a thread may just be between two jobs
                context.cancelJobsWithTag(tag)
                _, left = wait(left, timeout=0.5)
            raise failed[0].exception()
        return [f.result() for f in futures]


def train_and_promote(
    registry: Registry,
    model_name: str,
    label: str,
    algorithms: Sequence[str] = DEFAULT_ALGORITHMS,
    overrides: dict[str, dict[str, object]] | None = None,
    snapshot_id: str | None = None,
    metric: str = "accuracy",
) -> str:
    """Train every algorithm on a snapshot, promote the best by ``metric``; returns its run id.

    The train side is assembled and persisted once and all algorithms are fitted to it side by side,
    each in a scheduler pool of its own name (which shares the cluster out evenly where
    ``spark.scheduler.mode`` is ``FAIR``). The first error cancels the others and is
    raised; no run is recorded then. Runs are recorded in the order of ``algorithms``.
    """
    spark = registry.spark
    snapshot_id = snapshot_id or registry.last_snapshot()
    if snapshot_id is None:
        raise ValueError("no snapshot was recorded")
    root = registry.snapshot_root
    train_side = read_snapshot(spark, root, snapshot_id, TRAIN)
    data = models.assemble(train_side, label)
    test_side = read_snapshot(spark, root, snapshot_id, TEST)
    data.table.persist(StorageLevel.MEMORY_AND_DISK)
    data.table.count()  # one pass fills it for all

    def fit(algorithm: str) -> tuple[str, str, dict[str, float]]:
        settings = (overrides or {}).get(algorithm, {})
        model = models.train_assembled(data, algorithm, **settings)
        metrics = models.evaluate(model, test_side, label).first().asDict()
        return algorithm, registry.save_model(model), metrics

    try:
        fitted = side_by_side(spark, fit, algorithms)
    finally:
        data.table.unpersist()
    schema = models.input_schema(train_side, label)
    for algorithm, model_path, metrics in fitted:
        settings = (overrides or {}).get(algorithm, {})
        registry.record_saved(
            model_path, snapshot_id, algorithm, metrics, schema, {k: str(v) for k, v in settings.items()}
        )
    chosen = registry.champion(snapshot_id, metric, k=len(algorithms))
    if registry.snapshot(snapshot_id)["profile_path"] is None:
        _store_profile(registry, snapshot_id, label)
    registry.promote(chosen, model_name)
    return chosen["run_id"]


def _store_profile(registry: Registry, snapshot_id: str, label: str) -> None:
    features = snapshot_features(registry, snapshot_id, label)
    table = drift.profile(features, features.columns)
    table.write.mode("overwrite").parquet(registry.profile_path(snapshot_id))


def retrain_if_needed(
    registry: Registry,
    model_name: str,
    label: str,
    threshold: float = drift.THRESHOLD,
    combined_range: bool = False,
    originals_only: bool = True,
    bins: int | None = None,
    **training: object,
) -> tuple[str, str]:
    """:func:`check_drift` and train if it says so; returns ``(decision, reason)``."""
    _, gate = check_drift(
        registry, model_name, label, threshold, combined_range, originals_only, bins
    )
    verdict = gate.first()
    if verdict["decision"] == drift.HALT:
        raise ValueError("the new snapshot lacks a feature of the promoted model")
    if verdict["decision"] == drift.RETRAIN:
        train_and_promote(registry, model_name, label, **training)
    return verdict["decision"], verdict["reason"]


def score_with_current(registry: Registry, model_name: str, df: DataFrame) -> DataFrame:
    """Score prepared features with the model in force, after checking their schema."""
    path, schema = registry.current_model(model_name)
    return models.score(path, df, schema)


SCORES = "seq bigint, run_id string, part_path string, files array<string>, n_rows bigint"


class AlreadyScored(Exception):
    """Somebody else has recorded one of the files meanwhile."""


def scores_ledger(registry: Registry, target: str) -> Ledger:
    """The parts of a scored table: which files each was computed from, by which run's model."""
    return Ledger(registry.spark, f"{target}/ledger", SCORES)


def score_new_files(
    registry: Registry,
    model_name: str,
    source: str,
    target: str,
    files_at_once: int = FILES_AT_ONCE,
    at_most: int | None = None,
) -> int:
    """Score the Parquet files below ``source`` that the model in force has not scored yet.

    They are taken ``files_at_once`` at a time; each lot becomes a part of ``target`` that counts once the
    ledger has its record. Started again after a failure, or with more files there, only the rest is read.
    Of two that score the same files at a time one has its part dropped. ``at_most`` limits
    the lots of this call. Returns the number of rows scored.
    """
    spark = registry.spark
    run_id = registry.current(model_name)["run_id"]
    path, schema = registry.current_model(model_name)
    ledger = scores_ledger(registry, target)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(source)
    files = spark.createDataFrame([(f,) for f in listed.inputFiles()], "file string")
    done = ledger.read().where(F.col("run_id") == run_id).select(F.explode("files").alias("file"))
    left = [r["file"] for r in files.join(done, "file", "left_anti").orderBy("file").collect()]
    lots = [left[i : i + files_at_once] for i in range(0, len(left), files_at_once)]
    n_scored = 0
    for lot in lots[:at_most]:
        part = f"{target}/parts/{uuid.uuid4().hex}"
        models.score(path, spark.read.parquet(*lot), schema).write.parquet(part)
        n_rows = spark.read.parquet(part).count()

        def unseen(records: DataFrame, lot: list[str] = lot) -> None:
            same = (F.col("run_id") == run_id) & F.arrays_overlap("files", F.array(*map(F.lit, lot)))
            if not records.where(same).isEmpty():
                raise AlreadyScored

        try:
            ledger.append(unseen, run_id=run_id, part_path=part, files=lot, n_rows=n_rows)
            n_scored += n_rows
        except AlreadyScored:
            delete_tree(spark, part)
    return n_scored


def read_scored(registry: Registry, model_name: str, target: str) -> DataFrame:
    """All rows that the model in force has scored."""
    run_id = registry.current(model_name)["run_id"]
    parts = scores_ledger(registry, target).read().where(F.col("run_id") == run_id)
    paths = [r["part_path"] for r in parts.select("part_path").collect()]
    if not paths:
        raise ValueError(f"{model_name} has scored nothing at {target}")
    return registry.spark.read.parquet(*paths)
