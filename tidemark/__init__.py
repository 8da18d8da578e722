"""Prepare, monitor and model labelled tables with Spark."""

from tidemark.operators.categories import apply_index, category_counts, fit_index, one_hot
from tidemark.operators.clean import clean, select_features
from tidemark.operators.drift import drift_report, inject_shift, psi, retrain_gate
from tidemark.operators.histograms import histogram
from tidemark.operators.metrics import class_metrics, confusion, summary_metrics
from tidemark.operators.models import evaluate, score, train
from tidemark.operators.sampling import balance, split, split_exact
from tidemark.operators.scaling import apply_scaler, fit_scaler
from tidemark.plans.prepare import prepare, prepare_snapshot
from tidemark.sources.ledgers import Registry
from tidemark.sources.snapshots import read_snapshot, write_snapshot
from tidemark.spec import FeatureSpec

__all__ = [
    "FeatureSpec",
    "Registry",
    "apply_index",
    "apply_scaler",
    "balance",
    "category_counts",
    "class_metrics",
    "clean",
    "confusion",
    "drift_report",
    "evaluate",
    "fit_index",
    "fit_scaler",
    "histogram",
    "inject_shift",
    "one_hot",
    "prepare",
    "prepare_snapshot",
    "psi",
    "read_snapshot",
    "retrain_gate",
    "score",
    "select_features",
    "split",
    "split_exact",
    "summary_metrics",
    "train",
    "write_snapshot",
]
