"""Held-out learning from end to end: split, train, score, report, record."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plumbline.errors import DataError, ModelError
from plumbline.operators import classmetrics
from plumbline.operators.assurance import is_disjoint
from plumbline.operators.forest import (
    PREDICTION,
    VALIDATION_SHARE,
    Fitted,
    ForestSettings,
    check_signature,
    grid_search,
    predict,
)
from plumbline.operators.columns import require_columns
from plumbline.operators.split import TEST, TRAIN, random_split, stratified_split
from plumbline.session import stored
from plumbline.sources.datasets import load_model, save_model, write_metrics_json
from plumbline.sources.ledger import RunLedger


@dataclass(frozen=True)
class Training:
    """A fitted search with its internal validation as tables."""

    fitted: Fitted
    validation: DataFrame
    accuracy: DataFrame
    confusion: DataFrame
    report: DataFrame


def train_and_report(
    train: DataFrame,
    target: str,
    key: str | Sequence[str],
    settings: ForestSettings | None = None,
    *,
    validate_key: bool = True,
) -> Training:
    """Hold out a plain random fifth, search and refit on the rest, report on the fifth.

    The internal split is not stratified, and the model that is returned has not seen the
    validation rows.
    """
    settings = settings or ForestSettings()
    require_columns(train, [target], "training data")
    parts = random_split(train, VALIDATION_SHARE, settings.seed, key, validate=validate_key)
    fitted = grid_search(
        parts.where(parts.partition == TRAIN).drop("partition"), target, key, settings
    )
    scored = predict(fitted, parts.where(parts.partition == TEST).drop("partition"), "validation")
    return Training(
        fitted,
        scored,
        classmetrics.accuracy(scored, target, PREDICTION),
        classmetrics.confusion_matrix(scored, target, PREDICTION),
        classmetrics.classification_report(scored, target, PREDICTION),
    )


def evaluate_model(fitted: Fitted, held_out: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(scored rows, accuracy)`` on held-out data only."""
    require_columns(held_out, [fitted.target], "held-out data")
    check_signature(held_out, fitted.signature, "held-out data")
    scored = predict(fitted, held_out, "held-out data")
    return scored, classmetrics.accuracy(scored, fitted.target, PREDICTION)


def holdout_run(
    df: DataFrame,
    target: str,
    key: str | Sequence[str],
    *,
    test_size: float = 0.2,
    settings: ForestSettings | None = None,
) -> tuple[Training, DataFrame]:
    """Stratified split, training on one part, scored rows of the other.

    The features are stored before the split scans them, and the split before both sides
    read it, so neither is computed again; the key is checked once, before the first split.
    """
    settings = settings or ForestSettings()
    parts = stratified_split(stored(df, "features"), target, test_size, settings.seed, key)
    parts = stored(parts, "parts")
    train = parts.where(parts.partition == TRAIN).drop("partition")
    test = parts.where(parts.partition == TEST).drop("partition")
    training = train_and_report(train, target, key, settings, validate_key=False)
    scored, _ = evaluate_model(training.fitted, test)
    return training, scored


def save_fitted(fitted: Fitted, spark: SparkSession, path: str) -> None:
    """Store a model with its target, signatures, parameters and scores."""
    save_model(fitted.model, f"{path}/model", spark)
    about = {
        "target": fitted.target,
        "signature": fitted.signature,
        "output": fitted.output,
        "best_params": fitted.best_params,
        "scores": fitted.scores,
    }
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """A stored model, ready for ``predict``: scoring checks the stored signatures."""
    model = load_model(spark, f"{path}/model")
    try:
        about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
        scores = [tuple(s) for s in about["scores"]]
        return Fitted(model, about["target"], about["signature"], about["output"], about["best_params"], scores)
    except Exception as e:
        raise ModelError(f"model is corrupt: {path}: {type(e).__name__}") from e


def audit_inputs(train: DataFrame, test: DataFrame, key: str | Sequence[str]) -> None:
    """Raise if training and held-out inputs share a key."""
    if not is_disjoint(train, test, key):
        raise DataError("training and held-out data share rows")


def record_evaluation(
    accuracy: DataFrame,
    metrics_path: str,
    ledger: RunLedger | None = None,
    run_id: str | None = None,
    experiment: str | None = None,
) -> dict:
    """Write the metrics file first, then the ledger; the table is one row."""
    metrics = write_metrics_json(accuracy, metrics_path)
    if ledger is not None and run_id is not None:
        ledger.log_evaluation(run_id, metrics, experiment)
    return metrics


def record_training(
    training: Training,
    settings: ForestSettings,
    ledger: RunLedger,
    run_id: str,
    experiment: str | None = None,
) -> None:
    """Store settings, tuned parameters, validation accuracy and the rendered reports."""
    lines = classmetrics.report_text(training.report).collect()
    cells = training.confusion.orderBy("label", "prediction").collect()
    measured = training.accuracy.limit(2).collect()
    if len(measured) != 1:
        raise DataError("a training has one accuracy")
    best = {k: v for k, v in training.fitted.best_params.items() if k != "score"}
    ledger.log_training_run(
        run_id,
        params={"n_trees": settings.n_trees, "max_depth": settings.max_depth, "seed": settings.seed},
        best_params=best,
        metrics=measured[0].asDict(),
        artifacts={
            "classification_report": "\n".join(r["line"] for r in lines),
            "confusion_matrix": "\n".join(f"{c['label']} {c['prediction']} {c['n']}" for c in cells),
            "signature": training.fitted.signature,
        },
        experiment=experiment,
    )
