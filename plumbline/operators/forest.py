"""Random forests: grid search over stratified folds, scoring, signatures.

Trees are grown by ``trees``: all candidates and folds of a search in the same jobs.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.errors import DataError, ModelError
from plumbline.operators.columns import features_target
from plumbline.operators.split import stratified_kfold
from plumbline.operators.trees import Fit, GrownForest, binned, fold_hits, grow_forests

# Folds of the search, share of the internal validation, and the tuned grid.
FOLDS = 3
VALIDATION_SHARE = 0.20
LEAF_SIZES = (1, 2)
SPLIT_SIZES = (2, 5)
# End of fixed values.
PREDICTION = "prediction"


@dataclass(frozen=True)
class ForestSettings:
    """Settings of a forest; ``max_depth=None`` grows until leaves are pure or too small.

    ``leaf_sizes`` and ``split_sizes`` (rows of a node before it may be split) are the grid.
    """

    n_trees: int = 100
    max_depth: int | None = 5
    seed: int = 42
    leaf_sizes: Sequence[int] = LEAF_SIZES
    split_sizes: Sequence[int] = SPLIT_SIZES
    folds: int = FOLDS


@dataclass(frozen=True)
class Fitted:
    """A model with what is needed to use and to explain it."""

    model: GrownForest
    target: str
    signature: str
    output: str
    best_params: dict = field(default_factory=dict)
    scores: list = field(default_factory=list)


def signature(df: DataFrame, features: Sequence[str]) -> str:
    """The features a model was fitted on, as JSON schema text."""
    return T.StructType([df.schema[c] for c in features]).json()


def output_signature(df: DataFrame, target: str) -> str:
    """What a prediction looks like: its name and the target's type, as JSON schema text."""
    return T.StructType([T.StructField(PREDICTION, df.schema[target].dataType)]).json()


def check_signature(df: DataFrame, stored: str, source: str) -> list[str]:
    """Names of the features, if ``df`` has them all with the same types."""
    wanted = T.StructType.fromJson(json.loads(stored))
    wrong = [
        f"{f.name}: {f.dataType.simpleString()}"
        for f in wanted
        if f.name not in df.columns or df.schema[f.name].dataType != f.dataType
    ]
    if wrong:
        raise ModelError(f"{source} does not fit the model; missing or of another type: {wrong}")
    return wanted.fieldNames()


def _numeric(df: DataFrame, features: Sequence[str]) -> None:
    bad = [c for c in features if not isinstance(df.schema[c].dataType, T.NumericType)]
    if bad:
        raise DataError(f"features must be numbers: {bad}")


def grid_scores(means: Sequence[float], grid: Sequence[dict]) -> list[tuple[int, dict, float]]:
    """``(place, params, mean score)`` in grid order."""
    return [(i, g, float(s)) for i, (g, s) in enumerate(zip(grid, means, strict=True))]


def best_candidate(scores: Sequence[tuple[int, dict, float]]) -> tuple[int, dict, float]:
    """Highest mean score; equal scores go to the earlier candidate."""
    return min(scores, key=lambda s: (-s[2], s[0]))


def grid_search(
    df: DataFrame,
    target: str,
    key: str | Sequence[str],
    settings: ForestSettings | None = None,
) -> Fitted:
    """Search the grid by mean accuracy over stratified folds, then refit on all rows.

    Rows are binned and stored once; the forests of all candidates and folds grow in the same
    jobs and are scored in one pass.
    """
    settings = settings or ForestSettings()
    names = [key] if isinstance(key, str) else list(key)
    features = [c for c in features_target(df, target)[0] if c not in names]
    _numeric(df, features)
    folded = stratified_kfold(df, target, settings.folds, settings.seed, names)
    data = binned(folded, features, target, names, fold="fold")
    grid = [{"min_leaf": leaf, "min_split": split} for leaf, split in itertools.product(settings.leaf_sizes, settings.split_sizes)]

    def fit(candidate: dict, fold: int | None) -> Fit:
        per_node = max(1, math.isqrt(len(features)))
        return Fit(settings.n_trees, settings.max_depth, candidate["min_split"], candidate["min_leaf"], per_node, settings.seed, fold)

    fits = [fit(g, f) for g in grid for f in range(settings.folds)]
    hits = fold_hits(data, fits, grow_forests(data, fits))
    means = [sum(hits[i : i + settings.folds]) / settings.folds for i in range(0, len(hits), settings.folds)]
    scores = grid_scores(means, grid)
    _, params, score = best_candidate(scores)
    chosen = grow_forests(data, [fit(params, None)])[0]
    model = GrownForest(features, data.edges, data.classes, chosen, PREDICTION)
    return Fitted(model, target, signature(df, features), output_signature(df, target), {**params, "score": score}, scores)


def predict(fitted: Fitted, df: DataFrame, source: str = "dataset") -> DataFrame:
    """``df`` plus ``prediction``, of the type that the stored output signature states.

    The stored signatures are compared first, on column names and types only.
    """
    check_signature(df, fitted.signature, source)
    kind = T.StructType.fromJson(json.loads(fitted.output))[PREDICTION].dataType
    if fitted.target in df.columns and df.schema[fitted.target].dataType != kind:
        raise ModelError(f"{source}: target {fitted.target!r} is not of the type {kind.simpleString()} it was learnt with")
    out = fitted.model.transform(df).select(*df.columns, PREDICTION)
    return out.withColumn(PREDICTION, F.col(PREDICTION).cast(kind))
