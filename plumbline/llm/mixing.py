"""Rates for documents so that the mixture meets target weights by domain.

Membership is soft: a classifier learnt from a labelled table gives each whole text a
posterior over the domains.  Rates are the non-negative weights of documents that bring the
expected tokens of each domain closest to its target in least squares, while staying near 1.
The projected gradient needs one vector over domains per step, summed by Spark over all
documents; a document's rate follows from its posterior and the steps so far, so no table
of rates is kept between steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.text import byte_texts, small_batches
from plumbline.session import stored

#: Hashed pairs of neighbouring bytes.
PAIRS = 2048
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _features(text: bytes) -> tuple[np.ndarray, int]:
    """Square roots of the shares of byte pairs (unit length), and the words of a text."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(PAIRS), 0
    blank = _BLANK[data]
    words = int((~blank[1:] & blank[:-1]).sum()) + int(not blank[0])
    lower = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.int64)
    pairs = np.bincount((lower[:-1] * 37 + lower[1:]) % PAIRS, minlength=PAIRS)
    return np.sqrt(pairs / max(pairs.sum(), 1)), words


@dataclass
class Domains:
    """A linear classifier with one row of weights per domain."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    prior: np.ndarray

    def posteriors(self, features: np.ndarray) -> np.ndarray:
        logits = features @ self.weights.T + self.bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        out = odds / odds.sum(axis=1, keepdims=True)
        out[~features.any(axis=1)] = self.prior
        return out


def learn_domains(labelled: DataFrame, bound: int = 4096, steps: int = 300) -> Domains:
    """Softmax regression on ``labelled(text, domain)``, of which at most ``bound`` rows are used.

    The rows of smallest text hash are used.  Rows without domain are left out; null texts
    are empty.  Without rows there are no domains.
    """
    rows = (
        small_batches(labelled).where("domain is not null")
        .select(F.col("text").cast("string").alias("text"), F.col("domain").cast("string").alias("domain"))
        .orderBy(F.xxhash64("text"), "domain")
        .limit(bound)
    )

    def measure(batches):
        for batch in batches:
            found = [_features(t)[0].astype(np.float32) for t in byte_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float32()))], ["domain", "x"])

    table = rows.mapInArrow(measure, "domain string, x array<float>").toArrow()
    marks = table.column("domain").to_pylist()
    names = sorted(set(marks))
    if not names:
        return Domains([], np.zeros((0, PAIRS)), np.zeros(0), np.zeros(0))
    x = table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, PAIRS)
    place = {name: i for i, name in enumerate(names)}
    y = np.eye(len(names))[[place[m] for m in marks]]
    prior = y.mean(axis=0)
    model = Domains(names, np.zeros((len(names), PAIRS)), np.log(prior), prior)
    # Accelerated gradient; features have unit length, so 2 is a safe step for the mean loss.
    weights, bias = model.weights, model.bias
    for step in range(steps):
        ahead, ahead_bias = (
            model.weights + step / (step + 3) * (model.weights - weights),
            model.bias + step / (step + 3) * (model.bias - bias),
        )
        gap = Domains(names, ahead, ahead_bias, prior).posteriors(x) - y
        weights, bias = model.weights, model.bias
        model.weights = ahead - 2 * (gap.T @ x / len(x) + 1e-5 * ahead)
        model.bias = ahead_bias - 0.5 * gap.mean(axis=0)
    return model


def with_posteriors(docs: DataFrame, model: Domains, column: str = "mix") -> DataFrame:
    """``docs`` with a struct ``n_tokens, posterior``; an empty text has the sample's shares."""
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(vars(model))

    @F.arrow_udf("struct<n_tokens: long, posterior: array<double>>")
    def measure(texts: pa.Array) -> pa.Array:
        model = Domains(**shared.value)
        words, shares = [], []
        texts = byte_texts(texts)
        for i in range(0, len(texts), 128):
            found = [_features(t) for t in texts[i : i + 128]]
            words += [n for _, n in found]
            shares += list(model.posteriors(np.array([f for f, _ in found]))) if model.names else [[]] * len(found)
        return pa.StructArray.from_arrays(
            [pa.array(words, pa.int64()), pa.array(shares, pa.list_(pa.float64()))],
            ["n_tokens", "posterior"],
        )

    return docs.withColumn(column, measure(F.col("text").cast("string")))


def fit_steps(
    measured: DataFrame, model: Domains, targets: dict[str, float], pull: float = 1e-3, most: int = 50, close: float = 1e-7
) -> list[list[float]]:
    """The residual of each projected-gradient step, from ``measured(n_tokens, posterior)``.

    ``targets`` are weights of domains and are scaled to sum to 1; a domain without one is
    to vanish.  A domain that no text can belong to is left out.  ``pull`` keeps rates near 1.
    """
    want = np.array([float(targets.get(n, 0.0)) for n in model.names])
    if (want < 0).any() or not want.sum() > 0:
        return []
    want = want / want.sum()
    steps: list[list[float]] = []
    start = None
    for _ in range(most):
        have, total = _shares(measured, steps, pull, len(want))
        if not total:
            return []
        have = have / total
        start = have if start is None else start
        residual = np.where(start > 0, (have - want) / np.maximum(start, 1e-12), 0.0)
        if steps and np.abs(have - _last(steps, want, start)).max() < close:
            break
        steps.append([float(x) for x in np.round(residual, 12)])
    return steps


def _last(steps, want, start) -> np.ndarray:
    return np.array(steps[-1]) * np.maximum(start, 1e-12) + want


def _shares(measured: DataFrame, steps, pull: float, n: int) -> tuple[np.ndarray, float]:
    """Expected tokens by domain at the present rates, and all tokens."""

    def work(batches):
        sums, total = np.zeros(n), 0.0
        for batch in batches:
            tokens = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            p = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(tokens), n)
            sums += (tokens * rates_of(p, steps, pull)) @ p
            total += tokens.sum()
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64())), pa.array([total])], ["sums", "total"])

    rows = measured.select("n_tokens", "posterior").mapInArrow(work, "sums array<double>, total double").collect()
    # One row per task; added in a fixed order, so that equal tasks give equal sums.
    rows = sorted((r["total"], r["sums"]) for r in rows)
    return np.sum([s for _, s in rows], axis=0) if rows else np.zeros(n), float(sum(t for t, _ in rows))


def rates_of(posteriors: np.ndarray, steps, pull: float) -> np.ndarray:
    """Rates after the given steps: from 1, down the gradient, never below 0."""
    rate = np.ones(len(posteriors))
    for residual in steps:
        rate = np.maximum(0.0, rate - (posteriors @ np.array(residual) + pull * (rate - 1)) / (1 + pull))
    return rate


def with_rates(measured: DataFrame, steps, pull: float = 1e-3, posterior: str = "posterior") -> DataFrame:
    """``measured`` with the ``rate`` of each row."""

    @F.arrow_udf("double")
    def rate(p: pa.Array) -> pa.Array:
        n = len(steps[0])
        return pa.array(rates_of(p.flatten().to_numpy(zero_copy_only=False).reshape(-1, n), steps, pull))

    return measured.withColumn("rate", rate(F.col(posterior)) if steps else F.lit(1.0))


def mixture(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> tuple[DataFrame, Domains]:
    """Each row of ``docs(doc_id, text)`` with ``n_tokens, posterior, rate``; one pass over the texts.

    Null and empty texts have no tokens.  Repeated rows are rows of their own, and equal
    texts have equal rates.  Without labelled rows, tokens or usable targets all rates are 1.
    """
    model = learn_domains(labelled)
    measured = stored(
        with_posteriors(docs.select("doc_id", "text"), model).select("doc_id", "mix.n_tokens", "mix.posterior"), "mix"
    )
    return with_rates(measured, fit_steps(measured, model, targets) if model.names else []), model


#: Target weights of the registered query and the pipeline.
LANGUAGE_WEIGHTS = {"en": 0.5, "de": 0.2, "es": 0.15, "fr": 0.15}


def labelled_domains(docs: DataFrame, labels: DataFrame, domain: str = "lang", bound: int = 4096) -> DataFrame:
    """Texts and domains of at most ``bound`` documents of the labelled table (smallest hashes)."""
    chosen = (
        labels.select("doc_id")
        .where("doc_id is not null")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    return docs.select("doc_id", "text", F.col(domain).alias("domain")).join(F.broadcast(chosen), "doc_id")
