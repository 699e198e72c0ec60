"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The examples are a bounded sample of labelled documents, equal texts once.  Terms are the
words and beginnings of words whose document rates differ most between the labels
(chi-square), far beyond chance and next to the best of them.  Postings are cut into blocks
of examples; each block knows the largest weight of each term, which bounds the cosine of
all its examples.  Blocks are scored from the best bound down, and the search ends when no
bound reaches the k-th best cosine: the neighbours are exact.  Their votes, weighted by
cosine, are calibrated by isotonic regression on the examples themselves, each left out.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.labelled import sample_labelled
from plumbline.llm.text import byte_texts, remainder, small_batches
from plumbline.session import stored

#: ASCII marks and blanks between words become blanks, A-Z becomes a-z.
_PLAIN = bytes((c | 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256))
BLOCK = 64
#: Texts whose terms are counted before they are passed on.
COUNTED = 32
#: Chi-square of a term at least: in itself, and as a share of the best term's.
LEAST_CHI, LEAST_SHARE = 40.0, 0.05


def terms_of(text: bytes, known: dict | None = None) -> Counter:
    """Words and their beginnings (4 and 5 bytes, marked ``*``) of a text, or the ``known`` ones of them."""
    out: Counter = Counter()
    for word, n in Counter(text.translate(_PLAIN).split()).items():
        terms = (word, word[:4] + b"*", word[:5] + b"*") if len(word) > 5 else (word,)
        for term in terms:
            if known is None or term in known:
                out[term] += n
    return out


@dataclass
class Examples:
    """A block-max inverted index of weighted examples, and what calibrates its votes."""

    terms: dict[bytes, int]
    idf: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray]]
    block_max: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    blank: float
    near: int
    votes: np.ndarray | None = None
    rates: np.ndarray | None = None

    def weigh(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit weights of a text."""
        known = sorted((self.terms[t], n) for t, n in counts.items() if t in self.terms)
        at = np.array([t for t, _ in known], np.int64)
        weight = (1 + np.log(np.array([n for _, n in known], float))) * self.idf[at] if known else np.zeros(0)
        return at, weight / np.sqrt((weight**2).sum()) if known else weight

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest cosine (ties: the earlier one), and the cosines."""
        bound = weight @ self.block_max[at]
        scores = np.full(len(self.ids), -1.0)
        best = np.argsort(-bound, kind="stable")[: 2 + k // BLOCK]
        todo, floor = np.zeros(len(bound), bool), 0.0
        todo[best] = True
        done = np.zeros(len(bound), bool)
        while todo.any():
            part = np.zeros(len(self.ids))
            for t, w in zip(at.tolist(), weight.tolist(), strict=True):
                where, value = self.postings[t]
                use = todo[where // BLOCK]
                part[where[use]] += w * value[use]
            inside = np.repeat(todo, BLOCK)[: len(scores)]
            scores[inside] = part[inside]
            done |= todo
            if len(scores) > k:
                floor = np.partition(scores, -k)[-k]
            todo = ~done & (bound > 0) & (bound >= floor - 1e-12)
        order = np.lexsort((np.arange(len(scores)), -scores))[:k]
        order = order[scores[order] > 0]
        return order, scores[order]

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        return float((cosine * self.labels[near]).sum() / cosine.sum()) if len(near) else self.blank

    def score(self, counts: Counter) -> tuple[float, np.ndarray, np.ndarray]:
        """Calibrated score, and the examples that speak for it."""
        at, weight = self.weigh(counts)
        if not len(at) or not len(self.ids):
            return self.blank, np.zeros(0, np.int64), np.zeros(0)
        near, cosine = self.nearest(at, weight, self.near)
        vote = self.vote(near, cosine)
        return float(np.interp(vote, self.votes, self.rates)), near, cosine


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    learn: Column | None = None,
    bound: int = 8192,
    n_terms: int = 1024,
    near: int = 15,
) -> Examples:
    """Index at most ``bound`` labelled texts (see ``sample_labelled``) on ``n_terms`` words.

    Without labelled texts, or with one label only, every score is that label's rate (0
    without any).
    """
    learn = F.lit(True) if learn is None else learn
    rows = sample_labelled(small_batches(docs), labels, label, learn, bound)
    one = F.min_by(F.struct("doc_id", "label", "text"), "doc_id").alias("x")
    texts = rows.groupBy(F.xxhash64("text", F.length("text")).alias("key")).agg(one)
    sample = stored(texts.select("key", "x.*"), "examples")

    def count(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, COUNTED):
                part = batch.slice(start, COUNTED)
                found = [terms_of(t) for t in byte_texts(part.column(2))]
                sizes = [len(c) for c in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(len(found)), sizes))),
                        part.column(1).take(pa.array(np.repeat(np.arange(len(found)), sizes))),
                        pa.array([t for c in found for t in c], pa.binary()),
                        pa.array([n for c in found for n in c.values()], pa.int64()),
                    ],
                    ["key", "label", "term", "n"],
                )

    rows = stored(sample.select("key", "label", "text").mapInArrow(count, "key long, label int, term binary, n long"), "terms")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    all_, pos = sum(totals.values()), totals.get(1, 0)
    rate = pos / all_ if all_ else 0.0
    frequency = rows.groupBy("term").agg(F.count("*").alias("df"), F.sum("label").alias("hits"))
    # Chi-square of the 2 x 2 table of term and label, with its sides from the sample.
    gap = F.col("hits") * all_ - F.col("df") * pos
    spread = F.col("df") * (all_ - F.col("df")) * F.lit(float(max(pos, 1)) * max(all_ - pos, 1))
    chosen = (
        frequency.where((F.col("df") > 1) & (F.col("df") < all_))
        .withColumn("chi", F.lit(float(all_)) * gap * gap / spread)
        .where(F.col("chi") > LEAST_CHI)
        .orderBy(F.desc("chi"), "term")
        .limit(n_terms)
        .collect()
    )
    chosen = [r for r in chosen if r["chi"] >= LEAST_SHARE * chosen[0]["chi"] and not _outdone(r, chosen)]
    terms = {bytes(r["term"]): i for i, r in enumerate(chosen)}
    idf = np.array([np.log((1 + all_) / (1 + r["df"])) + 1 for r in chosen])
    model = Examples(terms, idf, [], np.zeros((len(terms), 0)), np.zeros(0, np.int64), np.zeros(0), rate, near)
    if not terms or not 0 < pos < all_:
        return model
    # The chosen terms are few and so are the examples; everything else stays in Spark.
    wanted = docs.sparkSession.createDataFrame([(t,) for t in terms], "term binary")
    kept = rows.join(F.broadcast(wanted), "term").groupBy("key").agg(F.collect_list(F.struct("term", "n")).alias("terms"))
    found = sample.select("key", "doc_id", "label").join(kept, "key", "left").collect()
    found.sort(key=lambda r: (r["doc_id"], r["key"]))
    ids, marks = [r["doc_id"] for r in found], np.array([r["label"] for r in found])
    counts = [{bytes(x["term"]): x["n"] for x in r["terms"] or ()} for r in found]
    weighed = [model.weigh(Counter(c)) for c in counts]
    # Similar examples side by side (by heaviest term), so that blocks have tight bounds.
    order = sorted(
        (i for i, (at, _) in enumerate(weighed) if len(at)),
        key=lambda i: (int(weighed[i][0][np.argmax(weighed[i][1])]), ids[i]),
    )
    none = [i for i, (at, _) in enumerate(weighed) if not len(at)]
    model.blank = float((marks[none].sum() + rate) / (len(none) + 1))
    model.ids = np.array([ids[i] for i in order])
    model.labels = marks[order].astype(float)
    model.block_max = np.zeros((len(terms), -(-len(order) // BLOCK)))
    lists: list[tuple[list[int], list[float]]] = [([], []) for _ in terms]
    for place, i in enumerate(order):
        for t, w in zip(*weighed[i], strict=True):
            lists[t][0].append(place)
            lists[t][1].append(w)
            model.block_max[t, place // BLOCK] = max(model.block_max[t, place // BLOCK], w)
    model.postings = [(np.array(p, np.int64), np.array(w)) for p, w in lists]
    votes = np.zeros(len(order))
    for place, i in enumerate(order):
        found_, cosine = model.nearest(*weighed[i], near + 1)
        other = found_ != place
        votes[place] = model.vote(found_[other][:near], cosine[other][:near])
    model.votes, model.rates = _isotonic(votes, model.labels)
    return model


def _outdone(row, rows) -> bool:
    """A beginning that tells no more than one longer term with it is left to that term."""
    term = bytes(row["term"])
    if not term.endswith(b"*"):
        return False
    longer = [r["chi"] for r in rows if (t := bytes(r["term"])) != term and t.startswith(term[:-1])]
    return max(longer, default=0.0) >= row["chi"]


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing means of ``y`` along ``x``, by pooling neighbours that violate the order."""
    levels, at = np.unique(x, return_inverse=True)
    means, weights, spans = [], [], []
    for mean, weight in zip(np.bincount(at, y) / np.bincount(at), np.bincount(at), strict=True):
        means.append(mean)
        weights.append(weight)
        spans.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            total = weights[-2] + weights[-1]
            means[-2] = (means[-2] * weights[-2] + means[-1] * weights[-1]) / total
            weights[-2], spans[-2] = total, spans[-2] + spans[-1]
            del means[-1], weights[-1], spans[-1]
    return levels, np.repeat(means, spans)


def with_toxicity(docs: DataFrame, model: Examples, column: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``score, evidence``: the calibrated score of each whole text and
    its nearest examples (doc_id, cosine, label), nearest first.

    Null, empty and unknown texts get the rate of the examples without a known term.
    Repeated rows and ties score alike; other columns are passed through.
    """
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(vars(model))
    kind = "struct<score: double, evidence: array<struct<doc_id: long, cosine: double, label: int>>>"
    ids = np.asarray(model.ids)
    numbered = ids.dtype.kind in "iu"

    @F.arrow_udf(kind)
    def score(texts: pa.Array) -> pa.Array:
        model, known = Examples(**shared.value), {}
        out = []
        for text in byte_texts(texts):
            counts = terms_of(text, model.terms)
            key = frozenset(counts.items())
            if key not in known:
                value, near, cosine = model.score(counts)
                known[key] = {
                    "score": value,
                    "evidence": [
                        {"doc_id": int(model.ids[i]) if numbered else None, "cosine": float(c), "label": int(model.labels[i])}
                        for i, c in zip(near[:3], cosine[:3], strict=True)
                    ],
                }
            out.append(known[key])
        return pa.array(
            out,
            pa.struct(
                [
                    ("score", pa.float64()),
                    ("evidence", pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))),
                ]
            ),
        )

    return docs.withColumn(column, score(F.col("text").cast("string")))


#: Remainder of crc32(doc_id) modulo 4 whose documents are never learnt from.
HELD_OUT = 2


def not_held_out() -> Column:
    return remainder(F.col("doc_id"), 4) != HELD_OUT
