"""Quality by attention-based multiple-instance learning over the passages of a text.

Every passage of a text is measured and encoded; a gated attention, learnt from labels of
whole documents only, weighs the passages, and the weighted encoding gives the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.labelled import sample_labelled
from plumbline.llm.text import byte_texts, located_words, remainder, small_batches

#: Words of a passage (the last has half of them to half of them more).
PASSAGE_WORDS = 50
#: Passages of a text that are learnt from at most, spread evenly over it; scores come from all.
LEARNT = 64
#: Passages that are encoded together.
TOGETHER = 4096
#: Byte classes: small letters, capitals, digits, blanks, line ends, stops, exclamations, bars, other marks, beyond ASCII.
_CLASSES = 10
_CLASS = np.full(256, 8)
for _i, _marks in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;:'-\"()", b"!?", b"|_=<>{}[]/\\")):
    _CLASS[list(_marks)] = _i
_CLASS[128:] = 9
MEASURES = _CLASSES + 12


def measure(text: bytes) -> np.ndarray:
    """One row of measures for each passage; a text without words is one row of zeros."""
    data = np.frombuffer(text, np.uint8)
    at, to, hashes = located_words(data) if len(data) else (np.zeros(0, int),) * 3
    n = len(at)
    if not n:
        return np.zeros((1, MEASURES))
    first = np.arange(0, n, PASSAGE_WORDS)
    if len(first) > 1 and n - first[-1] < PASSAGE_WORDS // 2:
        first = first[:-1]
    words = np.diff(np.append(first, n))
    where = np.repeat(np.arange(len(first)), words)
    edges = np.append(at[first], len(data))
    edges[0] = 0
    span = np.diff(edges)
    kinds = _CLASS[data]
    counts = np.bincount(np.repeat(np.arange(len(first)), span) * _CLASSES + kinds, minlength=len(first) * _CLASSES)
    shares = counts.reshape(-1, _CLASSES) / span[:, None]
    length = (to - at).astype(float)
    mean = np.add.reduceat(length, first) / words
    spread = np.sqrt(np.maximum(np.add.reduceat(length**2, first) / words - mean**2, 0))
    start, stop = kinds[at], kinds[to - 1]
    share = lambda mask: np.add.reduceat(mask.astype(float), first) / words
    # Repetition: words within the passage, and pairs of words in the whole text.
    order = np.lexsort((hashes, where))
    same = (hashes[order][1:] == hashes[order][:-1]) & (where[order][1:] == where[order][:-1])
    repeated = np.zeros(n)
    repeated[order[1:]] = same
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:]
    again = np.zeros(n)
    by = np.argsort(pairs, kind="stable")
    again[by[1:]] = pairs[by][1:] == pairs[by][:-1]
    beside = np.append(False, hashes[1:] == hashes[:-1])
    capitals = np.append(0, np.cumsum(kinds == 1))
    letters = np.append(0, np.cumsum((kinds < 2) | (kinds == 9)))
    shout = (capitals[to] - capitals[at] == letters[to] - letters[at]) & (letters[to] - letters[at] > 1)
    own = [
        np.log1p(words), mean, spread, share(start == 1), share(shout), share(stop == 8), share(stop == 6),
        share(start == 7), share(repeated), share(again), share(beside), np.full(len(first), np.log1p(n)),
    ]
    return np.concatenate([shares, np.stack(own, axis=1)], axis=1)


def spread(x: np.ndarray, most: int) -> np.ndarray:
    """At most so many rows, evenly over all, the first and the last among them."""
    return x if len(x) <= most else x[np.linspace(0, len(x) - 1, most).round().astype(int)]


@dataclass
class Attention:
    """Scaling, encoder, gated attention and output of the network."""

    centre: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def encoded(self, x: np.ndarray):
        """Scaled measures, encodings, the two sides of the gate, and the attention of passages."""
        p = self.p
        x = np.clip((x - self.centre) / self.scale, -8, 8)
        h = np.tanh(x @ p["enc"] + p["enc_b"])
        v, u = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        return x, h, v, u, (v * u) @ p["w"]

    def pooled(self, x: np.ndarray, together: int = TOGETHER) -> float:
        """The score of one text, some passages at a time: running maximum, sum and weighted sum."""
        top, total, z = -np.inf, 0.0, 0.0
        for i in range(0, len(x), together):
            _, h, _, _, e = self.encoded(x[i : i + together])
            higher = max(top, e.max())
            weight, before = np.exp(e - higher), np.exp(top - higher)
            total, z, top = total * before + weight.sum(), z * before + weight @ h, higher
        return float(1 / (1 + np.exp(-(z / total @ self.p["out"] + self.p["out_b"]))))

    def scores(self, texts: list[bytes]) -> list[float]:
        """The scores of texts; a few short ones are encoded together, a long one alone."""
        out, held, size = [], [], 0

        def flush():
            if held:
                first = np.cumsum([0] + [len(b) for b in held[:-1]])
                out.extend(self.forward(np.concatenate(held), first)[0].tolist())
                held.clear()

        for text in texts:
            x = measure(text)
            if size + len(x) > TOGETHER:
                flush()
                size = 0
            if len(x) > TOGETHER:
                out.append(self.pooled(x))
            else:
                held.append(x)
                size += len(x)
        flush()
        return out

    def forward(self, x: np.ndarray, first: np.ndarray):
        """Scores of the texts whose passages start at ``first``, and what training needs."""
        p = self.p
        x, h, v, u, e = self.encoded(x)
        text = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        e = np.exp(e - np.maximum.reduceat(e, first)[text])
        a = e / np.add.reduceat(e, first)[text]
        z = np.add.reduceat(a[:, None] * h, first)
        score = 1 / (1 + np.exp(-(z @ p["out"] + p["out_b"])))
        return score, (x, h, v, u, a, z, text)

    def gradients(self, y: np.ndarray, score: np.ndarray, kept, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        x, h, v, u, a, z, text = kept
        d = (score - y) / len(y)
        dz = d[:, None] * p["out"]
        da = (dz[text] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, first)[text])
        dvu = de[:, None] * p["w"]
        dv, du = dvu * u * (1 - v**2), dvu * v * u * (1 - u)
        dh = a[:, None] * dz[text] + dv @ p["v"].T + du @ p["u"].T
        dx = dh * (1 - h**2)
        return {
            "enc": x.T @ dx, "enc_b": dx.sum(axis=0), "v": h.T @ dv, "u": h.T @ du,
            "w": (v * u).T @ de, "out": z.T @ d, "out_b": d.sum(),
        }


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    learn: Column | None = None,
    bound: int = 6000,
    width: int = 16,
    steps: int = 400,
    seed: int = 11,
) -> Attention | float:
    """The network learnt from at most ``bound`` labelled texts (see ``sample_labelled``).

    The texts are measured in Spark; the driver gets ``LEARNT`` rows of measures per text at
    most, spread evenly over its passages.  Without both labels there is nothing to learn: the rate of label 1 is returned
    (0 without any text).
    """
    learn = F.lit(True) if learn is None else learn
    sample = sample_labelled(small_batches(docs), labels, label, learn, bound)

    def work(batches):
        for batch in batches:
            found = [spread(measure(t), LEARNT).astype(np.float32) for t in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f.ravel() for f in found], pa.list_(pa.float32()))], ["label", "x"]
            )

    rows = sample.orderBy(F.xxhash64("doc_id"), "doc_id").select("label", "text")
    table = rows.mapInArrow(work, "label int, x array<float>").toArrow()
    y = np.array(table.column("label").to_pylist(), float)
    if len(y) == 0 or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.0
    bags = [np.array(x, float).reshape(-1, MEASURES) for x in table.column("x").to_pylist()]
    first = np.cumsum([0] + [len(b) for b in bags[:-1]])
    x = np.concatenate(bags)
    rng = np.random.default_rng(seed)
    near = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = Attention(
        x.mean(axis=0),
        x.std(axis=0) + 1e-3,
        {
            "enc": near(MEASURES, width), "enc_b": np.zeros(width), "v": near(width, width), "u": near(width, width),
            "w": near(width), "out": near(width), "out_b": np.log(y.mean() / (1 - y.mean())),
        },
    )
    mean = {k: 0.0 for k in model.p}
    square = {k: 0.0 for k in model.p}
    for step in range(1, steps + 1):
        score, kept = model.forward(x, first)
        for k, g in model.gradients(y, score, kept, first).items():
            g = g + 1e-4 * model.p[k]
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            model.p[k] = model.p[k] - 0.02 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return model


def with_quality(docs: DataFrame, model: Attention | float, column: str = "quality") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1.

    A null or empty text, or one of blanks, is scored as one empty passage; a text of any
    length is scored by all its passages, which are equally long in all texts.  Equal texts have
    equal scores; other columns are passed through.
    """
    if isinstance(model, float):
        return docs.withColumn(column, F.lit(model))
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(vars(model))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = Attention(**shared.value)
        # Rounded, since the last bits of a matrix product depend on the rest of the batch.
        return pa.array(np.round(model.scores(byte_texts(texts)), 12), pa.float64())

    return docs.withColumn(column, score(F.col("text").cast("string")))


def learnt_from() -> Column:
    """Documents whose labels may be learnt from: those whose crc32 modulo 5 is not 0."""
    return remainder(F.col("doc_id"), 5) != 0
