"""Language-model scores: a log-bilinear model learnt by noise-contrastive estimation.

The model predicts a symbol from the two symbols before it, by embeddings that are turned
by one matrix per position.  The most frequent words and the end of a text are symbols of
their own; every other word belongs to the symbol of its last two bytes and is drawn inside
it in proportion to its count plus one, with one place left for all words never seen.  So
the probabilities of all words after any context sum to 1.

Counts are Spark aggregates over all training texts.  A hash of a document deals it to one
of the rounds and to a shard of it; a shard has about as many tokens in a corpus of any size.
Shards are learnt in the tasks, each in the order of the hashes from the same start; the
parameters are averaged, weighted by tokens, and are the start of the next round.  So the
model depends on the texts alone, neither on files nor on partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.text import mixed, remainder, small_batches, word_runs
from plumbline.session import stored

#: Words that are symbols of their own, and symbols of word endings.
HEAD, ENDINGS = 255, 256
END = HEAD + ENDINGS
SYMBOLS = END + 1
#: Symbol before the start of a text; a context only.
START = SYMBOLS
#: Words whose counts travel to every task (4 MB); the others are joined.
COMMON = 1 << 18
#: Size of an embedding, noise words of a training step, tokens of a step.
WIDTH, NOISE, STEP = 24, 48, 1024
#: Tokens that are scored together, and that are shuffled together in training.
TOGETHER, SHUFFLED = 1 << 19, 1 << 17
#: Tokens of a shard, about, and rounds of training.
SHARD, ROUNDS = 1 << 20, 2
#: Averages are sums of integers, equal in any order: so many parts of a unit.
PARTS = float(1 << 30)
#: Levels of word counts in a doubling.
LEVELS = 64


def ending_symbol(text: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The symbol of the last two bytes of each word (A-Z as a-z)."""
    lower = np.where((text >= 65) & (text <= 90), text | 32, text).astype(np.uint64)
    last = lower[to - 1] * np.uint64(256) + np.where(to - at > 1, lower[np.maximum(to - 2, 0)], 0).astype(np.uint64)
    return HEAD + (mixed(last + np.uint64(1)) % np.uint64(ENDINGS)).astype(np.int64)


@dataclass
class Counts:
    """What all training texts add up to."""

    head: np.ndarray  # sorted hashes of the head words
    head_n: np.ndarray  # their counts
    common: np.ndarray  # sorted hashes of the common words, head words included
    common_n: np.ndarray
    symbol_n: np.ndarray  # tokens of each symbol
    symbol_v: np.ndarray  # distinct words of each symbol
    texts: int

    @property
    def tokens(self) -> int:
        return int(self.symbol_n.sum())

    @property
    def types(self) -> int:
        return int(self.symbol_v.sum())

    def symbols(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        if not len(self.head):
            return endings
        spot = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
        return np.where(self.head[spot] == hashes, spot, endings)


def symbol_lists(column: pa.Array, counts: Counts):
    """``(symbols, hashes, start)`` for runs of rows; ends of texts are not in them."""
    for text, at, to, hashes, start in word_runs(column):
        yield counts.symbols(hashes, ending_symbol(text, at, to)), hashes, start


def count_words(texts: DataFrame) -> tuple[Counts, DataFrame]:
    """Counts of ``texts(text)`` for the tasks, and the table ``hash, symbol, n`` of all words."""

    def work(batches):
        held, ends, size = [], [], 0

        def merged():
            words = np.concatenate(held)
            kinds = np.concatenate(ends)
            distinct, first, n = np.unique(words, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(kinds[first]), pa.array(n)], ["hash", "symbol", "n"]
            )

        for batch in batches:
            for text, at, to, hashes, _ in word_runs(batch.column(0)):
                held.append(hashes)
                ends.append(ending_symbol(text, at, to))
                size += len(hashes)
                if size > 2 * TOGETHER:
                    yield merged()
                    held, ends, size = [], [], 0
        if size:
            yield merged()

    words = stored(
        texts.mapInArrow(work, "hash long, symbol long, n long")
        .groupBy("hash")
        .agg(F.first("symbol").alias("symbol"), F.sum("n").alias("n")),
        "words",
    )
    level = F.floor(F.log2("n") * LEVELS)
    common = words.where(level >= _cut(words, level)).toArrow()
    hashes, n = common.column("hash").to_numpy(), common.column("n").to_numpy()
    falling = np.lexsort((hashes, -n))
    hashes, n, kinds = hashes[falling].view(np.uint64), n[falling], common.column("symbol").to_numpy()[falling]
    symbol_n, symbol_v = np.zeros(SYMBOLS, np.int64), np.zeros(SYMBOLS, np.int64)
    for row in words.groupBy("symbol").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        symbol_n[row["symbol"]], symbol_v[row["symbol"]] = row["n"], row["v"]
    head = np.argsort(hashes[:HEAD])
    np.subtract.at(symbol_n, kinds[:HEAD], n[:HEAD])
    np.subtract.at(symbol_v, kinds[:HEAD], 1)
    symbol_n[: len(head)], symbol_v[: len(head)] = n[:HEAD][head], 1
    count = texts.count()
    symbol_n[END], symbol_v[END] = count, int(count > 0)
    order = np.argsort(hashes)
    return (
        Counts(hashes[:HEAD][head], n[:HEAD][head], hashes[order], n[order], symbol_n, symbol_v, count),
        words,
    )


def _cut(words: DataFrame, level: Column) -> int:
    """The lowest level of counts from which on no more than ``COMMON`` words are; a row per level is read."""
    total, cut = 0, 1 << 30
    for row in words.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        total += row["count"]
        if total > COMMON:
            break
        cut = row["level"]
    return cut


@dataclass
class LogBilinear:
    """Context embeddings, a matrix per position, output embeddings and biases."""

    context: np.ndarray
    turn: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.context[one] @ self.turn[0] + self.context[two] @ self.turn[1]

    def log_probabilities(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of all symbols after each context; they sum to 1."""
        logits = self.predicted(one, two) @ self.output.T + self.bias
        top = logits.max(axis=1, keepdims=True)
        return logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in vars(self).values()])

    def filled(self, flat: np.ndarray) -> LogBilinear:
        out, at = [], 0
        for x in vars(self).values():
            out.append(flat[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return LogBilinear(*out)

    def train(self, one, two, target, noise_p: np.ndarray, rng, squares: list[np.ndarray], rate: float = 0.15) -> None:
        """A step of noise-contrastive estimation, with noise words shared by the step."""
        noise = np.searchsorted(np.cumsum(noise_p), rng.random(NOISE)).clip(0, len(noise_p) - 1)
        scale = np.log(NOISE * noise_p + 1e-12).astype(np.float32)
        q = self.predicted(one, two)
        data = (q * self.output[target]).sum(axis=1) + self.bias[target] - scale[target]
        fake = q @ self.output[noise].T + self.bias[noise] - scale[noise]
        g_data = 1 / (1 + np.exp(np.clip(data, -30, 30)))  # rises the true word
        g_fake = -1 / (1 + np.exp(-np.clip(fake, -30, 30)))
        n = len(target)
        g_out = _summed(target, g_data[:, None] * q, SYMBOLS)
        np.add.at(g_out, noise, g_fake.T @ q)
        g_bias = np.bincount(target, g_data, SYMBOLS)
        np.add.at(g_bias, noise, g_fake.sum(axis=0))
        g_q = g_data[:, None] * self.output[target] + g_fake @ self.output[noise]
        x, y = self.context[one], self.context[two]
        g_turn = np.stack([x.T @ g_q, y.T @ g_q])
        g_context = _summed(one, g_q @ self.turn[0].T, SYMBOLS + 1) + _summed(two, g_q @ self.turn[1].T, SYMBOLS + 1)
        for p, g, s in zip(vars(self).values(), (g_context, g_turn, g_out, g_bias), squares, strict=True):
            g = g / n
            s += g * g
            p += (rate * g / (np.sqrt(s) + 1e-3)).astype(np.float32)


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by index."""
    order = np.argsort(at, kind="stable")
    keys, first = np.unique(at[order], return_index=True)
    out = np.zeros((n, rows.shape[1]))
    out[keys] = np.add.reduceat(rows[order], first)
    return out


def learn_model(texts: DataFrame, counts: Counts, shard: int = SHARD, seed: int = 5) -> LogBilinear:
    """The model learnt from all of ``texts(doc_id, text)``, in shards of about ``shard`` tokens.

    Copies under different doc_ids are dealt to different shards.
    """
    rng = np.random.default_rng(seed)
    share = (counts.symbol_n + 1) / (counts.symbol_n.sum() + SYMBOLS)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    model = LogBilinear(
        small(SYMBOLS + 1, WIDTH),
        np.stack([np.eye(WIDTH, dtype=np.float32)] * 2),
        small(SYMBOLS, WIDTH),
        np.log(share).astype(np.float32),
    )
    context = texts.sparkSession.sparkContext
    facts = context.broadcast(vars(counts))
    shards = max(1, -(-counts.tokens // (ROUNDS * shard)))
    keyed = texts.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    dealt = keyed.select(F.pmod("key", F.lit(ROUNDS)).alias("turn"), F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "text")
    for turn in range(ROUNDS):
        start = context.broadcast(vars(model))

        def work(batches, turn=turn, start=start):
            counts = Counts(**facts.value)
            total = np.zeros(sum(x.size for x in start.value.values()) + 1, np.int64)
            now, learner = None, None
            for batch in batches:
                places, row = batch.column(0).to_numpy(), 0
                for symbols, _, first in symbol_lists(batch.column(1), counts):
                    for place, at, to in zip(places[row:].tolist(), first[:-1].tolist(), first[1:].tolist(), strict=False):
                        if place != now:
                            if learner:
                                total += learner.closed(shard)
                            now, learner = place, Shard(start.value, share, [seed, turn, place])
                        learner.take(symbols[at:to])
                    row += len(first) - 1
            if learner:
                total += learner.closed(shard)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "value"])

        # Whole shards, in an order of their own; a partition may hold several.
        whole = dealt.where(F.col("turn") == turn).repartition(min(shards, 4096), "shard").sortWithinPartitions("shard", "key", "text")
        sums = whole.select("shard", "text").mapInArrow(work, "at long, value long")
        table = sums.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        total = np.zeros(model.flat().size + 1)
        total[table.column("at").to_numpy()] = table.column("value").to_numpy()
        if total[-1]:
            model = model.filled(total[:-1] / total[-1])
    return model


class Shard:
    """A model in training: texts are gathered, and learnt from in an order drawn anew for each lot."""

    def __init__(self, start: dict[str, np.ndarray], share: np.ndarray, seed: list[int]):
        self.model = LogBilinear(*[x.copy() for x in start.values()])
        self.squares = [np.full(x.shape, 1e-3) for x in start.values()]
        self.share, self.rng = share, np.random.default_rng(seed)
        self.held: list[np.ndarray] = []
        self.waiting = self.seen = 0

    def take(self, symbols: np.ndarray) -> None:
        self.held.append(symbols)
        self.waiting += len(symbols) + 1
        if self.waiting >= SHUFFLED:
            self.learn()

    def learn(self) -> None:
        first = np.cumsum([0] + [len(x) for x in self.held])
        one, two, target = _contexts(np.concatenate(self.held), first)[:3]
        order = self.rng.permutation(len(target))
        for i in range(0, len(order), STEP):
            some = order[i : i + STEP]
            self.model.train(one[some], two[some], target[some], self.share, self.rng, self.squares)
        self.seen += len(target)
        self.held, self.waiting = [], 0

    def closed(self, shard: int) -> np.ndarray:
        """Parameters times tokens, and the tokens, in parts of a shard's tokens."""
        if self.held:
            self.learn()
        weight = self.seen / shard * PARTS
        return np.rint(np.append(self.model.flat().astype(float), 1.0) * weight).astype(np.int64)


def _contexts(symbols: np.ndarray, first: np.ndarray):
    """Contexts and targets of a run of texts with their ends; ``place`` is the text of each."""
    n = len(first) - 1
    place = np.repeat(np.arange(n), np.diff(first) + 1)
    starts = first[:-1] + np.arange(n)
    target = np.full(len(symbols) + n, END)
    inner = np.ones(len(target), bool)
    inner[starts + np.diff(first)] = False
    target[inner] = symbols
    two = np.append(START, target[:-1])
    two[starts] = START
    one = np.append([START, START], target[:-2])[: len(target)]
    one[starts] = START
    one[np.minimum(starts + 1, len(target) - 1)[np.diff(first) > 0]] = START
    return one, two, target, place, inner


def lm_scores(docs: DataFrame, train: Column, shard: int = SHARD) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs(doc_id, text)``.

    Rows where ``train`` holds are learnt from, whatever their doc_id, null or not, in shards
    of about ``shard`` tokens.  Scores do not depend on the layout of the rows.  Tokens are the words between ASCII blanks
    (A-Z as a-z) and one end; a null or empty text is an end only.  ``base_score`` is the
    add-one unigram log10-probability over the training counts, ``score`` the model's.
    Repeated rows and equal texts have equal scores.  With nothing to learn from, no token
    is known and the base is 0.
    """
    docs = small_batches(docs).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), train.alias("train"))
    texts = docs.where("train").select("doc_id", "text")
    counts, words = count_words(texts.select("text"))
    model = learn_model(texts, counts, shard)
    context = docs.sparkSession.sparkContext
    facts, learnt = context.broadcast(vars(counts)), context.broadcast(vars(model))

    def work(batches):
        counts, model = Counts(**facts.value), LogBilinear(**learnt.value)
        inside = np.log10(counts.symbol_n + counts.symbol_v + 1.0)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            held, size, at = [], 0, 0
            for run in symbol_lists(batch.column(1), counts):
                held.append(run)
                size += len(run[0])
                if size > TOGETHER:
                    rows = sum(len(r[2]) - 1 for r in held)
                    yield _scored(held, batch.column(0).slice(at, rows), row, counts, model, inside)
                    held, size, at, row = [], 0, at + rows, row + rows
            if held:
                rows = sum(len(r[2]) - 1 for r in held)
                yield _scored(held, batch.column(0).slice(at, rows), row, counts, model, inside)
                row += rows

    scored = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            work,
            "doc_id long, row long, n_tokens long, n_known long, base double, score double,"
            " rare array<struct<hash: long, n: long>>",
        ),
        "scored",
    )
    rare = scored.select("row", F.explode("rare").alias("x")).select("row", "x.hash", "x.n")
    met = (
        rare.join(words.select("hash", F.col("n").alias("c")), "hash")
        .groupBy("row")
        .agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("gain"))
    )
    whole = float(np.log10(counts.tokens + counts.types + 1))
    return scored.join(met, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("score") + F.coalesce("gain", F.lit(0.0))).alias("score"),
    )


def _scored(runs, ids: pa.Array, row: int, counts: Counts, model: LogBilinear, inside: np.ndarray) -> pa.RecordBatch:
    """Sums of a few runs of texts, and the words whose counts are not at hand."""
    symbols = np.concatenate([r[0] for r in runs])
    hashes = np.concatenate([r[1] for r in runs])
    shift = np.cumsum([0] + [len(r[0]) for r in runs])
    first = np.concatenate([r[2][:-1] + s for r, s in zip(runs, shift, strict=False)] + [[shift[-1]]])
    n = len(first) - 1
    one, two, target, place, inner = _contexts(symbols, first)
    # Each distinct context is worked out once.
    pair = one * (SYMBOLS + 1) + two
    order = np.argsort(pair, kind="stable")
    distinct, start = np.unique(pair[order], return_index=True)
    bounds = np.append(start, len(pair))
    logs = np.zeros(len(pair))
    for i in range(0, len(distinct), 4096):
        some = distinct[i : i + 4096]
        table = model.log_probabilities(some // (SYMBOLS + 1), some % (SYMBOLS + 1))
        mine = order[bounds[i] : bounds[min(i + 4096, len(distinct))]]
        which = np.repeat(np.arange(len(some)), np.diff(bounds[i : i + len(some) + 1]))
        logs[mine] = table[which, target[mine]]
    score = np.bincount(place, logs, n) / np.log(10)
    # Words: counts of common ones, and the share of a word inside its symbol.
    text = place[inner]
    if len(counts.common):
        spot = np.minimum(np.searchsorted(counts.common, hashes), len(counts.common) - 1)
        common = counts.common[spot] == hashes
        c = np.where(common, counts.common_n[spot], 0)
    else:
        common, c = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    gain = np.log10(c + 1.0)
    grouped = symbols >= HEAD
    score += np.bincount(text, np.where(grouped, gain - inside[symbols], 0.0), n)
    base = np.bincount(text, gain, n) + np.log10(counts.texts + 1.0)
    known = np.bincount(text, common, n).astype(np.int64) + int(counts.texts > 0)
    # The rest: one entry per text and word.
    rare_text, rare_hash = text[~common], hashes[~common]
    by = np.lexsort((rare_hash, rare_text))
    rare_text, rare_hash = rare_text[by], rare_hash[by]
    new = np.flatnonzero(np.append(True, (rare_text[1:] != rare_text[:-1]) | (rare_hash[1:] != rare_hash[:-1]))[: len(by)])
    times = np.diff(np.append(new, len(by)))
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(rare_text[new], np.arange(n + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(rare_hash[new].view(np.int64)), pa.array(times.astype(np.int64))], ["hash", "n"]),
    )
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.arange(row, row + n)), pa.array(np.diff(first) + 1), pa.array(known), pa.array(base), pa.array(score), lists],
        ["doc_id", "row", "n_tokens", "n_known", "base", "score", "rare"],
    )


def learnt_from() -> Column:
    """Documents that are learnt from: those whose crc32 modulo 7 is not 2."""
    return remainder(F.col("doc_id"), 7) != 2
