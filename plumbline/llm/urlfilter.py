"""URL filters: rules first, then logistic regression on hashed character n-grams.

Host and path are taken apart by SQL functions.  The longest rule that fits a URL decides;
other URLs are judged by a logistic regression on hashed n-grams of bytes of host and path,
learnt from a small table of labelled URLs.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.text import mixed, small_batches

ALLOW, BLOCK = "allow", "block"
#: Hashed features, sizes of n-grams, and URLs learnt from at most.
FEATURE_BITS, SIZES, BOUND = 15, (3, 4, 5), 4096
#: Bytes of URLs whose n-grams are hashed together.
TOGETHER = 1 << 20

# A small labelled table, made from words of either kind in the usual shapes of URLs.
BLOCKED_WORDS = (
    "casino poker bets betting jackpot lottery pills viagra pharma-cheap adult xxx porn escort nude spam "
    "link-farm warez torrent crack keygen phish free-money payday replica followers"
).split()
ALLOWED_WORDS = (
    "news library school museum journal garden weather kitchen science history music travel city health "
    "docs wiki forum research archive company team books sport photo market report guide"
).split()
_SHAPES = (
    "https://www.{word}.example.com/{lang}/{n}",
    "http://{word}-x.example.net/{lang}/{n}.html",
    "https://blog.{word}.example.org/{lang}/{n}/",
    "http://my-{word}.example.com/{lang}/{n}?page=2",
    "https://example.net/{word}/{lang}/{n}",
)


def seed_urls(spark: SparkSession) -> DataFrame:
    """``url, verdict`` for each word in each shape; languages and numbers go round alike for both kinds."""
    rows, langs = [], ("en", "de", "fr", "es")
    for verdict, words in ((BLOCK, BLOCKED_WORDS), (ALLOW, ALLOWED_WORDS)):
        for i, word in enumerate(words):
            for j, shape in enumerate(_SHAPES):
                rows.append((shape.format(word=word, lang=langs[(i + j) % 4], n=37 * i % 1000 + j), verdict))
    return spark.createDataFrame(rows, "url string, verdict string")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, under a path's beginning."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def parse_rules(lines: Sequence[str]) -> list[Rule]:
    """Rules from ``allow host/path`` and ``block host/path``, longest first (ties: blocks, then by text)."""
    rules = []
    for line in lines:
        verdict, _, text = line.strip().partition(" ")
        text = text.strip()
        if verdict not in (ALLOW, BLOCK) or not text or text.startswith("/"):
            raise ValueError(f"not a rule: {line!r}")
        host, slash, path = text.partition("/")
        rules.append(Rule(verdict, _lower(host) + slash + path))
    return sorted(set(rules), key=lambda r: (-len(r.text), r.verdict != BLOCK, r.text))


def _lower(text: str) -> str:
    return text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    empty = lambda c: F.coalesce(c, F.lit(""))
    return F.translate(empty(host), string.ascii_uppercase, string.ascii_lowercase), empty(path)


def deciding_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``rule, verdict`` of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in reversed(rules):
        inside = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = inside & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(texts: list[bytes], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed feature of each n-gram of ``^text$``."""
    data = b"".join(b"^" + t + b"$" for t in texts)
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    sizes = np.array([len(t) + 2 for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    rows, features, value = [], [], raw
    for size in range(2, max(SIZES) + 1):
        value = value[:-1] | (raw[size - 1 :] << np.uint64(8 * (size - 1)))
        if size not in SIZES or not len(value):
            continue
        whole = row[: len(value)] == row[size - 1 :]
        rows.append(row[: len(value)][whole])
        keyed = value[whole] + np.uint64((seed * 8 + size) << 48)
        features.append((mixed(keyed) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(features)


def _features(hosts: list[bytes], paths: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of the n-grams; a URL's values have length 1 if no n-gram repeats."""
    (r1, f1), (r2, f2) = _grams(hosts, 1), _grams(paths, 2)
    rows, features = np.concatenate([r1, r2]), np.concatenate([f1, f2])
    counts = np.bincount(rows, minlength=len(hosts))
    return rows, features, 1 / np.sqrt(np.maximum(counts, 1))[rows]


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def chances(self, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        """The chance of a block for each URL; sums go along a URL, so its batch does not matter."""
        rows, features, values = _features(hosts, paths)
        score = np.bincount(rows, self.weights[features] * values, minlength=len(hosts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(score, -500, 500)))


def learn_urls(labelled: DataFrame, bound: int = BOUND, steps: int = 300, decay: float = 1e-3) -> UrlModel:
    """A regression fitted to at most ``bound`` distinct rows ``url, verdict`` of smallest hash.

    Rows with another verdict than allow or block, or without a URL, are not learnt from.
    A URL with both verdicts counts for both.  With no rows, or one verdict only, every
    chance is that verdict's share (a half without rows).
    """
    host, path = url_parts(F.col("url").cast("string"))
    rows = (
        labelled.where(F.col("verdict").isin(ALLOW, BLOCK) & F.col("url").isNotNull())
        .select("url", host.alias("host"), path.alias("path"), (F.col("verdict") == BLOCK).cast("int").alias("y"))
        .distinct()
        .orderBy(F.xxhash64("url"), "url", "y")
        .limit(bound)
        .collect()
    )
    y = np.array([r["y"] for r in rows], float)
    weights = np.zeros(1 << FEATURE_BITS)
    if not 0 < y.sum() < len(y):
        share = y.mean() if len(y) else 0.5
        return UrlModel(weights, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    at, feature, value = _features([r["host"].encode() for r in rows], [r["path"].encode() for r in rows])
    # Both verdicts weigh alike; steps of the inverse curvature bound with momentum.
    weigh = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    bias, step = 0.0, 1.0
    look, look_bias = weights.copy(), bias
    for i in range(steps):
        chance = 1 / (1 + np.exp(-(np.bincount(at, look[feature] * value, minlength=len(y)) + look_bias)))
        wrong = weigh * (chance - y)
        slope = np.bincount(feature, wrong[at] * value, minlength=len(weights)) + decay * look
        fresh, fresh_bias = look - step * slope, look_bias - step * wrong.sum()
        pull = i / (i + 3)
        look, look_bias = fresh + pull * (fresh - weights), fresh_bias + pull * (fresh_bias - bias)
        weights, bias = fresh, fresh_bias
    return UrlModel(weights, float(bias))


def filter_urls(
    pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = (), url: str = "url", column: str = "url_filter"
) -> DataFrame:
    """``pages`` with a struct ``host, path, rule, verdict, chance``.

    The verdict is that of the longest rule that fits, else a block where the model's chance
    of a block is a half or more.  A null URL, and one without ``://``, has an empty host
    and path, is fitted by no rule and is judged by the model like any other.  Repeated rows
    and equal URLs are judged alike; long URLs are hashed a megabyte at a time.  Other
    columns are kept, whatever their names, except one named ``column``.
    """
    shared = small_batches(pages).sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("double")
    def chance(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        judge = UrlModel(*shared.value)
        sides = [[t or b"" for t in c.cast(pa.binary()).to_pylist()] for c in (hosts, paths)]
        out, start, size = [], 0, 0
        for i in range(len(hosts)):
            size += len(sides[0][i]) + len(sides[1][i])
            if size > TOGETHER or i + 1 == len(hosts):
                out.append(judge.chances(sides[0][start : i + 1], sides[1][start : i + 1]))
                start, size = i + 1, 0
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    host, path = url_parts(F.col("row").getField(url).cast("string"))
    cut = pages.select(row.alias("row")).select("row", host.alias("host"), path.alias("path"))
    judged = cut.select("row", "host", "path", deciding_rule(F.col("host"), F.col("path"), rules).alias("by"), chance("host", "path").alias("chance"))
    verdict = F.coalesce("by.verdict", F.when(F.col("chance") >= 0.5, BLOCK).otherwise(ALLOW))
    result = F.struct("host", "path", F.col("by.rule").alias("rule"), verdict.alias("verdict"), "chance")
    kept = [F.col("row").getField(c).alias(c) for c in pages.columns if c != column]
    return judged.select(*kept, result.alias(column))
