"""Jaccard join of documents on word shingles: a grouped prefix join.

Shingles are ordered rarest first (by how often their bucket of hashes occurs).  Two sets
that overlap enough share one of their first tokens.  Documents with one and the same set
are one class; classes with the same prefix and size are one group.  Groups that share a
prefix token are candidates.  Links are sought in two steps, neither of which writes all pairs of a
group: first every group is compared with the most central group of each of its lists;
then, in lists that still hold several components, what lies outside the list's main
component is compared with the rest.  Exact bounds discard pairs before whole sets are compared: sizes, the
places of the first shared token (what lies before it in either set is in one set only), and the symmetric
difference (parity sketches never differ in more bits than the sets do in elements).  In crowded lists rows
meet by bins of size, so most pairs that these bounds rule out are never looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.filters import key_filter, spot
from plumbline.llm.text import mixed, shingle_sets, small_batches
from plumbline.session import stored

#: Buckets of hashes whose counts order the tokens; the counts are broadcast (2 MB).
BUCKET_BITS = 18
#: Rarest shared tokens of a set that tell in which list a pair has met before.
FIRST_TOKENS = 8
#: Rows of a list beyond which its rows meet by bins of size.
CROWDED = 64
#: Words of 64 bits in the parity sketch of a set.
SKETCH = 8
_KEYS = [f"k{i}" for i in range(SKETCH)]


def shingle_links(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs(doc_id, text)``.

    Two documents link when their sets of ``k``-word shingles have a Jaccard similarity of
    at least ``percent`` / 100; a text of fewer words is one shingle.  ``component_id`` is
    the smallest doc_id reachable by links.  Null and wordless texts have no shingles and
    link with nothing.  A row without doc_id links with nothing and has no component.
    Repeated rows give repeated results.  Further columns are ignored.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must lie between 1 and 100")
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = _bucket_counts(docs, k)
    sets = stored(_prefixes(docs, k, percent, order), "prefixes")
    small = sets.drop("prefix")

    # Classes of equal sets, and groups of equal prefix and size.
    classes = stored(
        small.where("sig is not null and doc_id is not null")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ["grp", "n_shingles", *_KEYS]]),
        "classes",
    )
    groups = stored(
        classes.groupBy("grp").agg(F.min("rep").alias("head"), F.count("*").alias("size")), "groups"
    )

    # Prefix tokens that at least two groups share.
    rows = sets.where("doc_id is not null").select(F.posexplode("prefix").alias("pos", "token"), "grp", F.col("n_shingles").alias("n"))
    shared = (
        rows.groupBy("token")
        .agg(F.min("grp").alias("low"), F.max("grp").alias("high"))
        .where("low <> high")
        .select("token")
    )
    lists = stored(rows.join(shared, "token").distinct(), "lists")

    # Step 1: each group against the most central group of its lists (fewest tokens of its own).
    width = F.expr(f"n_shingles - cast(ceil({percent} * n_shingles / 100.0) as int) + 1")
    own = (
        lists.groupBy("grp")
        .agg(F.count("*").alias("common"), F.first("n").alias("n_shingles"))
        .select("grp", (width - F.col("common")).alias("own"))
    )
    bin_ = F.floor(F.log("n") / F.lit(math.log(100 / percent) if percent < 100 else 1e-9))
    entries = lists.join(own, "grp").withColumn("bin", bin_)
    best = entries.groupBy("token", "bin").agg(F.min(F.struct("own", "n", "grp")).alias("best"))
    stars = (
        entries.join(best.select("token", "bin", F.col("best.grp").alias("to")), ["token", "bin"])
        .where("grp <> to")
        .select("grp", "to")
        .distinct()
    )
    heads = groups.select("grp", "head")
    first = (
        stars.join(heads, "grp")
        .withColumnRenamed("head", "a")
        .join(heads.select(F.col("grp").alias("to"), F.col("head").alias("b")), "to")
        .select("a", "b")
        .union(
            classes.select("grp", F.col("rep").alias("a"))
            .join(heads.withColumnRenamed("head", "b"), "grp")
            .where("a <> b")
            .select("a", "b")
        )
    )
    shared_prefix = lists.groupBy("grp").agg(
        F.collect_list("token").alias("tokens"),
        F.slice(F.sort_array(F.collect_list(F.struct("pos", "token"))), 1, FIRST_TOKENS).alias("firsts"),
    )
    seen = stored(
        classes.select("rep", "grp", F.col("n_shingles").alias("n"), *_KEYS).join(shared_prefix, "grp", "left"), "seen"
    )
    links = _verified(docs, _plausible(first, seen, percent), k, percent)
    known = components(links)

    # Step 2: what lies outside a list's main component against the rest of the list.
    member = stored(
        seen.select("rep", "grp", "n", "firsts", *_KEYS)
        .join(known.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")),
        "members",
    )
    crowd = groups.where("size > 1").select("grp")
    # Two sets that share one of the other's first tokens before this list's meet in that list.
    earlier = F.expr("transform(filter(firsts, x -> x.pos < pos), x -> x.token)").alias("earlier")
    none = F.array().cast("array<long>").alias("earlier")
    # Lists of one component are left out while their rows are still narrow.
    parted = stored(_open_lists(lists, member, crowd), "parted")
    of = lambda kind, name: parted.where(F.col("list.of") == kind).select(F.col("list.id").alias(name), "main", "crowded")
    columns = ["rep", "component", "n", "main", "crowded", *_KEYS]
    at = stored(
        lists.select("token", "grp", "pos")
        .join(of(0, "token"), "token")
        .join(member, "grp")
        .select(F.struct(F.lit(0).alias("of"), F.col("token").alias("id")).alias("list"), earlier, "pos", *columns)
        .union(
            member.join(of(1, "grp"), "grp").select(
                F.struct(F.lit(1).alias("of"), F.col("grp").alias("id")).alias("list"), none, F.lit(0).alias("pos"), *columns
            )
        ),
        "open",
    )
    rest = _across(at, percent).distinct()
    more = _verified(docs, _plausible(rest, seen, percent), k, percent)
    found = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    return (
        small.select("doc_id", "sig", "n_shingles")
        .join(classes.select("sig", "rep"), "sig", "left")
        .join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select(
            "doc_id",
            F.col("n_shingles").cast("long").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"),
        )
    )


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _bucket_counts(docs: DataFrame, k: int):
    """How often each bucket of shingle hashes occurs over all documents, as a broadcast array."""

    def work(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for tokens in shingle_sets(batch.column(0), k):
                np.add.at(counts, _bucket(tokens), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return docs.sparkSession.sparkContext.broadcast(counts)


def _prefixes(docs: DataFrame, k: int, percent: int, order) -> DataFrame:
    """Per document: size, signature, group, parity sketch and the rarest tokens of its set."""

    def work(batches):
        counts = order.value
        for batch in batches:
            sizes, sigs, groups, sketches, firsts = [], [], [], [], []
            for tokens in shingle_sets(batch.column(1), k):
                n = len(tokens)
                sizes.append(n)
                if not n:
                    sigs.append(None)
                    groups.append(None)
                    firsts.append(None)
                    sketches.append(np.zeros(SKETCH, np.int64))
                    continue
                width = n - -(-percent * n // 100) + 1
                first = tokens[np.lexsort((tokens, counts[_bucket(tokens)]))[:width]]
                sigs.append(xxhash.xxh3_128_hexdigest(tokens.tobytes()))
                groups.append(xxhash.xxh3_64_intdigest(first.tobytes(), seed=n) - (1 << 63))
                firsts.append(first.view(np.int64))
                spot = (mixed(tokens + np.uint64(1)) >> np.uint64(55)).astype(np.int64)
                odd = np.bincount(spot, minlength=64 * SKETCH) & 1
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            columns = [
                batch.column(0),
                pa.array(sigs, pa.string()),
                pa.array(groups, pa.int64()),
                pa.array(sizes, pa.int32()),
                pa.array(firsts, pa.list_(pa.int64())),
            ]
            bits = np.array(sketches, np.int64).reshape(-1, SKETCH)
            columns += [pa.array(bits[:, i]) for i in range(SKETCH)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sig", "grp", "n_shingles", "prefix", *_KEYS])

    keys = ", ".join(f"{c} long" for c in _KEYS)
    return docs.mapInArrow(
        work, f"doc_id long, sig string, grp long, n_shingles int, prefix array<long>, {keys}"
    )


def _may_link(n: str, m: str, left: str, right: str, percent: int):
    """Sizes within the ratio, and sketches not too far apart, for the similarity to be reachable."""
    apart = " + ".join(f"bit_count({left}{c} ^ {right}{c})" for c in _KEYS)
    return F.expr(
        f"100L * least({n}, {m}) >= {percent}L * greatest({n}, {m})"
        f" and ({100 + percent}L) * ({apart}) <= {100 - percent}L * ({n} + {m})"
    )


def _plausible(pairs: DataFrame, seen: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs of class representatives that cheap exact bounds do not rule out.

    What two sets share lies in both prefixes or beyond the prefix of one of them, so it is
    at most the shared prefix tokens and the larger rest.
    """
    sides = [
        seen.select(F.col("rep").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ["grp", "n", "tokens", *_KEYS]])
        for x in "ab"
    ]
    rest = f"cast(ceil({percent} * greatest(a_n, b_n) / 100.0) as int) - 1"
    common = "if(a_grp = b_grp, a_n, coalesce(size(array_intersect(a_tokens, b_tokens)), 0))"
    enough = F.expr(f"{100 + percent}L * ({common} + {rest}) >= {percent}L * (a_n + b_n)")
    return (
        pairs.distinct()
        .join(sides[0], "a")
        .join(sides[1], "b")
        .where(_may_link("a_n", "b_n", "a_", "b_", percent))
        .where(enough)
        .select("a", "b")
    )


def _open_lists(lists: DataFrame, member: DataFrame, crowd: DataFrame) -> DataFrame:
    """Lists that hold several components, with the component of most of their members' smallest ids."""
    at = lists.select("token", "grp").join(member.select("grp", "component"), "grp")
    keyed = at.select(F.struct(F.lit(0).alias("of"), F.col("token").alias("id")).alias("list"), "component").union(
        member.join(crowd, "grp").select(F.struct(F.lit(1).alias("of"), F.col("grp").alias("id")).alias("list"), "component")
    )
    counted = keyed.groupBy("list", "component").agg(F.count("*").alias("n"))
    return (
        counted.groupBy("list")
        .agg(
            F.max_by("component", F.struct("n", "component")).alias("main"),
            F.count("*").alias("parts"),
            (F.sum("n") > CROWDED).alias("crowded"),
        )
        .where("parts > 1")
        .select("list", "main", "crowded")
    )


def _across(at: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components in a list, of which one at most is of the list's main one.

    ``pos`` is the place of the list's token in the row's ordered set.  In the list of the first token that
    two sets share, all they share lies from there on, which bounds their sizes and the similarity; a pair
    that this rules out there is not similar, whatever other lists it is in.
    """
    bin_ = lambda n: F.floor(F.log(n) * (4 / math.log(100 / percent) if percent < 100 else 1e9))
    least = F.expr(f"cast(ceil({percent} * n / 100.0) as long)")
    most = F.expr(f"(100L * n - {100 + percent}L * pos) div {percent}")
    minor = at.where("component <> main").select(
        "list",
        F.explode(
            F.when(F.col("crowded"), F.sequence(bin_(least), bin_(F.greatest(least, most)))).otherwise(F.array(F.lit(0).cast("long")))
        ).alias("bin"),
        *[F.col(c).alias(f"a_{c}") for c in ["rep", "component", "n", "pos", "earlier", *_KEYS]],
    )
    other = at.withColumn("bin", F.when(F.col("crowded"), bin_(F.col("n"))).otherwise(0))
    return minor.join(
        other,
        (minor["list"] == other["list"])
        & (minor["bin"] == other["bin"])
        & F.expr("a_component <> component and (component = main or a_rep < rep)")
        & F.expr(f"{100 + percent}L * least(a_n - a_pos, n - pos) >= {percent}L * (a_n + n)")
        & _may_link("a_n", "n", "a_", "", percent)
        & ~F.arrays_overlap("a_earlier", "earlier"),
    ).select(F.least("a_rep", "rep").alias("a"), F.greatest("a_rep", "rep").alias("b"))


def _verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    pairs = stored(pairs, "pairs")
    needed = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "needed")
    sets = stored(_sets_of(docs, needed, k).join(needed, "doc_id", "left_semi"), "sets")
    one = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("a_set"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("b_set"))
    both = pairs.join(one, "a").join(two, "b")
    same = F.size(F.array_intersect("a_set", "b_set"))
    total = F.size("a_set") + F.size("b_set") - same
    return both.where(100 * same >= percent * total).select("a", "b").distinct()


def _sets_of(docs: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """Shingle sets of the needed documents and, where the filter cannot tell, of a few more."""
    marks = key_filter(needed, F.xxhash64("doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def work(batches):
        marked = shared.value
        for batch in batches:
            keep = np.flatnonzero(marked[batch.column(2).to_numpy()])
            if not len(keep):
                continue
            some = batch.take(pa.array(keep))
            sets = [x.view(np.int64) for x in shingle_sets(some.column(1), k)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "tokens"])

    rows = docs.where("doc_id is not null").select("doc_id", "text", spot(F.xxhash64("doc_id")))
    return rows.mapInArrow(work, "doc_id long, tokens array<long>")
