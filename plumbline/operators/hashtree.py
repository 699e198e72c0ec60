"""Hash trees of tables: two versions are compared from the top, and only what differs is read.

Rows lie in buckets by the hash of their key.  Each bucket has a digest that does not depend
on the order of its rows; four levels of buckets, each 16 times finer, make the tree.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.errors import ConfigError, DataError
from plumbline.operators.columns import require_columns

#: Bits of the bucket at each level, the root first; rows are stored in folders by ``FOLDER_BITS``.
LEVELS = (0, 4, 8, 12, 16)
FOLDER_BITS = 8
_BUCKET, _FOLDER, _HASH = "_bucket", "_folder", "_hash"
_DIGESTS = "bucket int, n long, hash_sum decimal(38,0), hash_xor long, bits int"


def _row_hash(columns: Sequence[str]) -> Column:
    """A 64-bit hash of fields and of whether they are null."""
    fields = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*[x for c in fields for x in (c.isNull(), c)])


def _digest() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(_HASH).cast("decimal(28,0)")).alias("hash_sum"),
        F.bit_xor(_HASH).alias("hash_xor"),
    ]


@dataclass(frozen=True)
class HashTree:
    """A stored table with the digests of its buckets."""

    spark: SparkSession
    path: str
    key: tuple[str, ...]
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def level(self, bits: int) -> DataFrame:
        """``(bucket, n, hash_sum, hash_xor)`` of one level."""
        kept = self.spark.read.schema(_DIGESTS).parquet(f"{self.path}/digests").where(F.col("bits") == bits)
        return kept.select("bucket", "n", "hash_sum", "hash_xor")

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The stored rows, or those of some of the finest buckets: other folders are not read."""
        own = [(_HASH, T.LongType()), (_BUCKET, T.IntegerType()), (_FOLDER, T.IntegerType())]
        whole = T.StructType([*self.schema.fields, *[T.StructField(n, k) for n, k in own]])
        found = self.spark.read.schema(whole).parquet(f"{self.path}/rows")
        if buckets is not None:
            folders = sorted({b >> (LEVELS[-1] - FOLDER_BITS) for b in buckets})
            found = found.where(F.col(_FOLDER).isin(folders) & F.col(_BUCKET).isin(list(buckets)))
        return found


def store_tree(df: DataFrame, key: str | Sequence[str], path: str) -> HashTree:
    """Store a table by key hash with its tree.

    Rows are sorted by bucket inside their folder, so a reader of some buckets also skips
    row groups.  Digests are combined on the map side; the finest level has 65,536 at most.
    """
    names = (key,) if isinstance(key, str) else tuple(key)
    require_columns(df, names, "hash tree")
    if clash := {_BUCKET, _FOLDER, _HASH} & set(df.columns):
        raise ConfigError(f"column names are taken: {sorted(clash)}")
    bucket = F.shiftrightunsigned(_row_hash(names), 64 - LEVELS[-1]).cast("int")
    tagged = df.withColumn(_HASH, _row_hash(df.columns)).withColumn(_BUCKET, bucket)
    (
        tagged.withColumn(_FOLDER, F.shiftright(_BUCKET, LEVELS[-1] - FOLDER_BITS))
        .repartition(_FOLDER)
        .sortWithinPartitions(_FOLDER, _BUCKET)
        .write.mode("errorifexists")
        .partitionBy(_FOLDER)
        .parquet(f"{path}/rows")
    )
    spark = df.sparkSession
    about = json.dumps({"key": names, "schema": df.schema.json()})
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/about")
    tree = HashTree(spark, path, names, df.schema)
    finest = tree.rows().groupBy(F.col(_BUCKET).alias("bucket")).agg(*_digest()).withColumn("bits", F.lit(LEVELS[-1]))
    finest.write.mode("append").parquet(f"{path}/digests")
    leaves = spark.read.schema(_DIGESTS).parquet(f"{path}/digests")
    sums = [F.sum("n").alias("n"), F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor")]
    for bits in reversed(LEVELS[:-1]):
        parents = leaves.where(F.col("bits") == LEVELS[-1]).groupBy(F.shiftright("bucket", LEVELS[-1] - bits).alias("bucket")).agg(*sums)
        parents.withColumn("bits", F.lit(bits)).coalesce(1).write.mode("append").parquet(f"{path}/digests")
    return tree


def open_tree(spark: SparkSession, path: str) -> HashTree:
    about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
    return HashTree(spark, path, tuple(about["key"]), T.StructType.fromJson(json.loads(about["schema"])))


def differing_buckets(old: HashTree, new: HashTree) -> list[int]:
    """The finest buckets whose digests differ, found from the root down.

    A level is read only below what differs above it; the list has 65,536 entries at most.
    """
    if old.key != new.key or old.columns != new.columns or [f.dataType for f in old.schema] != [f.dataType for f in new.schema]:
        raise DataError(f"the tables have other columns or another key: {old.columns} / {new.columns}")
    differing = [0]
    for above, bits in zip((0, *LEVELS[:-1]), LEVELS, strict=True):
        # As ranges of neighbours, so that the filter stays short and is pushed.
        inside = F.shiftright("bucket", bits - above).isin(differing)
        one, other = old.level(bits).where(inside), new.level(bits).where(inside)
        sides = one.select("bucket", F.struct("n", "hash_sum", "hash_xor").alias("_a")).join(
            other.select("bucket", F.struct("n", "hash_sum", "hash_xor").alias("_b")), "bucket", "full_outer"
        )
        differing = sorted(r["bucket"] for r in sides.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("bucket").collect())
        if not differing:
            return []
    return differing


def tree_diff(old: HashTree, new: HashTree) -> DataFrame:
    """``(key..., change)``: ``added``, ``removed`` or ``changed``, for exactly the keys whose rows differ.

    Of a key with several rows, the bags of its rows are compared.
    """
    buckets = differing_buckets(old, new)
    side = lambda t, name: t.rows(buckets).groupBy(*t.key).agg(F.struct(*_digest()).alias(name))
    one, other = side(old, "_a"), side(new, "_b")
    same_key = [one[k].eqNullSafe(other[k]) for k in old.key]
    both = one.join(other, same_key, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed")
    return both.select(*[F.coalesce(one[k], other[k]).alias(k) for k in old.key], change.alias("change"))
