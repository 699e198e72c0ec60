"""Metric samples as a batch table or a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.errors import ConfigError
from plumbline.functions.labels import promote_labels, series_key
from plumbline.operators.chunks import CHUNK, MICROS, ChunkedSamples, chunk_width, with_chunks

SAMPLE_SCHEMA = "metric string, labels map<string,string>, ts timestamp, value double"


def read_samples(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored samples table; a filter on ``metric`` prunes its folders."""
    if fmt not in ("parquet", "json", "orc"):
        raise ConfigError(f"unsupported sample format {fmt!r}")
    schema = SAMPLE_SCHEMA if fmt == "json" else None
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.format(fmt).load(path)


def stream_samples(
    spark: SparkSession, path: str, fmt: str = "parquet", *, schema: str = SAMPLE_SCHEMA, **options
) -> DataFrame:
    """The same table as a file stream; options such as ``maxFilesPerTrigger`` pass through."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def stream_kafka_samples(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Samples sent as JSON to a Kafka topic (needs Spark's Kafka package)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), SAMPLE_SCHEMA).alias("s")).select("s.*")


def write_samples(
    samples: DataFrame, path: str, promoted: Sequence[str] = (), *, spread_over: int = 64
) -> None:
    """Store samples partitioned by metric and day, with hot labels as plain columns.

    Rows are spread over (metric, day, hash of labels and hour), so that one large metric,
    or one large series, is written by up to ``spread_over`` tasks and files a day.
    """
    place = F.xxhash64(F.to_json("labels"), F.hour("ts"))
    spread = F.pmod(place, F.lit(spread_over))
    (
        promote_labels(samples, promoted)
        .withColumn("day", F.to_date("ts"))
        .repartition("metric", "day", spread)
        .write.mode("append")
        .partitionBy("metric", "day")
        .parquet(path)
    )


_STORED_KEYS = ("metric", "series")
_REACH, _WIDTH = "samples.reach_us", "samples.width_us"


def store_chunked(
    samples: DataFrame, name: str, path: str, *, reach_s: int, chunk_s: int | None = None, buckets: int | None = None
) -> ChunkedSamples:
    """Store samples as the table ``name``, so that ranges up to ``reach_s`` need no exchange.

    Rows are cut into (series, chunk), with the ghosts that a neighbouring chunk must see (at
    most a quarter more rows), and bucketed by metric, series and chunk: a series that holds
    a third of all samples lies in as many buckets as any.  Each bucket is sorted by series and time.
    ``buckets`` defaults to the session's shuffle partitions.
    """
    spark = samples.sparkSession
    reach = reach_s * MICROS
    width = chunk_width(reach, chunk_s and chunk_s * MICROS)
    slim = samples.where("ts is not null").select("metric", series_key().alias("series"), F.unix_micros("ts").alias("_us"), "value")
    order = [*_STORED_KEYS, CHUNK]
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        with_chunks(slim, "_us", width, ahead_us=reach, back_us=reach)
        .repartition(count, *order)
        .write.mode("errorifexists")
        .bucketBy(count, *order)
        .sortBy(*order, "_us")
        .option("path", path)
        .saveAsTable(name)
    )
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_REACH}' = '{reach}', '{_WIDTH}' = '{width}')")
    return open_chunked(spark, name)


def open_chunked(spark: SparkSession, name: str) -> ChunkedSamples:
    """A table written by ``store_chunked``, for the range operators."""
    about = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if _REACH not in about:
        raise ConfigError(f"{name} is not a table of chunked samples")
    return ChunkedSamples(spark.table(name), _STORED_KEYS, int(about[_REACH]), int(about[_WIDTH]))
