"""Reading and writing datasets, metric files and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.errors import ConfigError, DataError, ModelError
from plumbline.operators.columns import require_columns
from plumbline.operators.trees import GrownForest

CORRUPT = "_corrupt_record"


def _header(spark: SparkSession, path: str) -> list[str]:
    """The first line of the dataset, split into names.  Reads one line only."""
    try:
        first = _reader(spark, False).option("header", False).csv(path).limit(1).collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise DataError(f"dataset not found: {path}") from None
        raise DataError(f"dataset cannot be read: {path}: {e.getCondition()}") from None
    names = [c for c in first[0]] if first else []
    if not names or all(c is None for c in names):
        raise DataError(f"dataset is empty: {path}")
    if len(set(names)) != len(names):
        raise DataError(f"duplicate column names in {path}: {names}")
    return names


def _reader(spark: SparkSession, multi_line: bool):
    return spark.read.option("escape", '"').option("multiLine", multi_line)


def read_dataset(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    malformed: str = "error",
    required: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """A CSV dataset with a header.  Quotes inside a field are doubled.

    ``multi_line`` allows line breaks inside quoted fields; a file is then read by one task.

    A missing path, an empty file, a duplicate header and a header that differs from the
    schema raise ``DataError`` at once.  A file whose own header differs from the first
    file's fails the read of that file (``error`` finds it and raises ``DataError``).  Rows with too many or too few fields, or with
    values that do not parse, are handled by ``malformed``:

    ``error``   one pass looks for such a row and raises ``DataError``;
    ``fail``    no extra pass, the job that reads such a row fails;
    ``keep``    they stay, with their text in ``_corrupt_record``, for ``split_malformed``.
    """
    if malformed not in ("error", "fail", "keep"):
        raise ConfigError(f"malformed must be 'error', 'fail' or 'keep', got {malformed!r}")
    names = _header(spark, path)
    missing = [c for c in required if c not in names]
    if missing:
        raise DataError(f"{path}: missing column(s) {missing}; found {names}")
    if schema is None:
        wanted = _reader(spark, multi_line).csv(path, header=True, inferSchema=True).schema
    else:
        wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        if [f.name for f in wanted] != names:
            raise DataError(f"{path}: header {names} does not match columns {wanted.fieldNames()}")
    marked = T.StructType([*wanted.fields, T.StructField(CORRUPT, T.StringType())])
    df = (
        _reader(spark, multi_line)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # Every file's own header must name the columns in this order; the first file's is not enough.
        .option("enforceSchema", False)
        # A pruned read parses only the wanted fields and misses surplus ones.
        .option("columnPruning", False)
        .schema(marked)
        .csv(path)
    )
    if malformed == "keep":
        return df
    broken = F.col(CORRUPT).isNotNull()
    if malformed == "error":
        try:
            bad = df.where(broken).limit(1).collect()
        except Exception as e:
            if "CSV header does not conform to the schema" in str(e):
                raise DataError(f"{path}: the files do not have the same header {names}") from e
            raise
        if bad:
            raise DataError(f"malformed row in {path}: {bad[0][CORRUPT]!r}")
        return df.drop(CORRUPT)
    message = F.concat(F.lit(f"malformed row in {path}: "), F.col(CORRUPT))
    first = wanted.fields[0]
    guard = F.when(broken, F.raise_error(message).cast(first.dataType)).otherwise(F.col(first.name))
    return df.withColumn(first.name, guard).drop(CORRUPT)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows, malformed lines)`` of a frame read with ``malformed="keep"``."""
    require_columns(df, [CORRUPT], "split_malformed")
    # Spark refuses a query that reads nothing but the malformed text, so the filter also
    # looks at a parsed field; the comparison is always true.
    read = F.coalesce(F.col(df.columns[0]).cast("string"), F.lit("")) >= ""
    return (
        df.where(F.col(CORRUPT).isNull() & read).drop(CORRUPT),
        df.where(F.col(CORRUPT).isNotNull() & read),
    )


def write_dataset(
    df: DataFrame, path: str, fmt: str = "parquet", *, partition_by: Sequence[str] = ()
) -> None:
    """Write a dataset as part files; Parquet, or CSV with a header.  No index column.

    CSV does not tell an empty text from a null; both read back as null.
    """
    if fmt not in ("parquet", "csv"):
        raise ConfigError(f"format must be 'parquet' or 'csv', got {fmt!r}")
    out = df.write.mode("overwrite")
    if partition_by:
        out = out.partitionBy(*partition_by)
    if fmt == "csv":
        out = out.option("header", True).option("escape", '"')
    out.format(fmt).save(path)


def metrics_row(metrics: DataFrame) -> DataFrame:
    """A metrics table with its columns in name order."""
    for f in metrics.schema:
        if isinstance(f.dataType, (T.BinaryType, T.MapType, T.ArrayType, T.VariantType)):
            raise DataError(f"metric {f.name!r} of type {f.dataType.simpleString()} is not a value")
    return metrics.select(*[f"`{c}`" for c in sorted(metrics.columns)])


def write_metrics_json(metrics: DataFrame, path: str) -> dict:
    """One JSON object with sorted keys, in one file; also returned.

    A metrics table is one row: more rows, or none, are refused.
    """
    row = metrics_row(metrics)
    found = row.limit(2).collect()
    if len(found) != 1:
        raise DataError(f"a metrics table has one row, not {'more' if found else 'none'}: {row.columns}")
    one = metrics.sparkSession.createDataFrame(found, row.schema).coalesce(1)
    one.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return found[0].asDict()


def run_metric_rows(metrics: DataFrame, run_id: Column, stage: str) -> DataFrame:
    """``(run_id, stage, name, value)`` from a one-row metrics table."""
    names = sorted(metrics.columns)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names]
    )
    return metrics.select(run_id.alias("run_id"), F.lit(stage).alias("stage"), F.inline(pairs))


def save_model(model: GrownForest | PipelineModel, path: str, spark: SparkSession | None = None) -> None:
    """Write a fitted model as a directory, replacing what is there."""
    try:
        if isinstance(model, GrownForest):
            model.save(spark or SparkSession.active(), path)
        else:
            model.write().overwrite().save(path)
    except Exception as e:
        raise ModelError(f"model cannot be written to {path}: {type(e).__name__}") from e


def load_model(spark: SparkSession, path: str) -> GrownForest | PipelineModel:
    """Read a model; one that is missing and one that is broken give different messages."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        raise ModelError(f"model not found: {path}")
    grown = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "forest"))
    try:
        return GrownForest.load(spark, path) if grown else PipelineModel.load(path)
    except Exception as e:
        raise ModelError(f"model is corrupt: {path}: {type(e).__name__}") from e
