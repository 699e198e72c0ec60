"""File manifests: digests, verification against pins, snapshots, gated landing."""

from __future__ import annotations

import logging
import re
import sys
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.errors import DataError
from plumbline.functions.scalars import digest_equal
from plumbline.session import stored

# Executors need not have this package installed: its task code travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

log = logging.getLogger(__name__)

# Fixed value: bytes hashed at a time.
HASH_CHUNK_BYTES = 1024 * 1024
# End of fixed value.


def content_manifest(df: DataFrame, path: str, content: str) -> DataFrame:
    """``(path, length, md5, sha256)`` of a table of (path, content)."""
    data = F.col(content).cast("binary")
    return df.select(
        F.col(path).alias("path"),
        F.length(data).cast("bigint").alias("length"),
        F.md5(data).alias("md5"),
        F.sha2(data, 256).alias("sha256"),
    )


def file_manifest(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Manifest of every file under a path; ``pattern`` is a file-name glob.

    Spark's reader lists the files.  Those on local disks are hashed in blocks by the tasks that
    they fall to, whatever their size.  Of other stores each file is read as one row, so it must stay
    below 2 GB and fit in a task's memory; see ``large_file_manifest`` for larger ones.  Spark does
    not plan a read of an empty file; those that its listing names and the read does not are added
    with the digests of nothing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(path)
    # The listing is on the driver in any case; it holds empty files too.
    names = [(re.sub("^file:/+", "file:/", p),) for p in found.inputFiles()]
    if all(p.startswith("file:") for p, in names):
        files = found.select(F.col("_metadata.file_path").alias("path")).mapInArrow(_digests, _MANIFEST)
    else:
        files = content_manifest(found.select(F.col("_metadata.file_path").alias("path"), "content"), "path", "content")
    listed = spark.createDataFrame(names, "path string")
    read = found.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("path"))
    empty = listed.join(read, "path", "left_anti")
    return files.union(content_manifest(empty.withColumn("content", F.lit(b"")), "path", "content"))


def _store_of(uri: str):
    """The file system of a path or URI, and the path in it (local disks, HDFS, S3, GCS)."""
    from pyarrow import fs

    scheme = urlparse(uri).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(urlparse(uri).path) if scheme else uri
    return fs.FileSystem.from_uri(uri)


_MANIFEST = "path string, length bigint, md5 string, sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The manifest of files named in the first column, each read in blocks."""
    import hashlib

    for batch in batches:
        for name in batch.column(0).to_pylist():
            store, at = _store_of(name)
            md5, sha, length = hashlib.md5(usedforsecurity=False), hashlib.sha256(), 0
            # The bytes as they lie there: by default Arrow unpacks what a name says is packed.
            with store.open_input_stream(at, compression=None) as f:
                while block := f.read(HASH_CHUNK_BYTES):
                    md5.update(block)
                    sha.update(block)
                    length += len(block)
            columns = [[name], [length], [md5.hexdigest()], [sha.hexdigest()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["path", "length", "md5", "sha256"])


def _uri_of(uri: str, path: str) -> str:
    """The URI of a path in the same store as ``uri``; of a local one as Spark's readers write it."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return "file:" + re.sub(r"[\x00-\x9f\s]+", lambda m: quote(m[0], safe="/!*'(),;:$&+=@"), path)
    # The stores give paths with the bucket first, but for HDFS, whose host is no part of them.
    return f"{parts.scheme}://{parts.netloc}{path}" if path.startswith("/") else f"{parts.scheme}://{path}"


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(path, length)`` of every file under a path, listed by tasks, a level of folders at a time.

    Names that begin with ``_`` or a dot are passed over, as Spark's readers do; ``pattern`` is
    a glob for file names.  The driver sees no listing.
    """

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fnmatch import fnmatchcase

        from pyarrow import fs

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                store, at = _store_of(folder)
                one = store.get_file_info(at)
                if one.type == fs.FileType.NotFound:
                    raise FileNotFoundError(folder)
                found = [one] if one.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at))
                rows = [
                    (_uri_of(folder, f.path), f.size, f.type == fs.FileType.Directory)
                    for f in found
                    if not f.base_name.startswith(("_", "."))
                    and (pattern is None or f.type == fs.FileType.Directory or fnmatchcase(f.base_name, pattern))
                ]
                names = ["path", "length", "folder"]
                kinds = [pa.string(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    frontier, files = spark.createDataFrame([(path,)], "path string"), []
    while not files or not frontier.isEmpty():
        listed = stored(frontier.repartition("path").mapInArrow(children, "path string, length long, folder boolean"), "listing")
        files.append(listed.where("not folder").select("path", "length"))
        frontier = listed.where("folder").select("path")
    return reduce(DataFrame.union, files)


def large_file_manifest(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """The same manifest for files of any size and number, on local disks or object stores.

    Files are listed and hashed by tasks; each is read in blocks by one task, so its size
    never has to fit in memory.  Empty files have the digests of nothing.
    """

    spread = list_files(spark, path, pattern).select("path").repartition("path")
    return spread.mapInArrow(_digests, _MANIFEST)


def write_files(df: DataFrame, root: str, name: str, content: str) -> DataFrame:
    """Write each row's content to a file of its own under ``root``; ``(path, length)`` of all.

    A task that runs twice writes the same file again.  A null content is an empty file.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                uri = f"{root.rstrip('/')}/{file}"
                store, at = _store_of(uri)
                store.create_dir(at.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(at) as f:
                    f.write(data or b"")
                out.append((_uri_of(uri, at), len(data or b"")))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64())], ["path", "length"])

    rows = df.select(F.col(name).cast("string"), F.col(content).cast("binary"))
    return stored(rows.mapInArrow(put, "path string, length long"), "written")


def verify_manifest(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``(path, status, actual_sha256, expected_sha256)``.

    ``expected`` is ``(path, sha256)``; blanks and upper case in it do not matter.  A file
    with no pin is ``unpinned``, a pin with no file ``missing``, else ``ok`` or ``mismatch``.
    """
    pins = expected.select(
        "path", F.nullif(F.lower(F.trim("sha256")), F.lit("")).alias("expected_sha256")
    )
    found = actual.select("path", F.col("sha256").alias("actual_sha256"))
    status = (
        F.when(F.col("actual_sha256").isNull(), "missing")
        .when(F.col("expected_sha256").isNull(), "unpinned")
        .when(digest_equal("actual_sha256", "expected_sha256"), "ok")
        .otherwise("mismatch")
    )
    return found.join(pins, "path", "full_outer").select(
        "path", status.alias("status"), "actual_sha256", "expected_sha256"
    )


def require_verified(verified: DataFrame, *, allow_missing: bool = False) -> None:
    """Raise if a file does not match its pin: how many do not, and both digests of the first ones.

    ``verified`` itself names all of them.
    """
    wrong = ["mismatch"] if allow_missing else ["mismatch", "missing"]
    bad = verified.where(F.col("status").isin(*wrong))
    n = bad.count()
    if n:
        shown = "; ".join(
            f"{r['path']}: {r['status']}, expected {r['expected_sha256']}, got {r['actual_sha256']}"
            for r in bad.orderBy("path").limit(20).collect()
        )
        raise DataError(f"{n} file(s) do not match: {shown}" + ("; and more, see the verification table" if n > 20 else ""))


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(path, change)`` between two manifests: added, removed, changed or same."""
    before = old.select("path", F.col("sha256").alias("_old"))
    after = new.select("path", F.col("sha256").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") == F.col("_new"), "same")
        .otherwise("changed")
    )
    return before.join(after, "path", "full_outer").select("path", change.alias("change"))


def is_unchanged(old: DataFrame, new: DataFrame) -> bool:
    """True when nothing was added, removed or changed, so a stage may be skipped."""
    return snapshot_diff(old, new).where("change <> 'same'").isEmpty()


def land_dataset(
    spark: SparkSession,
    source: str,
    dest: str,
    expected: DataFrame | None = None,
    *,
    schema: str,
    fmt: str = "csv",
    strict: bool = False,
) -> DataFrame:
    """Read files, check each against its pin, and write the rows of the good ones.

    Rows of files that are ``ok`` or ``unpinned`` go to ``dest``; unpinned ones are warned
    about.  The verification table is stored in ``<dest>_verified``, also for the files that
    were refused, and returned.  ``strict`` raises on a wrong digest instead, after that
    table is stored and before any row is.  Refused files are never parsed.
    """
    manifest = file_manifest(spark, source)
    pins = expected if expected is not None else spark.createDataFrame([], "path string, sha256 string")
    checked = f"{dest.rstrip('/')}_verified"
    verify_manifest(manifest, pins).write.mode("overwrite").parquet(checked)
    verified = spark.read.parquet(checked)
    totals = verified.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()
    log.info("files under %s: %s", source, {r["status"]: r["n"] for r in totals})
    if any(r["status"] == "unpinned" for r in totals):
        log.warning("files without a pinned digest under %s", source)
    if strict:
        require_verified(verified)
    # Names of files only; a reader takes its list of files from the driver.
    good = [unquote(r["path"]) for r in verified.where("status in ('ok', 'unpinned')").select("path").toLocalIterator()]
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    rows = reader.format(fmt).load(good) if good else spark.createDataFrame([], schema)
    rows.write.mode("overwrite").parquet(dest)
    return verified
