"""Append-only tables with numbered commits, so that several writers lose and repeat nothing.

Rows are written to a folder of their own first.  They count once a commit names that
folder; a commit is created complete and only if its number is not taken, so of two writers
one wins and the other looks at what was added and tries again.  Readers see whole commits.
"""

from __future__ import annotations

import json
import os
import random
import time
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.errors import ConfigError, DataError

_COMMIT = "_commit"


class CommitLog:
    """A table under one folder: ``rows/_commit=<id>/...`` and ``commits/<number>.json``."""

    def __init__(self, spark: SparkSession, root: str, schema: str, partition_by: Sequence[str] = (), attempts: int = 200):
        self.spark, self.root, self.attempts = spark, root.rstrip("/"), attempts
        self.schema = T.StructType.fromDDL(schema)
        self.partition_by = list(partition_by)
        jvm = spark._jvm
        self._at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        self._fs = self._at("commits").getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """Number of the newest commit; 0 before the first."""
        if not self._fs.exists(self._at("commits")):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(self._at("commits"))]
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json") and n.split(".")[0].isdigit()), default=0)

    def folders(self, version: int | None = None) -> list[str]:
        """The folders that a version consists of."""
        version = self.version() if version is None else version
        if not version:
            return []
        text = self.spark.read.text(f"{self.root}/commits/{version:020d}.json", wholetext=True).first()[0]
        return json.loads(text)["folders"]

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest or of a given version."""
        return self._rows(self.folders(version))

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        names = self.schema.fieldNames()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        whole = T.StructType([*self.schema.fields, T.StructField(_COMMIT, T.StringType())])
        found = self.spark.read.schema(whole).option("basePath", f"{self.root}/rows")
        return found.parquet(*[f"{self.root}/rows/{_COMMIT}={f}" for f in folders]).select(*names)

    def _write(self, rows: DataFrame) -> str | None:
        """Rows in a folder of their own; its name, or none for no rows."""
        name = uuid.uuid4().hex
        path = f"{self.root}/rows/{_COMMIT}={name}"
        rows.select(*self.schema.fieldNames()).write.partitionBy(*self.partition_by).parquet(path)
        written = self.spark.read.schema(self.schema).parquet(path)
        return None if written.isEmpty() else name

    def append(self, make: Callable[[DataFrame], DataFrame]) -> int:
        """Add the rows that ``make`` gives, seen the table as it is; the version that holds them.

        If another writer commits first, ``make`` is asked again with the newer table.
        """
        for attempt in range(self.attempts):
            version = self.version()
            folders = self.folders(version)
            name = self._write(make(self._rows(folders)))
            if name is None:
                return version
            if self._create(version + 1, {"folders": [*folders, name]}):
                return version + 1
            time.sleep(random.uniform(0, 0.05 * min(attempt + 1, 10)))
        raise DataError(f"{self.root}: no commit in {self.attempts} attempts")

    def append_new(self, rows: DataFrame, key: Sequence[str]) -> int:
        """Add the rows whose key the table does not hold yet."""
        return self.append(lambda known: rows.join(known.select(*key).distinct(), list(key), "left_anti"))

    def compact(self) -> int:
        """Put all rows into one folder, as a commit like any other; older versions stay readable."""
        for _ in range(self.attempts):
            version = self.version()
            name = self._write(self.read(version))
            if name is None or self._create(version + 1, {"folders": [name]}):
                return version + (name is not None)
        raise DataError(f"{self.root}: no commit in {self.attempts} attempts")

    def _create(self, number: int, about: dict) -> bool:
        """Create a commit whole, unless its number is taken.

        The text is written aside first.  A hard link on a local disk, and a rename without
        overwriting elsewhere, are atomic and fail where the target is there.
        """
        name, aside = f"commits/{number:020d}.json", f"aside/{uuid.uuid4().hex}"
        data = bytearray(json.dumps(about).encode())
        self._fs.mkdirs(self._at("commits"))
        stream = self._fs.create(self._at(aside), False)
        try:
            stream.write(data)
        finally:
            stream.close()
        try:
            if self._fs.getScheme() == "file":
                path = lambda n: unquote(urlparse(self._at(n).toUri().toString()).path)
                os.link(path(aside), path(name))
                return True
            context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
            none = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = self.spark._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            context.rename(self._at(aside), self._at(name), options)
            return True
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        finally:
            self._fs.delete(self._at(aside), False)


def checked_key(schema: str, key: Sequence[str]) -> list[str]:
    """``key``, if the schema has it."""
    names = T.StructType.fromDDL(schema).fieldNames()
    if missing := [k for k in key if k not in names]:
        raise ConfigError(f"no such columns: {missing}")
    return list(key)
