"""A stored table that upserts replace, version by version.

A version is one small entry in a log: for each bucket of keys, the folder that holds its rows. An upsert writes the
buckets its keys fall in beside the old ones and then moves the entry into the log, which is what switches readers
over: a rename that fails if another writer has added the version first. Whoever still reads an older version keeps its
files; an upsert that dies before its entry leaves files that nobody reads. The file system must rename atomically.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerwave.functions.joins import join_hot

ENTRY = "version long, batch string, schema string, buckets map<string,string>"


class Conflict(RuntimeError):
    """Another writer has added the version first; nothing of this one can be seen."""


@dataclass(frozen=True)
class Version:
    number: int
    batch: str
    schema: StructType
    buckets: dict[int, str]


class StoredTable:
    """Rows under ``folder``, replaced by ``keys``; ``buckets`` is fixed when the table is first written."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], buckets: int = 16) -> None:
        self.spark, self.folder, self.keys, self.buckets = spark, folder.rstrip("/"), list(keys), buckets

    def log(self) -> list[Version]:
        """The versions in order."""
        try:
            entries = self.spark.read.schema(ENTRY).json(f"{self.folder}/log/*").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

        def buckets(entry: Row) -> dict[int, str]:
            return {int(b): path for b, path in entry["buckets"].items()}

        known = [
            Version(e["version"], e["batch"], StructType.fromJson(json.loads(e["schema"])), buckets(e))
            for e in entries
        ]
        return sorted(known, key=lambda v: v.number)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default, with the version that wrote each as ``version``."""
        versions = {v.number: v for v in self.log()}
        if not versions:
            raise LookupError(f"nothing is stored under {self.folder}")
        return self._rows(versions[max(versions) if number is None else number])

    def upsert(self, incoming: DataFrame, batch: str) -> int:
        """Put ``incoming`` in place of the rows with its keys and return the number of the version that has it.

        ``batch`` names the change: one that is in the log already is not made again. Rows without a key replace
        nothing and are never replaced. Buckets without an incoming key are not read or written.
        """
        versions = self.log()
        for v in versions:
            if v.batch == batch:
                return v.number
        last = versions[-1] if versions else None
        number = last.number + 1 if last else 1
        rows = incoming.withColumns({"version": F.lit(number).cast("long"), "_bucket": self._bucket()})
        touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # no more than there are buckets
        known = {b: last.buckets[b] for b in touched if b in last.buckets} if last else {}
        if known:
            old = self._rows(Version(last.number, last.batch, last.schema, known))
            kept = join_hot(old, incoming.select(*self.keys).distinct(), self.keys, "left_anti")
            rows = rows.unionByName(kept.withColumn("_bucket", self._bucket()))
        data = f"{self.folder}/data/{uuid.uuid4().hex}"
        # Few files for each bucket, and a busy bucket is still split over tasks.
        rows.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(data)
        schema = rows.drop("_bucket").schema
        buckets = {**(last.buckets if last else {}), **{b: f"{data}/_bucket={b}" for b in touched}}
        self._switch(number, batch, schema, buckets)
        return number

    def unused(self) -> list[str]:
        """Folders under ``data`` whose rows no version has: what broken-off upserts have left."""
        referenced = {path.rsplit("/", 1)[0] for v in self.log() for path in v.buckets.values()}
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.folder}/data")
        folders = files.select(F.regexp_extract("path", "(.*/data/[0-9a-f]+)/", 1).alias("folder")).distinct().collect()
        names = {path.rsplit("/", 1)[1] for path in referenced}
        return sorted(r["folder"] for r in folders if r["folder"].rsplit("/", 1)[1] not in names)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, version: Version) -> DataFrame:
        if not version.buckets:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*sorted(version.buckets.values()))

    def _switch(self, number: int, batch: str, schema: StructType, buckets: dict[int, str]) -> None:
        paths = {str(b): path for b, path in buckets.items()}
        entry = self.spark.createDataFrame([(number, batch, schema.json(), paths)], ENTRY)
        ready = f"{self.folder}/ready/{uuid.uuid4().hex}"
        entry.coalesce(1).write.json(ready)
        try:
            _move(self.spark, ready, f"{self.folder}/log/{number:012d}")
        except Py4JJavaError as taken:
            if "FileAlreadyExistsException" not in str(taken.java_exception):
                raise
            raise Conflict(f"version {number} of {self.folder} is another writer's") from taken


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder, or fail if there is one of the new name."""
    context = spark.sparkContext
    jvm = context._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    new.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(new.getParent())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), context._jsc.hadoopConfiguration())
    none = context._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    files.rename(files.makeQualified(old), files.makeQualified(new), none)
