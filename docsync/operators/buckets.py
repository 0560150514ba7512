"""A stored table of documents: Parquet files that Spark writes into folders by a hash of the id."""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from threading import RLock
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync import storage
from docsync.operators.ids import DOC_ID, ERROR_TYPE, ERRORS

BUCKET = "docsync_bucket"
# Folder of the rows that failed, beside the documents
FAILED = -1
# Buckets of a target unless its spec says otherwise. A bucket should hold about 1 GB.
BUCKETS = 16
_SCHEMA = "_schema.json"
_LOAD = re.compile(r"load-(\d{6})-of-(\d+)")
_FOLDER = re.compile(rf"/{BUCKET}=(\d+)/")
_LOCKS: dict[str, RLock] = defaultdict(RLock)


class Written(NamedTuple):
    documents: int
    failed: int
    buckets: frozenset


class Buckets:
    """The last full load of a folder, ``load-<number>-of-<buckets>``, and what was added to it.

    A batch reads and changes only the buckets of its ids. One application writes a target at a
    time: its threads wait for each other (``lock``), but nothing keeps two applications apart. A
    full load is written beside the old one and counts from its last file on. Other changes are
    Spark's own appends and replacements of partitions, which show when their job commits; a reader
    whose buckets are replaced while it runs has to start again.

    Rows that carry errors are stored by the same write, in a folder of their own (``errors``); they
    are no documents.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def lock(self) -> RLock:
        return _LOCKS[self.path]

    def _loads(self) -> list[tuple[int, int, str]]:
        names = storage.folders(self.spark, self.path)
        return sorted((int(m[1]), int(m[2]), f"{self.path}/{m[0]}") for m in map(_LOAD.fullmatch, names)
                      if m)

    def _last(self) -> tuple[int, int, str] | None:
        """(number, buckets, folder) of the last complete load."""
        return next((x for x in reversed(self._loads())
                     if storage.exists(self.spark, f"{x[2]}/{_SCHEMA}")), None)

    def exists(self) -> bool:
        return self._last() is not None

    def _there(self) -> tuple[int, int, str]:
        last = self._last()
        if last is None:
            raise FileNotFoundError(f"nothing has been written to {self.path}")
        return last

    def schema(self) -> T.StructType:
        return _read_schema(self.spark, self._there()[2])

    def buckets_there(self) -> int:
        """The number of buckets of the last load."""
        return self._there()[1]

    def bucket(self, new: bool = False) -> Column:
        """The bucket of a row's id; ``new`` in the next full load."""
        last = None if new else self._last()
        return F.pmod(F.hash(DOC_ID), F.lit(last[1] if last else self.buckets))

    def read(self, within=None) -> DataFrame:
        """The documents; ``within``: those of some buckets, the only ones that are read."""
        _, buckets, folder = self._there()
        schema = _read_schema(self.spark, folder)
        rows = self._files(folder, schema.fields)
        if within is not None and len(within) < buckets:
            return rows.where(F.col(BUCKET).isin(sorted(within))).drop(BUCKET)
        return rows.where(F.col(BUCKET) >= 0).drop(BUCKET)

    def _files(self, folder: str, fields) -> DataFrame:
        return self.spark.read.schema(T.StructType(
            [*fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)

    def errors(self) -> DataFrame:
        """(doc_id, field, value, reason): why rows of this load and of what came after it failed.
        A row that is read again and fails again counts once."""
        fields = [T.StructField(DOC_ID, T.StringType()),
                  T.StructField(ERRORS, T._parse_datatype_string(ERROR_TYPE))]
        failed = self._files(self._there()[2], fields).where(F.col(BUCKET) == FAILED)
        return failed.select(DOC_ID, F.explode(ERRORS).alias("e")).select(DOC_ID, "e.*").distinct()

    def count(self) -> int:
        return self.read().count()

    def laid_out(self, rows: DataFrame, new: bool = False, ordered: bool = False) -> DataFrame:
        """Rows as they are written: a task has few buckets, and a large bucket several tasks."""
        bucket = self.bucket(new)
        if ERRORS in rows.columns:
            bucket = F.when(F.size(ERRORS) > 0, FAILED).otherwise(bucket)
        rows = rows.withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET))
        return rows.sortWithinPartitions(BUCKET, DOC_ID) if ordered else rows

    def _write(self, laid: DataFrame, folder: str, mode: str) -> Written:
        """Store rows that are laid out; counted by the writing tasks."""
        seen, good = Observation(), F.col(BUCKET) >= 0
        (laid.observe(seen, F.count_if(good).alias("documents"), F.count_if(~good).alias("failed"),
                      F.collect_set(BUCKET).alias("buckets"))
         .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET)
         .parquet(folder))
        return Written(seen.get["documents"], seen.get["failed"], frozenset(seen.get["buckets"]))

    def replace(self, laid: DataFrame) -> Written:
        """Make rows, laid out for a new load, the whole content. The load before stays for its
        readers until the next one."""
        loads, last = self._loads(), self._last()
        folder = f"{self.path}/load-{loads[-1][0] + 1 if loads else 1:06d}-of-{self.buckets}"
        stored = self._write(laid, folder, "error")
        _save_schema(self.spark, folder, laid.drop(BUCKET, ERRORS).schema)
        for _, _, old in loads:
            if last is None or old != last[2]:
                storage.delete(self.spark, old)
        return stored

    def append(self, laid: DataFrame) -> Written:
        """Add rows, laid out, with ids that are not there. New fields join the schema."""
        folder = self._joined(laid)
        return self._write(laid, folder, "append")

    def _joined(self, rows: DataFrame) -> str:
        folder = self._there()[2]
        old = _read_schema(self.spark, folder)
        both = _merged(old, rows.drop(BUCKET, ERRORS).schema)
        if both != old:
            _save_schema(self.spark, folder, both)
        return folder

    def exchange(self, ids: DataFrame, rows: DataFrame | None = None, ordered: bool = False) -> int:
        """Remove the documents with the given ids (a written table) and add ``rows``, which carry
        no errors; returns how many of the ids there were. Only the buckets of the ids are written
        anew."""
        touched = {r[0] for r in ids.select(self.bucket()).distinct().collect()}  # a row per bucket
        there = self.read(touched).select(DOC_ID).join(ids.select(DOC_ID), DOC_ID, "left_semi").count()
        if rows is not None and not there:
            self.append(self.laid_out(rows, ordered=ordered))
        if not there:
            return 0
        folder = self._there()[2] if rows is None else self._joined(rows)
        stored = self.read(touched)
        rest = stored.join(ids.select(DOC_ID), DOC_ID, "left_anti").select(stored.columns)
        if rows is not None:
            rest = rest.unionByName(rows, allowMissingColumns=True)
        written = self._write(self.laid_out(rest, ordered=ordered), folder, "overwrite")
        for bucket in touched - written.buckets:  # nothing of it is left
            storage.delete(self.spark, f"{folder}/{BUCKET}={bucket}")
        return there

    def merge(self, limit: int, ordered: bool = False) -> int:
        """Write the buckets of more than ``limit`` files anew; returns how many."""
        files = Counter(int(m[1]) for m in map(_FOLDER.search, self.read().inputFiles()) if m)
        many = [b for b, n in files.items() if n > limit]
        if many:
            self._write(self.laid_out(self.read(many), ordered=ordered), self._there()[2], "overwrite")
        return len(many)


def _read_schema(spark: SparkSession, folder: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(storage.read_text(spark, f"{folder}/{_SCHEMA}")))


def _save_schema(spark: SparkSession, folder: str, schema: T.StructType) -> None:
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    storage.write_text(spark, f"{folder}/{_SCHEMA}", T.StructType(fields).json())


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    known = {f.name: f.dataType for f in old.fields}
    fields = list(old.fields)
    for f in new.fields:
        if f.name not in known:
            fields.append(T.StructField(f.name, f.dataType, True))
        elif known[f.name].simpleString() != f.dataType.simpleString():
            raise ValueError(f"field {f.name} is stored as {known[f.name].simpleString()}, "
                             f"the new rows have {f.dataType.simpleString()}")
    return T.StructType(fields)
