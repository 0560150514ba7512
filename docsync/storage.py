"""Small files and folders on the cluster's shared file system."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one."""
    fs, p = _path(spark, path)
    draft = p.suffix("." + uuid.uuid4().hex)
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        p.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(draft, p, options)


def files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="docsync-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/docsync-{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str):
    """The rows of ``df`` as a written table, for as long as the block runs.

    What follows reads the table: the source is read once, its size is known to the optimizer,
    and a lost executor costs a file read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)
