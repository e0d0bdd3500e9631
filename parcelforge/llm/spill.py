"""Written intermediate tables in the shared folder that the session names."""

from __future__ import annotations

import ctypes
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

#: Bytes of a written result that one task reads.
RESULT_BYTES = 1 << 27
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


Batches = Iterable[pa.RecordBatch]


def give_back() -> None:
    """Hand memory that this process has freed back to the system: Spark keeps Python workers between tasks, and what their allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(run: Callable[[Batches], Iterator[pa.RecordBatch]]) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that gives its memory back when its task ends."""

    def bounded(batches: Batches) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return bounded


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where that is unset, a folder of this machine in local mode and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        made = getattr(spark, "_parcelforge_folder", None)
        if made is None:
            made = spark._parcelforge_folder = "file://" + tempfile.mkdtemp(prefix="parcelforge-")
        folder = made
    return folder.rstrip("/")


def _mounted(path: str) -> str | None:
    """The plain path of a folder that is mounted everywhere (scheme ``file``); else null."""
    found = re.match(r"file:(?://)?(/.*)$", path)
    return found[1] if found else None


def _write_mounted(df: DataFrame, folder: str, through: Callable[[Batches], Iterator[pa.RecordBatch]] | None) -> None:
    """One file per task, written under a name of its own and moved in place by the driver once its task has succeeded.

    ``through`` runs in the worker that writes: a task then has one Python worker, not two.

    Hadoop's local file system starts a ``chmod`` process for each file and folder that it makes.
    """
    os.makedirs(f"{folder}/_parts")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, name = None, f"part-{uuid.uuid4().hex}.parquet"
        for batch in through(batches) if through else batches:
            if batch.num_rows:
                writer = writer or pq.ParquetWriter(f"{folder}/_parts/{name}", batch.schema, compression="snappy")
                writer.write_batch(batch)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    for row in df.mapInArrow(lean(run), "name string").collect():  # one short name a task
        os.rename(f"{folder}/_parts/{row['name']}", f"{folder}/{row['name']}")
    shutil.rmtree(f"{folder}/_parts")  # what failed attempts have left


def write_table(df: DataFrame, label: str, *, native: bool = False, through: tuple[Callable[[Batches], Iterator[pa.RecordBatch]], str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: cuts lineage, survives lost executors.

    ``native`` keeps to Spark's writer on mounted folders too; elsewhere it is used always.  ``through`` is a function as for ``mapInArrow``
    and its schema: what it makes of ``df`` is written.
    """
    spark = df.sparkSession
    made = df.mapInArrow(lean(through[0]), through[1]) if through else df
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    mounted = None if native else _mounted(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # the shuffle files of this write go with it
    try:
        if mounted:
            _write_mounted(df, mounted, through and through[0])
        else:
            made.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(made.schema).parquet(path)
    out._parcelforge_path = path
    return out


def result_table(df: DataFrame, label: str) -> DataFrame:
    """Write a result and read it in parts of about RESULT_BYTES, so that whoever writes it on makes few files; what it was made from may then go."""
    out = write_table(df, label)
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(out._parcelforge_path)
    size = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()
    return out.coalesce(int(size // RESULT_BYTES) + 1)


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """At most so many rows in one batch between the JVM and Python, unless the session asks for fewer: bounds the workers' memory with long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def drop_table(df: DataFrame) -> None:
    """Delete a table made by ``write_table`` that nothing will read again."""
    path = getattr(df, "_parcelforge_path", None)
    if path:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
