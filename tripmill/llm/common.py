"""What the operators share: input tables, the shared folder, staged tables and plain file access."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Text handed to a Python worker at a time; with its objects a worker then takes some 120 MB in the pipeline.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit on Arrow batches, which by default suits larger executors."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see, one per application.

    It lies under ``spark.checkpoint.dir``. Only a session in local mode may leave that unset; then
    a temporary folder is used, as everything runs on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/llm-{spark.conf.get('spark.app.id')}"


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder nobody has used, in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from the written copy.

    This cuts the lineage: an executor that is lost later costs a reread, not a recomputation, and
    values that differ between attempts (row numbers by partition) are fixed once.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete what this application has staged. Call it when no result is to be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pick(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the named columns, so that others in the input can clash with nothing."""
    return df.select(*[df[c] for c in columns])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def salt_of(*columns: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def salts(count: int) -> Column:
    """One row per salt, for the small side of a salted join."""
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def file_system(uri: str):
    """A pyarrow file system and the path in it; works on executors for local, HDFS and object stores."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)
