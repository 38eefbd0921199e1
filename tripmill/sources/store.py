"""Parquet tables: writing and reading the star schema and its rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill import schema

# Partition columns of the fact table: the month of the pickup, by which reports prune, and the load that
# wrote a row. A load that is run again replaces exactly its own rows.
FACT_PARTITIONS = ["load_batch", "pickup_month"]
_MORE = [StructField(n, StringType()) for n in ("source_file", "source_period", "pickup_month", "load_batch")]
_COMPACTIONS = "fact_compactions"
_COMPACTION = "number int, batch string, replaced array<string>"
# Stored layouts, so that types never depend on what partition folders happen to be called.
LAYOUTS = {
    "fact_trip": StructType([*schema.FACT_TRIP, *_MORE]),
    "load_audit": schema.LOAD_AUDIT,
}


def write_table(df: DataFrame, path: str, name: str) -> None:
    """Overwrite a table, so that a second load never keeps rows of the first."""
    df.write.mode("overwrite").parquet(f"{path}/{name}")


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    reader = spark.read.schema(LAYOUTS[name]) if name in LAYOUTS else spark.read
    df = reader.parquet(f"{path}/{name}")
    return df.select(LAYOUTS[name].names) if name in LAYOUTS else df


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a derived table and go on from the written copy, which cuts the lineage."""
    write_table(df, folder, name)
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Hadoop finds it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage_fact(df: DataFrame, folder: str) -> DataFrame:
    """Stage a fact table by month of pickup, as a load stores it."""
    rows = df.hint("rebalance", F.col("pickup_month"))
    _write_partitioned(rows, f"{folder}/fact_trip", ["pickup_month"], True)
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/fact_trip").select(df.columns)


def write_fact(df: DataFrame, path: str, batch: str, replace_all: bool, rebalance: bool = True) -> None:
    """Write one load of the fact table, one month of pickups to a partition.

    Rows are rebalanced by month: AQE merges small months and splits one that holds most of the
    rows. With ``replace_all`` the whole table is replaced, otherwise only the partitions of this batch.
    """
    rows = df.withColumn("load_batch", F.lit(batch))
    rows = rows.hint("rebalance", F.col("pickup_month")) if rebalance else rows
    if replace_all:
        delete(df.sparkSession, f"{path}/{_COMPACTIONS}")
    _write_partitioned(rows, f"{path}/fact_trip", FACT_PARTITIONS, replace_all)


def write_audit(df: DataFrame, path: str, batch: str, replace_all: bool) -> None:
    _write_partitioned(df.withColumn("load_batch", F.lit(batch)), f"{path}/load_audit", ["load_batch"], replace_all)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def write_compaction(spark: SparkSession, path: str, batch: str, replaced: list[str]) -> None:
    """Record that a batch stands for others; writing it is the switch that readers see."""
    folder = f"{path}/{_COMPACTIONS}"
    number = len(_compactions(spark, path))
    spark.createDataFrame([(number, batch, replaced)], _COMPACTION).coalesce(1).write.mode("append").parquet(folder)


def _compactions(spark: SparkSession, path: str) -> list:
    """All records in their order; a few names each."""
    folder = f"{path}/{_COMPACTIONS}"
    return spark.read.schema(_COMPACTION).parquet(folder).orderBy("number").collect() if _exists(spark, folder) else []


def replaced_batches(spark: SparkSession, path: str) -> set[str]:
    return {b for record in _compactions(spark, path) for b in record["replaced"]}


def visible_batches(spark: SparkSession, path: str) -> list[str]:
    """Batches of the fact table that readers take: those that the audit lists, or what stands for them."""
    found = {r[0] for r in read_table(spark, path, "load_audit").select("load_batch").distinct().collect()}
    for record in _compactions(spark, path):
        found = found - set(record["replaced"]) | {record["batch"]}
    return sorted(found)


def fact_files(spark: SparkSession, path: str) -> DataFrame:
    """(load_batch, pickup_month, length) of every file of the fact table; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/fact_trip")
    parts = [F.regexp_extract("path", f"/{name}=([^/]*)/", 1).alias(name) for name in FACT_PARTITIONS]
    return files.select(*parts, "length")


def write_state(df: DataFrame, path: str, name: str, batch: str, replace_all: bool) -> None:
    """Keep one batch's state for a rollup, replacing what that batch had before, or everything."""
    folder = f"{path}/rollup_state/{name}"
    if replace_all:
        delete(df.sparkSession, folder)
    write_table(df, folder, f"load_batch={batch}")


def read_state(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The states of all batches, complete or not, with their ``load_batch``."""
    folder = f"{path}/rollup_state/{name}"
    columns = [f for f in spark.read.parquet(folder).schema if f.name != "load_batch"]
    # The batch's name is text, whatever it looks like.
    return spark.read.schema(StructType([*columns, StructField("load_batch", StringType())])).parquet(folder)


def _write_partitioned(df: DataFrame, path: str, partitions: list[str], replace_all: bool) -> None:
    mode = "static" if replace_all else "dynamic"
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*partitions)
        .parquet(path)
    )
