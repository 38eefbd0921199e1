"""Raw trip files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegralType, LongType, StringType, StructField, StructType

from tripmill import schema
from tripmill.sources import footers

# A file's path, its number of rows, and the position of the last row of each row group.
FILES = StructType(
    [StructField("source_file", StringType()), StructField("rows", LongType()), StructField("ends", ArrayType(LongType()))]
)


# Columns that only some years have, and that are loaded where they are asked for.
CBD_FEE = StructField("cbd_congestion_fee", DoubleType())


def conform(df: DataFrame, more: Sequence[StructField] = ()) -> DataFrame:
    """Project any yearly variant of the raw files onto the raw schema.

    Names match without regard to case; a column absent from the files is NULL. A column
    that already has the wanted type is passed through uncast, so that filters on it still
    reach the Parquet reader. A fractional value going into an integer column is rounded
    half to even.
    """
    present = {f.name.lower(): f for f in df.schema}
    columns = []
    for field in [*schema.RAW_TRIPS, *more]:
        found = present.get(field.name.lower())
        if found is None:
            column = F.lit(None).cast(field.dataType)
        elif found.dataType == field.dataType:
            column = F.col(found.name)
        elif isinstance(field.dataType, IntegralType) and found.dataType.typeName() in ("double", "float"):
            column = F.rint(F.col(found.name)).cast(field.dataType)
        else:
            column = F.col(found.name).cast(field.dataType)
        columns.append(column.alias(field.name))
    origin = [c for c in schema.RAW_ORIGIN.names if c in df.columns]
    return df.select(*columns, *origin)


@dataclass(frozen=True)
class TripFiles:
    """Raw trips of all files that can be read, what their footers say, and the paths of those that cannot.

    ``files`` has a row per file: its path, its number of trips, and the positions of the last trip of each
    of its row groups. A file that turns out to be torn while it is read stops there, without an error; the last
    trips of its row groups are then not all seen.
    """

    raw: DataFrame
    files: DataFrame
    unreadable: list[str]


def list_files(spark: SparkSession, *paths: str) -> list[str]:
    """The files behind paths, folders and globs, from Spark's file index; none is opened."""
    return sorted(spark.read.option("recursiveFileLookup", "true").text(list(paths)).inputFiles())


def open_trips(spark: SparkSession, *paths: str, cbd_fee: bool = False) -> TripFiles:
    """Look at the footer of every file, in one job, and read files of the same layout together.

    With ``cbd_fee`` the fee of that name is read from the files that have it; otherwise loads set it to 0. Each file keeps its own column types, so a column that only later files have, or that changes its
    type, loses no values. A file whose footer cannot be read is set aside and named.
    """
    more = [CBD_FEE] if cbd_fee else []
    found = _footers(spark, paths, more)
    raw = _read(spark, found, {"ignoreCorruptFiles": "true"}, more)
    known = [f for group in found.layouts.values() for f in group]
    rows = [(f.source_file, f.rows, f.ends) for f in known]
    return TripFiles(raw, spark.createDataFrame(rows, FILES), found.unreadable)


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw trips from Parquet files, folders or globs, each file read with the types in its own footer.

    Every row keeps the path of its file and its position in that file, which together identify it
    however often a task is run again. A file that cannot be read is an error; ``open_trips`` sets it aside.
    """
    found = _footers(spark, paths)
    if found.unreadable:
        raise ValueError(f"not readable as Parquet: {', '.join(found.unreadable[:5])}")
    return _read(spark, found, {})


def _footers(spark: SparkSession, paths: Sequence[str], more: Sequence[StructField] = ()) -> footers.Footers:
    if not paths:
        raise ValueError("no trip files given")
    return footers.look_at(spark, paths, [*schema.RAW_TRIPS.names, *[f.name for f in more]])


def _read(
    spark: SparkSession, found: footers.Footers, options: dict[str, str], more: Sequence[StructField] = ()
) -> DataFrame:
    parts = []
    for layout, own in found.layouts.items():
        reader = spark.read.options(**options).schema(StructType.fromJson(json.loads(layout)))
        parts.append(conform(with_origin(reader.parquet(*[f.path for f in own])), more))
    if not parts:
        parts = [spark.createDataFrame([], StructType([*schema.RAW_TRIPS, *more, *schema.RAW_ORIGIN]))]
    return reduce(DataFrame.unionByName, parts)


def files_of(raw: DataFrame) -> DataFrame:
    """A row per file, as in ``TripFiles``, from trips whose footers nobody has looked at."""
    counted = raw.groupBy("source_file").agg(F.count("*").alias("rows"), F.array(F.max("source_row")).alias("ends"))
    return counted.select(*FILES.names)


def with_origin(files: DataFrame) -> DataFrame:
    """Add file path and row position; a name alone may occur in several folders."""
    return files.withColumns(
        {"source_file": F.col("_metadata.file_path"), "source_row": F.col("_metadata.row_index")}
    )


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.limit(rows)
