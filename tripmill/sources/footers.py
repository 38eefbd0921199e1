"""What the footers of many Parquet files say, looked at by the executors in one job."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

# What runs in tasks travels by value, so that workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Files in a task at least, and tasks per core at most.
_FILES, _TASKS = 16, 4
_AT_ONCE = 16
_FOUND = "path string, source_file string, state string, layout string, rows bigint, ends array<bigint>"
# What Spark says about a file that is no Parquet, or an empty one.
_NO_PARQUET = ("CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA", "is not a Parquet file", "Could not read footer")
_SPARK_LAYOUT = b"org.apache.spark.sql.parquet.row.metadata"
# Names of the object stores as Hadoop has them and as Arrow does.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3"}


@dataclass(frozen=True)
class File:
    """A path to read from, the same as rows of the file name it, number of rows, last rows of row groups."""

    path: str
    source_file: str
    rows: int
    ends: list[int]


@dataclass(frozen=True)
class Footers:
    """Files by layout (a schema as JSON), and the paths of those that are no Parquet."""

    layouts: dict[str, list[File]] = field(default_factory=dict)
    unreadable: list[str] = field(default_factory=list)


def look_at(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> Footers:
    """One job over all files behind paths, folders and globs; what comes back is as long as Spark's own list of them.

    ``columns`` are those whose types matter, in any case. A file system that only Hadoop knows is asked through
    Spark, a job per file.
    """
    found = Footers()
    wanted = frozenset(c.lower() for c in columns)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, name, *_footer(path, wanted)) for path, name in zip(batch["path"], batch["source_file"])]
            yield pd.DataFrame(rows, columns=["path", "source_file", "state", "layout", "rows", "ends"])

    # Only names are asked for, so contents are not read.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    named = listed.select("path", F.col("_metadata.file_path").alias("source_file"))
    tasks = min(-(-len(listed.inputFiles()) // _FILES), _TASKS * spark.sparkContext.defaultParallelism)
    dealt = named.repartition(max(1, tasks))
    others = []
    for row in sorted(dealt.mapInPandas(look, _FOUND).collect(), key=lambda r: r["path"]):
        if row["state"] == "parquet":
            file = File(row["path"], row["source_file"], row["rows"], row["ends"])
            found.layouts.setdefault(row["layout"], []).append(file)
        elif row["state"] == "broken":
            found.unreadable.append(row["source_file"])
        else:
            others.append((row["path"], row["source_file"]))
    # Whatever could not be opened or told from within a task.
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        for (path, name), layout in zip(others, pool.map(lambda f: _spark_layout(spark, f[0]), others)):
            if layout is None:
                found.unreadable.append(name)
            else:
                last = spark.read.parquet(path).selectExpr("count(*)", "max(_metadata.row_index)").first()
                file = File(path, name, last[0], [last[1]] if last[0] else [])
                found.layouts.setdefault(layout, []).append(file)
    found.unreadable.sort()
    return found


def _open(path: str):
    """A file by its Hadoop path, with Arrow's file systems."""
    from urllib.parse import quote

    from pyarrow import fs

    scheme, found, inner = path.partition(":/")
    if not found or scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + inner.lstrip("/") if found else path)
    system, inner = fs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:/{quote(inner)}")
    return system.open_input_file(inner)


def _footer(path: str, wanted: frozenset[str]) -> tuple[str, str | None, int, list[int]]:
    """State, layout, rows and ends of row groups of one file; trouble comes back as a state."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    try:
        with _open(path) as source:
            footer = pq.read_metadata(source)
    except (pa.ArrowInvalid, EOFError):
        return "broken", None, 0, []
    except Exception:  # a file system or a feature that Arrow does not know
        return "unknown", None, 0, []
    try:
        layout = _layout(footer, wanted)
    except Exception:  # a type that Spark may know
        return "unknown", None, 0, []
    ends, at = [], 0
    for group in range(footer.num_row_groups):
        at += footer.row_group(group).num_rows
        if footer.row_group(group).num_rows:
            ends.append(at - 1)
    return "parquet", layout, footer.num_rows, ends


def _layout(footer, wanted: frozenset[str]) -> str:
    """The wanted columns as a Spark schema in JSON."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_type

    stored = (footer.metadata or {}).get(_SPARK_LAYOUT)
    if stored:
        fields = [f for f in json.loads(stored)["fields"] if f["name"].lower() in wanted]
        return json.dumps({"type": "struct", "fields": [f | {"metadata": {}} for f in fields]}, sort_keys=True)
    arrow = footer.schema.to_arrow_schema()
    physical = {footer.schema.column(i).path: footer.schema.column(i).physical_type for i in range(len(footer.schema))}
    fields = []
    for column in arrow:
        if column.name.lower() in wanted:
            kind = column.type.value_type if pa.types.is_dictionary(column.type) else column.type
            old_timestamp = physical.get(column.name) == "INT96"
            fields.append(StructField(column.name, TimestampType() if old_timestamp else from_arrow_type(kind, True)))
    return json.dumps(StructType(fields).jsonValue(), sort_keys=True)


def _spark_layout(spark: SparkSession, path: str) -> str | None:
    """Columns of one file as JSON, or None if its footer is no Parquet."""
    try:
        return spark.read.parquet(path).schema.json()
    except Exception as error:  # the class depends on the kind of session
        if any(sign in str(error) for sign in _NO_PARQUET):
            return None
        raise
