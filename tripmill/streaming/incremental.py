"""Incremental load: only files that arrived since the last run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill.config import Settings
from tripmill.plans import load
from tripmill.sources.trips import open_trips

# Files of one micro-batch; a backlog is worked off in several.
FILES_PER_BATCH = 1000
# Only the path is asked for, so the content is not read.
_ARRIVAL = "path string, modificationTime timestamp, length long, content binary"


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Names the history that a checkpoint stands for; a new or lost checkpoint gets a new one."""
    folder = f"{checkpoint.rstrip('/')}/stream_name"
    try:
        return spark.read.text(folder).first()[0]
    except Exception as error:  # the class depends on the kind of session
        if "PATH_NOT_FOUND" not in str(error):
            raise
    spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.text(folder)
    return spark.read.text(folder).first()[0]


def load_new_files(
    spark: SparkSession,
    folder: str,
    locations: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Load every file not seen before, then stop.

    The checkpoint remembers the files, and the audit of the tables does too: a file that a bulk load or
    another stream has loaded is left alone, and is not opened. Batches are named after the stream and its batch number, so a
    batch repeated after a failure replaces itself and no other. Files are opened batch by batch with the
    types in their own footers; one that cannot be opened is listed as rejected. Every batch keeps
    its sums for the rollups; merge them with ``load.merge_rollups`` when the query has ended.
    """
    settings = settings or Settings()
    load.write_dimensions(spark, locations, path)
    stream = _stream_id(spark, checkpoint)

    def write_batch(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        batch = f"{stream}-{batch_id}"
        paths = [r["path"] for r in load.not_loaded(files, path, batch).select("path").collect()]
        if paths:
            found = open_trips(session, *paths, cbd_fee=settings.cbd_fee)
            load.load_trips(session, found, path, settings, batch)

    arrivals = spark.readStream.format("binaryFile").schema(_ARRIVAL).option("recursiveFileLookup", "true")
    return (
        arrivals.option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path", F.col("_metadata.file_path").alias("source_file"))
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
