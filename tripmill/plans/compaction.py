"""Compaction of the fact table: trips of many small batches in few files.

Complete batches are rewritten, month by month, as one batch of files near a target size. Nobody sees these until a
record is written that names the batches they replace; from then on readers take the new batch instead. A compaction that breaks off
before leaves an unlisted folder and changes nothing. The replaced files stay for readers that have begun, until
``drop_replaced``. Audit and rollup states keep the names of the original batches.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmill.sources import store

TARGET_BYTES = 256 << 20


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> str | None:
    """Compact the batches whose files in some month are on average below half the target; the new batch's name, or None."""
    visible = store.visible_batches(spark, path)
    files = store.fact_files(spark, path).filter(F.col("load_batch").isin(visible))
    per_batch = files.groupBy("load_batch", "pickup_month").agg(F.avg("length").alias("mean"))
    small = [r[0] for r in per_batch.filter(F.col("mean") < target_bytes / 2).select("load_batch").distinct().collect()]
    if len(small) < 2:
        return None
    sizes = files.filter(F.col("load_batch").isin(small)).groupBy("pickup_month").agg(F.sum("length").alias("bytes"))
    months = {r["pickup_month"]: max(1, math.ceil(r["bytes"] / target_bytes)) for r in sizes.collect()}

    trips = store.read_table(spark, path, "fact_trip").filter(F.col("load_batch").isin(small)).drop("load_batch")
    parts = F.create_map(*[F.lit(x) for month in months.items() for x in month])
    part = F.pmod(F.xxhash64("trip_id"), F.element_at(parts, F.col("pickup_month")))
    name = f"compact-{uuid.uuid4().hex}"
    dealt = trips.repartition(sum(months.values()), "pickup_month", part).sortWithinPartitions("pickup_month", "pickup_datetime")
    store.write_fact(dealt, path, name, False, rebalance=False)
    store.write_compaction(spark, path, name, small)
    return name


def drop_replaced(spark: SparkSession, path: str) -> list[str]:
    """Delete the files of replaced batches; call it when no reader has begun before the compaction."""
    replaced = sorted(store.replaced_batches(spark, path))
    for batch in replaced:
        store.delete(spark, f"{path}/fact_trip/load_batch={batch}")
    return replaced
