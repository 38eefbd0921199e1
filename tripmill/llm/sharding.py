"""Sharding by extendible hashing: only oversized buckets are split, on one more bit of the hash.

A bucket is a prefix of the key's hash. All rows start in the bucket of no bits; every round sums the
bytes of the buckets still open, closes those that fit the limit, and splits the others on their next
bit. The closed prefixes form the directory: a row's shard is the one closed prefix of its hash.

The rounds run over cells, sums of bytes per long prefix of the hash, not over rows. Cells that are
themselves too large are opened again at row level, and rows that agree in the whole hash of their key
go on with the bits of a second hash that differs from row to row, so that a key that holds a third of
all rows is still split. A bucket with a single row is closed even if it exceeds the limit.

Cases: a null text has 0 bytes; a null key is a key of its own; equal rows are told apart by the second
hash. An empty table has no shards. Other columns are kept; those named like added ones are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import common

BITS = 60  # of each of the two hashes
# A cell's prefix is so many bits longer than the directory would be if all buckets were equal.
_SPARE_BITS = 6


def key_hash(*key: Column) -> Column:
    """60 bits of the MD5 of the key's text."""
    text = F.concat_ws(":", *[F.coalesce(k.cast("string"), F.lit("null")) for k in key])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _bits(value: Column, count: Column | int) -> Column:
    """The first ``count`` of 60 bits, as a number."""
    count = F.lit(count) if isinstance(count, int) else count
    return F.call_function("shiftright", value, F.lit(BITS) - count.cast("int"))


def _label(value: Column, count: Column) -> Column:
    return F.substring(F.lpad(F.bin(value), BITS, "0"), F.lit(1), count.cast("int"))


def split(cells: DataFrame, group: list[str], limit: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """Buckets of cells (group columns, cell, bytes, n_rows), by rounds of one bit, down to ``depth`` bits.

    Returns the closed buckets (group columns, depth, prefix, shard_bytes) and, in the same form, those that are
    too large even with all ``depth`` bits.
    """
    closed, open_cells, at = [], cells, 0
    while True:
        prefix = _bits(F.col("cell"), at).alias("prefix")
        sums = common.stage(
            open_cells.groupBy(*group, prefix).agg(
                F.sum("bytes").alias("shard_bytes"),
                F.sum("n_rows").alias("n_rows"),
                # Bits that all cells of the bucket share: splitting on one of these would change nothing.
                (BITS - F.length(F.bin(F.min("cell").bitwiseXOR(F.max("cell"))))).alias("shared"),
                F.lit(at).alias("depth"),
            ),
            f"directory-{at}",
        )
        fits = (F.col("shard_bytes") <= limit) | (F.col("n_rows") == 1)
        closed.append(sums.filter(fits).select(*group, "depth", "prefix", "shard_bytes"))
        oversized = sums.filter(~fits)
        shared = oversized.agg(F.min("shared")).first()[0]
        if shared is None or at == depth:
            return reduce(DataFrame.unionByName, closed), oversized.select(*group, "depth", "prefix", "shard_bytes")
        same = [open_cells[g].eqNullSafe(oversized[g]) for g in group]
        open_cells = open_cells.join(oversized, [*same, _bits(open_cells["cell"], at) == oversized["prefix"]], "left_semi")
        if len(closed) % 8 == 0:
            open_cells = common.stage(open_cells, f"open-{at}")
        at = min(depth, max(at, shared) + 1)


def hashed(docs: DataFrame, key: tuple[str, ...] = ("doc_id",), size: Column | None = None) -> DataFrame:
    """Stage the rows with their hash, second hash and bytes, which fixes the row numbers in the second hash."""
    docs = docs.drop("hash", "second", "bytes")
    size = F.octet_length("text") if size is None else size
    second = F.call_function("shiftrightunsigned", F.xxhash64(F.monotonically_increasing_id(), *key), F.lit(64 - BITS))
    return common.stage(
        docs.select(
            "*",
            key_hash(*[F.col(k) for k in key]).alias("hash"),
            second.alias("second"),
            F.coalesce(size, F.lit(0)).cast("long").alias("bytes"),
        ),
        "hashed-rows",
    )


def assign(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of ``hashed`` with shard, depth and shard_bytes, and no shard of several rows above ``limit`` bytes.

    ``shard`` is the bucket's bits as text; bits of the second hash follow a dot.
    """
    rows = rows.drop("shard", "depth", "shard_bytes")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    bits = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + _SPARE_BITS)
    placed, left = _level(rows, [], "hash", bits, limit)
    if left is None:
        return placed
    # Rows of cells that are too large: all bits of the hash, then those of the second one.
    deeper, left = _level(left, [], "hash", BITS, limit)
    placed = placed.unionByName(deeper)
    if left is None:
        return placed
    last, left = _level(left, ["hash"], "second", BITS, limit)
    placed = placed.unionByName(last)
    return placed if left is None else placed.unionByName(_closed(left, F.lit(2 * BITS), F.lit(None)))


def write(docs: DataFrame, folder: str, limit: int, key: tuple[str, ...] = ("doc_id",)) -> None:
    """Write all columns of the documents, one folder per shard."""
    rows = assign(hashed(docs, key), limit)
    dealt = rows.repartition("shard").drop("hash", "second", "bytes", "depth", "shard_bytes")
    dealt.write.mode("overwrite").partitionBy("shard").parquet(folder)


def _closed(rows: DataFrame, depth: Column, shard_bytes: Column) -> DataFrame:
    """Name the shard after the bits that lead to it."""
    first = _label(F.col("hash"), F.least(depth, F.lit(BITS)))
    beyond = F.concat(first, F.lit("."), _label(F.col("second"), depth - BITS))
    return rows.select(
        "*",
        F.when(depth > BITS, beyond).otherwise(first).alias("shard"),
        depth.cast("int").alias("depth"),
        shard_bytes.cast("long").alias("shard_bytes"),
    )


def _level(rows: DataFrame, group: list[str], hashed_by: str, bits: int, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Split over ``bits`` bits of one hash: the rows placed, and the staged rows of cells that are too large."""
    cell = F.call_function("shiftleft", _bits(F.col(hashed_by), bits), F.lit(BITS - bits))
    cells = common.stage(
        rows.groupBy(*group, cell.alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n_rows")), "cells"
    )
    closed, full = split(cells, group, limit, bits)
    known = common.stage(_bucket_of(cells, closed, group), "cell-buckets")

    def same(other: DataFrame) -> list[Column]:
        return [*(rows[g] == other[g] for g in group), rows["_cell"] == other["cell"]]

    rows = rows.withColumn("_cell", cell)
    found = rows.join(known, same(known)).select(*[rows[c] for c in rows.columns if c != "_cell"], "_depth", "_bytes")
    depth = F.col("_depth") + (BITS if hashed_by == "second" else 0)
    placed = _closed(found, depth, F.col("_bytes")).drop("_depth", "_bytes")
    if full.isEmpty():
        return placed, None
    over = full.select(*group, F.call_function("shiftleft", F.col("prefix"), F.lit(BITS - bits)).alias("cell"))
    return placed, common.stage(rows.join(over, same(over), "left_semi").drop("_cell"), "rows-left")


def _bucket_of(cells: DataFrame, closed: DataFrame, group: list[str]) -> DataFrame:
    """(group, cell, _depth, _bytes): the closed bucket of each cell, by an equality join for each depth in use."""
    depths = sorted(r[0] for r in closed.select("depth").distinct().collect())
    key = [cells[g] for g in group]
    parts = [cells.limit(0).select(*key, "cell", F.lit(0).alias("_depth"), F.col("bytes").alias("_bytes"))]
    for d in depths:
        own = closed.filter(F.col("depth") == d).alias("own")
        same = [*(cells[g] == own[g] for g in group), _bits(cells["cell"], d) == own["prefix"]]
        parts.append(
            cells.join(own, same).select(
                *key, cells["cell"], own["depth"].alias("_depth"), own["shard_bytes"].alias("_bytes")
            )
        )
    return reduce(DataFrame.unionByName, parts)
