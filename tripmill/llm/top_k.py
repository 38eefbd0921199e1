"""Exact top-k search over vector-approximation files.

Vectors are turned into whole numbers, ``floor(256 * x)`` of each component, which doubles hold exactly. The approximation file holds, of
each distinct vector, the cell of every component on a grid of ``2 ** BITS`` equal cells over that
component's range; the exact vectors stand in a file of their own. A search scans the cells only: from a
cell's ends follow a lower and an upper bound of the inner product with a query. The k-th largest lower
bound says which upper bounds are still of interest. Exact vectors are then read in the order of their
bounds, first the best few of every query; what remains is read only where its bound still reaches the
k-th exact score, after which the result is certain.

Equal vectors are one entry with the ids of their rows: the k + 1 smallest ids, each with how many rows it has,
as no others can be among the first k, whichever id is left out. A query leaves out all rows of its own id. As these may be
many and near, every cut is made as many places further down as the query's id has vectors. Queries
and cells are dealt in blocks of packed rows, and every block of queries meets every block of cells once: a task holds
some blocks of cells, at most ``CELLS_HELD`` bytes, and blocks of queries pass by them. So queries are copied once per task that holds
other cells, not once per block. Nothing is collected, and what is multiplied (queries, answers) or packed (vectors) is never
broadcast, as Spark judges tables by the size of their files, before rows are multiplied and lists unpacked.

Cases: a vector that is null or has null or non-finite components takes no part, nor does a row without
vec_id. Shorter vectors count as filled up with zeros. Ties go to the smaller vec_id. Repeated rows count as often as they
are there, as queries and as candidates. Scores are exact whatever the
size of components; one that no long holds becomes the largest or smallest long. Components of 1e140 or more count as
non-finite. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm import common

SCALE, BITS = 256, 8
_TOO_LARGE = 1e140
# Vectors in a block of cells and in a block of queries.
CELL_BLOCK, QUERY_BLOCK = 8192, 512
# Bytes of cells that a task holds, tasks that hold different cells if there are as many blocks, and blocks of queries in a task.
CELLS_HELD, CELL_TASKS, QUERY_TASK = 32 << 20, 16, 128
# Pairs of a query and a cell that a task gathers before it hands them on.
PAIRS_HELD = 1 << 18
_SALTS = 16


def whole_numbers(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, values): components as integers; rows that take no part are left out."""
    def whole(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        # Doubles of this size have no fraction.
        return F.when(F.abs(scaled) < float(1 << 52), F.floor(scaled).cast("double")).otherwise(scaled)

    usable = (
        F.col("vec_id").isNotNull()
        & F.col(vector).isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < _TOO_LARGE))
    )
    return df.filter(usable).select("vec_id", F.transform(vector, whole).alias("values"))


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(key, values, ids): equal vectors once; ids as (vec_id, copies), the k + 1 smallest, copies k at most."""
    keyed = vectors.withColumn("key", vector_key(F.col("values")))
    counted = keyed.groupBy("key", "vec_id").agg(F.count("*").alias("copies"), F.first("values").alias("values"))
    order = Window.partitionBy("key").orderBy("vec_id")
    smallest = counted.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    entry = F.struct("vec_id", F.least("copies", F.lit(k)).alias("copies"))
    return smallest.groupBy("key").agg(F.first("values").alias("values"), F.array_sort(F.collect_list(entry)).alias("ids"))


def vector_key(values: Column) -> Column:
    """Names an integer vector; zeros at the end make no difference."""
    text = F.regexp_replace(F.array_join(F.transform(values, lambda x: x.cast("string")), ","), "(,0\\.0|^0\\.0)+$", "")
    return F.unhex(F.md5(text))


def _pack(rows: DataFrame, block_size: int, make: Callable[..., tuple], schema: str) -> DataFrame:
    """Rows (key, values, width) in blocks: for each (block, *make(keys, widths, matrix)), all numbers with 64 bits in a row."""
    blocks = max(1, math.ceil(rows.count() / block_size))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        held: dict[int, tuple[list, list, list]] = {}
        for batch in batches:
            for block, key, values, width in zip(batch["block"], batch["key"], batch["values"], batch["width"]):
                keys, widths, data = held.setdefault(block, ([], [], []))
                keys.append(key)
                widths.append(width)
                data.append(values)
        while held:
            block, (keys, widths, data) = held.popitem()
            dims = max(map(len, data))
            matrix = np.zeros((len(data), dims), "<f8")
            for at, values in enumerate(data):
                matrix[at, : len(values)] = values
            row = (block, *make(b"".join(keys), np.array(widths, "<i8"), matrix))
            yield pd.DataFrame([row], columns=["block", *(x.split()[0] for x in schema.split(", "))])

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    return dealt.select("block", "key", "values", "width").mapInPandas(pack, f"block int, {schema}")


def query_blocks(asked: DataFrame) -> DataFrame:
    """Blocks of (block, keys, dims, data, widths): the exact vectors of queries."""

    def exact(keys, widths, matrix) -> tuple:
        return keys, matrix.shape[1], matrix.tobytes(), widths.tobytes()

    return common.stage(_pack(asked, QUERY_BLOCK, exact, "keys binary, dims int, data binary, widths binary"), "query-blocks")


def approximation_file(exact: DataFrame) -> DataFrame:
    """Blocks of (block, keys, dims, data, low, step): a byte per component, and the grid of the block."""

    def quantise(keys, _, matrix) -> tuple:
        import numpy as np

        low = matrix.min(axis=0)
        step = np.floor((matrix.max(axis=0) - low) / (1 << BITS)) + 1
        cells = np.minimum((matrix - low) // step, (1 << BITS) - 1).astype("uint8")
        return keys, matrix.shape[1], cells.tobytes(), low.tobytes(), step.tobytes()

    packed = _pack(
        exact.withColumn("width", F.lit(0)), CELL_BLOCK, quantise, "keys binary, dims int, data binary, low binary, step binary"
    )
    return common.stage(packed, "cells")


def bounds(queries, cells, low, step):
    """(inner, below, above): the product of an integer query and a vector in a cell is from inner + below to inner + above.

    ``inner`` has a row per query and a column per cell. A cell is as wide as any other, so that what its width may add
    or take is a number per query.
    """
    import numpy as np

    # Beyond the shorter of the two, one factor is zero.
    n = min(queries.shape[1], cells.shape[1])
    q, cells, low, step = queries[:, :n], cells[:, :n], low[:n], step[:n]
    weights = q * step
    # Whole numbers of this size are exact in four bytes.
    kind = "f4" if np.abs(weights).sum(axis=1).max() * ((1 << BITS) - 1) < 1 << 24 else "f8"
    inner = weights.astype(kind) @ cells.T.astype(kind)
    # What goes beyond 2 ** 53 is rounded; the slack keeps the bounds bounds.
    slack = 1e-12 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(low + step * (1 << BITS))))
    start = q @ low
    return inner, start + np.minimum(q, 0) @ (step - 1) - slack, start + np.maximum(q, 0) @ (step - 1) + slack


def possible(queries, widths, held):
    """(query, key, lower, upper) in lots: pairs of a query and a cell in ``held`` (keys, cells, low, step) that cannot be ruled out.

    Of the vectors in ``held``, those whose upper bound is below the width-th largest lower bound are ruled out.
    """
    import numpy as np

    least = np.full(len(queries), -np.inf)
    # Queries of the same width, mostly all of them, are cut together: their rows, and the largest lower bounds so far.
    # Wider ones, of an id with that many vectors, are not cut here.
    tops = {}
    for width in np.unique(widths[widths <= CELL_BLOCK]).tolist():
        rows = np.nonzero(widths == width)[0]
        tops[width] = rows, np.empty((len(rows), 0))
    lots, count = [], 0

    def cut():
        kept = [tuple(x[upper >= least[query]] for x in (query, key, lower, upper)) for query, key, lower, upper in lots]
        return [np.concatenate(x) for x in zip(*kept)] if kept else None

    for keys, cells, low, step in held:
        inner, below, above = bounds(queries, cells, low, step)
        full = []
        for width, (rows, top) in tops.items():
            if top.shape[1] == width:
                full.append(width)
                continue
            top = np.concatenate([top, inner[rows] + below[rows, None]], axis=1)
            if top.shape[1] >= width:
                top = np.partition(top, top.shape[1] - width, axis=1)[:, top.shape[1] - width :].copy()
                least[rows] = top.min(axis=1)
            tops[width] = rows, top
        reach = least - above
        if inner.dtype == np.float32:
            reach = np.nextafter(np.clip(reach, -3e38, 3e38).astype("f4"), np.float32(-np.inf))
        a, b = np.nonzero(inner >= reach[:, None])
        found = inner[a, b].astype("f8")
        lower, upper = found + below[a], found + above[a]
        for width in full:
            rows, top = tops[width]
            mine = widths[a] == width
            at = np.searchsorted(rows, a[mine])
            counts = np.bincount(at, minlength=len(rows))
            more = np.full((len(rows), counts.max()), -np.inf)
            more[at, np.arange(len(at)) - (np.cumsum(counts) - counts)[at]] = lower[mine]
            top = np.concatenate([top, more], axis=1)
            top = np.partition(top, top.shape[1] - width, axis=1)[:, top.shape[1] - width :].copy()
            least[rows] = top.min(axis=1)
            tops[width] = rows, top
        lots.append((a, np.frombuffer(keys, "V16")[b], lower, upper))
        count += len(a)
        if count > PAIRS_HELD:
            lots = [cut()]
            count = len(lots[0][0])
            if count > PAIRS_HELD // 2:
                yield lots[0]
                lots, count = [], 0
    if lots:
        yield cut()


def _each(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def candidates(queries: DataFrame, approximations: DataFrame) -> DataFrame:
    """(query, width, key, lower, upper): per query and task what the bounds of the task's cells cannot rule out."""

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        def binary(keys):
            ends = np.arange(len(keys) + 1, dtype="<i4") * 16
            return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(keys.tobytes())])

        task, held = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                of, asks, keys, dims, data, widths, low, step = (column[n].as_py() for column in batch.columns)
                if of != task:
                    task, held = of, []
                if not asks:
                    cells = np.frombuffer(data, "uint8").reshape(len(keys) // 16, dims)
                    held.append((keys, cells, np.frombuffer(low, "<f8"), np.frombuffer(step, "<f8")))
                    continue
                names, widths = np.frombuffer(keys, "V16"), np.frombuffer(widths, "<i8")
                for query, key, lower, upper in possible(np.frombuffer(data, "<f8").reshape(len(names), dims), widths, held):
                    for k in range(0, len(query), PAIRS_HELD):
                        part = slice(k, k + PAIRS_HELD)
                        yield pa.RecordBatch.from_arrays(
                            [binary(names[query[part]]), widths[query[part]], binary(key[part]), lower[part], upper[part]],
                            ["query", "width", "key", "lower", "upper"],
                        )

    blocks, largest = approximations.agg(F.count("*"), F.max(F.length("keys") + F.length("data"))).first()
    groups = math.ceil(blocks / max(1, min(CELLS_HELD // (largest or 1), blocks // CELL_TASKS))) or 1
    parts = math.ceil(queries.count() / QUERY_TASK) or 1
    # Tasks are pairs of a group of cells and a part of the queries, a partition each.
    cells = approximations.withColumn("group", F.pmod("block", F.lit(groups))).withColumn("part", _each(parts))
    asking = queries.withColumn("part", F.pmod("block", F.lit(parts))).withColumn("group", _each(groups))
    both = cells.withColumn("asks", F.lit(False)).unionByName(asking.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    both = both.withColumn("task", (F.col("group") * parts + F.col("part")).cast("int"))
    dealt = both.repartitionById(groups * parts, "task").sortWithinPartitions("task", "asks")
    columns = ["task", "asks", "keys", "dims", "data", "widths", "low", "step"]
    found = dealt.select(*columns).mapInArrow(scan, "query binary, width long, key binary, lower double, upper double")
    return common.stage(found, "bounds")


def _scores(pairs: DataFrame, exact: DataFrame, asked: DataFrame) -> DataFrame:
    """Exact inner products of pairs (query, key)."""

    @F.pandas_udf("long")
    def product(a: pd.Series, b: pd.Series) -> pd.Series:
        import numpy as np

        def exact_product(x, y) -> int:
            n = min(len(x), len(y))
            x, y = x[:n], y[:n]
            # Sums of this size are exact in doubles; larger ones are added as Python's integers.
            if float(np.abs(x) @ np.abs(y)) < float(1 << 53):
                return int(x @ y)
            return max(-(1 << 63), min((1 << 63) - 1, sum(int(p) * int(q) for p, q in zip(x, y))))

        return pd.Series([exact_product(np.asarray(x), np.asarray(y)) for x, y in zip(a, b)], dtype="int64")

    vectors = exact.select("key", F.col("values").alias("b"), "ids")
    known = pairs.join(vectors.hint("merge"), "key")
    known = known.join(asked.select(F.col("key").alias("query"), F.col("values").alias("a")).hint("merge"), "query")
    return known.select("query", "width", "key", "upper", product("a", "b").alias("score"), "ids")


def search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row of (vec_id, embedding) that is a query."""
    rows = common.stage(whole_numbers(vectors), "vectors")
    exact = common.stage(distinct_vectors(rows, k), "exact")
    keyed = rows.withColumn("key", vector_key(F.col("values")))
    asking = keyed.filter(is_query).select("vec_id", "key")
    # How many vectors the query's own rows may have among the best.
    own = keyed.join(asking.select("vec_id").distinct(), "vec_id", "left_semi").groupBy("vec_id")
    own = own.agg(F.count_distinct("key").alias("own"))
    widths = asking.distinct().join(own, "vec_id").groupBy("key").agg((F.max("own") + k).alias("width"))
    asked = common.stage(exact.hint("merge").join(widths, "key"), "asked")
    found = candidates(query_blocks(asked), approximation_file(exact))

    by_lower = Window.partitionBy("query").orderBy(F.desc("lower"))
    least = found.withColumn("n", F.row_number().over(by_lower)).filter(F.col("n") == F.col("width"))
    hopeful = found.join(least.select("query", F.col("lower").alias("least")), "query", "left")
    by_upper = Window.partitionBy("query").orderBy(F.desc("upper"), "key")
    hopeful = hopeful.filter(F.col("least").isNull() | (F.col("upper") >= F.col("least"))).select(
        "query", "width", "key", "upper", F.row_number().over(by_upper).alias("turn")
    )
    hopeful = common.stage(hopeful, "hopeful")
    early = F.col("turn") <= 2 * F.col("width")
    first = common.stage(_scores(hopeful.filter(early), exact, asked), "first-scores")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"))
    reached = first.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") == F.col("width"))
    rest = hopeful.filter(~early).join(reached.select("query", F.col("score").alias("reached")), "query", "left")
    rest = rest.filter(F.col("reached").isNull() | (F.col("upper") >= F.col("reached"))).select("query", "width", "key", "upper")
    scored = first.unionByName(_scores(rest, exact, asked)).select("query", "score", F.explode("ids").alias("of"))
    scored = scored.select("query", "score", "of.vec_id", "of.copies")
    # Of an id, k rows at most; then so many ids that k are left when the asking one goes.
    of_id = Window.partitionBy("query", "vec_id").orderBy(F.desc("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    kept = scored.withColumn("turn", F.row_number().over(of_id)).filter(F.col("turn") <= k)
    kept = kept.withColumn("ids", F.sum((F.col("turn") == 1).cast("int")).over(best)).filter(F.col("ids") <= k + 1)
    hits = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "vec_id", "score", "copies")))
    spread = common.stage(kept.groupBy("query").agg(hits.alias("best")), "best").withColumn("salt", common.salts(_SALTS))
    asking = asking.withColumn("salt", common.salt_of("vec_id", salts=_SALTS))
    answers = asking.join(spread.hint("merge"), (asking["key"] == spread["query"]) & (asking["salt"] == spread["salt"]))
    others = F.filter("best", lambda x: x["vec_id"] != F.col("query_id"))
    repeated = F.flatten(F.transform(others, lambda x: F.array_repeat(x, x["copies"].cast("int"))))
    answers = answers.select(F.col("vec_id").alias("query_id"), "best").select(
        "query_id", F.posexplode(F.slice(repeated, 1, k)).alias("at", "hit")
    )
    return answers.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
