"""Deterministic top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.arguments import EVERY, _Every

def top(df: DataFrame, limit: int | _Every, *order: Column) -> DataFrame:
    """First ``limit`` rows by ``order``; remaining ties go by every column.

    Planned as TakeOrderedAndProject: each task keeps ``limit`` rows, nothing is shuffled. With ``EVERY`` all rows get
    their position; a filter on it, as the SQL functions have, is planned the same way.
    """
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns]
    if limit is EVERY:
        return df.withColumn("position", F.row_number().over(Window.orderBy(*order, *ties)))
    return df.orderBy(*order, *ties).limit(limit)


def top_ranked(df: DataFrame, limit: int | _Every, by: str, rank: str) -> DataFrame:
    """Top rows by ``by``, largest first, with their SQL rank.

    A row's rank depends only on rows above it, so ranking the ``limit`` kept rows gives
    the same numbers as ranking them all, without sorting everything in one task.
    """
    order = F.col(by).desc_nulls_last()
    kept = top(df, limit, order)
    return kept.withColumn(rank, F.rank().over(Window.orderBy(order)).cast("bigint"))


def over_all(total: Column) -> Column:
    """An aggregate over all rows of a result that is already grouped and small."""
    return total.over(Window.partitionBy())
