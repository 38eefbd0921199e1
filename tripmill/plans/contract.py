"""The contract of the stored tables, checked before a batch can be seen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import schema
from tripmill.functions.exact import count_where
from tripmill.sources import store


class ContractError(ValueError):
    """A table that was to be written breaks its contract; ``violations`` has (table, rule, rows)."""

    def __init__(self, violations: list[tuple[str, str, int]]) -> None:
        self.violations = violations
        super().__init__("; ".join(f"{table}: {rule} broken by {rows} rows" for table, rule, rows in violations))


def table_violations(rows: DataFrame, name: str) -> list[tuple[str, str, int]]:
    """Nulls in required columns, and rows whose key another one has, of a table by itself."""
    absent = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in schema.REQUIRED[name]])
    nulls = rows.agg(count_where(absent)).first()[0]
    repeated = rows.groupBy(schema.PRIMARY_KEY[name]).agg((F.count("*") - 1).alias("extra")).filter("extra > 0")
    extra = repeated.agg(F.coalesce(F.sum("extra"), F.lit(0))).first()[0]
    found = [(name, "not null", nulls), (name, "primary key", extra)]
    return [v for v in found if v[2]]


def batch_violations(spark: SparkSession, path: str, batch: str, earlier: list[str]) -> list[tuple[str, str, int]]:
    """Violations of a batch of trips that lies in its partitions but is not listed yet.

    Its own rows are read, and of the ``earlier`` batches those row groups alone whose ids reach into its range: ids
    made of file numbers never do, so such batches cost no more the more there are.
    """
    key = schema.PRIMARY_KEY["fact_trip"]
    stored = store.read_table(spark, path, "fact_trip")
    new = stored.filter(F.col("load_batch") == batch)
    found = table_violations(new, "fact_trip")
    low, high = new.agg(F.min(key), F.max(key)).first()
    if low is not None and earlier:
        old = stored.filter(F.col("load_batch").isin(earlier)).filter(F.col(key).between(low, high))
        clashes = new.select(key).join(old.select(key), key, "left_semi").count()
        if clashes:
            found.append(("fact_trip", "primary key of an earlier batch", clashes))
    return found
