"""Tables and reports for SQL: a view per table and report, and a table function per report.

After ``register(tables)`` a session knows ``SELECT * FROM fact_trip``, ``SELECT * FROM zone_top_pickup`` with the
report's usual arguments, and ``SELECT * FROM zone_top_pickup(5)`` or ``zone_top_pickup(`limit` => 5)``. Functions are
expanded into the query around them, so filters and columns reach the scan, and a limit is planned as a top-k (in the
three reports with a rank, above the window that ranks all zones or routes).
"""

from __future__ import annotations

import inspect

from pyspark.sql import DataFrame

from tripmill.functions.arguments import API_ROWS, EVERY
from tripmill.plans import catalog
from tripmill.plans.tables import REPORTED, TripTables

TABLES = [*REPORTED, "summary_statistics", "load_audit"]


def register(tables: TripTables) -> list[str]:
    """Views and functions over ``tables`` for the session; gives the names of the reports."""
    for name in TABLES:
        getattr(tables, name).createOrReplaceTempView(name)
    registered = []
    for name, report in catalog.REPORTS.items():
        if name in TABLES:
            continue
        try:
            plain = catalog.run(name, tables)
        except ValueError:  # a report over raw trips, where only loaded tables are at hand
            continue
        plain.createOrReplaceTempView(name)
        usual = inspect.signature(report).parameters.get("limit")
        if usual is None:
            _create(tables, name, "", plain, f"SELECT * FROM {name}")
        else:
            everything = f"{name}_in_order"
            catalog.run(name, tables, limit=EVERY).createOrReplaceTempView(everything)
            columns = ", ".join(f"`{c}`" for c in plain.columns)
            most = API_ROWS if name.startswith("api_") else (1 << 31) - 1
            # A limit out of range leaves no row to count on, hence the check beside the filter.
            allowed = f"if({name}.`limit` BETWEEN 1 AND {most}, {name}.`limit`, raise_error('limit must be between 1 and {most}'))"
            body = f"SELECT {columns} FROM {everything} WHERE position <= {allowed} ORDER BY position"
            _create(tables, name, f"`limit` INT DEFAULT {usual.default}", plain, body)
        registered.append(name)
    return registered


def _create(tables: TripTables, name: str, arguments: str, result: DataFrame, body: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema)
    tables.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}")
