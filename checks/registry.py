"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sql import with_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text and doubles to six places, so both engines print alike."""
    columns = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("date", "timestamp"):
            columns[field.name] = F.col(field.name).cast("string")
        elif kind in ("double", "float"):
            columns[field.name] = F.round(F.col(field.name).cast("double"), 6)
        elif kind == "boolean":
            columns[field.name] = F.col(field.name).cast("int")
    return df.withColumns(columns) if columns else df


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its counterpart in terms of ``checks.sql.TABLES``."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(spark, folder))

        run.__module_name__ = build.__module__.rsplit(".", 1)[-1]
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return build

    return register
