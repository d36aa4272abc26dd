"""Registration of queries with their reference SQL, in a form both sides print alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(rows: DataFrame) -> DataFrame:
    """Days and times as text, doubles rounded: sums differ in the last bits by order."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def _portable_sql(spec: str) -> str:
    """``d:`` marks a day, ``t:`` a time, ``f:`` a double, ``i:`` a count."""
    layouts = {
        "d": "strftime(cast({0} as date), '%Y-%m-%d')",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
        "f": "round(cast({0} as double), 6)",
        "i": "cast({0} as bigint)",
    }
    columns = []
    for item in spec.split():
        kind, _, name = item.rpartition(":")
        columns.append(f"{layouts.get(kind, '{0}').format(name)} as {name}")
    return ", ".join(columns)


def register(name: str, columns: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; with ``sql`` it is compared on ``columns``."""
    from catalog.oracle import BASE

    def add(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(query(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = f"with {BASE} select {_portable_sql(columns)} from ({sql}) as answer"
        return query

    return add
