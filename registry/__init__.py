"""Checked queries: each operator on the given tables, beside its SQL.

``QUERIES`` maps a name to a callable (spark, folder) -> DataFrame, ``ORACLE`` the
same name to SQL over views of the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL it must equal."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


from registry import columns, drops, hotels, joins, schemas, upserts, writes  # noqa: E402,F401
