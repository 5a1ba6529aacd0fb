"""The registry that the modules of the query catalogue fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: A common table expression: the turns of every conversation, numbered from 0.
TURNS = "c AS (SELECT conv_id AS rid, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role, text FROM conversations)"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that checks it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
