"""Queries over the test tables, each beside SQL that states the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import cache, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

BATCH_TS = "2019-11-22 10:00:00.9"
BATCH_NBR = 20191122100000


#: Databases made by the query that runs.
_databases: ContextVar[list[str] | None] = ContextVar("databases", default=None)


def scratch_database(spark: SparkSession) -> str:
    """A new database in the scratch folder; the query drops it when its rows are written apart."""
    name = f"dimload_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark)}/{name}'")
    made = _databases.get()
    if made is not None:
        made.append(name)
    return name


def query(sql: str):
    """Register a function under its name with its SQL twin. Of a query that fails no database stays."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            made: list[str] = []
            before = _databases.set(made)
            try:
                return function(spark, sf_dir)
            except BaseException:
                for name in made:
                    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
                raise
            finally:
                _databases.reset(before)

        QUERIES[function.__name__] = run
        ORACLE[function.__name__] = sql
        return function

    return register


class TestTables:
    """The test tables of one scale."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, so results do not depend on the session's."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.simpleString() == "timestamp" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@cache
def load_all() -> None:
    """Import every module that registers queries."""
    from . import columns, customers, jobs, joins, tables, versions  # noqa: F401
