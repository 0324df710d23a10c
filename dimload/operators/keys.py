"""Surrogate keys: dense numbers on top of a registry value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import cut_lineage
from .joins import quoted, require_columns, sql_name

# monotonically_increasing_id: task number above bit 33, place in the task below.
PLACE_BITS = 33


def row_numbers(df: DataFrame, column: str, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Number all rows 1, 2, 3, … without bringing them to one task.

    With ``order_by`` the rows are range-partitioned and sorted, so the numbers
    follow that order; it has to be a total order for repeatable numbers. Ranges
    are cut by row count on all order columns and, between equal rows, on the
    task that read them, so neither a frequent value nor many copies of a row
    make a large range. Without it the rows stay where they are and nothing is
    shuffled.

    The rows are written to the checkpoint folder once. A row's number is then
    its place in its task plus the rows of the tasks before. Only one count per
    task is added up in a single place.
    """
    if order_by:
        order = [quoted(o) if isinstance(o, str) else o for o in order_by]
        df = (
            df.withColumn("__tie", F.spark_partition_id())
            .repartitionByRange(*order, "__tie")
            .sortWithinPartitions(*order, "__tie")
            .drop("__tie")
        )
    placed = cut_lineage(df).withColumn("__at", F.monotonically_increasing_id())
    task = F.shiftright("__at", PLACE_BITS).cast("int")
    counts = placed.groupBy(task.alias("__task")).agg(F.count("*").alias("__n"))
    before = counts.select(
        "__task",
        (F.sum("__n").over(W.orderBy("__task")) - F.col("__n")).alias("__before"),
    )
    # One row per task: its size is the number of tasks, not of rows.
    numbered = placed.withColumn("__task", task).join(F.broadcast(before), "__task")
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return numbered.withColumn(column, F.col("__before") + place + 1).drop("__at", "__task", "__before")


def assign_surrogate_keys(
    df: DataFrame,
    base: int,
    key: str,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Add (or replace) ``key`` with ``base + 1, base + 2, …``, without gaps."""
    numbered = row_numbers(df.drop(key), "__number", order_by)
    columns = [sql_name(c) for c in numbered.columns if c != "__number"]
    return numbered.selectExpr(f"{int(base)}L + __number AS {sql_name(key)}", *columns)


def largest_key(df: DataFrame, key: str, base: int = 0) -> int:
    """The largest key in use, at least ``base``."""
    found = df.agg(F.max(quoted(key)).alias("k")).first()["k"]
    return base if found is None else max(base, int(found))


def advance_registry(registry: DataFrame, table_name: str, new_max: int) -> DataFrame:
    """The registry with one table's value raised; it is never lowered."""
    name, value = require_columns(registry, ["TABLE_NAME", "MAX_VALUE_KEY"], "registry")
    raised = F.greatest(quoted(value), F.lit(new_max).cast("bigint"))
    return registry.withColumn(value, F.when(quoted(name) == table_name, raised).otherwise(quoted(value)))
