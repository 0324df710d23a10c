"""Reading and writing warehouse tables.

Only this module writes. A load never creates its target: the table and its
schema must exist, and the frame is fitted to that schema before it is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.shape import align, project
from . import files


class TableMissing(Exception):
    pass


def require_table(spark: SparkSession, table: str) -> None:
    if not spark.catalog.tableExists(table):
        raise TableMissing(f"{table} does not exist; a load does not create its target")


def scan(
    spark: SparkSession,
    table: str,
    columns: Mapping[str, str | Column] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """A table, optionally filtered and projected to ``{output: input}``."""
    df = spark.table(table)
    if where is not None:
        df = df.where(where)
    if columns is None:
        return df
    return project(df, columns)


def facts(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table, by name."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns of a table; 0 if it has none."""
    known = facts(spark, table)
    columns = known.get("Bucket Columns", "[]").strip("[]")
    return int(known.get("Num Buckets", 0)), [c.strip(" `") for c in columns.split(",") if c.strip()]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def gathered(rows: DataFrame, table: str) -> DataFrame:
    """Rows brought together by the table's partitions and buckets.

    Otherwise every task would write a file into every one of them. A partition
    or bucket with very many rows is split over several tasks and files.
    """
    spark = rows.sparkSession
    buckets, columns = bucketing(spark, table)
    columns = partition_columns(spark, table) + columns
    if not columns:
        return rows
    return rows.hint("rebalance", *([buckets] if buckets else []), *columns)


def append(df: DataFrame, table: str) -> None:
    """Add rows to an existing table, gathered by its partitions and buckets."""
    spark = df.sparkSession
    require_table(spark, table)
    gathered(align(df, spark.table(table).schema), table).write.insertInto(table)


def _side_names(table: str) -> tuple[str, str, str]:
    head, _, last = table.rpartition(".")
    prefix = f"{head}." if head else ""
    return f"{prefix}{last}__next", f"{prefix}{last}__before", table


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a replacement that stopped half way; every load begins with it.

    Without the target, the version before it is renamed back. With the target,
    leftovers of the replacement are dropped. A replaced partition or rewritten files
    (``replace_open``, ``rewrite_rows``) are put in place if they were complete, and
    removed if not.
    """
    following, before, table = _side_names(table)
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(before):
        spark.sql(f"ALTER TABLE {before} RENAME TO {table}")
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {before}")
        spark.sql(f"DROP TABLE IF EXISTS {table}__apart")
        if spark.catalog.tableExists(f"{table}__rewrite"):
            _swap_files(spark, table)
        if spark.catalog.tableExists(f"{table}__closed"):
            _publish_open(spark, table, again=True)
    spark.sql(f"DROP TABLE IF EXISTS {following}")


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def partition_location(spark: SparkSession, table: str, flag: str, value: int) -> str | None:
    """Where the files of a partition lie; None if the catalog has no such partition."""
    spec = f"PARTITION (`{flag}` = {value})"
    if not spark.sql(f"SHOW PARTITIONS {table} {spec}").collect():
        return None
    described = spark.sql(f"DESCRIBE EXTENDED {table} {spec}").collect()
    return next(r["data_type"] for r in described if r["col_name"] == "Location")


def _write_apart(rows: DataFrame, table: str, folder: str) -> None:
    """Write rows as the table would, its partitions and buckets included, to another folder."""
    spark = rows.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}__apart")
    spark.sql(f"CREATE TABLE {table}__apart LIKE {table} LOCATION '{folder}'")
    fitted = align(rows, spark.table(table).schema)
    buckets, by = bucketing(spark, table)
    if buckets:
        fitted = fitted.hint("rebalance", buckets, *by)
    fitted.write.insertInto(f"{table}__apart")
    spark.sql(f"DROP TABLE {table}__apart")  # it is external: the files stay


def _side_table(spark: SparkSession, side: str, columns: str, properties: dict[str, str]) -> None:
    pairs = ", ".join(f"'dimload.{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"CREATE TABLE {side} ({columns}) USING parquet TBLPROPERTIES ({pairs})")


def _complete(spark: SparkSession, side: str) -> None:
    spark.sql(f"ALTER TABLE {side} SET TBLPROPERTIES ('dimload.complete' = 'true')")


def _known(spark: SparkSession, side: str) -> dict[str, str]:
    return {k.removeprefix("dimload."): v for k, v in _properties(spark, side).items() if k.startswith("dimload.")}


def replace_open(open_rows: DataFrame, closed_rows: DataFrame, table: str, flag: str, key: str) -> None:
    """Replace the open rows of a table partitioned by its open flag (1 or 0), and add
    closed ones to the others. Files of closed rows are neither read nor written again.

    Neither frame may read the table any more (see ``cut_lineage``). The closed rows go to
    ``<table>__closed``, the open ones to files in a new folder of the table. Until both are
    complete nothing in the table changes, whatever fails. Then the open partition is pointed at the new
    folder, in one step of the catalog, the closed rows are filed and the files
    it had before are deleted; ``recover`` finishes that. ``key`` tells rows apart.
    """
    spark = open_rows.sparkSession
    recover(spark, table)
    side, schema = f"{table}__closed", spark.table(table).schema
    folder = f"{facts(spark, table)['Location']}/_open-{uuid.uuid4().hex}"
    old = partition_location(spark, table, flag, 1) or ""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    _side_table(spark, side, columns, {"key": key, "flag": flag, "folder": folder, "old": old})
    align(closed_rows, schema).write.insertInto(side)
    _write_apart(align(open_rows, schema).where(f"`{flag}` = 1"), table, folder)
    _complete(spark, side)
    _publish_open(spark, table)


def _publish_open(spark: SparkSession, table: str, again: bool = False) -> None:
    """Put a complete replacement of the open partition in place, or remove an incomplete one."""
    side = f"{table}__closed"
    known = _known(spark, side)
    key, flag, folder = known["key"], known["flag"], known["folder"]
    if known.get("complete") == "true":
        place = f"{folder}/{flag}=1"
        files.make_folder(spark, place)
        now = partition_location(spark, table, flag, 1)
        if now is None:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION (`{flag}` = 1) LOCATION '{place}'")
        elif now != place:
            spark.sql(f"ALTER TABLE {table} PARTITION (`{flag}` = 1) SET LOCATION '{place}'")
        spark.catalog.refreshTable(table)
        closed = spark.table(side)
        if again:  # some may have been filed
            closed = closed.join(spark.table(table).where(f"`{flag}` = 0").select(key), key, "left_anti")
        append(closed, table)
        if known["old"] and known["old"] != place:
            above = known["old"].rsplit("/", 1)[0]
            files.delete(spark, above if above.rsplit("/", 1)[-1].startswith("_open-") else known["old"])
    else:
        files.delete(spark, folder)
    spark.sql(f"DROP TABLE {side}")


def rewrite_rows(spark: SparkSession, table: str, flag: str, value: int, wrong: Column, right: Mapping[str, Column]) -> int:
    """Correct the rows of one partition where ``wrong`` holds; returns how many files that took.

    Only files with such rows are read whole and written again, with the columns ``right``;
    all others stay as they are. The new files are complete, and the old ones listed in
    ``<table>__rewrite``, before anything in the partition changes. Then the new ones are moved in
    and the old ones deleted; ``recover`` finishes that. No row is missing at any time; one that reads the
    table meanwhile may see rows of both.
    """
    recover(spark, table)
    rows = spark.table(table).where(F.col(flag) == value)
    paths = [r["file_path"] for r in rows.where(wrong).select("_metadata.file_path").distinct().collect()]
    if not paths:
        return 0
    side, known = f"{table}__rewrite", facts(spark, table)
    folder = f"{known['Location']}/_rewritten-{uuid.uuid4().hex}"
    _side_table(spark, side, "path STRING", {"flag": flag, "value": str(value), "folder": folder})
    spark.createDataFrame([(p,) for p in paths], "path string").write.insertInto(side)
    stored = StructType([f for f in spark.table(table).schema.fields if f.name != flag])
    some = spark.read.format(known["Provider"]).schema(stored).load([unquote(p) for p in paths])
    some = some.withColumn(flag, F.lit(value))
    _write_apart(some.withColumns({c: F.when(wrong, v).otherwise(F.col(c)) for c, v in right.items()}), table, folder)
    _complete(spark, side)
    _swap_files(spark, table)
    return len(paths)


def _swap_files(spark: SparkSession, table: str) -> None:
    """Put complete rewritten files in the place of those they replace, or remove incomplete ones."""
    side = f"{table}__rewrite"
    known = _known(spark, side)
    if known.get("complete") == "true":
        place = partition_location(spark, table, known["flag"], int(known["value"]))
        for path in files.children(spark, f"{known['folder']}/{known['flag']}={known['value']}"):
            if not files.move(spark, path, f"{place}/{path.rsplit('/', 1)[-1]}"):
                raise OSError(f"{path} could not be moved to {place}")
        for r in spark.table(side).collect():
            files.delete(spark, r["path"])
        spark.catalog.refreshTable(table)
    files.delete(spark, known["folder"])
    spark.sql(f"DROP TABLE {side}")


def _like(spark: SparkSession, table: str, new: str) -> None:
    """A new empty table with the layout, comment and properties of another."""
    spark.sql(f"CREATE TABLE {new} LIKE {table}")
    passing = ("transient_", "spark.sql.", "numFiles", "totalSize")
    kept = {k: v for k, v in _properties(spark, table).items() if not k.startswith(passing)}
    literal = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if kept:
        pairs = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in kept.items())
        spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ({pairs})")
    comment = facts(spark, table).get("Comment")
    if comment:
        spark.sql(f"COMMENT ON TABLE {new} IS {literal(comment)}")


def replace(df: DataFrame, table: str) -> None:
    """Replace all rows of a table, also with a frame that reads that table.

    The rows go to a new table with the target's format, partitioning, bucketing,
    comment and properties, which then takes its name. The target is untouched
    until the new rows are complete, and its old rows are kept until the new table
    is in place. An external table is refused: its files would not move with the
    name.
    """
    spark = df.sparkSession
    following, before, table = _side_names(table)
    recover(spark, table)
    require_table(spark, table)
    if facts(spark, table).get("Type") == "EXTERNAL":
        raise ValueError(f"{table} is external: replacing it by name would leave its files and location behind")
    fitted = align(df, spark.table(table).schema)
    _like(spark, table, following)
    gathered(fitted, table).write.insertInto(following)
    spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    spark.sql(f"DROP TABLE {before}")
    spark.catalog.refreshTable(table)
