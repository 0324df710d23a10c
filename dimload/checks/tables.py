"""Catalog tables written and read back."""

from pyspark.sql import functions as F

from ..operators import project, without_keys
from ..sources import TableMissing, append, cut_lineage, replace, replace_open, rewrite_rows, scan
from .registry import TestTables, query, scratch_database


class ScratchTable:
    """A new empty table with the columns of ``like``, in a database of its own."""

    def __init__(self, spark, like, layout=""):
        self.spark, self.database = spark, scratch_database(spark)
        self.name = f"{self.database}.t"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet {layout}")

    def result(self, rows):
        """The rows, written apart; the table is dropped."""
        rows = cut_lineage(rows)
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")
        return rows


@query("SELECT * FROM customer")
def scan_full_table(spark, sf):
    customer = TestTables(spark, sf).customer
    table = ScratchTable(spark, customer)
    append(customer, table.name)
    return table.result(scan(spark, table.name))


@query("SELECT *, 1 AS refused FROM supplier")
def target_must_exist(spark, sf):
    """A write without its target is refused, makes no table and loses no rows."""
    suppliers = TestTables(spark, sf).supplier
    table = ScratchTable(spark, suppliers)
    missing, refused = f"{table.database}.missing", []
    for write in (append, replace):
        try:
            write(suppliers, missing)
        except TableMissing:
            refused.append(not spark.catalog.tableExists(missing))
    append(suppliers, table.name)
    return table.result(scan(spark, table.name).withColumn("refused", F.lit(int(refused == [True, True]))))


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 300000 THEN 'large' ELSE o_orderpriority END AS o_orderpriority,
       CAST(o_orderdate >= TIMESTAMP '2000-01-01' AS INTEGER) AS is_open
FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' OR o_orderstatus <> 'F'
UNION ALL
SELECT o_orderkey, 'X', CASE WHEN o_totalprice > 300000 THEN 'large' ELSE o_orderpriority END, 0
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'F'
""")
def replace_one_partition(spark, sf):
    """Closes open rows of a table partitioned by its open flag, and corrects rows of both partitions."""
    orders = TestTables(spark, sf).orders
    is_open = (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).cast("int")
    rows = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", is_open.alias("is_open"))
    table = ScratchTable(spark, rows, "PARTITIONED BY (is_open)")
    append(rows, table.name)
    wrong, right = F.col("o_totalprice") > 300000, {"o_orderpriority": F.lit("large")}
    rewrite_rows(spark, table.name, "is_open", 0, wrong, right)
    current = cut_lineage(scan(spark, table.name, where="is_open = 1"))
    closed = current.where("o_orderstatus = 'F'").withColumns({"o_orderstatus": F.lit("X"), "is_open": F.lit(0)})
    replace_open(current.where("o_orderstatus <> 'F'"), closed, table.name, "is_open", "o_orderkey")
    for flag in (0, 1):
        rewrite_rows(spark, table.name, "is_open", flag, wrong & (F.col("o_orderpriority") != "large"), right)
    return table.result(scan(spark, table.name).select("o_orderkey", "o_orderstatus", "o_orderpriority", "is_open"))


@query("SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'")
def filter_record_type(spark, sf):
    events = TestTables(spark, sf).events
    table = ScratchTable(spark, events)
    append(events, table.name)
    names = {c: c for c in ("event_id", "user_id", "ts")}
    return table.result(scan(spark, table.name, names, where="event_type = 'error'"))


@query("SELECT count(*) AS n, CAST(sum(l_quantity * 100) AS BIGINT) AS q FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'R'")
def filter_conjunction(spark, sf):
    lines = TestTables(spark, sf).lineitem
    table = ScratchTable(spark, lines)
    append(lines, table.name)
    both = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "R")
    rows = scan(spark, table.name, {"quantity": "l_quantity"}, where=both)
    return table.result(rows.agg(F.count("*").alias("n"), F.sum(F.col("quantity") * 100).cast("bigint").alias("q")))


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
""")
def append_roundtrip(spark, sf):
    t = TestTables(spark, sf)
    table = ScratchTable(spark, t.customer)
    append(t.customer, table.name)
    append(
        project(
            t.supplier,
            {"c_acctbal": "s_acctbal", "c_custkey": "s_suppkey", "C_NAME": "s_name", "c_nationkey": "s_nationkey"},
        ),
        table.name,
    )
    return table.result(scan(spark, table.name))


SWAPPED = """
SELECT c_custkey + 1000000 AS c_custkey, c_name, c_nationkey, c_acctbal, 'moved' AS c_mktsegment
FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_acctbal <= 0
"""


def swapped(spark, sf, layout=""):
    t = TestTables(spark, sf)
    table = ScratchTable(spark, t.customer, layout)
    append(t.customer, table.name)
    gone = scan(spark, table.name, {"c_custkey": "c_custkey"}, "c_mktsegment = 'BUILDING' AND c_acctbal > 0")
    replace(without_keys(scan(spark, table.name), gone, ["c_custkey"], unique=True), table.name)
    moved = {"c_mktsegment": F.lit("moved"), "c_custkey": F.col("c_custkey") + 1000000}
    replace(scan(spark, table.name).withColumns(moved), table.name)
    return table.result(scan(spark, table.name))


@query(SWAPPED)
def replace_swap_roundtrip(spark, sf):
    """Replaces a table with rows computed from it, twice."""
    return swapped(spark, sf)


@query(SWAPPED)
def replace_swap_bucketed(spark, sf):
    return swapped(spark, sf, "CLUSTERED BY (c_custkey) INTO 4 BUCKETS")


@query(SWAPPED)
def replace_swap_partitioned(spark, sf):
    return swapped(spark, sf, "PARTITIONED BY (c_mktsegment)").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
