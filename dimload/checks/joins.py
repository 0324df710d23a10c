"""Overlays, lookups, key resolution, deduplication, unions, surrogate keys."""

from pyspark.sql import functions as F

from .. import operators
from ..operators import (
    Feed,
    advance_registry,
    assign_surrogate_keys,
    find_hot_keys,
    first_match,
    insert_only,
    largest_key,
    lookup_overlay,
    overlay,
    overlay_chain,
    project,
    refresh,
    registry_base,
    resolve_key,
    union_rows,
    upsert_replace,
    with_registry_base,
    without_copies,
)
from .registry import TestTables, query

EVENT_ORDER = ["ts", "event_id"]


def customer_feed(events):
    """Events as a feed with many rows for some of the customers."""
    return project(
        events,
        {
            "c_custkey": "user_id",
            "c_acctbal": "value",
            "c_mktsegment": F.nullif(F.col("event_type"), F.lit("error")),
            "ts": "ts",
            "event_id": "event_id",
        },
    )


FIRST_EVENT = """
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1)
"""


@query(f"""
WITH {FIRST_EVENT}
SELECT c_custkey, c_name, c_nationkey, CASE WHEN user_id IS NULL THEN c_acctbal ELSE value END AS c_acctbal,
       CASE WHEN user_id IS NULL THEN c_mktsegment ELSE event_type END AS c_mktsegment, ts, event_id
FROM customer LEFT JOIN f ON c_custkey = user_id
""")
def overlay_first(spark, sf):
    t = TestTables(spark, sf)
    feed = project(
        t.events,
        {"c_custkey": "user_id", "c_acctbal": "value", "c_mktsegment": "event_type", "ts": "ts", "event_id": "event_id"},
    )
    return overlay(t.customer, feed, ["c_custkey"], EVENT_ORDER)


@query(f"""
WITH {FIRST_EVENT}
SELECT c_custkey, c_name, c_nationkey, CASE WHEN user_id IS NULL THEN c_acctbal ELSE value END AS c_acctbal,
       CASE WHEN user_id IS NULL THEN c_mktsegment ELSE nullif(event_type, 'error') END AS c_mktsegment
FROM customer LEFT JOIN f ON c_custkey = user_id
""")
def overlay_null_overwrite(spark, sf):
    t = TestTables(spark, sf)
    return overlay(t.customer, customer_feed(t.events), ["c_custkey"], EVENT_ORDER).drop("ts", "event_id")


@query("""
WITH l AS (
  SELECT l_orderkey, l_linestatus, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL
), f AS (
  SELECT l.l_orderkey, l.l_linestatus, l.l_partkey, max(x.l_extendedprice) AS price
  FROM l JOIN lineitem x ON l.l_orderkey = x.l_orderkey AND l.l_linestatus = x.l_linestatus AND l.l_partkey = x.l_partkey
  GROUP BY ALL
)
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN l_orderkey IS NULL THEN o_totalprice ELSE price END AS o_totalprice,
       o_orderdate, o_orderpriority, l_partkey
FROM orders LEFT JOIN f ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus
""")
def overlay_composite_key(spark, sf):
    t = TestTables(spark, sf)
    feed = project(
        t.lineitem,
        {"o_orderkey": "l_orderkey", "o_orderstatus": "l_linestatus", "o_totalprice": "l_extendedprice", "l_partkey": "l_partkey"},
    )
    return overlay(t.orders, feed, ["o_orderkey", "o_orderstatus"], ["l_partkey", -F.col("o_totalprice")])


@query("""
WITH n AS (
  SELECT * FROM (SELECT CASE WHEN n_nationkey > 1 THEN n_nationkey END AS k, n_name,
                        row_number() OVER (PARTITION BY CASE WHEN n_nationkey > 1 THEN n_nationkey END ORDER BY n_nationkey) AS rn FROM nation)
  WHERE rn = 1
)
SELECT c_custkey, nullif(c_nationkey, 0) AS k, CASE WHEN n.rn IS NULL THEN c_mktsegment ELSE n.n_name END AS c_mktsegment
FROM customer LEFT JOIN n ON nullif(c_nationkey, 0) IS NOT DISTINCT FROM n.k
""")
def overlay_null_key(spark, sf):
    t = TestTables(spark, sf)
    left = project(
        t.customer,
        {"c_custkey": "c_custkey", "k": F.nullif(F.col("c_nationkey"), F.lit(0)), "c_mktsegment": "c_mktsegment"},
    )
    right = project(
        t.nation,
        {"k": F.when(F.col("n_nationkey") > 1, F.col("n_nationkey")), "c_mktsegment": "n_name", "n": "n_nationkey"},
    )
    return overlay(left, right, ["k"], ["n"], null_safe=True, hot=find_hot_keys(left, ["k"])).drop("n")


@query("""
WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate, l_linestatus,
       CASE WHEN o.rn IS NULL THEN l_returnflag ELSE o_orderpriority END AS l_returnflag, o_orderdate, o_orderkey
FROM lineitem LEFT JOIN o ON l_linestatus = o_orderstatus
""")
def overlay_hot_keys(spark, sf):
    """Two keys hold all left rows; they are spread over the tasks."""
    t = TestTables(spark, sf)
    left = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate", "l_linestatus", "l_returnflag"
    )
    right = project(
        t.orders,
        {"l_linestatus": "o_orderstatus", "l_returnflag": "o_orderpriority", "o_orderdate": "o_orderdate", "o_orderkey": "o_orderkey"},
    )
    return overlay(
        left, right, ["l_linestatus"], ["o_orderdate", "o_orderkey"], hot=find_hot_keys(left, ["l_linestatus"])
    )


@query("""
WITH e AS (
  SELECT user_id, event_type, value, ts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events
), p AS (SELECT * FROM e WHERE rn = 1 AND event_type = 'purchase'),
   v AS (SELECT * FROM e WHERE rn = 1 AND event_type = 'view'),
   s AS (SELECT * FROM e WHERE rn = 1 AND event_type = 'signup' AND value > 20)
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN v.user_id IS NOT NULL THEN v.value WHEN p.user_id IS NOT NULL THEN p.value ELSE c_acctbal END AS c_acctbal,
       CASE WHEN s.user_id IS NOT NULL THEN 'signup' ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN s.user_id IS NOT NULL THEN s.ts ELSE p.ts END AS seen_ts
FROM customer LEFT JOIN p ON c_custkey = p.user_id LEFT JOIN v ON c_custkey = v.user_id LEFT JOIN s ON c_custkey = s.user_id
""")
def overlay_chain_feeds(spark, sf):
    t = TestTables(spark, sf)

    def feed(kind, columns):
        rows = t.events.where(F.col("event_type") == kind)
        return project(rows, {"c_custkey": "user_id", **columns, "event_id": "event_id", "ts": "ts"})

    purchases = feed("purchase", {"c_acctbal": "value", "seen_ts": "ts"})
    views = feed("view", {"c_acctbal": "value"})
    signups = feed("signup", {"c_mktsegment": "event_type", "seen_ts": "ts", "value": "value"})
    signups = first_match(signups, ["c_custkey"], EVENT_ORDER).where("value > 20").drop("value")
    out = overlay_chain(t.customer, [Feed(f, EVENT_ORDER) for f in (purchases, views, signups)], ["c_custkey"])
    return out.drop("event_id", "ts")


@query("SELECT * FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def insert_only_new(spark, sf):
    t = TestTables(spark, sf)
    return insert_only(t.customer, t.events.select(F.col("user_id").alias("c_custkey")), ["c_custkey"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')")
def insert_only_prefiltered(spark, sf):
    """Staged keys as if they were too many to copy: a Bloom filter of them goes to the target's scan."""
    t = TestTables(spark, sf)
    stored = t.customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return insert_only(t.orders.select("o_orderkey", "o_custkey"), stored, ["o_custkey"], unique=True, prefilter=True)


@query("""
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders n WHERE o_orderdate >= TIMESTAMP '2000-01-01'
AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderdate < TIMESTAMP '2000-01-01' AND o.o_custkey = n.o_custkey AND o.o_orderpriority = n.o_orderpriority)
""")
def insert_only_composite(spark, sf):
    t = TestTables(spark, sf)
    keys = ["o_custkey", "o_orderpriority"]
    split = F.lit("2000-01-01").cast("timestamp_ntz")
    new = t.orders.where(F.col("o_orderdate") >= split).select("o_orderkey", *keys)
    return insert_only(new, t.orders.where(F.col("o_orderdate") < split), keys, hot=find_hot_keys(new, keys))


@query("""
SELECT user_id * 17 AS customer_id, event_id, c_nationkey AS nation_key
FROM events JOIN customer ON user_id * 17 = c_custkey
""")
def resolve_key_accepted(spark, sf):
    return resolved_events(spark, sf).accepted


@query("""
SELECT user_id * 17 AS customer_id, event_id, 'customer not found' AS REJECT_REASON
FROM events WHERE user_id * 17 NOT IN (SELECT c_custkey FROM customer)
""")
def resolve_key_rejects(spark, sf):
    return resolved_events(spark, sf).rejected


def resolved_events(spark, sf):
    t = TestTables(spark, sf)
    rows = t.events.select((F.col("user_id") * 17).alias("customer_id"), "event_id")
    reference = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("nation_key"))
    return resolve_key(
        rows, reference, ["customer_id"], unique=True,
        hot=find_hot_keys(rows, ["customer_id"]), reason="customer not found",
    )


def registry(t):
    """The region table as a registry of surrogate keys."""
    return t.region.select(
        F.col("r_name").alias("TABLE_NAME"), (F.col("r_regionkey").cast("bigint") * 1000000).alias("MAX_VALUE_KEY")
    )


@query("""
SELECT c_custkey, CAST(r_regionkey AS BIGINT) * 1000000 AS MAX_VALUE_KEY, CAST(r_regionkey AS BIGINT) * 1000000 + c_custkey AS shifted
FROM customer, region WHERE r_name = 'ASIA'
""")
def registry_cross(spark, sf):
    t = TestTables(spark, sf)
    rows = with_registry_base(t.customer.select("c_custkey"), registry(t), "ASIA")
    return rows.withColumn("shifted", F.col("MAX_VALUE_KEY") + F.col("c_custkey"))


@query("SELECT DISTINCT user_id FROM events")
def distinct_keys(spark, sf):
    return operators.distinct_keys(TestTables(spark, sf).events, ["USER_ID"])


@query("SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders")
def drop_duplicates(spark, sf):
    return without_copies(TestTables(spark, sf).orders.select("o_custkey", "o_orderpriority", "o_orderstatus"))


@query("""
SELECT 'key ' || c_custkey AS customer, c_nationkey AS nation, n_name AS nation_name, c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 AND n_nationkey < 12
""")
def plain_functions(spark, sf):
    """What pipelines do by classes of their own, as functions from frame to frame: a step of
    several operators, rows to none or one, a side table, filters, a key beside each row."""
    t = TestTables(spark, sf)

    def above(rows, column, least):
        return rows.where(F.col(column) > least)

    def with_nations(rows, nations):
        return lookup_overlay(rows, nations, ["nation"], unique=True).where("nation < 12")

    def keyed(rows):
        return rows.withColumn("customer", F.concat(F.lit("key "), F.col("customer").cast("string")))

    nations = project(t.nation, {"nation": "n_nationkey", "nation_name": "n_name"})
    rows = project(t.customer, {"customer": "c_custkey", "nation": "c_nationkey", "balance": "c_acctbal"})
    return rows.transform(above, "balance", 0).transform(with_nations, nations).transform(keyed)


@query("""
SELECT r_name AS TABLE_NAME, CASE WHEN r_name = 'AFRICA' THEN greatest(r_regionkey * CAST(1000000 AS BIGINT), (SELECT max(c_custkey) FROM customer))
                             ELSE r_regionkey * CAST(1000000 AS BIGINT) END AS MAX_VALUE_KEY
FROM region
""")
def max_key(spark, sf):
    t = TestTables(spark, sf)
    return advance_registry(registry(t), "AFRICA", largest_key(t.customer, "c_custkey"))


@query("""
SELECT (SELECT CAST(r_regionkey AS BIGINT) * 1000000 FROM region WHERE r_name = 'ASIA')
         + row_number() OVER (ORDER BY o_custkey, o_orderpriority, o_orderkey) AS order_sk,
       o_orderkey, o_custkey, o_orderpriority
FROM orders
""")
def surrogate_keys(spark, sf):
    t = TestTables(spark, sf)
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return assign_surrogate_keys(
        rows, registry_base(registry(t), "ASIA"), "order_sk", ["o_custkey", "o_orderpriority", "o_orderkey"]
    )


@query("""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier
""")
def union_by_name(spark, sf):
    t = TestTables(spark, sf)
    customers = project(t.customer, {"id": "c_custkey", "name": "c_name", "nation": "c_nationkey", "segment": "c_mktsegment"})
    suppliers = project(t.supplier, {"balance": "s_acctbal", "nation": "s_nationkey", "name": "s_name", "ID": "s_suppkey"})
    return union_rows(customers, suppliers)


@query("""
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')
UNION ALL
SELECT user_id, props, NULL, value, NULL FROM events WHERE event_type = 'purchase'
""")
def upsert_replace_rows(spark, sf):
    t = TestTables(spark, sf)
    staged = project(
        t.events.where(F.col("event_type") == "purchase"),
        {"c_custkey": "user_id", "c_acctbal": "value", "c_name": "props"},
    )
    return upsert_replace(t.customer, staged, ["c_custkey"])


REFRESHED = """
WITH {first}
SELECT c_custkey, c_name, c_nationkey, CASE WHEN user_id IS NULL THEN {bal} ELSE value END AS c_acctbal,
       CASE WHEN user_id IS NULL THEN {seg} ELSE nullif(event_type, 'error') END AS c_mktsegment
FROM customer LEFT JOIN f ON c_custkey = user_id
"""


def first_events(t):
    """One row per customer, in the target's own columns."""
    return first_match(customer_feed(t.events), ["c_custkey"], EVENT_ORDER).drop("ts", "event_id")


@query(REFRESHED.format(first=FIRST_EVENT, bal="c_acctbal", seg="c_mktsegment"))
def refresh_missing_keep(spark, sf):
    t = TestTables(spark, sf)
    return refresh(t.customer, first_events(t), ["c_custkey"], unique=True)


@query(REFRESHED.format(first=FIRST_EVENT, bal="NULL", seg="NULL").replace("c_nationkey,", "CAST(NULL AS INTEGER) AS c_nationkey,"))
def refresh_missing_null(spark, sf):
    t = TestTables(spark, sf)
    return refresh(
        t.customer, first_events(t), ["c_custkey"], unique=True, on_missing="null", also_erase=["c_nationkey"]
    )
