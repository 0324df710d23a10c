"""Scans, projections, scalar expressions and filters."""

from pyspark.sql import functions as F

from ..functions import (
    OPEN_BEGIN,
    OPEN_END,
    area_code,
    batch_number,
    blank_to_zero,
    constant,
    indicator,
    parse_compact,
    plus_days,
    text_to_long,
    text_to_timestamp,
    timestamp_literal,
    to_second,
    unknown_key,
    void_flag,
    zip4,
    zip5,
)
from ..operators import project
from ..plans.feeds import stamp
from .registry import BATCH_TS, TestTables, plain_times, query


@query("""
SELECT c_custkey AS customer_id, c_custkey AS merged_source_id, c_name AS customer_name,
       c_nationkey AS billing_nation, c_nationkey AS primary_nation
FROM customer
""")
def scan_project_rename(spark, sf):
    return project(
        TestTables(spark, sf).customer,
        {
            "customer_id": "c_custkey",
            "merged_source_id": "c_custkey",
            "customer_name": "c_name",
            "billing_nation": "c_nationkey",
            "primary_nation": "c_nationkey",
        },
    )


@query("""
SELECT c_custkey AS customer_id, CAST(999999999999 AS BIGINT) AS address_key, 'CLIC' AS source_system,
       CAST(0 AS INTEGER) AS purged_ind, TIMESTAMP '1990-01-01 00:00:00' AS begin_dt,
       TIMESTAMP '2099-12-31 00:00:00' AS end_dt, CAST(NULL AS BIGINT) AS merged_id,
       CAST(20191122100000 AS BIGINT) AS UPD_BATCH_NBR, CAST(20191122100000 AS BIGINT) AS INS_BATCH_NBR
FROM customer
""")
def constants_sentinels(spark, sf):
    df = project(
        TestTables(spark, sf).customer,
        {
            "customer_id": "c_custkey",
            "address_key": unknown_key(),
            "source_system": F.lit("CLIC"),
            "purged_ind": constant(0, "int"),
            "begin_dt": timestamp_literal(OPEN_BEGIN, "timestamp_ntz"),
            "end_dt": timestamp_literal(OPEN_END, "timestamp_ntz"),
            "merged_id": constant(None, "bigint"),
        },
    )
    return stamp(df, BATCH_TS, insert=True)


@query("""
SELECT c_custkey, CAST(substr(c_name, 10) AS BIGINT) AS account, CAST(substr(substr(c_name, 13), 1, 3) AS BIGINT) AS area,
       TRY_CAST(c_name AS BIGINT) AS not_a_number
FROM customer
""")
def cast_text_to_long(spark, sf):
    digits = F.substring("c_name", 13, 9)
    return project(
        TestTables(spark, sf).customer,
        {
            "c_custkey": "c_custkey",
            "account": text_to_long(F.substring("c_name", 10, 9)),
            "area": area_code(digits),
            "not_a_number": text_to_long("c_name", strict=False),
        },
    )


@query("""
SELECT c_custkey, substr(z, 1, 5) AS postal_zip, substr(z, 6, 9) AS postal_zip4
FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN substr(c_name, 10, 5) || '-' || substr(c_name, 15, 4)
                             WHEN c_mktsegment = 'MACHINERY' THEN substr(c_name, 16)
                             WHEN c_mktsegment = 'FURNITURE' THEN NULL
                             ELSE substr(c_name, 10) END AS z FROM customer)
""")
def zip_split(spark, sf):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    z = (
        F.when(segment == "BUILDING", F.concat(F.substring(name, 10, 5), F.lit("-"), F.substring(name, 15, 4)))
        .when(segment == "MACHINERY", F.substring(name, 16, 9))
        .when(segment == "FURNITURE", None)
        .otherwise(F.substring(name, 10, 9))
    )
    return project(
        TestTables(spark, sf).customer,
        {"c_custkey": "c_custkey", "postal_zip": zip5(z), "postal_zip4": zip4(z)},
    )


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN NULL
                 ELSE CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS sync_ind
FROM events
""")
def blank_to_zero_text(spark, sf):
    text = (
        F.when(F.col("event_type") == "click", "")
        .when(F.col("event_type") == "view", None)
        .otherwise(F.regexp_replace("props", "[^0-9]", ""))
    )
    return project(TestTables(spark, sf).events, {"event_id": "event_id", "sync_ind": blank_to_zero(text)})


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(coalesce(nullif(l_returnflag, 'N') = 'A', false) AS INTEGER) AS accepted_ind,
       CAST(l_linestatus = 'O' AS INTEGER) AS open_ind, CAST(NOT (l_linestatus = 'O') AS INTEGER) AS closed_ind
FROM lineitem
""")
def flag_indicators(spark, sf):
    return project(
        TestTables(spark, sf).lineitem,
        {
            "l_orderkey": "l_orderkey",
            "l_linenumber": "l_linenumber",
            "l_partkey": "l_partkey",
            "accepted_ind": indicator(F.nullif(F.col("l_returnflag"), F.lit("N")), "A"),
            "open_ind": indicator("l_linestatus", "O"),
            "closed_ind": indicator("l_linestatus", "F"),
        },
    )


@query("""
SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y%m%d') || '120203', '%Y%m%d%H%M%S') AS parsed,
       CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS casted, CAST(NULL AS TIMESTAMP) AS unreadable
FROM orders
""")
def parse_compact_ts(spark, sf):
    return plain_times(
        project(
            TestTables(spark, sf).orders,
            {
                "o_orderkey": "o_orderkey",
                "parsed": parse_compact(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("120203"))),
                "casted": text_to_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
                "unreadable": parse_compact("o_orderpriority", strict=False),
            },
        )
    )


@query("""
SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS batch_nbr, date_trunc('second', ts) AS to_second,
       ts + INTERVAL 1 DAY AS next_day, CAST(ts > TIMESTAMP '2024-01-15 12:00:00' AS INTEGER) AS late_ind
FROM events
""")
def batch_audit_stamp(spark, sf):
    return plain_times(
        project(
            TestTables(spark, sf).events,
            {
                "event_id": "event_id",
                "batch_nbr": batch_number("ts"),
                "to_second": to_second("ts").cast("timestamp_ntz"),
                "next_day": plus_days("ts", 1),
                "late_ind": void_flag("ts", timestamp_literal("2024-01-15 12:00:00", "timestamp_ntz")),
            },
        )
    )
