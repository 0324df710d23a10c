"""The plans are the ones meant for large tables."""

import re

import pytest
from pyspark.sql import functions as F

from dimload.operators import (
    Feed,
    assign_surrogate_keys,
    expire,
    fits_broadcast,
    insert_only,
    new_versions,
    overlay,
    overlay_chain,
    resolve_key,
    role_keys,
    settle,
)
from dimload.plans import ADDRESS_LAYOUT, ADDRESS_SCHEMA
from dimload.sources import append, scan

LEFT_SIDE = r"Exchange hashpartitioning\((?:cust|CUSTOMER_ID)#\d+L, 8\)"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Joins are planned as if no side were small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def target(spark):
    return spark.range(100).selectExpr("id AS cust", "id * 2 AS ck", "string(id) AS a", "string(id) AS b", "id AS c")


def feed(spark, column):
    return spark.range(50).selectExpr("id AS cust", f"string(id) AS {column}", "id AS ord_" + column)


def test_a_chain_shuffles_the_target_once(spark, target, large):
    steps = [Feed(feed(spark, c), [f"ord_{c}"]) for c in ("a", "b", "c")]
    text = plan(overlay_chain(target, steps, ["cust"]))
    assert text.count("SortMergeJoin") == 3
    # One exchange for the target and one for each feed.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 4


def test_settled_small_feeds_leave_the_target_in_place(spark, target, large):
    steps = [settle(Feed(feed(spark, c), [f"ord_{c}"]), ["cust"]) for c in ("a", "b")]
    text = plan(overlay_chain(target, steps, ["cust"]))
    assert text.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in text


def test_small_staged_rows_leave_the_target_in_place(spark, target, large):
    staged = feed(spark, "a")
    text = plan(insert_only(staged, target, ["cust"], unique=True, small=True))
    # What the broadcast leaves of the target is shuffled, not the target itself.
    assert re.search(r"BroadcastHashJoin .* LeftSemi", text)
    text = plan(resolve_key(staged, target.select("cust", "ck"), ["cust"], ["ck"], small=True).accepted)
    assert re.search(r"BroadcastHashJoin .* LeftSemi", text)


def test_broadcast_incoming_rows_leave_current_rows_in_place(spark, large):
    current = spark.createDataFrame([], ADDRESS_SCHEMA).union(
        spark.range(10).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in ADDRESS_SCHEMA.fields])
    )
    incoming = current.select(*ADDRESS_LAYOUT.natural_key, *ADDRESS_LAYOUT.content)
    text = plan(new_versions(current, F.broadcast(incoming), ADDRESS_LAYOUT, "2019-11-22 10:00:00"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_size_is_measured(spark):
    assert fits_broadcast(spark.range(100))
    assert not fits_broadcast(spark.range(100), limit=1000)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert not fits_broadcast(wide, limit=5000) and fits_broadcast(wide, limit=20000)
    assert not fits_broadcast(wide.select(F.array("s")))


def test_null_safe_keys_cost_no_further_exchange(spark, target, large):
    text = plan(overlay(target, feed(spark, "a"), ["cust"], ["ord_a"], null_safe=True))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


def test_role_keys_within_do_not_move_the_target_again(spark, target, large):
    chained = overlay_chain(target, [Feed(feed(spark, "a"), ["ord_a"])], ["cust"])
    rows = spark.range(200).selectExpr("id % 100 AS cust", "id % 100 * 2 AS ck", "id AS cak", "'S' AS role")
    assign = {"c": ["S"]}
    apart = plan(role_keys(chained, rows, "ck", "cak", "role", assign))
    within = plan(role_keys(chained, rows, "ck", "cak", "role", assign, within="cust"))
    assert re.search(r"Exchange hashpartitioning\(ck#\d+L, 8\).*\n.*Project \[cust", apart)
    on_target = [line for line in within.splitlines() if "Exchange hashpartitioning(cust#" in line]
    # The target by cust, the feed by cust, the roles by (cust, ck) and by cust.
    assert len(on_target) + within.count("Exchange hashpartitioning(__r0") == 4
    assert "Exchange hashpartitioning(ck#" not in within


def test_a_small_closing_set_leaves_the_target_in_place(spark):
    target = spark.createDataFrame([], ADDRESS_SCHEMA).union(
        spark.range(10).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in ADDRESS_SCHEMA.fields]
        )
    )
    closing = target.select(*ADDRESS_LAYOUT.natural_key)
    text = plan(expire(target, closing, ADDRESS_LAYOUT, "2019-11-22 10:00:00", small=True))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_a_large_closing_set_moves_current_rows_only(spark, large):
    table = "plan_addresses"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.createDataFrame([], ADDRESS_SCHEMA).write.saveAsTable(table)
    target = spark.table(table)
    closing = target.select(*ADDRESS_LAYOUT.natural_key).distinct()
    text = plan(expire(target, closing, ADDRESS_LAYOUT, "2019-11-22 10:00:00"))
    union = text.split("Union")[1]
    joined, passed = union.split("\n   +- ")[0], union.split("\n   +- ")[-1]
    assert "SortMergeJoin" in joined and "EqualTo(ETL_CURRENT_IND,1)" in joined
    assert "Exchange" not in passed and "FileScan" in passed
    spark.sql(f"DROP TABLE {table}")


def test_a_bucketed_target_is_not_shuffled(spark, large):
    spark.sql("DROP TABLE IF EXISTS plan_bucketed")
    spark.sql("CREATE TABLE plan_bucketed (cust BIGINT, a STRING) USING parquet CLUSTERED BY (cust) INTO 8 BUCKETS")
    append(spark.range(100).selectExpr("id AS cust", "'x' AS a"), "plan_bucketed")
    text = plan(overlay(spark.table("plan_bucketed"), feed(spark, "a"), ["cust"], ["ord_a"]))
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    spark.sql("DROP TABLE plan_bucketed")


def test_scans_are_pruned_and_filters_pushed(spark):
    spark.sql("DROP TABLE IF EXISTS plan_scan")
    spark.sql("CREATE TABLE plan_scan (k BIGINT, a STRING, b STRING) USING parquet")
    text = plan(scan(spark, "plan_scan", {"x": "a"}, "k = 3"))
    assert "ReadSchema: struct<k:bigint,a:string>" in text and "EqualTo(k,3)" in text
    spark.sql("DROP TABLE plan_scan")


def test_numbering_puts_only_counts_in_one_task(spark):
    text = plan(assign_surrogate_keys(spark.range(100).withColumn("payload", F.lit("x")), 0, "sk", ["id"]))
    single = text.split("Exchange SinglePartition")
    assert len(single) == 2
    below = single[1].splitlines()[1]
    assert "HashAggregate" in below and "payload" not in below
