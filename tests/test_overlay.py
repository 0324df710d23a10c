import pytest
from pyspark.sql import functions as F

from dimload.operators import (
    Feed,
    find_hot_keys,
    settle_all,
    spread,
    first_match,
    lookup_overlay,
    match_one,
    overlay,
    overlay_chain,
    refresh,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def left(spark):
    return spark.createDataFrame(
        [(1, "a", "old"), (1, "b", "old"), (2, "c", "old"), (None, "d", "old")], "k long, n string, v string"
    )


@pytest.fixture
def right(spark):
    return spark.createDataFrame(
        [(1, None, 10), (1, "zzz", 15), (None, "nk", 1), (9, "r", 2)], "k long, v string, ord int"
    )


def test_overlay_plain_keys(left, right):
    out = overlay(left, right, ["k"], ["ord"]).select("k", "n", "v")
    assert rows(out) == rows_of([(1, "a", None), (1, "b", None), (2, "c", "old"), (None, "d", "old")])


def test_overlay_null_safe(left, right):
    out = overlay(left, right, ["k"], ["ord"], null_safe=True).select("k", "n", "v")
    assert rows(out) == rows_of([(1, "a", None), (1, "b", None), (2, "c", "old"), (None, "d", "nk")])


def rows_of(expected):
    return sorted(expected, key=repr)


def test_overlay_adds_right_only_columns_and_keeps_left_spelling(left, right):
    out = overlay(left, right.withColumnRenamed("v", "V"), ["K"], ["ord"])
    assert out.columns == ["k", "n", "v", "ord"]
    assert {r["n"]: r["ord"] for r in out.collect()} == {"a": 10, "b": 10, "c": None, "d": None}


def test_overlay_latest(left, right):
    out = overlay(left, right, ["k"], ["ord"], latest=True)
    assert {r["n"]: r["v"] for r in out.collect()} == {"a": "zzz", "b": "zzz", "c": "old", "d": "old"}


def test_order_is_mandatory(left, right):
    with pytest.raises(ValueError, match="order_by"):
        overlay(left, right, ["k"])


def test_feed_values_are_cast_to_the_target_type(spark, left):
    feed = spark.createDataFrame([(1, 7)], "k long, v int")
    out = overlay(left, feed, ["k"], unique=True)
    assert out.schema["v"].dataType.simpleString() == "string"
    assert {r["n"]: r["v"] for r in out.collect()}["a"] == "7"


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_returns_what_the_plain_join_returns(spark, how, null_safe):
    big = spark.range(0, 6000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"),
        (F.col("id") % 2).cast("string").alias("part"),
        "id",
    )
    small = spark.range(0, 5000, 7).select(
        F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("1").alias("part"), (F.col("id") * 2).alias("x")
    )
    for keys in (["k"], ["k", "part"]):
        hot = find_hot_keys(big, keys)
        assert hot
        args = dict(how=how, null_safe=null_safe, order_by=["x"])
        plain = match_one(big, small, keys, **args)
        spread = match_one(big, small, keys, hot=hot, **args)
        assert rows(plain) == rows(spread)


def test_hot_keys_finds_the_hot_key_only(spark):
    df = spark.range(0, 9000, 1, 9).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    hot = find_hot_keys(df, ["k"])
    (expected,) = [r[0] for r in spark.sql("select xxhash64(cast(-1 as bigint))").collect()]
    assert [h for hashes in hot.pieces.values() for h in hashes] == [expected]
    assert not find_hot_keys(spark.range(0, 9000, 1, 9), ["id"])


def test_hot_rows_are_spread_over_tasks(spark):
    big = spark.range(0, 20000, 1, 40).select(F.lit(1).cast("long").alias("k"), "id")
    small = spark.createDataFrame([(1, 2)], "k long, x int")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    hot = find_hot_keys(big, ["k"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = match_one(big, small, ["k"], unique=True, hot=hot)
        per_task = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in per_task) == 20000
    assert len(per_task) > 2 and max(r["count"] for r in per_task) < 15000


@pytest.mark.parametrize("clustered", ["bucketed", "by key", "spread"])
def test_salts_do_not_depend_on_where_rows_lie(spark, clustered):
    """One key with half of the rows, which one task reads."""
    rows = spark.range(0, 4000, 1, 8).selectExpr("IF(id % 2 = 0, -1, id) AS k", "id", "string(id) AS v")
    spark.sql("DROP TABLE IF EXISTS clustered_rows")
    if clustered == "bucketed":
        rows.write.bucketBy(4, "k").saveAsTable("clustered_rows")
    elif clustered == "by key":
        rows.repartition(4, "k").write.saveAsTable("clustered_rows")
    else:
        rows.write.saveAsTable("clustered_rows")
    table = spark.table("clustered_rows")
    hot = find_hot_keys(table, ["k"])
    (pieces,) = hot.pieces
    assert pieces == 4
    salts = spread(table, ["k"], hot).where("k = -1").groupBy("__salt").count().collect()
    assert len(salts) == pieces and max(r["count"] for r in salts) < 2 * 2000 / pieces
    assert spread(table, ["k"], hot).where("k <> -1 and __salt <> 0").count() == 0
    spark.sql("DROP TABLE clustered_rows")


def test_a_key_just_above_a_partition_is_found(spark):
    """A share of 0.0009 at 5,000 partitions."""
    rows = spark.range(0, 100_000, 1, 8).selectExpr("IF(id < 90, -1, id) AS k")
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        assert {n: len(h) for n, h in find_hot_keys(rows.coalesce(2), ["k"]).pieces.items()} == {8: 1}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_small_feeds_together_stay_below_the_limit(spark):
    """Which feeds are copied changes the plan, never the rows."""
    target = spark.range(0, 300).selectExpr("id AS k", "'old' AS a", "'old' AS b", "'old' AS c")
    feeds = [Feed(spark.range(0, n).selectExpr("id AS k", f"string(id) AS {c}"), [c]) for n, c in ((50, "a"), (200, "b"), (100, "c"))]
    want = rows(overlay_chain(target, feeds, ["k"]))
    for limit, small in ((1 << 20, [True] * 3), (7000, [True, False, True]), (0, [False] * 3)):
        settled = settle_all(feeds, ["k"], limit)
        assert [f.small for f in settled] == small
        assert rows(overlay_chain(target, settled, ["k"])) == want


def test_types_must_agree_for_hashed_keys(spark, left):
    feed = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(ValueError, match="same type"):
        overlay(left, feed, ["k"], unique=True, null_safe=True)


def test_chain_later_feed_wins(spark, left):
    one = spark.createDataFrame([(1, "one"), (2, "one")], "k long, v string")
    two = spark.createDataFrame([(2, "two", 5)], "k long, v string, w int")
    out = overlay_chain(left, [Feed(one, unique=True), Feed(two, ["w"])], ["k"])
    assert {r["n"]: (r["v"], r["w"]) for r in out.collect()} == {
        "a": ("one", None), "b": ("one", None), "c": ("two", 5), "d": ("old", None)
    }


def test_spread_chain_equals_plain_chain_with_one_shuffle_of_the_target(spark):
    target = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"), "id", F.lit("old").alias("v")
    )
    steps = [
        Feed(spark.range(100).selectExpr("id AS k", "'one' AS v"), unique=True),
        Feed(spark.range(50).selectExpr("id AS k", "'two' AS v", "id AS w"), ["w"]),
    ]
    hot = find_hot_keys(target, ["k"])
    assert hot
    spread = overlay_chain(target, steps, ["k"], hot=hot)
    assert spread.columns == ["k", "id", "v", "w"]
    assert rows(spread) == rows(overlay_chain(target, steps, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = overlay_chain(target, steps, ["k"], hot=hot)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(k#") == 1
    assert text.count("Exchange hashpartitioning(__r0#") == 2


def test_refresh_keep_and_null(spark, left):
    feed = spark.createDataFrame([(1, "new")], "k long, v string")
    keep = refresh(left, feed, ["k"], unique=True)
    assert {r["n"]: r["v"] for r in keep.collect()} == {"a": "new", "b": "new", "c": "old", "d": "old"}
    null = refresh(left, feed, ["k"], unique=True, on_missing="null")
    assert {r["n"]: r["v"] for r in null.collect()} == {"a": "new", "b": "new", "c": None, "d": None}
    with pytest.raises(ValueError, match="lacks"):
        refresh(left, feed.withColumn("w", F.lit(1)), ["k"], unique=True)


def test_lookup_overlay_both_directions(spark, left):
    incoming = spark.createDataFrame([(1, "new", 3)], "k long, v string, w int")
    out = lookup_overlay(left, incoming, ["k"], unique=True)
    assert rows(out) == [(1, "a", "new", 3), (1, "b", "new", 3)]
    out = lookup_overlay(left, incoming, ["k"], unique=True, winner="rows")
    assert rows(out) == [(1, "a", "old", 3), (1, "b", "old", 3)]


def test_first_match_settles_ties_and_takes_expressions(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 3, "c"), (2, None, "z"), (2, 1, "y")], "k int, o int, v string")
    assert rows(first_match(df, ["k"], [-F.col("o")])) == [(1, 5, "a"), (2, None, "z")]
    assert rows(first_match(df, ["k"], ["o"], latest=True)) == [(1, 5, "b"), (2, 1, "y")]
    maps = df.withColumn("m", F.create_map("v", "o"))
    assert [r["m"] for r in first_match(maps, ["k"], ["o", "v"]).orderBy("k").collect()] == [{"c": 3}, {"z": None}]


def test_first_match_keeps_columns_in_order(right):
    out = first_match(right, ["k"], ["ord"])
    assert out.columns == ["k", "v", "ord"]
    assert rows(out) == rows_of([(1, None, 10), (None, "nk", 1), (9, "r", 2)])
