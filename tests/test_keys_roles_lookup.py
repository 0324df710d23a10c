import pytest
from pyspark.sql import functions as F

from dimload.operators import (
    advance_registry,
    assign_surrogate_keys,
    content_anti_join,
    find_hot_keys,
    insert_only,
    largest_key,
    registry_base,
    resolve_key,
    role_keys,
    row_numbers,
    upsert_replace,
    with_registry_base,
)


def test_ordered_numbers_equal_a_global_row_number(spark):
    df = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).alias("a"), "id"
    )
    got = sorted((r["n"], r["a"], r["id"]) for r in row_numbers(df, "n", ["a", "id"]).collect())
    want = sorted((r["a"], r["id"]) for r in df.collect())
    assert got == [(i + 1, a, b) for i, (a, b) in enumerate(want)]


def test_unordered_numbers_are_dense_and_need_no_shuffle(spark):
    df = spark.range(0, 1000, 1, 5).where("id % 7 <> 0")
    out = row_numbers(df, "n")
    n = df.count()
    assert sorted(r["n"] for r in out.collect()) == list(range(1, n + 1))


def test_numbers_of_no_rows(spark):
    assert row_numbers(spark.range(0), "n", ["id"]).collect() == []


def test_surrogate_keys_and_registry(spark):
    registry = spark.createDataFrame([("T", 100), ("U", 5)], "TABLE_NAME string, MAX_VALUE_KEY long")
    out = assign_surrogate_keys(spark.range(3, 6), registry_base(registry, "T"), "key", ["id"])
    assert [(r["key"], r["id"]) for r in out.orderBy("key").collect()] == [(101, 3), (102, 4), (103, 5)]
    after = advance_registry(registry, "T", largest_key(out, "key", 100))
    assert {r[0]: r[1] for r in after.collect()} == {"T": 103, "U": 5}
    assert registry_base(advance_registry(registry, "T", 50), "T") == 100
    assert largest_key(out.limit(0), "key", 100) == 100
    assert with_registry_base(spark.range(1), registry, "U").first()["MAX_VALUE_KEY"] == 5


@pytest.mark.parametrize("rows,found", [([], "none"), ([("T", 1), ("T", 2)], "several")])
def test_registry_needs_exactly_one_row(spark, rows, found):
    registry = spark.createDataFrame(rows, "TABLE_NAME string, MAX_VALUE_KEY long")
    with pytest.raises(ValueError, match=found):
        registry_base(registry, "T")


def test_insert_only_keeps_duplicates_of_new_keys(spark):
    staged = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, v string")
    target = spark.createDataFrame([(1,), (1,)], "k long")
    out = insert_only(staged, target, ["k"])
    assert sorted(r["v"] for r in out.collect()) == ["b", "c", "d"]
    nulls = target.union(spark.createDataFrame([(None,)], "k long"))
    assert sorted(r["v"] for r in insert_only(staged, nulls, ["k"], null_safe=True).collect()) == ["b", "c"]


def test_composite_keys_do_not_collide(spark):
    staged = spark.createDataFrame([(11, "A")], "k long, n string")
    target = spark.createDataFrame([(1, "1A")], "k long, n string")
    assert insert_only(staged, target, ["k", "n"]).count() == 1


def test_resolve_key_splits_the_input(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k long, v string")
    ref = spark.createDataFrame([(1, 10), (1, 11), (3, None)], "k long, fk long")
    hot = find_hot_keys(rows, ["k"])
    for spread in (None, hot):
        out = resolve_key(rows, ref, ["k"], ["fk"], hot=spread, reason="no customer")
        assert sorted((r["v"], r["fk"]) for r in out.accepted.where("fk is not null").collect()) == [("a", 10), ("b", 10)]
        # found with a NULL key: accepted
        assert [r["v"] for r in out.accepted.where("fk is null").collect()] == ["d"]
        assert sorted((r["v"], r["REJECT_REASON"]) for r in out.rejected.collect()) == [
            ("c", "no customer"), ("e", "no customer")
        ]


def test_content_anti_join_scopes(spark):
    target = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "k long, a string, b string")
    staged = spark.createDataFrame(
        [(1, "x", None), (1, "y", "z"), (2, "y", None), (3, "q", "q")], "k long, a string, b string"
    )
    key = content_anti_join(staged, target, ["a", "b"], ["k"])
    assert sorted((r["k"], r["a"]) for r in key.collect()) == [(1, "y"), (2, "y"), (3, "q")]
    everywhere = content_anti_join(staged, target, ["a", "b"], scope="global")
    assert sorted((r["k"], r["a"]) for r in everywhere.collect()) == [(2, "y"), (3, "q")]


UNKNOWN = 999999999999


def test_role_keys(spark):
    target = spark.createDataFrame(
        [(i, UNKNOWN, UNKNOWN, UNKNOWN, 1) for i in range(1, 6)], "ck long, prim long, bill long, mkt long, upd long"
    )
    rows = spark.createDataFrame(
        [
            (1, 5, "SHIPADDR0"),
            (2, 5, "SHIPADDR0"), (2, 6, "BILLADDR1"),
            (3, 6, "BILLADDR1"),
            (4, 7, "MKTADDR"),
            (5, 8, "OTHER"),
        ],
        "ck long, cak long, role string",
    )
    assign = {"prim": ["SHIPADDR0"], "bill": ["BILLADDR1", "SHIPADDR0"], "mkt": ["MKTADDR"]}
    out = role_keys(target, rows, "ck", "cak", "role", assign, stamp={"upd": F.lit(2)})
    assert {tuple(r) for r in out.collect()} == {
        (1, 5, 5, UNKNOWN, 2),
        (2, 5, 6, UNKNOWN, 2),
        (3, UNKNOWN, 6, UNKNOWN, 2),
        (4, UNKNOWN, UNKNOWN, 7, 2),
        (5, UNKNOWN, UNKNOWN, UNKNOWN, 1),
    }
    several = rows.union(spark.createDataFrame([(1, 9, "SHIPADDR0")], rows.schema))
    newest = role_keys(target, several, "ck", "cak", "role", assign)
    assert newest.where("ck = 1").first()["prim"] == 9
    oldest = role_keys(target, several, "ck", "cak", "role", assign, ["cak"])
    assert oldest.where("ck = 1").first()["prim"] == 5


def test_upsert_replace(spark):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "lost")], "k long, v string, w string")
    staged = spark.createDataFrame([("new", 2), ("add", 3)], "v string, k long")
    out = upsert_replace(target, staged, ["k"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "keep"), (2, "new", None), (3, "add", None)]


def test_role_keys_within_the_business_key(spark):
    target = spark.createDataFrame([(1, 11, UNKNOWN), (2, 12, UNKNOWN), (3, 13, UNKNOWN)], "ck long, id long, prim long")
    # Customer 12 has an address of a key it no longer has.
    rows = spark.createDataFrame(
        [(1, 11, 5, "S"), (9, 12, 6, "S"), (2, 12, 7, "S"), (8, 13, 8, "S")], "ck long, id long, cak long, role string"
    )
    plain = role_keys(target, rows, "ck", "cak", "role", {"prim": ["S"]})
    within = role_keys(target, rows, "ck", "cak", "role", {"prim": ["S"]}, within="id")
    assert within.columns == plain.columns
    assert {tuple(r) for r in within.collect()} == {tuple(r) for r in plain.collect()} == {
        (1, 11, 5), (2, 12, 7), (3, 13, UNKNOWN)
    }


def test_small_sides_give_the_same_rows(spark):
    target = spark.range(0, 300, 3).selectExpr("nullif(id, 0) AS k", "string(id % 5) AS a", "id * 10 AS fk")
    staged = spark.range(0, 60).selectExpr("nullif(id, 0) AS k", "string(id % 7) AS a", "id AS n")

    def same(one, two):
        return sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)

    for null_safe in (False, True):
        assert same(
            insert_only(staged, target, ["k"], null_safe=null_safe),
            insert_only(staged, target, ["k"], null_safe=null_safe, small=True),
        )
    for scope in ("key", "global"):
        assert same(
            content_anti_join(staged, target, ["a"], ["k"], scope=scope),
            content_anti_join(staged, target, ["a"], ["k"], scope=scope, small=True),
        )
    plain = resolve_key(staged, target.drop("a"), ["k"], ["fk"])
    small = resolve_key(staged, target.drop("a"), ["k"], ["fk"], small=True)
    assert same(plain.accepted, small.accepted) and same(plain.rejected, small.rejected)


def test_hot_keys_of_no_rows(spark):
    assert not find_hot_keys(spark.range(0), ["id"])
