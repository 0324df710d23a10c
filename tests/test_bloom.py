"""The Bloom filter, contents by digest, and what of large tables is moved."""

import re

import pytest
from pyspark.sql import functions as F

from dimload.operators import bloom, changed_rows, content_anti_join, content_digest, insert_only, probably_matching, scd2_merge
from dimload.operators import scd2 as merges
from test_scd2 import BATCH, LAYOUT, parents, staged, stored  # noqa: F401


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_partner_is_lost_and_few_others_stay(spark):
    few = spark.range(0, 40_000, 2).selectExpr("id AS k", "IF(id % 7 = 0, NULL, string(id)) AS s")
    df = spark.range(0, 80_000).selectExpr("id AS k", "IF(id % 7 = 0, NULL, string(id)) AS s", "id AS v")
    out = probably_matching(df, few, ["K", "S"])
    assert out.columns == df.columns
    kept = {r["v"] for r in out.collect()}
    assert set(range(0, 40_000, 2)) <= kept and len(kept) < 20_000 + 60_000 * 0.06
    again = {r["v"] for r in probably_matching(df.repartition(13), few.repartition(5), ["k", "s"]).collect()}
    assert again == kept


def test_where_the_filter_does_not_apply(spark):
    df = spark.range(10).selectExpr("id AS k", "double(id) AS d", "array(id) AS a")
    few = df.where("k = 3")
    assert probably_matching(df, few, ["d"]) is df and probably_matching(df, few, ["a"]) is df
    assert probably_matching(df, few.withColumn("k", F.col("k").cast("int")), ["k"]) is df
    assert probably_matching(df, few.where("false"), ["k"]) is df
    assert probably_matching(df, df, ["k"], most_bytes=0) is df
    small = spark.range(100_000).selectExpr("id AS k")
    assert probably_matching(small, small, ["k"], most_bytes=64 << 10) is small
    assert probably_matching(df, few, ["k"]).count() == 1
    assert bloom.bloom_filter(small, 3).count() == 3


def test_only_candidate_keys_of_the_target_are_moved(spark, large):
    staged = spark.range(0, 3000, 3).selectExpr("id AS k", "id AS v")
    target = spark.range(1000, 100_000).selectExpr("id AS k", "string(id) AS wide")
    out = insert_only(staged, target, ["k"], unique=True, prefilter=True)
    assert sorted(r["k"] for r in out.collect()) == list(range(0, 1000, 3))
    text = plan(out)
    # Read upwards, the target is filtered by the broadcast bits before its exchange, and only its key goes on.
    exchange = text.index("Exchange hashpartitioning(__r0")
    below = text[exchange:]
    assert "BroadcastHashJoin" in below and "wide" not in below.split("BroadcastHashJoin")[0]
    moved = probably_matching(target.select("k"), staged, ["k"]).count()
    assert moved < 667 + 98_000 * 0.06


ROWS = [(1, "a", None, 1), (1, "a", "", 1), (1, "a", None, 1), (2, "a:1", "b", 2), (2, "a", "1:b", 2), (3, None, None, None), (4, "é", "x", 4)]


@pytest.fixture
def contents(spark):
    schema = "k long, a string, b string, n int"
    return spark.createDataFrame(ROWS, schema).repartition(3), spark.createDataFrame([*ROWS[::2], (9, "z", "z", 9)], schema)


@pytest.mark.parametrize("scope", ["key", "global"])
@pytest.mark.parametrize("equal", [False, True])
def test_content_by_digest(contents, scope, equal):
    """Also where all rows have one digest: their columns decide."""
    staged, target = contents
    digest = (lambda columns: F.lit(b"same digest 1234").cast("binary")) if equal else content_digest
    out = content_anti_join(staged, target, ["a", "b", "n"], ["k"], scope=scope, digest=digest)
    assert out.columns == staged.columns
    known = {r[0 if scope == "key" else 1 :] for r in ROWS[::2]}
    want = [r for r in ROWS if r[0 if scope == "key" else 1 :] not in known]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert content_anti_join(staged, target.where("false"), ["a", "b", "n"], scope="global", digest=digest).count() == len(ROWS)


def test_different_contents_have_different_digests(contents):
    staged, _ = contents
    digests = staged.distinct().select(content_digest([F.col(c) for c in ("a", "b", "n")]).alias("d")).collect()
    assert len({bytes(r["d"]) for r in digests}) == len(digests) == len(set(ROWS)) and len(digests[0]["d"]) == 16


def test_content_of_the_target_moves_as_a_digest(spark, contents, large, monkeypatch):
    from dimload.operators import lookup

    staged, target = contents
    plans, written = [], lookup.cut_lineage
    monkeypatch.setattr(lookup, "cut_lineage", lambda df: (plans.append(plan(df)), written(df))[1])
    content_anti_join(staged, target, ["a", "b", "n"], scope="global").collect()
    lines = plans[1].splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            # The node below an exchange lists what is moved.
            assert not re.search(r"[\[(, ][abn]#", line + lines[i + 1]), line


def test_changed_rows(spark):
    schema = "k long, a string, n int"
    staged = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (2, "y", 2), (None, "n", 1), (4, "w", 1), (5, "v", 1), (6, None, 1)], schema)
    target = spark.createDataFrame([(1, "x", 9), (2, "y", 9), (2, "y", 8), (None, "n", 7), (4, "W", 1), (5, "v", 1), (5, "v", 1), (7, "q", 1), (6, None, 0)], schema)
    out = changed_rows(staged, target, ["k"], ignore=["N"])
    assert sorted((r["k"], r["a"]) for r in out.collect()) == [(4, "w"), (5, "v")]
    out = changed_rows(staged.withColumn("k", F.col("k").cast("int")), target, ["k"], ignore=["n"])
    assert out.count() == 2 and dict(out.dtypes)["k"] == "bigint"


@pytest.mark.parametrize("small", [True, False])
def test_changed_rows_of_large_feeds(spark, monkeypatch, small):
    monkeypatch.setattr("dimload.operators.shape.fits_broadcast", lambda df: small)
    staged = spark.range(500).selectExpr("IF(id % 50 = 0, NULL, id) AS k", "string(id % 3) AS a")
    target = spark.range(1000).selectExpr("IF(id % 50 = 0 AND id < 500, NULL, id) AS k", "IF(id % 10 = 1, 'other', string(id % 3)) AS a")
    out = changed_rows(staged, target, ["k"])
    assert sorted(r["k"] for r in out.collect()) == [k for k in range(500) if k % 10 == 1 and k % 50]


def test_superseded_rows_are_not_moved(spark, stored, staged, parents, large, monkeypatch):  # noqa: F811
    """Which staged rows are left out is told by their numbers; no exchange holds their columns."""
    plans = []
    superseded = merges._superseded
    monkeypatch.setattr(merges, "_superseded", lambda *a: plans.append(superseded(*a)) or plans[-1])
    more = staged.union(staged.replace("X st", "Y st"))
    merged = scd2_merge(stored, more, parents, 100, BATCH, LAYOUT, ["line1"])
    assert sum(r["REJECT_REASON"].startswith("another") for r in merged.rejected.collect()) == 4
    text = plan(plans[0])
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
    broadcast = next(line for line in text.splitlines() if "BroadcastExchange" in line)
    assert "input[0, bigint" in broadcast and "line1" not in broadcast


@pytest.mark.parametrize("compat", ["corrected", "reference", "reference_without_compare"])
def test_a_merge_by_shuffles_only(spark, stored, staged, parents, large, monkeypatch, compat):  # noqa: F811
    """With nothing small enough to copy the rows are the same."""
    want = scd2_merge(stored, staged, parents, 100, BATCH, LAYOUT, ["line1"], compat=compat)
    for module in ("scd2", "lookup"):
        monkeypatch.setattr(f"dimload.operators.{module}.fits_broadcast", lambda df: False)
    got = scd2_merge(stored, staged, parents, 100, BATCH, LAYOUT, ["line1"], compat=compat)
    for one, two in zip(want, got):
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


def test_the_merge_brings_rows_together_once(spark, stored, staged, parents, large, monkeypatch):  # noqa: F811
    """One exchange by natural key for stored and staged rows, besides that which picks staged rows."""
    plans = []
    written = merges.cut_lineage
    monkeypatch.setattr(merges, "cut_lineage", lambda df: (plans.append(plan(df)), written(df))[1])
    scd2_merge(stored.where("cak < 5"), staged.where("id < 14"), parents, 100, BATCH, LAYOUT, ["line1"])
    exchanges = [re.findall(r"Exchange hashpartitioning\((\w+)#", p.split("Initial Plan")[0]) for p in plans]
    assert sum(len(e) for e in exchanges) == 2 and len([e for e in exchanges if e]) == 2
