"""Extracts too large to copy: what is moved and counted, and the same rows as for small ones."""

import re

import pytest
from pyspark.sql import functions as F

from dimload.operators import HotKeys, bloom, find_hot_keys, initial_load, scd2_merge
from dimload.operators import scd2 as merges
from dimload.operators import skew
from test_scd2 import BATCH, LAYOUT, parents, staged, stored  # noqa: F401


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def large(spark, monkeypatch):
    """Nothing is small enough to copy."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(merges, "fits_broadcast", lambda df: False)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def written(monkeypatch):
    plans, cut = [], merges.cut_lineage
    monkeypatch.setattr(merges, "cut_lineage", lambda df: (plans.append(plan(df)), cut(df))[1])
    return plans


def moving(text, column):
    """Exchanges that hold a column, in the plan that is run."""
    lines = text.split("Initial Plan")[0].splitlines()
    return [line for i, line in enumerate(lines) if re.search(r"\bExchange (hash|range)", line) and f"{column}#" in line + lines[i + 1]]


def test_an_initial_load_moves_staged_rows_once_and_its_refused_ones_no_more(spark, stored, staged, parents, large, written):  # noqa: F811
    more = staged.union(staged.replace("X st", "Y st")).union(staged.replace("N st", "M st"))
    more = spark.createDataFrame(more.collect(), more.schema)
    loaded = initial_load(more, stored.where("cak < 3"), parents, 100, BATCH, LAYOUT, ["line1"], hot_parents=HotKeys())
    assert len(moving(written[0], "line1")) == 1 and "SortMergeJoin" in written[0]
    superseded = loaded.rejected.where("REJECT_REASON like 'another%'")
    assert superseded.count() == 8 and not moving(plan(superseded), "line1")


def test_a_merge_does_not_move_refused_rows(spark, stored, staged, parents, large, written):  # noqa: F811
    more = staged.union(staged.replace("X st", "Y st"))
    more = spark.createDataFrame(more.collect(), more.schema)
    merged = scd2_merge(stored, more, parents, 100, BATCH, LAYOUT, ["line1"], hot_parents=HotKeys())
    assert len(moving(written[0], "line1")) == 1
    superseded = merged.rejected.where("REJECT_REASON like 'another%'")
    assert superseded.count() == 4 and not moving(plan(superseded), "line1")


def many(spark, n=1200):
    """A third of the rows of one parent, a ninth of one key, some with NULL in the key, some without a parent."""
    staged = spark.range(0, n, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 <> 1 THEN id % 400 END AS id",
        "CASE WHEN id % 9 = 0 THEN 'A' WHEN id % 40 <> 2 THEN concat('B', id % 5) END AS name", "'S' AS src",
        "string(id % 13) AS line1", "id AS v",
    )
    stored = spark.range(0, 300, 1, 3).selectExpr(
        "id AS cak", "100 + id AS ck", "IF(id % 2 = 0, 7, id) AS id", "concat('B', id % 5, IF(id % 2 = 0, string(id), '')) AS name", "'S' AS src",
        "string(id % 11) AS line1", "timestamp'2019-01-01' AS begin", "timestamp'2099-12-31' AS `end`", "1 AS cur",
        "1 AS ver", "0 AS void", "1L AS ins", "1L AS upd", "'p' AS private",
    )
    return staged, stored, spark.range(5, 390).selectExpr("id", "id * 2 AS ck")


@pytest.mark.parametrize("fits", [(False, False), (False, True)])
@pytest.mark.parametrize("latest", [False, True])
@pytest.mark.parametrize("hot", ["given", None])
def test_large_and_small_extracts_give_the_same_rows(spark, monkeypatch, fits, latest, hot):
    staged, stored, parents = many(spark)
    hot = find_hot_keys(staged, ["id"]) if hot else None
    assert hot is None or hot
    for target in (stored, stored.limit(0)):
        args = (staged, target, parents, 5000, BATCH, LAYOUT, ["line1"])
        want = initial_load(*args, latest=latest)
        with monkeypatch.context() as m:
            answers = iter(fits)
            m.setattr(merges, "fits_broadcast", lambda df: next(answers))
            got = initial_load(*args, latest=latest, hot_parents=hot)
        assert [rows(d.select(sorted(d.columns))) for d in want] == [rows(d.select(sorted(d.columns))) for d in got]
        assert sum(d.count() for d in got) == staged.count() and got.rejected.select("REJECT_REASON").distinct().count() == 3


@pytest.mark.parametrize("compat", ["corrected", "reference", "reference_without_compare"])
def test_large_and_small_merges_give_the_same_rows(spark, monkeypatch, compat):
    staged, stored, parents = many(spark)
    args = (stored, staged, parents, 5000, BATCH, LAYOUT, ["line1"])
    want = scd2_merge(*args, latest=True, compat=compat)
    monkeypatch.setattr(merges, "fits_broadcast", lambda df: False)
    got = scd2_merge(*args, latest=True, compat=compat, hot_parents=find_hot_keys(staged, ["id"]))
    assert [rows(d) for d in want] == [rows(d) for d in got]


@pytest.mark.parametrize("some", [True, False])
def test_staged_rows_that_were_never_closed_stay_in_place(spark, stored, staged, parents, monkeypatch, written, some):  # noqa: F811
    """Only the rows of keys with closed versions alone are paired with these."""
    closed = stored.where("cak <> 2").withColumn("cur", F.when(F.col("cak") == 5, 0).otherwise(F.col("cur")))
    target = closed if some else closed.where("cur = 1")
    new = staged.replace("B st", "D st")
    want = scd2_merge(target, new, parents, 100, BATCH, LAYOUT, ["line1"])
    paired, asked = [], []
    pair = merges._paired
    monkeypatch.setattr(merges, "_paired", lambda *a, **b: (paired.append(a[1].count()), pair(*a, **b))[1])
    # Not the extract and what is staged or unseen, but the closed keys fit.
    monkeypatch.setattr(merges, "fits_broadcast", lambda df: (asked.append(1), len(asked) == 4)[1])
    got = scd2_merge(target, new, parents, 100, BATCH, LAYOUT, ["line1"], hot_parents=HotKeys())
    assert [rows(d) for d in want] == [rows(d) for d in got]
    assert paired == ([4, 1] if some else [4]) and got.added.count() == (1 if some else 0)


def test_a_parent_id_outside_the_key(spark, monkeypatch):
    layout = merges.Scd2Layout(**{**LAYOUT.__dict__, "natural_key": ["name", "src"]})
    staged, stored, parents = many(spark)
    args = (staged, stored, parents, 5000, BATCH, layout, ["line1"])
    want = initial_load(*args)
    monkeypatch.setattr(merges, "fits_broadcast", lambda df: False)
    got = initial_load(*args, hot_parents=find_hot_keys(staged, ["id"]))
    assert [rows(d) for d in want] == [rows(d) for d in got] and got.rows.count() > 0


def test_keys_are_counted_one_by_one_only_if_some_group_is_large(spark, monkeypatch):
    spread = spark.range(0, 50_000, 1, 4)
    grouped, kind = [], type(spread)
    group = kind.groupBy
    monkeypatch.setattr(kind, "groupBy", lambda self, *c: (grouped.extend(map(str, c)), group(self, *c))[1])
    assert not find_hot_keys(spread, ["id"]) and len(grouped) == 1 and "AS g" in grouped[0]
    uneven = spread.selectExpr("IF(id % 4 = 0, NULL, id) AS id")
    assert {n: len(h) for n, h in find_hot_keys(uneven, ["id"]).pieces.items()} == {2: 1} and len(grouped) == 3
    monkeypatch.setattr(skew, "GROUPS", 1)  # several keys of a group: counted exactly
    assert not find_hot_keys(spark.range(100), ["id"])


def test_the_words_of_a_filter_are_in_place(spark):
    keys = spark.range(3000).selectExpr("id AS k")
    block, word, mask = bloom._place(["k"], 2)
    want = [[0] * bloom.WORDS for _ in range(2)]
    for b, w, m in keys.select(block, word, mask).collect():
        want[b][w] |= m
    text = plan(filtered := bloom.bloom_filter(keys, 2))
    assert [r["__words"] for r in filtered.orderBy("__block").collect()] == want and "map_from_entries" not in text
