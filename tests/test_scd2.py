"""Worked merge of six stored versions, in three behaviours."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dimload.operators import Scd2Layout, find_hot_keys, initial_load, scd2_merge

BATCH = "2019-11-22 10:00:00"
NOW = datetime(2019, 11, 22, 10)
NEXT = datetime(2019, 11, 23, 10)
START = datetime(1990, 1, 1)
OPEN = datetime(2099, 12, 31)
LAYOUT = Scd2Layout(
    natural_key=["id", "name", "src"],
    content=["line1"],
    surrogate="cak",
    parent="ck",
    parent_id="id",
    begin="begin",
    end="end",
    current="cur",
    version="ver",
    void="void",
    ins_batch="ins",
    upd_batch="upd",
)
STORED = [
    (1, 101, 11, "SHIPADDR0", "CLIC", "A st", START, datetime(2019, 11, 1), 0, 1, 0, 1, 1, "p"),
    (2, 101, 11, "SHIPADDR0", "CLIC", "B st", datetime(2019, 11, 2), OPEN, 1, 2, 0, 1, 1, "q"),
    (3, 102, 12, "SHIPADDR0", "CLIC", "C st", START, OPEN, 1, 1, 0, 1, 1, "r"),
    (4, 103, 13, "BILLADDR1", "CLIC", "D st", START, OPEN, 1, 1, 0, 1, 1, "s"),
    (5, 103, 13, "MKTADDR", "CLIC", "E st", datetime(2019, 11, 21, 12), datetime(2019, 11, 20, 12), 0, 1, 0, 1, 1, "t"),
    (6, 103, 13, "MKTADDR", "CLIC", "F st", datetime(2019, 11, 21, 12), OPEN, 1, 2, 0, 1, 1, "u"),
]
SCHEMA = (
    "cak long, ck long, id long, name string, src string, line1 string, begin timestamp, `end` timestamp, "
    "cur int, ver int, void int, ins long, upd long, private string"
)


@pytest.fixture
def stored(spark):
    return spark.createDataFrame(STORED, SCHEMA)


@pytest.fixture
def staged(spark):
    return spark.createDataFrame(
        [
            (11, "SHIPADDR0", "CLIC", "X st"),
            (12, "SHIPADDR0", "CLIC", "C st"),
            (13, "BILLADDR1", "CLIC", "B st"),
            (14, "SHIPADDR0", "CLIC", "N st"),
        ],
        "id long, name string, src string, line1 string",
    )


@pytest.fixture
def parents(spark):
    return spark.createDataFrame([(11, 101), (12, 102), (13, 103)], "id long, ck long")


def by_key(df):
    return {r["cak"]: r.asDict() for r in df.collect()}


def reasons(rejected):
    return sorted((r["id"], r["REJECT_REASON"]) for r in rejected.collect())


def short(row):
    return (row["id"], row["name"], row["line1"], row["end"], row["cur"], row["ver"], row["void"])


def check_new(row, cak, line1, ver):
    assert (row["cak"], row["line1"], row["ver"]) == (cak, line1, ver)
    assert (row["begin"], row["end"], row["cur"], row["void"]) == (NEXT, OPEN, 1, 0)
    assert row["ins"] == row["upd"] == 20191122100000


def untouched(row, i, void=0):
    before = dict(zip([c.split()[0].strip("`") for c in SCHEMA.split(", ")], STORED[i]))
    assert row == {**before, "void": void}


@pytest.mark.parametrize("limit", [None, 0])
def test_corrected(stored, staged, parents, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr("dimload.operators.scd2.fits_broadcast", lambda df: False)
    merged = scd2_merge(stored, staged, parents, 100, BATCH, LAYOUT, ["line1"])
    assert merged.table.columns == stored.columns
    assert merged.table.count() == 8
    assert reasons(merged.rejected) == [(14, "no stored version")]
    assert [r["id"] for r in merged.unchanged.collect()] == [12]
    out = by_key(merged.table)
    untouched(out[1], 0)
    assert short(out[2])[3:] == (NOW, 0, 2, 0) and out[2]["upd"] == 20191122100000
    untouched(out[3], 2)
    assert short(out[4])[3:] == (NOW, 0, 1, 0)
    untouched(out[5], 4, void=1)
    untouched(out[6], 5)
    check_new(out[101], 101, "X st", 3)
    check_new(out[102], 102, "B st", 2)
    assert out[101]["private"] == "q" and out[102]["private"] == "s"
    assert (out[101]["ck"], out[102]["ck"]) == (101, 103)
    current = [(r["id"], r["name"]) for r in out.values() if r["cur"] == 1]
    assert len(current) == len(set(current)) == 4


def test_corrected_rerun_changes_nothing(stored, staged, parents):
    first = scd2_merge(stored, staged, parents, 100, BATCH, LAYOUT, ["line1"]).table.cache()
    again = scd2_merge(first, staged, parents, 102, "2019-11-25 10:00:00", LAYOUT, ["line1"])
    assert again.added.count() == 0
    assert by_key(again.table) == by_key(first)


def test_reference(stored, staged, parents):
    merged = scd2_merge(stored, staged, parents, 100, BATCH, LAYOUT, ["line1"], compat="reference")
    assert merged.table.count() == 7
    out = by_key(merged.table)
    for cak in (1, 2, 3, 4):
        assert (out[cak]["end"], out[cak]["cur"]) == (NOW, 0)
    untouched(out[5], 4, void=1)
    untouched(out[6], 5)
    check_new(out[101], 101, "X st", 3)


def test_reference_without_compare(stored, staged, parents):
    merged = scd2_merge(stored, staged, parents, 100, BATCH, LAYOUT, ["line1"], compat="reference_without_compare")
    assert merged.table.count() == 9
    rows = merged.table.where("cur = 1 and begin = timestamp'2019-11-23 10:00:00'").collect()
    new = {(r["id"], r["name"]): r.asDict() for r in rows}
    check_new(new[11, "SHIPADDR0"], 103 - 2, "X st", 3)
    check_new(new[12, "SHIPADDR0"], 102, "C st", 2)
    check_new(new[13, "BILLADDR1"], 103, "B st", 2)
    assert by_key(merged.table.where("cur = 0"))[1]["end"] == NOW


@pytest.mark.parametrize("compat", ["corrected", "reference_without_compare"])
def test_effective_time_from_the_feed(stored, staged, parents, compat):
    dated = staged.withColumn("filed", F.lit("2019-11-20 08:00:00").cast("timestamp"))
    merged = scd2_merge(stored, dated, parents, 100, BATCH, LAYOUT, ["line1"], compat=compat, effective="filed")
    assert merged.table.columns == stored.columns
    out = by_key(merged.table)
    assert out[2]["end"] == datetime(2019, 11, 20, 8)
    assert out[101]["begin"] == datetime(2019, 11, 21, 8)


def test_unresolved_parent_is_rejected_before_closing(stored, staged, parents):
    merged = scd2_merge(stored, staged, parents.where("id <> 11"), 100, BATCH, LAYOUT, ["line1"])
    out = by_key(merged.table)
    untouched(out[2], 1)
    assert reasons(merged.rejected) == [(11, "ck not found"), (14, "no stored version")]
    check_new(out[101], 101, "B st", 2)


def test_duplicate_feed_rows_give_one_version(stored, staged, parents):
    merged = scd2_merge(stored, staged.union(staged.replace("X st", "Y st")), parents, 100, BATCH, LAYOUT, ["line1"])
    assert [r["line1"] for r in merged.added.where("id = 11").collect()] == ["X st"]


def test_initial_load(stored, staged, parents, spark):
    more = staged.union(staged.where("id = 14").replace("N st", "M st"))
    parents = parents.union(spark.createDataFrame([(14, 104)], "id long, ck long"))
    loaded = initial_load(more, stored, parents, 100, BATCH, LAYOUT, ["line1"])
    (row,) = loaded.rows.collect()
    assert (row["cak"], row["ck"], row["line1"], row["ver"], row["cur"], row["void"]) == (101, 104, "M st", 1, 1, 0)
    assert (row["begin"], row["end"]) == (START, OPEN)
    assert reasons(loaded.rejected) == [(14, "another staged row of the key is used")]
    assert sorted(r["id"] for r in loaded.existing.collect()) == [11, 12, 13]
    assert initial_load(more, stored, parents, 100, BATCH, LAYOUT).rows.count() == 2
    none = initial_load(staged, stored, parents.where("id <> 14"), 100, BATCH, LAYOUT, ["line1"])
    assert none.rows.count() == 0 and [r["id"] for r in none.rejected.collect()] == [14]
    empty = initial_load(staged, stored.limit(0), parents, 100, BATCH, LAYOUT, ["line1"])
    assert sorted(r["cak"] for r in empty.rows.collect()) == [101, 102, 103, 104]


@pytest.mark.parametrize("limit", [None, 0])
def test_a_key_without_a_current_version_is_opened_again(stored, parents, spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr("dimload.operators.scd2.fits_broadcast", lambda df: False)
    closed = stored.where("cak <> 2 and cak <> 6").withColumn("cur", F.when(F.col("cak") == 5, 0).otherwise(F.col("cur")))
    staged = spark.createDataFrame(
        [(11, "SHIPADDR0", "CLIC", "A st"), (13, "MKTADDR", "CLIC", "G st"), (13, "BILLADDR1", "CLIC", "D st")],
        "id long, name string, src string, line1 string",
    )
    merged = scd2_merge(closed, staged, parents, 100, BATCH, LAYOUT, ["line1"])
    out = by_key(merged.table)
    check_new(out[101], 101, "A st", 2)
    check_new(out[102], 102, "G st", 2)
    untouched(out[1], 0)
    assert merged.rejected.count() == 0 and [r["name"] for r in merged.unchanged.collect()] == ["BILLADDR1"]
    loaded = initial_load(staged, closed, parents, 100, BATCH, LAYOUT, ["line1"])
    assert loaded.rows.count() == 0 and loaded.existing.count() == 3
    again = scd2_merge(merged.table.cache(), staged, parents, 102, BATCH, LAYOUT, ["line1"])
    assert again.added.count() == 0 and again.unchanged.count() == 3


@pytest.mark.parametrize("latest", [False, True])
@pytest.mark.parametrize("compat", ["corrected", "reference_without_compare"])
def test_no_staged_row_is_lost(stored, staged, parents, spark, compat, latest):
    more = spark.createDataFrame(
        [(11, "SHIPADDR0", "CLIC", "X st"), (11, "SHIPADDR0", "CLIC", None), (None, "SHIPADDR0", "CLIC", "N st"),
         (13, None, "CLIC", "N st"), (15, "SHIPADDR0", "CLIC", "O st"), (14, "SHIPADDR0", "CLIC", "N st")],
        "id long, name string, src string, line1 string",
    )
    everything = staged.union(more)
    merged = scd2_merge(stored, everything, parents, 100, BATCH, LAYOUT, ["line1"], compat=compat, latest=latest)
    parts = [merged.added.count(), merged.rejected.count(), merged.unchanged.count()]
    assert sum(parts) == everything.count() and merged.rejected.where("REJECT_REASON is null").count() == 0
    assert merged.rejected.where("REJECT_REASON = 'NULL in the natural key'").count() == 2
    assert [r["line1"] for r in merged.added.where("id = 11").collect()] == ["X st" if latest else None]
    loaded = initial_load(everything, stored, parents, 100, BATCH, LAYOUT, ["line1"], latest=latest)
    parts = [loaded.rows.count(), loaded.rejected.count(), loaded.existing.count()]
    assert sum(parts) == everything.count()
    loaded = initial_load(everything, stored, parents, 100, BATCH, LAYOUT)
    assert loaded.rows.count() + loaded.rejected.count() + loaded.existing.count() == everything.count()


def test_parents_are_read_once(stored, staged, spark):
    """Accepted and rejected rows come from one written join."""
    read = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            read.add(1)
            yield row

    parents = spark.createDataFrame([(11, 101), (12, 102), (13, 103)], "id long, ck long").rdd.mapPartitions(seen).toDF("id long, ck long")
    merged = scd2_merge(stored, staged, parents, 100, BATCH, LAYOUT, ["line1"], parents_unique=True)
    once = read.value
    merged.added.collect(), merged.rejected.collect(), merged.table.collect()
    assert read.value == once == 3


@pytest.mark.parametrize("compat", ["corrected", "reference", "reference_without_compare"])
def test_a_third_of_all_rows_under_one_key(spark, compat):
    """Hot keys are spread without changing a row of the result."""
    n = 1200
    stored = spark.range(0, n, 1, 6).selectExpr(
        "id AS cak", "100 + id AS ck", "IF(id % 3 = 0, 7, id) AS id", "IF(id % 3 = 0, 'A', 'B') AS name", "'S' AS src",
        "string(id % 11) AS line1", "timestamp'2019-01-01' AS begin", "timestamp'2099-12-31' AS `end`",
        f"IF(id % 3 = 0 AND id < {n} - 3, 0, 1) AS cur", "int(id % 5) AS ver", "0 AS void", "1L AS ins", "1L AS upd",
        "'p' AS private",
    )
    staged = spark.range(0, n, 1, 6).selectExpr(
        "IF(id % 3 = 0, 7, id) AS id", "IF(id % 3 = 0, CONCAT('A', IF(id = 3, '', string(id))), 'B') AS name", "'S' AS src",
        "string(id % 13) AS line1",
    )
    parents = spark.range(5, n).selectExpr("id", "id * 2 AS ck")
    hot, hot_parents = find_hot_keys(stored, LAYOUT.natural_key), find_hot_keys(staged, ["id"])
    assert hot and hot_parents
    args = (stored, staged, parents, 5000, BATCH, LAYOUT, ["line1"])
    plain = scd2_merge(*args, compat=compat)
    spread = scd2_merge(*args, compat=compat, hot=hot, hot_parents=hot_parents)
    for one, two in zip(plain, spread):
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
    args = (staged, stored, parents, 5000, BATCH, LAYOUT, ["line1"])
    for one, two in zip(initial_load(*args), initial_load(*args, hot_parents=hot_parents)):
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
    assert plain.table.count() >= n and plain.added.count() + plain.rejected.count() > 0
