"""Replacing one partition and rewriting single files, stopped at every step."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from dimload.sources import recover, replace, replace_open, rewrite_rows
from dimload.sources import tables as store
from dimload.sources.tables import facts, files, partition_location

LAYOUTS = ["", "CLUSTERED BY (id) INTO 2 BUCKETS"]
OLD = [(1, "a", 0, 1), (2, "b", 1, 1), (3, "c", 0, 0), (4, "d", 0, 0)]
NEW = [(2, "b", 1, 1), (5, "e", 0, 1)]
CLOSED = [(1, "a", 0, 0)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, w int, f int").coalesce(1)


@pytest.fixture(params=LAYOUTS, ids=["plain", "bucketed"])
def table(spark, request):
    for t in ("parts", "parts__closed", "parts__rewrite", "parts__apart"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    spark.sql(f"CREATE TABLE parts (id BIGINT, v STRING, w INT, f INT) USING parquet PARTITIONED BY (f) {request.param}")
    for row in OLD:  # a file each
        frame(spark, [row]).write.insertInto("parts")
    yield "parts"
    spark.sql("DROP TABLE parts")


def content(spark, table="parts"):
    spark.catalog.refreshTable(table)
    return sorted(tuple(r) for r in spark.table(table).select("id", "v", "w", "f").collect())


def file_names(spark, where):
    rows = spark.table("parts").where(where).select("_metadata.file_path", "_metadata.file_modification_time")
    return {tuple(r) for r in rows.distinct().collect()}


class Stop(Exception):
    pass


def stopping(spark, patch, at):
    """Let the load die at its ``at``-th step: a statement, a write, a move or a deletion."""
    left = [at]

    def step(f):
        def wrapped(*args, **kwargs):
            left[0] -= 1
            if left[0] == 0:
                raise Stop
            return f(*args, **kwargs)

        return wrapped

    reading = ("DESCRIBE", "SHOW")
    sql = type(spark).sql
    counted = step(sql)
    patch.setattr(type(spark), "sql", lambda self, q, *a: sql(self, q, *a) if q.startswith(reading) else counted(self, q, *a))
    patch.setattr(DataFrameWriter, "insertInto", step(DataFrameWriter.insertInto))
    for name in ("delete", "move", "make_folder"):
        patch.setattr(files, name, step(getattr(files, name)))


def each_stop(spark, monkeypatch, work):
    """Run ``work`` stopped at its first, second, ... step until it is done; yields after each."""
    for at in range(1, 60):
        with monkeypatch.context() as patch:
            stopping(spark, patch, at)
            try:
                work()
                return
            except Stop:
                pass
        yield at


def parts_of(rows, flag):
    return sorted(r for r in rows if r[3] == flag)


AFTER = sorted([*NEW, *CLOSED, *parts_of(OLD, 0)])


def test_open_partition_is_never_without_its_rows(spark, table, monkeypatch):
    steps = 0
    for steps in each_stop(spark, monkeypatch, lambda: replace_open(frame(spark, NEW), frame(spark, CLOSED), table, "f", "id")):
        found = content(spark)
        assert parts_of(found, 1) in (parts_of(OLD, 1), sorted(NEW)), steps
        assert set(parts_of(OLD, 0)) <= set(found) <= set(OLD) | set(AFTER)
        recover(spark, table)
        found = content(spark)
        assert found in (sorted(OLD), AFTER), steps
        if found == AFTER:  # as it was, for the next stop
            replace(frame(spark, OLD), table)
        assert not spark.catalog.tableExists("parts__closed")
    assert steps > 6 and content(spark) == AFTER
    before = file_names(spark, "f = 0")
    replace_open(frame(spark, [(9, "z", 9, 1)]), frame(spark, NEW).withColumn("f", F.lit(0)), table, "f", "id")
    assert content(spark) == sorted([(9, "z", 9, 1), (2, "b", 1, 0), (5, "e", 0, 0), *CLOSED, *parts_of(OLD, 0)])
    assert before <= file_names(spark, "f = 0")
    left = [c.rsplit("/", 1)[-1] for c in files.children(spark, facts(spark, table)["Location"])]
    assert sum(n.startswith("_open-") for n in left) == 1 and "f=1" not in left


@pytest.mark.parametrize("bad", ["open", "closed"])
def test_rows_that_fail_while_they_are_written(spark, table, bad):
    def failing(rows):
        wrong = F.when(F.col("id") % 3 == 2, F.raise_error("bad row")).otherwise(F.col("w"))
        return frame(spark, rows).withColumn("w", F.when(F.col("id") == rows[-1][0], F.raise_error("bad row")).otherwise(wrong).cast("int"))

    rows = {"open": frame(spark, NEW), "closed": frame(spark, CLOSED)}
    rows[bad] = failing(NEW if bad == "open" else CLOSED)
    with pytest.raises(PySparkException, match="bad row"):
        replace_open(rows["open"], rows["closed"], table, "f", "id")
    assert content(spark) == sorted(OLD)
    recover(spark, table)
    assert content(spark) == sorted(OLD)
    replace_open(frame(spark, NEW), frame(spark, CLOSED), table, "f", "id")
    assert content(spark) == AFTER


def test_open_partition_may_be_missing_or_become_empty(spark, table):
    replace_open(frame(spark, NEW).where("false"), frame(spark, parts_of(OLD, 1)).withColumn("f", F.lit(0)), table, "f", "id")
    assert content(spark) == sorted((*r[:3], 0) for r in OLD)
    spark.sql("ALTER TABLE parts DROP PARTITION (f = 1)")
    assert partition_location(spark, table, "f", 1) is None
    replace_open(frame(spark, NEW), frame(spark, []), table, "f", "id")
    assert content(spark) == sorted([*[(*r[:3], 0) for r in OLD], *NEW])


def test_only_files_with_wrong_rows_are_rewritten(spark, table, monkeypatch):
    wrong, right = F.col("v") == "c", {"w": F.lit(7)}
    corrected = sorted([*[r for r in OLD if r[1] != "c"], (3, "c", 7, 0)])
    others = file_names(spark, "v <> 'c'")
    steps = 0
    for steps in each_stop(spark, monkeypatch, lambda: rewrite_rows(spark, table, "f", 0, wrong, right)):
        assert {r[0] for r in content(spark)} == {1, 2, 3, 4}, steps
        recover(spark, table)
        found = content(spark)
        assert found in (sorted(OLD), corrected), steps
        if found == corrected:  # wrong again
            rewrite_rows(spark, table, "f", 0, F.col("w") == 7, {"w": F.lit(0)})
        assert not spark.catalog.tableExists("parts__rewrite")
    assert steps > 5 and content(spark) == corrected
    assert others == file_names(spark, "v <> 'c'")
    assert rewrite_rows(spark, table, "f", 0, F.col("v") == "none", right) == 0
    assert store.bucketing(spark, table)[0] in (0, 2) and spark.table(table).where("id = 3").count() == 1
