import pytest

from dimload.operators import align, project, union_rows
from dimload.sources import TableMissing, append, recover, replace, scan
from dimload.sources.tables import bucketing


@pytest.fixture
def table(spark):
    name = "dim_t"
    for t in (name, f"{name}__next", f"{name}__before"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    spark.sql(f"CREATE TABLE {name} (K BIGINT, V STRING, W INT) USING parquet CLUSTERED BY (K) INTO 4 BUCKETS")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_append_fills_and_casts(spark, table):
    append(spark.createDataFrame([("1", "a")], "k string, v string"), table)
    append(spark.createDataFrame([("b", 2)], "v string, k int"), table)
    assert content(spark, table) == [(1, "a", None), (2, "b", None)]


def test_append_writes_one_file_per_bucket(spark, table):
    append(spark.range(0, 400, 1, 8).selectExpr("id AS k"), table)
    assert bucketing(spark, table) == (4, ["K"])
    assert spark.table(table).select("_metadata.file_path").distinct().count() == 4


def files(spark, table):
    return spark.table(table).select("_metadata.file_path").distinct().count()


@pytest.mark.parametrize("write", [append, replace])
def test_files_follow_buckets_and_partitions(spark, table, write):
    """Rows lie in 32 tasks by another column; files don't multiply by them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 3200, 1, 32).selectExpr("id % 97 AS k", "string(id) AS v", "int(id % 5) AS w")
        write(rows, table)
        assert files(spark, table) == 4 and spark.table(table).count() == 3200
        spark.sql("DROP TABLE IF EXISTS dim_p")
        spark.sql("CREATE TABLE dim_p (K BIGINT, V STRING, W INT) USING parquet PARTITIONED BY (W)")
        write(rows, "dim_p")
        assert files(spark, "dim_p") == 5 and spark.table("dim_p").count() == 3200
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.sql("DROP TABLE IF EXISTS dim_p")


def test_replace_keeps_comment_and_properties(spark, table):
    spark.sql(f"COMMENT ON TABLE {table} IS 'it''s a \\\\ dimension'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('owner.team' = 'o''neil', 'x' = '1')")
    described = lambda: {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    comment = described()["Comment"]
    replace(spark.range(3).selectExpr("id AS k"), table)
    assert described()["Comment"] == comment and "dimension" in comment
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert kept["owner.team"] == "o'neil" and kept["x"] == "1"


def test_replace_refuses_external_tables(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS dim_x")
    spark.sql(f"CREATE TABLE dim_x (K BIGINT) USING parquet LOCATION '{tmp_path}/x'")
    append(spark.range(2).selectExpr("id AS k"), "dim_x")
    with pytest.raises(ValueError, match="external"):
        replace(spark.range(1).selectExpr("id AS k"), "dim_x")
    assert spark.table("dim_x").count() == 2
    spark.sql("DROP TABLE dim_x")


def test_target_must_exist(spark):
    for write in (append, replace):
        with pytest.raises(TableMissing):
            write(spark.range(1), "no_such_table")


def test_unknown_column_is_refused(spark, table):
    with pytest.raises(ValueError, match="no columns"):
        append(spark.createDataFrame([(1, 2)], "k long, other int"), table)


def test_replace_reads_the_table_it_writes(spark, table):
    append(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, w int"), table)
    replace(spark.table(table).where("k > 1").selectExpr("k + 10 AS k", "v", "w"), table)
    assert content(spark, table) == [(12, "b", 2)]
    assert not spark.catalog.tableExists(f"{table}__before")
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert described["Num Buckets"] == "4"


def test_replace_leaves_the_target_when_the_rows_fail(spark, table):
    append(spark.createDataFrame([(1, "a", 1)], "k long, v string, w int"), table)
    bad = spark.table(table).selectExpr("k", "v", "CAST(v AS INT) AS w")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        replace(bad, table)
    assert content(spark, table) == [(1, "a", 1)]
    replace(spark.table(table), table)
    assert content(spark, table) == [(1, "a", 1)]


def test_recover_between_the_two_renames(spark, table):
    append(spark.createDataFrame([(1, "a", 1)], "k long, v string, w int"), table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__before")
    recover(spark, table)
    assert content(spark, table) == [(1, "a", 1)]


def test_scan_projects_and_filters(spark, table):
    append(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, w int"), table)
    out = scan(spark, table, {"id": "K", "also_id": "K", "name": "V"}, where="W = 2")
    assert out.columns == ["id", "also_id", "name"]
    assert [tuple(r) for r in out.collect()] == [(2, 2, "b")]
    assert scan(spark, table).columns == ["K", "V", "W"]


def test_shapes(spark):
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([(2, 3)], "K int, w int")
    assert sorted(tuple(r) for r in union_rows(a, b).collect()) == [(1, "x", None), (2, None, 3)]
    assert project(a, {"n": "k"}).columns == ["n"]
    assert [tuple(r) for r in align(b.drop("w"), a.schema).collect()] == [(2, None)]
