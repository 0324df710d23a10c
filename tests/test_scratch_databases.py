import pytest
from pyspark.sql import functions as F

from dimload.checks import registry
from dimload.checks.tables import ScratchTable
from dimload.sources import append, scan


@pytest.fixture
def databases(spark):
    def found():
        return {r[0] for r in spark.sql("SHOW DATABASES").collect()}

    return found


@pytest.fixture
def registered():
    """Queries registered by a test go with it."""
    queries, sql = dict(registry.QUERIES), dict(registry.ORACLE)
    yield registry
    for now, before in ((registry.QUERIES, queries), (registry.ORACLE, sql)):
        now.clear()
        now.update(before)


@pytest.mark.parametrize("fails", ["while writing", "in the driver", "not"])
def test_no_database_of_a_query_stays(spark, databases, registered, fails):
    rows = spark.range(3)
    before = databases()

    @registered.query("SELECT 1")
    def some_query(spark, sf):
        table = ScratchTable(spark, rows)
        assert len(databases()) == len(before) + 1
        broken = F.when(F.col("id") == 1, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")
        append(rows.select(broken) if fails == "while writing" else rows, table.name)
        if fails == "in the driver":
            raise KeyError("broken")
        return table.result(scan(spark, table.name))

    run = registered.QUERIES["some_query"]
    if fails == "not":
        assert sorted(r.id for r in run(spark, "").collect()) == [0, 1, 2]
    else:
        with pytest.raises(Exception, match="broken"):
            run(spark, "")
    assert databases() == before
