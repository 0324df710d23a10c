import pytest
from pyspark.sql import functions as F

from dimload.sources import cut_lineage, scratch_dir


class Session:
    """A session with a given setting and master."""

    def __init__(self, master, value=""):
        self.sparkContext = type("Context", (), {"master": master})()
        self.settings = {"spark.checkpoint.dir": value} if value else {}
        self.conf = self

    def get(self, key, default):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_the_folder_of_the_session_is_used():
    assert scratch_dir(Session("yarn", "hdfs://shared/folder/")) == "hdfs://shared/folder"


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"))


def test_a_local_session_gets_one_folder_of_its_own():
    session = Session("local[2]")
    assert scratch_dir(session) == scratch_dir(session)


def test_rows_and_places_survive(spark):
    df = cut_lineage(spark.range(0, 100, 1, 3).withColumn("at", F.spark_partition_id()))
    assert df.where(F.col("at") != F.spark_partition_id()).count() == 0
    assert df.count() == 100
