import pytest
from corpus_data import CLASHING, SCHEMA, document_rows

from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def rows():
    return document_rows()


@pytest.fixture(scope="session")
def odd_docs(spark, rows):
    """The documents with extra columns of awkward names."""
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
