import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) pairs, dealt over a few partitions."""
    def build(rows, **extra):
        frame = spark.createDataFrame(rows, DOCS)
        return frame.repartition(3) if rows else frame

    return build
