import brute_llm as bf
import pytest
from pyspark.sql import types as T

CLASH = ["fp", "id", "words", "seg", "kept", "slot", "block", "bucket", "before", "component_id", "n_words", "score", "shard", "cls"]


@pytest.fixture(scope="session")
def frame(spark):
    """(rows of id and text) -> documents with NULL and clashing columns."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in CLASH]])

    def make(rows):
        return spark.createDataFrame([(i, t, None, (None, "a", "b")[k % 3], None, *["x"] * len(CLASH)) for k, (i, t) in enumerate(rows)], schema).repartition(5)

    return make


@pytest.fixture(scope="session")
def edge(frame):
    return frame(bf.edge_texts())


@pytest.fixture(scope="session")
def ready(spark):
    from strata.llm.common import prepare

    return prepare(spark)
