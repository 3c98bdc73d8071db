import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOC = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text) -> DataFrame; also with clashing extra columns."""
    def make(rows, parts=3):
        return spark.createDataFrame(rows, DOC).repartition(parts)
    return make


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", "to"] * 6 + ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def some(n, seed):
        r = random.Random(seed)
        return [r.choice(vocabulary) for _ in range(n)]
    return some
