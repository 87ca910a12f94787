import pytest
from edge_rows import CLASHING, EDGE, SCHEMA
from pyspark.sql import functions as F



@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, blanks, a very long text with a copy, ties, repeated rows, one id with two texts, clashing columns."""
    df = spark.createDataFrame(EDGE, SCHEMA)
    df = df.withColumns({c: F.lit(f"kept {c}") for c in CLASHING})
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA).withColumns({c: F.lit(f"kept {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
