import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def table(spark):
    """(doc_id, text) rows with extra columns whose names clash with the operators' own."""

    def make(rows, id_name="doc_id", text_name="text"):
        df = spark.createDataFrame(rows, f"{id_name} long, {text_name} string")
        for c in ("chunk", "bucket", "key", "row", "n", "sha", "cls", "score", "task", "k", "kept", "norm", "carried_0"):
            df = df.withColumn(c, F.lit("x"))
        return df

    return make


ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a b c"), (4, "A b c"), (4, "A b c"), (None, None), (5, "x" * 50_000)]


@pytest.fixture
def odd_rows():
    return ODD
