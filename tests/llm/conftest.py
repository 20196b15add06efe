import pytest
from pyspark.sql import types as T

from lexiloom.session import ship_package


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, with the columns of the driver's table and some whose names clash."""
    ship_package(spark)

    def make(texts, first=0, **extra):
        rows = [
            (first + i, t, "en", ("b", "a", None)[i % 3], None if t is None else len(t), "x", 1, True)
            for i, t in enumerate(texts)
        ]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, clean_text string, size int, kept boolean"
        )
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def empty_docs(spark):
    ship_package(spark)
    return spark.createDataFrame(
        [],
        T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("lang", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("n_chars", T.LongType()),
            ]
        ),
    )
