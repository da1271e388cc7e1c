import pytest
from pyspark.sql import types as T

DOC = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text) pairs, with an extra column of a clashing name."""

    def make(pairs, **extra):
        rows = [(d, t, "en", "s", None) for d, t in pairs]
        df = spark.createDataFrame(rows, DOC)
        for name, value in extra.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make
