import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def texts(spark):
    """Documents with nulls, empty and blank texts, repeated rows and clashing columns."""
    rows = [
        (1, None, 7), (2, "", 7), (3, " \n", 7), (4, "a b", 7), (5, "A  b", 7), (5, "A  b", 7), (None, "a b", 7),
        (7, "c", 7), (8, "c", 7), (9, "a b c d", 7), (10, "a b\tc d", 7),
        (11, " ".join(map(str, range(40))), 7), (12, " ".join(map(str, range(41))), 7), (13, "x " * 5000, 7),
        (14, "漢字 ünï​ \x1c½²", 7), (15, None, None),
    ]
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("kept", T.IntegerType()),
    ])
    df = spark.createDataFrame(rows, schema)
    extra = {c: df["kept"] for c in ("n", "row", "score", "key", "block", "__size", "__sha", "id", "group", "label")}
    return df.withColumns(extra)
