import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"wort{i % 977}" for i in range(30_000))

#: Null and empty texts, ties, repeated rows, a null id, a very long text, names that clash.
ODD_ROWS = [
    (1, None, "a", 0),
    (2, "", "b", 0),
    (3, "one", "a", 0),
    (4, "Same words here to see and to find again", "b", 1),
    (5, "same words here to see and to find again", "b", 1),
    (6, "Same words here to see and to find again", None, 1),
    (6, "Same words here to see and to find again", None, 1),
    (None, "a text without an id, quite unlike the rest of them all", "c", 2),
    (8, LONG, "c", 2),
    (9, "ünïcode wörds ñandú 　 日本語 text with\x0bodd\x1fspace 😀 end", "a", 3),
    (10, "   \n\t ", "a", 3),
]

#: Columns that operators make themselves.
CLASHING = ["size", "shard", "slot", "fingerprint", "score", "spans", "row", "taken", "id", "u"]


@pytest.fixture(scope="session")
def odd(spark):
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("source", T.StringType()),
            *[T.StructField(c, T.IntegerType()) for c in CLASHING],
        ]
    )
    rows = [(i, t, s, *[n] * len(CLASHING)) for i, t, s, n in ODD_ROWS]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("1 = 0")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
