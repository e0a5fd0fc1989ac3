import pytest
from pyspark.sql.types import LongType, StringType, StructType

DOCUMENTS = (
    StructType()
    .add("doc_id", LongType())
    .add("text", StringType())
    .add("lang", StringType())
    .add("source", StringType())
    .add("n_chars", LongType())
)

LONG = "lorem ipsum dolor sit amet, " * 4000


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, copies and repeated rows,
    and columns whose names operators use themselves."""
    rows = [
        (1, "The cat sat on the mat with the other cats of the house.", "en", "a", 5),
        (1, "The cat sat on the mat with the other cats of the house.", "en", "a", 5),
        (2, "The cat sat on the mat with the other cats of the house.", "en", "b", 5),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n\r ", "en", "a", 5),
        (6, LONG, "la", "a", len(LONG)),
        (7, "señor über naïve 漢字 😀 — fin", "es", "c", 9),
        (None, "no id at all here", "en", "a", 5),
        (None, None, None, None, None),
        (8, "12 34 56", "en", "a", 8),
        (9, "Der Hund ist nicht in dem Haus und die Katze auch nicht.", "de", "a", 5),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("fp", "words", "seed", "key", "score", "kept", "terms", "spans", "factor", "rank"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(small):
    return {r.doc_id: r.text for r in small.select("doc_id", "text").collect()}


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, str(r[1:])))
