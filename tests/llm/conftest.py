import pytest
from pyspark.sql import types as T

from cadenza.llm.registry import ready

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.StringType()),
                     T.StructField("th", T.StringType()), T.StructField("__hash", T.StringType()), T.StructField("score", T.DoubleType())])


def words(seed, n):
    """Invented words that no two seeds share."""
    return [f"w{seed}x{i * 7919 % 1000003}" for i in range(n)]


LONG = " ".join(words(1, 3000))
#: null and empty texts, null ids, ties, repeated rows, white space, a long text and its near copy, signs beyond ASCII
ROWS = [(1, "Ärger  mit\tdem Text"), (2, "Ärger mit dem Text"), (3, None), (4, ""), (5, " "), (6, "\t\n"), (7, LONG), (8, LONG + " end"), (8, LONG + " end"),
        (9, " ".join(words(2, 60))), (10, " ".join(words(2, 60)).upper()), (None, " ".join(words(2, 60))), (None, None), (11, "one two"), (12, "One two"),
        (13, " ".join(words(3, 40) + words(2, 60) + words(4, 40))), (14, "x" * 500), (15, "ab" * 300), (16, "\x00\x01   \U0001f600 é")]


@pytest.fixture(scope="session")
def docs(spark):
    ready(spark)
    return spark.createDataFrame([(*r, "a", "b", None, 0.5) for r in ROWS], DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    ready(spark)
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def rows():
    return ROWS


@pytest.fixture(scope="session")
def invented():
    return words
