import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


#: Nulls, empty and blank texts, repeated rows, a long text, and columns whose names clash with those operators make.
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "s0", 1, "x"),
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "s0", 1, "x"),
    (2, None, "en", "s0", 1, None),
    (3, "", None, None, 0, "y"),
    (4, " \t\n ", "de", "s1", 4, "y"),
    (None, "alpha beta gamma delta epsilon zeta eta theta", "en", "s1", 1, "z"),
    (5, "word " * 20_000, "xx", "s0", 100_000, "z"),
    (6, "Ünïcödé 😀 one\ntwo\n\ntwo three four", "de", "s2", 1, "z"),
    (7, "a", "de", "s2", 1, "z"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
