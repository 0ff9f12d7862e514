import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def odd_docs(spark):
    """Nulls, empty texts, ties, repeated rows, a long text, and columns whose names clash with results."""
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [(None, None, None), (None, "a b c d e f", "s"), (1, "", "s"), (2, " \n\t ", None), (3, long, "t"), (4, long, "t"), (4, long, "t"), (5, "Ärger mit ünicode ✓ und so weiter im Text", "s"), (5, "one two", "u"), (6, "\x00odd\x0bblanks", "u")]
    docs = spark.createDataFrame([(i, t, "en" if i and i % 2 else None, s, 1, 2.0, "x") for i, t, s in rows], "doc_id long, text string, lang string, source string, n_hit int, score double, task string")
    return docs


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
