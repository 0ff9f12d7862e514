import pytest
from pyspark.sql import SparkSession

from seqsluice.session import configured


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return configured(session)


@pytest.fixture()
def lines(spark):
    return lambda *rows: spark.createDataFrame([(r,) for r in rows], "value string")
