import pytest
from pyspark.sql import SparkSession

from tierlake.session import configure, use_local_scratch


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tierlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield use_local_scratch(configure(session))
    session.stop()
