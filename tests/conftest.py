import pytest
from pyspark.sql import SparkSession

from shopgrain.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.checkpoint.dir": str(scratch / "shared"),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
