import pytest

from admitflow import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "admitflow-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
