import pytest

from tableward import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build(
        "tests", master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    session.release(s)
    s.stop()
