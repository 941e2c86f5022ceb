import pytest

from strandline.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("strandline-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
