import pytest

from seriesmill.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "seriesmill-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.driver.host": "localhost"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
