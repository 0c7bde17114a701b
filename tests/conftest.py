import pytest

from surveyloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("*", "tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate an expression over one row of named values."""

    def run(expr, schema="x string", *values):
        return spark.createDataFrame([values], schema).select(expr.alias("r")).first()["r"]

    return run
