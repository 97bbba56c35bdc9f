import pytest

from claimweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def rows_of(df, *order):
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r)) if not order else found
