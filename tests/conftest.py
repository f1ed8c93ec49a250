import pytest

from amendry.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df):
    """Rows as a sorted list of tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])
