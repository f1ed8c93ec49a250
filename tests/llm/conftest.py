import pytest

from tests.conftest import settings, spark  # noqa: F401 - fixtures


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def table(spark, sf_dir, name):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
