import pytest

from saleswright.session import local_session
from saleswright.sources.staging import drop_staged

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    from saleswright.sources import star_sales

    return star_sales(spark, SF_SMALL)


@pytest.fixture(scope="session")
def sales(spark):
    from saleswright.sources import clean_star_sales, staged

    return staged(spark, SF_SMALL, "sales", lambda: clean_star_sales(spark, SF_SMALL))


@pytest.fixture
def plan():
    """Text of the optimized physical plan."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
