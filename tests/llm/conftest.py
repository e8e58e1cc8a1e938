import pytest


@pytest.fixture(autouse=True, scope="session")
def workers(spark):
    """Functions defined in test modules travel by value; the package itself is on the workers' path."""
    return spark
