import pytest

from carelake.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, driver_memory="8g")


@pytest.fixture
def rows():
    """Sorted tuples of a DataFrame."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
