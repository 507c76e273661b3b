import pytest

from idtrail.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8)
    yield session
    session.stop()


@pytest.fixture
def rows():
    def run(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is None, str(v)) for v in t])

    return run
