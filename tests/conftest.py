import pytest

from tessera.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="3g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(df) -> sorted list of tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) if columns else sorted(map(tuple, df.collect()), key=repr)

    return collect
