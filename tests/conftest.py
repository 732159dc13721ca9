import pytest

from tripmart.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tripmart-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    """A folder for one table."""
    return str(tmp_path / "table")


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def plan(df):
    """Physical plan as text."""
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
