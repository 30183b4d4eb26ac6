import itertools

import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tidemark-tests", "local[2]", **{
        "spark.sql.shuffle.partitions": "2",
        "spark.ui.enabled": "false",
        "spark.sql.codegen.wholeStage": "false",    # compiling costs more than the few rows here
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    """Fresh folder names below the test's own folder."""
    numbers = itertools.count()
    return lambda name="t": str(tmp_path / f"{name}{next(numbers)}")


@pytest.fixture(scope="session")
def rows():
    """All rows of a frame as sorted tuples: a bag that can be compared."""
    def as_bag(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return as_bag
