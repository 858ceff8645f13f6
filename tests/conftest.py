from __future__ import annotations

import tempfile

import pytest

from clearbook.session import build_session


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="clearbook-warehouse-")
    session = build_session(
        "local[4]",
        4,
        **{
            "spark.sql.warehouse.dir": warehouse,
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect
