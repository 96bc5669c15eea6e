from __future__ import annotations

import pytest

from cuadre.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            # plan tests read pushed filters and scan schemas in full
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as sorted tuples, so that tests do not depend on row order."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
