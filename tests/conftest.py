from __future__ import annotations

import pytest

from adoptrend.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
