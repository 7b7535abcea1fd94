from __future__ import annotations

import uuid
from datetime import datetime

import pytest

from tablewarden.config import WatchConfig
from tablewarden.session import local_session
from tablewarden.state.store import WatchStore, shared_folder


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return WatchConfig(as_of=datetime(2024, 1, 31))


@pytest.fixture
def store(spark):
    name = f"tests_{uuid.uuid4().hex[:12]}"
    made = WatchStore(spark, name, f"{shared_folder(spark).rstrip('/')}/{name}")
    made.ensure_tables()
    return made


@pytest.fixture
def rows(spark):
    """Rows as a DataFrame: ``rows("a INT, b STRING", (1, "x"), ...)``."""

    def make(ddl: str, *values: tuple):
        return spark.createDataFrame(list(values), ddl)

    return make
