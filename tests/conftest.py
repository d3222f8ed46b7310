"""One local session for all tests."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from orolog.session import local_session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session(4, "orolog-tests", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
