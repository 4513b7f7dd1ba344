from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from loomline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(4, app="tests", **{
        "spark.sql.warehouse.dir": str(warehouse),
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def catalog(spark):
    """An empty default database around a test."""

    def clear():
        for table in spark.catalog.listTables():
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")

    clear()
    yield spark
    clear()
