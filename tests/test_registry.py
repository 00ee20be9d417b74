"""Every registered query of the mart against its SQL on the smallest test tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.registry.oracle import ORACLE
from tidemark.registry.queries import QUERIES
from tidemark.registry.tables import landed_warehouse, snapshot_warehouse

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def problems(spark):
    """What differs per query; a few queries run at the same time to save waiting."""
    connection = connect(FOLDER)
    for build in (snapshot_warehouse, landed_warehouse):
        build(spark, FOLDER)

    def check(name):
        try:
            return compare(spark, connection.cursor(), FOLDER, name)
        except Exception as error:  # noqa: BLE001 - reported by the test of that query
            return repr(error)

    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(QUERIES, pool.map(check, QUERIES)))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns[:2] == ["builder", "current_milestone"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(problems, name):
    assert problems[name] is None
