"""Every registered query against its SQL over the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(
    not Path(contract.SMOKE_DIR).exists(), reason="the given tables are not here"
)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{contract.SMOKE_DIR}/{name}.parquet"
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == [
        "observation_date", "region", "region_name", "daily_total_load", "rank",
    ]
    assert rows.count() > 0


OWN = sorted(k for k in contract.queries() if k != "pipeline" and not k.startswith("op"))


def test_every_query_has_its_sql():
    assert set(OWN) <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", OWN)
def test_query_matches_its_sql(spark, database, name):
    found = contract.queries()[name](spark, contract.SMOKE_DIR)
    expected = database.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted((tuple(row) for row in found.select(*columns).collect()), key=repr) == sorted(
        expected.fetchall(), key=repr
    )
