"""Every registered query against DuckDB over the same tables."""

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

# Queries of optional parts without SQL have tests of their own.
ORACLES = driver.oracle_sql()
QUERIES = {name: query for name, query in driver.queries().items() if name in ORACLES}


TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def plain(value):
    """Exact values; only the numeric class (int, decimal, double) is kept apart."""
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(record[i]) for i in order] for record in records), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    from registered import oracles, queries

    assert set(queries.QUERIES) == set(oracles.ORACLES)
    assert set(ORACLES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_oracle(spark, duck, sf_dir, name):
    answer = QUERIES[name](spark, sf_dir)
    found = rows(answer.columns, [tuple(r) for r in answer.collect()])
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = rows(columns, cursor.fetchall())
    assert sorted(answer.columns) == sorted(columns)
    types = {d[0]: TYPES[str(d[1])] for d in cursor.description}
    assert dict(answer.dtypes) == types
    assert found == expected
    assert len(found) > 0


def test_entry(spark):
    answer = driver.entry(spark)
    assert answer.columns == ["account_id", "total_spend"]
    assert answer.count() > 0


def test_known_values(spark):
    sf = "/root/testdata/sf0.01"
    assert QUERIES["finance_gold"](spark, sf).filter("account_id = 0").first().total_spend == 2504339.15
    assert QUERIES["finance_gold"](spark, sf).count() == 1500
    assert QUERIES["manufacturing_gold"](spark, sf).filter("plant_id = 0").first().total_output == 16492.0
    counts = {r.event_type: r.event_count for r in QUERIES["sbe_gold"](spark, sf).collect()}
    assert counts == {"click": 2006, "purchase": 1981, "signup": 2017, "view": 1982}
    assert QUERIES["keep_positive"](spark, sf).count() == 1378
