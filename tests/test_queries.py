"""Every registered query against DuckDB on the same Parquet files."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from tidemark.plans.queries import oracle_sql, queries

ORACLES = oracle_sql()


def canonical(table):
    """Column names with their types, and the rows as sorted text tuples."""
    names = sorted(table.column_names)
    kinds = [str(table.schema.field(n).type).replace("large_", "") for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    return list(zip(names, kinds)), sorted(tuple(map(str, row)) for row in zip(*columns))


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_an_oracle():
    assert set(queries()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    ours = canonical(queries()[name](spark, sf_dir).toArrow())
    theirs = canonical(duck.sql(ORACLES[name]).to_arrow_table())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
