"""The registered queries: those with SQL against DuckDB, all of them for whole tables and named columns."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.llm.queries import oracle_sql, queries

COLUMNS = {
    "op1": "query_id rank vec_id score",
    "op2": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op3": "page_id url text n_chars",
    "op4": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5": "page_id host path rule verdict",
    "op6": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7": "doc_id n_shingles component_id",
    "op8": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op9": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op10": "doc_id held_out score predicted",
    "op11": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13": "doc_id n_features weight score rank",
}


def test_every_operator_is_registered():
    names = driver.queries()
    assert "pipeline" in names and sorted(n.partition("_")[0] for n in queries()) == sorted(COLUMNS)
    assert set(queries()) <= set(names) and set(oracle_sql()) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_columns(spark, sf_dir, name):
    assert set(COLUMNS[name.partition("_")[0]].split()) <= set(queries()[name](spark, sf_dir).columns)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")

    def rows(table):
        columns = sorted(table.column_names)
        kinds = [str(table.schema.field(c).type).replace("large_", "") for c in columns]
        return list(zip(columns, kinds)), sorted(tuple(map(str, row)) for row in zip(*(table.column(c).to_pylist() for c in columns)))

    assert rows(queries()[name](spark, sf_dir).toArrow()) == rows(duck.sql(oracle_sql()[name]).to_arrow_table())
