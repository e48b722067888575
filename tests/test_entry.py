from __future__ import annotations

import importlib
import sys

import __spark_entry__ as driver


def test_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    got = driver.entry(spark)
    assert got.columns == ["run_id", "record_count", "checkpoint_to"] and got.count() == 3


def test_the_training_data_operators_can_be_taken_away(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        without = importlib.reload(driver)
        assert "table_full_scan" in without.queries()
        assert not any(name == "pipeline" or name.startswith("op") for name in [*without.queries(), *without.oracle_sql()])
    finally:
        monkeypatch.undo()
        importlib.reload(driver)
