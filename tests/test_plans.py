"""The shape of the plans: what is scanned, what is shuffled, what leaves the JVM."""

from __future__ import annotations

import re

import pytest
from helpers import plan_text

from tidemark.plans.queries import queries

NO_SHUFFLE = [
    "table_full_scan", "table_window_ts", "table_window_int", "table_custom_query", "table_partitioned_scan",
    "table_filters", "file_lower_bound", "file_window", "file_post_filters", "kafka_decode_string",
    "kafka_decode_json", "checkpoint_parse", "checkpoint_serde", "checkpoint_literal", "run_id_sanitize",
    "scheme_normalize", "landing_path", "prewrite_prune_cast", "run_event_envelope", "run_event_flatten",
    "run_event_queue",
]
ONE_SHUFFLE = ["table_record_count", "table_max_checkpoint", "file_max_checkpoint", "kafka_end_offsets",
               "checkpoint_store_upsert"]
SCANNED = {
    "table_custom_query": "o_orderkey,o_orderstatus,o_totalprice",
    "table_partitioned_scan": "o_orderkey,o_totalprice",
    "table_record_count": "",
    "table_max_checkpoint": "o_orderdate",
    "file_max_checkpoint": "ts",
    "kafka_decode_string": "event_id,ts,user_id,props",
    "kafka_end_offsets": "event_id,user_id",
    "run_id_sanitize": "page_id,url",
    "scheme_normalize": "page_id,url",
    "landing_path": "event_id,ts,event_type",
    "run_event_flatten": "event_id,ts,user_id,event_type",
    "run_event_retention": "event_id,ts,event_type",
}
PYTHON = re.compile("EvalPython|MapInPandas|MapInArrow|FlatMapGroups")


@pytest.fixture(scope="module")
def plan(spark, sf_dir):
    cache = {}

    def build(name):
        if name not in cache:
            cache[name] = plan_text(queries()[name](spark, sf_dir))
        return cache[name]

    return build


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_wise_operators_do_not_shuffle(plan, name):
    assert "Exchange" not in plan(name) and not PYTHON.search(plan(name))


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_aggregates_combine_before_their_only_shuffle(plan, name):
    text = plan(name)
    assert text.count("Exchange") == 1 and text.count("partial_") >= 1 and not PYTHON.search(text)


@pytest.mark.parametrize("name", SCANNED)
def test_only_needed_columns_are_read(plan, name):
    columns = [
        [field.split(":")[0] for field in schema.split(",") if field]
        for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan(name))
    ]
    assert columns == [[c for c in SCANNED[name].split(",") if c]]


def test_custom_query_filters_reach_the_scan(plan):
    assert "EqualTo(o_orderstatus,F)" in plan("table_custom_query")
