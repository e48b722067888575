from __future__ import annotations

import random
from datetime import date, datetime

from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.state import RunState, latest_checkpoints
from tidemark.session import scratch_path


def test_lookup_insert_update_and_skip(spark):
    state = RunState(spark, scratch_path(spark, "state"))
    assert state.checkpoint("p") is None
    assert state.checkpoints().count() == 0 and state.events().count() == 0
    assert state.save_checkpoint("p", "100")
    assert state.checkpoint("q") is None
    assert state.save_checkpoint("p", "200") and state.save_checkpoint("q", "7")
    assert not state.save_checkpoint("p", None) and not state.save_checkpoint("p", "")
    assert state.checkpoint("p") == "200"
    assert rows(state.checkpoints(), "dag_id", "checkpoint_to") == [("p", "200"), ("q", "7")]


def test_similar_names_do_not_mix(spark):
    state = RunState(spark, scratch_path(spark, "state"))
    state.save_checkpoint("a-b", "1")
    assert state.checkpoint("a_b") is None
    state.save_checkpoint("a_b", "2")
    assert (state.checkpoint("a-b"), state.checkpoint("a_b")) == ("1", "2")
    assert state.checkpoints().columns == ["dag_id", "checkpoint_to", "updated_at"]


def test_newest_wins_by_time_then_sequence_however_hot_the_key(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.5 else f"p{rng.randrange(20)}", str(i), rng.randrange(50), i) for i in range(2000)]
    expected = {}
    for dag, value, at, seq in data:
        expected[dag] = max(expected.get(dag, (-1, -1, "")), (at, seq, value))
    log = spark.createDataFrame(data, "dag_id string, checkpoint_to string, at int, seq bigint")
    log = log.select("dag_id", "checkpoint_to", F.timestamp_seconds("at").alias("updated_at"), "seq")
    got = dict(rows(latest_checkpoints(log), "dag_id", "checkpoint_to"))
    assert got == {dag: value for dag, (_, _, value) in expected.items()}


def test_events(spark):
    state = RunState(spark, scratch_path(spark, "events"))
    event = {"dag_id": "p", "run_id": "r", "status": "success", "start_time": datetime(2024, 1, 1, 2),
             "ingestion_date": date(2024, 1, 1), "record_count": 5, "checkpoint_from": None}
    state.append_event(event, {"status": "partial", "owner": "me", "tries": 2})
    state.append_event({"dag_id": "p", "run_id": "r2", "status": "failed", "error": "it's \"bad\""})
    first, second = state.events().orderBy("run_id").collect()
    assert (first.status, first.record_count, first.ingestion_date) == ("partial", 5, date(2024, 1, 1))
    assert first.start_time == datetime(2024, 1, 1, 2) and first.checkpoint_from is None
    assert first.extra == {"owner": "me", "tries": "2"}
    assert second.error == "it's \"bad\"" and second.extra is None and second.record_count is None
