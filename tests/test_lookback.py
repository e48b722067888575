"""Late rows: overlapping windows land every row once, whatever arrives when and whichever runs are repeated."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest
from helpers import plan_text
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_pipeline import Job

from tidemark.operators.lookback import earlier_bound, identity_of, not_landed
from tidemark.operators.upsert import read_current
from tidemark.plans.spec import PipelineSpec, SpecError

SOURCE = {"format": "parquet", "database": "d", "schema": "s", "table": "t", "checkpoint_column": "at"}
DDL = "id bigint, at bigint, v string"


def job(spark, lookback="20", source=None, **more):
    return Job(spark, source=SOURCE | {"lookback": lookback, "identity": ["id"]} | (source or {}), **more)


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


@pytest.mark.parametrize(
    ("kind", "bound", "back", "want"),
    [
        (T.LongType(), "100", "30", "70"),
        (T.IntegerType(), "5", "30", "-25"),
        (T.DecimalType(10, 2), "1.50", "0.25", "1.25"),
        (T.TimestampType(), "2024-01-10 00:00:00+00:00", "36 hours", "2024-01-08 12:00:00+00:00"),
        (T.TimestampNTZType(), "2024-01-10 00:00:00", "1 day 1 hour", "2024-01-08 23:00:00"),
        (T.DateType(), "2024-03-01", "1 day", "2024-02-29"),
    ],
)
def test_bounds_move_in_the_type_of_the_column(spark, kind, bound, back, want):
    assert earlier_bound(spark, bound, kind, back) == want


def test_refusals(spark):
    with pytest.raises(TypeError):
        earlier_bound(spark, "b", T.StringType(), "1 day")
    with pytest.raises(ValueError, match="lack x"):
        identity_of(T.StructType.fromDDL(DDL), ["x"], "at")
    assert identity_of(T.StructType.fromDDL("id int, at int, m map<string,int>, a array<int>"), [], "at") == ["id", "a"]
    with pytest.raises(SpecError):
        PipelineSpec.from_dict("d", {"read_type": "file", "write_type": "hadoop", "source": {"path": "/x", "lookback": "1"}, "sink": {"endpoint": "/y", "source_system_name": "s"}})


def test_nulls_repeats_and_newer_rows(spark):
    rows = frame(spark, [(1, 5, "a"), (None, 5, "b"), (2, 5, "c"), (2, 5, "c"), (3, 5, "d")])
    landed = frame(spark, [(1, 5, "x"), (None, 5, "x"), (3, 6, "x"), (2, 4, "x")])
    assert sorted(r.v for r in not_landed(rows, landed, ["id"], "at").collect()) == ["c", "c", "d"]
    assert sorted(r.v for r in not_landed(rows, landed, ["id"], "at", keyed=True).collect()) == ["c", "c"]
    assert not_landed(rows, landed.limit(0), ["id"], "at").count() == 5


def test_a_late_row_lands_once_and_an_older_one_is_lost(spark):
    late = job(spark)
    first = [(i, i, "on time") for i in range(0, 100, 2)]
    late.run("r1", frame(spark, first))
    second = [*first, (1001, 97, "late"), (1002, 79, "late"), (1003, 78, "too late"), (1004, 150, "on time")]
    assert late.run("r2", frame(spark, second)).record_count == 3
    assert late.run("r3", frame(spark, second)).record_count == 0
    got = Counter(r.id for r in late.landed().collect())
    assert set(got.values()) == {1} and 1003 not in got and {1001, 1002, 1004} <= set(got)


def test_random_arrivals_repeats_and_failures_land_every_row_once(spark, monkeypatch):
    """Rows arrive up to 30 below the checkpoint; any earlier run may be repeated at any time."""
    pick = random.Random(3)
    late = job(spark, "30", sink={"partition_by": ["v"]})
    seen, top, number, done = [], 0, 0, []
    for turn in range(6):
        checkpoint = top
        for _ in range(pick.randint(1, 15)):
            at = pick.randint(max(0, checkpoint - 29), checkpoint + 25)
            seen.append((number, at, pick.choice("ab")))
            number += 1
        top = max(at for _, at, _ in seen)
        if pick.random() < 0.3:
            with pytest.raises(OSError):
                late.run(f"r{turn}", frame(spark, seen), publish=lambda _: (_ for _ in ()).throw(OSError()))
        late.run(f"r{turn}", frame(spark, seen))
        done.append(f"r{turn}")
        if pick.random() < 0.5:
            late.run(pick.choice(done), frame(spark, seen))
    late.run("last", frame(spark, seen))
    assert Counter(r.id for r in late.landed().collect()) == Counter(i for i, _, _ in seen)


def test_whole_rows_tell_apart_where_no_identity_is_given(spark):
    late = job(spark, source={"identity": None})
    late.run("r1", frame(spark, [(1, 10, "a"), (2, 20, None)]))
    assert late.run("r2", frame(spark, [(1, 10, "a"), (1, 10, "b"), (2, 20, None), (2, 20, "c")])).record_count == 2


@pytest.mark.parametrize("mode", ["upsert", "merge"])
def test_keyed_tables_never_go_back_to_an_older_row(spark, mode):
    late = job(spark, sink={"mode": mode, "keys": ["id"], "order_by": ["at"], "buckets": 4})
    log = [(1, 10, "old"), (1, 18, "new"), (2, 20, "x")]
    late.run("r1", frame(spark, log))
    late.run("r2", frame(spark, [*log, (1, 15, "late and old"), (2, 20, "x"), (3, 12, "late"), (4, 25, "y")]))
    base = f"{late.root}/lake/sys/d/s/t"
    want = {1: "new", 2: "x", 3: "late", 4: "y"}
    assert {r.id: r.v for r in read_current(spark, base).collect()} == want
    late.run("r2", frame(spark, [*log, (3, 12, "late"), (4, 25, "y")]))  # a retry starts from the version before
    assert {r.id: r.v for r in read_current(spark, base).collect()} == want


def test_timestamps_and_csv_landings(spark):
    late = job(spark, "2 days", sink={"file_format": "csv"})
    day = lambda d, h=0: datetime(2024, 1, d, h)
    ddl = "id bigint, at timestamp, v string"
    first = [(1, day(5), "a"), (2, day(9), "b")]
    late.run("r1", frame(spark, first, ddl))
    assert late.run("r2", frame(spark, [*first, (3, day(7, 1), "late"), (4, day(6), "too late"), (5, day(12), "c")], ddl)).record_count == 2


def test_only_the_runs_concerned_are_read(spark, monkeypatch):
    late = job(spark, "5")
    for turn in range(4):
        late.run(f"r{turn}", frame(spark, [(i, i, "a") for i in range(10 * (turn + 1))]))
    plans = []
    from tidemark.plans import pipeline

    def spy(rows, landed, *more, **named):
        plans.append(sorted({f.rsplit("/run_id=", 1)[-1].split("/")[0].split("_")[-1] for f in landed.inputFiles()}))
        plans.append(plan_text(landed))
        return not_landed(rows, landed, *more, **named)

    monkeypatch.setattr(pipeline, "not_landed", spy)
    late.run("r9", frame(spark, [(i, i, "a") for i in range(60)]))
    assert len(plans[0]) == 1 and "GreaterThan(at,34)" in plans[1] and "LessThanOrEqual(at,39)" in plans[1]
