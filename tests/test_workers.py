"""Threads of a batch: tags, pools, deadlines; and the table of states."""

from __future__ import annotations

import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.model import LEDGER_SCHEMA, RunContext, TableJob
from millrace.operators.ledger import ensure_states, jobs_failed_last, latest_states, note_states, state_table, write_ledger
from millrace.plans import batch as batch_module
from millrace.plans.table_load import Target
from millrace.plans.workers import side_by_side
from millrace.session import scratch_table
from millrace.sources.lake import LakeSource

RUN = RunContext("r1", "2024010203", "app", "daily", datetime(2024, 1, 2, 3))


def slow(spark, seconds):
    nap = F.udf(lambda n: time.sleep(seconds) or n, "long")
    return spark.range(1, numPartitions=1).select(nap("id").alias("id"))


def test_results_come_in_order_with_tag_and_pool(spark):
    spark.sparkContext.setLocalProperty("millrace.test", "inherited")
    seen = []

    def work(item):
        context = spark.sparkContext
        seen.append((item, context.getLocalProperty("spark.scheduler.pool"), len(context.getJobTags()),
                     context.getLocalProperty("millrace.test")))
        return item * 10

    try:
        assert side_by_side(spark, list(range(7)), work, lambda i: -1, workers=3, pool=lambda i: f"p{i}") == [i * 10 for i in range(7)]
    finally:
        spark.sparkContext.setLocalProperty("millrace.test", None)
    assert sorted(seen) == [(i, f"p{i}", 1, "inherited") for i in range(7)]
    assert side_by_side(spark, [], work, work) == []


def test_an_error_of_the_work_is_raised(spark):
    def work(item):
        if item == 1:
            raise ValueError("one")
        return item

    with pytest.raises(ValueError, match="one"):
        side_by_side(spark, [0, 1, 2], work, lambda i: -1)


def test_a_deadline_cancels_only_its_own_jobs(spark):
    def work(item):
        return len(slow(spark, 120 if item == 1 else 3).collect())

    began = time.monotonic()
    assert side_by_side(spark, [0, 1, 2], work, lambda i: "late", workers=3, deadline=20) == [1, "late", 1]
    assert time.monotonic() - began < 60


def test_work_that_no_job_can_stop_is_left_behind(spark):
    never = threading.Event()

    def work(item):
        if item == 0:
            never.wait(120)
        return item

    began = time.monotonic()
    assert side_by_side(spark, [0, 1, 2], work, lambda i: "late", workers=1, deadline=1, grace=1) == ["late", 1, 2]
    assert time.monotonic() - began < 30
    never.set()


def test_a_hung_table_fails_and_the_others_land(spark):
    schema, name = scratch_table(spark, "hung").split(".")
    jobs = [TableJob(f"J{i}", "s", f"t{i}", schema, f"{name}_{i}") for i in range(3)]
    target, ledger, log = Target(spark, scratch_table(spark, "tracker")), scratch_table(spark, "ledger"), batch_module.RunLog()
    source = LakeSource(spark, lambda schema, table: slow(spark, 300) if table == "t1" else spark.range(5))
    rows = batch_module.run_jobs(spark, jobs, source, target, RUN, ledger, log, deadline=25)
    found = {r.job_id: (r.status, r.error_message, r.comments) for r in rows.collect()}
    assert found["J0"][0] == found["J2"][0] == "COMPLETED" and found["J1"][0] == "FAILED"
    assert "took more than 25 seconds" in found["J1"][1] and found["J1"][2] == "CRITICAL: Network Connectivity issue"
    assert [spark.table(target.table(jobs[i])).count() for i in (0, 2)] == [5, 5]
    assert [r.job_id for r in jobs_failed_last(spark.table(state_table(ledger)), "daily").collect()] == ["J1"]


def states(spark, rows):
    full = [tuple({"job_id": j, "run_group": g, "batch_id": b, "run_id": f"r{b}", "status": s,
                   "start_time": None if t is None else datetime(2024, 1, t)}.get(f) for f in LEDGER_SCHEMA.fieldNames())
            for j, g, b, s, t in rows]
    return spark.createDataFrame(full, LEDGER_SCHEMA)


def test_states_follow_the_latest_row_whatever_comes_last(spark):
    table = scratch_table(spark, "states")
    runs = [[("J1", "daily", "1", "FAILED", 1), ("J2", "daily", "1", "FAILED", 1), ("J1", "hourly", "1", "FAILED", 9)],
            [("J1", "daily", "3", "COMPLETED", 3), ("J3", "daily", "3", "FAILED", None)],
            [("J1", "daily", "2", "FAILED", 2), ("J2", "daily", "2", "COMPLETED", 2), ("J2", "daily", "2", "STARTED", 2)]]
    for rows in runs:
        note_states(states(spark, rows), table, most=2)
    history = states(spark, sum(runs, []))
    for group in ("daily", "hourly"):
        kept, whole = (sorted(map(tuple, jobs_failed_last(rows, group).collect())) for rows in (spark.table(table), history))
        assert kept == whole
    assert latest_states(spark.table(table)).count() == 4 and len(spark.table(table).inputFiles()) <= 2


def test_states_of_an_older_ledger_are_read_once(spark):
    ledger = scratch_table(spark, "ledger")
    write_ledger(states(spark, [("J1", "daily", "1", "FAILED", 1), ("J1", "daily", "2", "COMPLETED", 2)]), ledger)
    ensure_states(spark, ledger)
    assert [(r.job_id, r.status) for r in spark.table(state_table(ledger)).collect()] == [("J1", "COMPLETED")]


def test_many_states_pass_several_tasks(spark):
    """Without coalescing every partition of the states is a file; no task takes all of them."""
    table = scratch_table(spark, "states")
    runs = [[(f"J{i}", "daily", str(b), "FAILED" if (i + b) % 3 else "COMPLETED", b) for i in range(200)] for b in (1, 3, 2)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for rows in runs:
            note_states(states(spark, rows), table, most=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spark.table(table).inputFiles()) > 1 and spark.table(table).count() == 200
    assert {r.job_id for r in jobs_failed_last(spark.table(table), "daily").collect()} == {f"J{i}" for i in range(200) if i % 3}
    note_states(states(spark, runs[0]), table, most=2)  # two additions, of however many files
    assert spark.table(table).count() == 400


def test_a_history_that_was_read_in_part_is_read_again(spark, monkeypatch):
    ledger = scratch_table(spark, "ledger")
    write_ledger(states(spark, [(f"J{i}", "daily", "1", "FAILED", 1) for i in range(4)]), ledger)

    def die(rows, table, fmt):
        note_states(rows.where("job_id = 'J1'"), table, fmt)
        raise KeyboardInterrupt

    monkeypatch.setattr("millrace.operators.ledger.note_states", die)
    with pytest.raises(KeyboardInterrupt):
        ensure_states(spark, ledger)
    monkeypatch.undo()
    ensure_states(spark, ledger)
    ensure_states(spark, ledger)
    assert latest_states(spark.table(state_table(ledger))).count() == 4 and spark.table(state_table(ledger)).count() == 5
