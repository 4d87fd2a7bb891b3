"""Threads that submit the Spark jobs of several tables, each with its own tag and pool, and a deadline that ends its jobs alone."""

from __future__ import annotations

import threading
import time
import uuid
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

#: Seconds between two looks at the clock, and after a deadline until a thread is given up that no cancelled job stops.
PULSE, GRACE = 0.5, 30.0


@dataclass
class _Turn:
    """One item in work."""

    number: int
    tag: str = field(default_factory=lambda: f"millrace-{uuid.uuid4().hex}")
    began: float = field(default_factory=time.monotonic)
    overdue: bool = False


def side_by_side(
    spark: SparkSession,
    items: list[Item],
    work: Callable[[Item], Result],
    late: Callable[[Item], Result],
    workers: int = 5,
    deadline: float | None = None,
    pool: Callable[[Item], str] = str,
    grace: float = GRACE,
) -> list[Result]:
    """The results of ``work`` for all items, in their order, by so many threads.

    Threads inherit the properties of the caller's. The Spark jobs of an item bear its own tag, and run in the scheduler
    pool that ``pool`` names. Past ``deadline`` seconds an item's running jobs are cancelled, again and again until its work
    ends, and its result is ``late``; work that is stuck outside of Spark is left behind after ``grace`` more seconds.
    """
    context = spark.sparkContext
    waiting, results = deque(range(len(items))), {}
    active: dict[int, _Turn] = {}
    guard, ended = threading.Condition(), threading.Event()

    def run() -> None:
        while True:
            with guard:
                if not waiting or ended.is_set():
                    return
                turn = _Turn(waiting.popleft())
                active[turn.number] = turn
            item = items[turn.number]
            context.addJobTag(turn.tag)
            context.setLocalProperty("spark.scheduler.pool", pool(item))
            context.setLocalProperty("spark.job.interruptOnCancel", "true")
            try:
                found = (False, work(item))
            except BaseException as error:  # raised again where all results are awaited
                found = (True, error)
            finally:
                context.removeJobTag(turn.tag)
            with guard:
                if active.get(turn.number) is not turn:
                    return  # given up
                del active[turn.number]
                if turn.overdue:
                    found = (False, late(item))
                results[turn.number] = found
                guard.notify_all()

    def begin() -> None:
        thread = InheritableThread(target=run, session=spark)
        thread.daemon = True
        thread.start()

    for _ in range(min(max(1, workers), len(items))):
        begin()
    while True:
        with guard:
            if len(results) == len(items):
                break
            guard.wait(PULSE)
            now = time.monotonic()
            past = [t for t in active.values() if deadline is not None and now - t.began > deadline]
            for turn in past:
                turn.overdue = True
                if now - turn.began > deadline + grace:
                    del active[turn.number]
                    results[turn.number] = (False, late(items[turn.number]))
                    begin()
        for turn in past:
            context.cancelJobsWithTag(turn.tag)
    ended.set()
    for failed, value in results.values():
        if failed:
            raise value
    return [results[i][1] for i in range(len(items))]
