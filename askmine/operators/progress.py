"""Counters of a run without a second scan, and how far it has come.

``counted`` puts an observation into a plan: its counts are there when the rows have been written, whoever reads them.
``Progress`` looks at the tasks of the jobs that run inside it and says their rate and the time that is left.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """(df, its counters: rows, and rows for which each condition holds); ``observation.get`` waits for the first action on df."""
    seen = Observation(name)
    counts = [F.count_if(F.coalesce(holds, F.lit(False))).alias(c) for c, holds in conditions.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def counted_by(df: DataFrame, name: str, column: str, values: list[str]) -> tuple[DataFrame, Observation]:
    """The same for the values of a column, such as the reasons for which rows go; ``kept`` counts the nulls."""
    return counted(df, name, kept=F.col(column).isNull(), **{v: F.col(column) == v for v in values})


class Progress:
    """``with Progress(spark, "extraction"): write()`` tells, every few seconds, tasks done of those known, their rate and the time left."""

    def __init__(self, spark: SparkSession, name: str, tell: Callable[[str], None] = print, every: float = 10.0):
        self.context, self.name, self.tell, self.every = spark.sparkContext, name, tell, every
        self.group, self.stop = f"{name}-{time.monotonic_ns()}", threading.Event()
        self.done, self.known = 0, 0

    def look(self) -> tuple[int, int]:
        """(tasks done, tasks known) of the stages of this run's jobs; stages that were skipped aren't known."""
        tracker = self.context.statusTracker()
        stages = {s for job in tracker.getJobIdsForGroup(self.group) if (info := tracker.getJobInfo(job)) for s in info.stageIds}
        seen = [i for s in stages if (i := tracker.getStageInfo(s)) is not None]
        started = [i for i in seen if i.numCompletedTasks + i.numActiveTasks > 0 or i.numFailedTasks]
        self.done, self.known = sum(i.numCompletedTasks for i in started), sum(i.numTasks for i in started)
        return self.done, self.known

    def line(self, seconds: float) -> str:
        rate = self.done / seconds if seconds > 0 else 0.0
        left = f", {(self.known - self.done) / rate:.0f} s left of what has started" if rate else ""
        return f"{self.name}: {self.done} of {self.known} tasks, {rate:.1f} a second{left}"

    def _watch(self) -> None:
        began = time.monotonic()
        while not self.stop.wait(self.every):
            self.look()
            self.tell(self.line(time.monotonic() - began))

    def __enter__(self) -> Progress:
        self.began = time.monotonic()
        self.context.setJobGroup(self.group, self.name)
        self.watcher = threading.Thread(target=self._watch, daemon=True)
        self.watcher.start()
        return self

    def __exit__(self, *problem) -> None:
        self.stop.set()
        self.watcher.join()
        self.look()
        self.context.setLocalProperty("spark.jobGroup.id", None)
        self.context.setLocalProperty("spark.job.description", None)
        self.tell(self.line(time.monotonic() - self.began) + ", done")
