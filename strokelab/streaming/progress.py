"""Progress of work that is still running (O-X05): completed, failed, remaining, percent, rate and seconds to go (as O-B26).

``watch`` follows the tasks of all jobs that a block of code starts, ``StreamProgress`` the rows of streams.  Both call back
while the work goes on and once at its end.  Only counts come to the driver.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRIC = "strokelab_progress"


@dataclass(frozen=True)
class Progress:
    completed: int
    failed: int
    total: int | None
    elapsed_sec: float
    done: bool = False

    @property
    def remaining(self) -> int | None:
        return None if self.total is None else max(0, self.total - self.completed - self.failed)

    @property
    def percent(self) -> float | None:
        return 100.0 * self.completed / self.total if self.total else None

    @property
    def rate(self) -> float | None:
        """Completed ones a second."""
        return self.completed / self.elapsed_sec if self.elapsed_sec > 0 else None

    @property
    def eta_sec(self) -> float | None:
        return self.remaining / self.rate if self.remaining is not None and self.rate else None


Callback = Callable[[Progress], None]


def _tasks(tracker, group: str) -> tuple[int, int, int]:
    """Completed and failed tasks of a job group's stages, and the tasks known so far; stages that were skipped hold none."""
    done = failed = total = 0
    seen = set()
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        running = info is not None and info.status == "RUNNING"
        for stage in info.stageIds if info else ():
            s = tracker.getStageInfo(stage)
            if s is None or stage in seen:
                continue
            seen.add(stage)
            done += s.numCompletedTasks
            failed += s.numFailedTasks
            total += s.numTasks if running or s.numActiveTasks else s.numCompletedTasks
    return done, failed, total


@contextmanager
def watch(spark: SparkSession, callback: Callback, every_sec: float = 0.5) -> Iterator[None]:
    """Call back with the tasks of the jobs that the block starts from this thread, whenever they have changed.

    The total grows as Spark plans further jobs (adaptive plans are made stage by stage); a failed task that Spark runs again
    counts as failed once and as completed once.  An error of the callback ends the block's reports and is raised at its end.
    """
    sc = spark.sparkContext
    group, before = f"watch-{uuid.uuid4().hex}", {k: sc.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
    start, stop, errors = time.monotonic(), threading.Event(), []
    tracker = sc.statusTracker()

    def report(done: bool, last: tuple[int, int, int] | None) -> tuple[int, int, int]:
        now = _tasks(tracker, group)
        if done or now != last:
            callback(Progress(*now, time.monotonic() - start, done))
        return now

    def follow() -> None:
        last = (0, 0, 0)
        try:
            while not stop.wait(every_sec):
                last = report(False, last)
        except Exception as e:  # a callback's own
            errors.append(e)

    sc.setJobGroup(group, "watched")
    thread = threading.Thread(target=follow, daemon=True)
    thread.start()
    try:
        yield
    finally:
        stop.set()
        thread.join()
        for k, v in before.items():
            sc.setLocalProperty(k, v)
        if not errors:
            report(True, None)
    if errors:
        raise errors[0]


def measured(stream: DataFrame, failed: Column | None = None) -> DataFrame:
    """A stream (or a frame that is written once a batch) whose rows are counted as they pass, those of ``failed`` apart.

    Rows count as often as they are read: persist a batch that several actions read.  What Spark reads again after it lost an
    executor may count twice.
    """
    bad = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    return stream.observe(METRIC, F.count_if(~bad).alias("completed"), F.count_if(bad).alias("failed"))


class StreamProgress(StreamingQueryListener):
    """Calls back after every batch of the streams that it is added for (``spark.streams.addListener``).

    Counts are those of ``measured`` streams; other streams' input rows all count as completed.  ``total`` is the number of
    rows expected, where known.  ``name`` limits it to the stream of that query name.  A query that stops with an error is
    reported in ``errors``.
    """

    def __init__(self, callback: Callback, total: int | None = None, name: str | None = None) -> None:
        self.callback, self.total, self.name = callback, total, name
        self.errors: list[str] = []
        self._runs: set[str] = set()
        self._batches: set[tuple[str, int]] = set()
        self._completed = self._failed = 0
        self._start = time.monotonic()
        self._lock, self._ended = threading.Lock(), threading.Event()

    def onQueryStarted(self, event) -> None:
        if self.name is None or event.name == self.name:
            self._runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = str(p.runId)
        with self._lock:
            # A batch is reported again while a stream is idle.
            if run not in self._runs or (run, p.batchId) in self._batches or not p.numInputRows:
                return
            self._batches.add((run, p.batchId))
            row = p.observedMetrics.get(METRIC)
            self._completed += row["completed"] if row else p.numInputRows
            self._failed += row["failed"] if row else 0
            now = self._now(False)
        self.callback(now)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) not in self._runs:
            return
        if event.exception:
            self.errors.append(event.exception)
        self.callback(self._now(True))
        self._ended.set()

    def wait(self, timeout_sec: float) -> bool:
        """Until a stream has ended and all its reports are in; they come a little later than its rows."""
        return self._ended.wait(timeout_sec)

    def _now(self, done: bool) -> Progress:
        return Progress(self._completed, self._failed, self.total, time.monotonic() - self._start, done)
