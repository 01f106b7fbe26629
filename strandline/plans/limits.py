"""Work under a time limit: its Spark jobs end when the time is up.

The work runs in a thread of its own, and every job it starts carries a tag. When the
time is up the jobs with that tag are cancelled, so the work fails with the error of
its own action. For a while it may run others, to note its failure; what it starts
after that is cancelled too.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import SparkSession

T = TypeVar("T")

GRACE_SECONDS = 15.0  # for the work to end after its jobs
POLL_SECONDS = 0.1


class OverLimit(RuntimeError):
    """The work was stopped: its time was up."""


class _Work:
    """A call in a thread, and what came of it."""

    def __init__(self, spark: SparkSession, call: Callable[[], T], tag: str) -> None:
        self.result: T | None = None
        self.error: BaseException | None = None
        self.ended = threading.Event()
        self._context, self._call, self._tag = spark.sparkContext, call, tag
        # Inherits the caller's job properties, as its description or pool. A thread that
        # hangs outside of Spark does not keep the process from ending.
        self._thread = InheritableThread(target=self._run)
        self._thread.daemon = True
        self._thread.start()

    def _run(self) -> None:
        self._context.addJobTag(self._tag)
        self._context.setInterruptOnCancel(True)  # or a task would go on to its next check
        try:
            self.result = self._call()
        except BaseException as error:
            self.error = error
        finally:
            self._context.removeJobTag(self._tag)
            self.ended.set()

    def interrupt(self) -> bool:
        """End the jobs that run now; whether there were any."""
        tracker = self._context._jsc.sc().statusTracker()
        running = set(tracker.getActiveJobIds()) & set(tracker.getJobIdsForTag(self._tag))
        if running:
            self._context.cancelJobsWithTag(self._tag)
        return bool(running)

    def stop(self, grace: float) -> bool:
        """End its jobs once, those that run or else the next to start, and wait for it;
        whether it ended."""
        until, struck = time.monotonic() + grace, False
        while time.monotonic() < until:
            struck = struck or self.interrupt()
            if self.ended.wait(POLL_SECONDS):
                return True
        return self.ended.is_set()

    def hold_down(self) -> None:
        """End whatever job it starts, until it or the session ends."""
        while not self.ended.wait(POLL_SECONDS):
            try:
                self.interrupt()
            except Exception:
                if self._context._jsc is None or self._context._jsc.sc().isStopped():
                    return


def within(
    spark: SparkSession, seconds: float, call: Callable[[], T], grace: float = GRACE_SECONDS
) -> T:
    """The result of ``call``, or :class:`OverLimit` once ``seconds`` have passed.

    A limit of 0 or less is none. Work that ends in time gives its result or its own
    error. Work that is stopped gets ``grace`` seconds to end by itself after its jobs
    are gone; it may write its failure down in that time. If it then still runs, outside
    of Spark or with further jobs, this returns to the caller all the same, and a thread
    in the background cancels each job that it starts from then on.

    Jobs of other threads, and of the caller, carry other tags and go on.
    """
    if seconds <= 0:
        return call()
    begun = time.monotonic()
    work = _Work(spark, call, f"limit-{uuid.uuid4().hex}")
    try:
        in_time = work.ended.wait(seconds)
    except BaseException:  # the caller is stopped: so is the work
        work.interrupt()
        raise
    if in_time:
        if work.error is not None:
            raise work.error
        return work.result
    if not work.stop(grace):
        threading.Thread(target=work.hold_down, daemon=True).start()
    elif work.error is None:
        return work.result  # it ended just then, and whole
    taken = time.monotonic() - begun
    raise OverLimit(f"over budget: stopped after {taken:.1f} s of {seconds:g} s") from work.error
