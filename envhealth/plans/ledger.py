"""A ledger of the runs of each date: what was claimed, finished, failed, and with which counts.

Every event is a row in a folder of its own, so that nothing is ever rewritten and writers do not
meet. The state of a date is read from its rows.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import as_date, partition_value

EVENT = "owner STRING, stage STRING, attempt INT, state STRING, detail STRING, at DOUBLE"
#: The stage of the rows that say who works on a date.
CLAIM = "claim"
CLAIMED, RELEASED, DONE, FAILED = "claimed", "released", "done", "failed"
#: Attempts at a stage, and seconds after which a claim that was not released is void.
ATTEMPTS, LEASE = 2, 24 * 3600.0


class Busy(RuntimeError):
    """Another run holds the date."""


class Ledger:
    """The events of one date below `path`, written by one owner."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        run_date: dt.date | str,
        lease: float = LEASE,
        clock: Callable[[], float] = time.time,
    ):
        self.spark, self.path, self.lease, self.clock = spark, path, lease, clock
        self.run_date = as_date(run_date)
        self.owner = uuid.uuid4().hex

    @property
    def folder(self) -> str:
        return f"{self.path}/run_date={partition_value(self.run_date)}"

    def events(self) -> DataFrame:
        try:
            return self.spark.read.schema(EVENT).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], EVENT)

    def note(self, stage: str, attempt: int, state: str, detail: str | None = None) -> None:
        row = [(self.owner, stage, attempt, state, detail, self.clock())]
        made = self.spark.createDataFrame(row, EVENT).coalesce(1)
        made.write.parquet(f"{self.folder}/event={uuid.uuid4().hex}")

    def holder(self) -> str | None:
        """Who holds the date: the earliest owner whose claim is neither released nor void."""
        since: dict[str, float] = {}
        last: dict[str, Row] = {}
        for event in self._ordered(F.col("stage") == CLAIM):
            since.setdefault(event["owner"], event["at"])
            last[event["owner"]] = event
        void = self.clock() - self.lease
        held = [o for o, event in last.items() if event["state"] == CLAIMED and event["at"] > void]
        return min(held, key=lambda o: (since[o], o), default=None)

    def _ordered(self, where: Column) -> list[Row]:
        """Events of the date in order: a few for every stage that was tried."""
        return sorted(self.events().where(where).collect(), key=lambda event: event["at"])

    def claim(self) -> None:
        """Take the date, or fail. Of two that claim at once, the later one gives way."""
        self.note(CLAIM, 0, CLAIMED)
        if self.holder() != self.owner:
            self.release()
            raise Busy(f"{self.run_date} is held by another run")

    def release(self) -> None:
        self.note(CLAIM, 0, RELEASED)

    def finished(self) -> dict[str, dict]:
        """Counts of the stages that were finished, by any owner, and not begun again since."""
        last = {event["stage"]: event for event in self._ordered(F.col("stage") != CLAIM)}
        return {s: json.loads(event["detail"]) for s, event in last.items() if event["state"] == DONE}

    def run(self, stage: str, work: Callable[[], dict], attempts: int = ATTEMPTS) -> dict:
        """The counts of `work`, tried again once after a failure; every attempt is noted."""
        for attempt in range(1, attempts + 1):
            try:
                counts = work()
            except Exception as error:
                self.note(stage, attempt, FAILED, f"{type(error).__name__}: {error}"[:2000])
                if attempt == attempts:
                    raise
            else:
                self.note(stage, attempt, DONE, json.dumps(counts))
                return counts
        raise ValueError("attempts must be at least 1")


def run_stages(
    ledger: Ledger,
    stages: dict[str, tuple[tuple[str, ...], Callable[[], dict]]],
    attempts: int = ATTEMPTS,
    again: bool = False,
) -> dict:
    """Run stages `name: (needed stages, work)`; returns the counts of all, in the order given.

    Stages that need nothing unfinished run at the same time. A stage that is finished is not run
    again unless one that it needs was, or with `again`. The date is held meanwhile, so that two
    runs of a date cannot mix.
    """
    ledger.claim()
    try:
        finished = {} if again else ledger.finished()
        ran: set[str] = set()
        counts: dict[str, dict] = {}
        while len(counts) < len(stages):
            ready = [n for n, (needed, _) in stages.items() if n not in counts and counts.keys() >= set(needed)]
            if not ready:
                raise ValueError("stages need each other, or one that is not there")
            kept = [n for n in ready if n in finished and not ran.intersection(stages[n][0])]
            counts |= {n: finished[n] for n in kept}
            fresh = [n for n in ready if n not in counts]
            with ThreadPoolExecutor(max_workers=max(1, len(fresh))) as pool:
                made = {n: pool.submit(ledger.run, n, stages[n][1], attempts) for n in fresh}
            counts |= {n: job.result() for n, job in made.items()}
            ran.update(fresh)
        return {k: v for name in stages for k, v in counts[name].items()}
    finally:
        ledger.release()
