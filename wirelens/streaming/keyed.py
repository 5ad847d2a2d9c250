"""Keyed state that leaves the store: sources' streaks and urls that were seen, by transformWithState.

Both age by the clock of the machine.  A source that nothing is heard of for
the time to live is dropped by a timer; a url is dropped by the store that
long after it came first.  Both need the RocksDB store (``jobs.run_available``
names it), which holds keys on disk.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.constants import MISSES_TO_FLAG, STATE_DAYS

DAY_MS = 86_400_000
STREAK = "streak int, flagged boolean, render boolean, seq long"
STREAK_OUT = "firm_name string, consecutive_404s int, needs_url_update boolean, prefer_render boolean, last_outcome string, outcomes map<string,long>"
#: last_outcome of a source that was dropped.
IDLE = "idle"


class Streaks(StatefulProcessor):
    """Streak of 404s, sticky flags and a count of each outcome for a source.

    A batch's rows of a source are put into the order of seq, as pairs of two
    small values; the stream's limit on a batch bounds them.  A row that is
    not later than what the state has seen (a replay, a late copy) is passed
    over, as is one without seq or outcome.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.streak = handle.getValueState("streak", STREAK)
        self.counts = handle.getMapState("outcomes", "outcome string", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        streak, flagged, render, until = self.streak.get() if self.streak.exists() else (0, False, False, None)
        news, last = {}, None
        for seq, outcome in sorted({r["seq"]: r["outcome"] for r in rows if r["seq"] is not None and r["outcome"] is not None}.items()):
            if until is not None and seq <= until:
                continue
            until, last = seq, outcome
            streak = 0 if outcome == "ok" else streak + (outcome == "404")
            flagged = flagged or streak >= MISSES_TO_FLAG
            render = render or outcome == "403"
            news[outcome] = news.get(outcome, 0) + 1
        if last is None:
            return
        self.streak.update((streak, flagged, render, until))
        for outcome, n in news.items():
            before = self.counts.getValue((outcome,))[0] if self.counts.containsKey((outcome,)) else 0
            self.counts.updateValue((outcome,), (before + n,))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
        yield Row(firm_name=key[0], consecutive_404s=streak, needs_url_update=flagged, prefer_render=render, last_outcome=last, outcomes={k[0]: v[0] for k, v in self.counts.iterator()})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.streak.clear()
        self.counts.clear()
        yield Row(firm_name=key[0], consecutive_404s=0, needs_url_update=False, prefer_render=False, last_outcome=IDLE, outcomes={})


def error_state(log: DataFrame, ttl_ms: int = STATE_DAYS * DAY_MS) -> DataFrame:
    """A row for each source that a batch brings news of, and one (last outcome 'idle') for each that is dropped.

    ``log`` has firm_name, outcome and seq, which numbers a source's fetches.
    """
    rows = log.selectExpr("firm_name", "cast(seq as long) as seq", "outcome")
    return rows.groupBy("firm_name").transformWithState(Streaks(ttl_ms), STREAK_OUT, "Update", "ProcessingTime")


class First(StatefulProcessor):
    """The first row of a key; the store forgets it a time to live after it came."""

    def __init__(self, columns: list[str], ttl_ms: int):
        self.columns, self.ttl_ms = columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "known boolean", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        row = next(rows)
        for _ in rows:  # the rest of the key's rows are repeats
            pass
        if not self.known.exists():
            self.known.update((True,))
            yield Row(**{c: row[c] for c in self.columns})


def new_rows(rows: DataFrame, key: str = "url", ttl_ms: int = STATE_DAYS * DAY_MS) -> DataFrame:
    """Rows whose key did not come within the time to live, however late their own dates are; rows without a key do not come through."""
    some = rows.where(f"`{key}` is not null")
    return some.groupBy(key).transformWithState(First(rows.columns, ttl_ms), rows.schema, "Update", "ProcessingTime")
