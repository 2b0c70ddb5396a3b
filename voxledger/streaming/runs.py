"""Runs as keyed state: events in order, steps that are not allowed, and runs that are stuck now.

Events of a run may arrive in any order. They wait in the run's state until the watermark has passed
them (a timer stands at the first that waits), then take part in the order of their time. A timer stands at the last event of an open run plus the
patience; when the watermark passes it, the run is reported stuck, while it is still open. A run's state
goes when it is finished and nothing waits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# States of a record, in the order a run goes through them, and those that end it.
STEPS = ["pending", "processing", "saving-data", "complete"]
FINAL = ["complete", "failed"]
CHUNK = 1_000  # events that wait in one entry of the state

FOUND = "dataset_id bigint, kind string, at_ms bigint, ord bigint, status string, before string"


def allowed(before: str | None, status: str) -> bool:
    """A step may repeat, go on to the next one, or fail; a run begins, or begins again after its end, at any step."""
    if before is None or before in FINAL or status == "failed" or status == before:
        return True
    return STEPS.index(status) == STEPS.index(before) + 1


def _chunks(columns: list) -> list[tuple[list, list, list]]:
    """Columns of events as state entries of at most ``CHUNK`` events."""
    return [tuple(list(c[i : i + CHUNK]) for c in columns) for i in range(0, len(columns[0]), CHUNK)]


class RunState(StatefulProcessor):
    """One run: the events that wait, the last step, and the time it was reported stuck for."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        event = [T.StructField("at_ms", T.LongType()), T.StructField("ord", T.LongType()), T.StructField("status", T.StringType())]
        # An entry is a list of events: each entry costs a call to the store, whatever it holds.
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in event]))
        self.last = handle.getValueState("last", T.StructType([*event, T.StructField("told", T.BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """New events wait; a timer stands at the time of the first of them."""
        first = None
        for part in rows:
            columns = [[int(n) for n in part["at_ms"].tolist()], [int(n) for n in part["ord"].tolist()], part["status"].tolist()]
            if columns[0]:
                self.waiting.appendList(_chunks(columns))
                first = min(columns[0]) if first is None else min(first, *columns[0])
        if first is not None:
            self.handle.registerTimer(first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Release what the watermark has passed, in order, and tell of a run that was or is stuck by then."""
        now = timerValues.getCurrentWatermarkInMs()
        held = sorted(event for entry in self.waiting.get() for event in zip(*entry))
        last = tuple(self.last.get()) if self.last.exists() else None
        found = []

        def look(until: int) -> None:
            nonlocal last
            if last and last[2] not in FINAL and not last[3] and last[0] + self.patience_ms <= until:
                found.append(("stuck", last[0] + self.patience_ms, last[1], last[2], None))
                last = (*last[:3], True)

        ready = [w for w in held if w[0] <= now]
        for at, ord_, status in ready:
            look(at - 1)
            before = last[2] if last else None
            if not allowed(before, status):
                found.append(("illegal", at, ord_, status, before))
            last = (at, ord_, status, False)
        look(now)
        if ready:
            rest = held[len(ready) :]
            if rest:
                self.waiting.put(_chunks(list(zip(*rest))))
                self.handle.registerTimer(rest[0][0])
            else:
                self.waiting.clear()
        if last and last[2] in FINAL:
            self.last.clear()  # a finished run keeps nothing: a new one may begin at any step
        elif last:
            self.last.update(last)
            if not last[3] and ready:
                self.handle.registerTimer(last[0] + self.patience_ms)
        if found:
            yield pd.DataFrame([(key[0], *f) for f in found], columns=["dataset_id", "kind", "at_ms", "ord", "status", "before"])

    def close(self) -> None:
        pass


def run_findings(events: DataFrame, patience: int = 10_800, lateness: str = "1 hour") -> DataFrame:
    """Findings on a stream of status events (``dataset_id``, ``ord``, ``ts``, ``status``): ``illegal`` steps and ``stuck`` runs.

    ``patience`` is in seconds. A finding is told once, when the watermark passes its time: an open
    run is stuck if nothing more happened to it by then. Events of one time go by ``ord``. Sets the RocksDB
    state store for the session, which keyed state with timers needs.
    """
    events.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    timed = events.withWatermark("ts", lateness).select("dataset_id", "ts", F.unix_millis("ts").alias("at_ms"), "ord", "status")
    out = timed.groupBy("dataset_id").transformWithStateInPandas(
        RunState(patience * 1000), outputStructType=FOUND, outputMode="Append", timeMode="EventTime"
    )
    return out


def run_findings_batch(events: DataFrame, until_ms, patience: int = 10_800) -> DataFrame:
    """The same findings on a table of events, as of the watermark ``until_ms`` (a column).

    Events later than the watermark wait, so they take no part.
    """
    order = Window.partitionBy("dataset_id").orderBy("at_ms", "ord")
    rows = events.select("dataset_id", F.unix_millis("ts").alias("at_ms"), "ord", "status").where(F.col("at_ms") <= until_ms)
    seen = rows.withColumns({"before": F.lag("status").over(order), "next_ms": F.lead("at_ms").over(order)})
    number = lambda c: F.array_position(F.array(*[F.lit(s) for s in STEPS]), F.col(c))
    fine = (
        F.col("before").isNull() | F.col("before").isin(*FINAL) | (F.col("status") == "failed")
        | (F.col("status") == F.col("before")) | (number("status") == number("before") + 1)
    )
    illegal = seen.where(~fine).select("dataset_id", F.lit("illegal").alias("kind"), "at_ms", "ord", "status", "before")
    due = F.col("at_ms") + patience * 1000
    open_ = ~F.col("status").isin(*FINAL) & (due <= until_ms) & (F.col("next_ms").isNull() | (F.col("next_ms") > due))
    stuck = seen.where(open_).select("dataset_id", F.lit("stuck").alias("kind"), due.alias("at_ms"), "ord", "status", F.lit(None).cast("string").alias("before"))
    return illegal.unionByName(stuck)
