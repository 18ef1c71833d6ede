"""Notifications without repeats: a source is notified again only when what it says has changed."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keyed state needs.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def signature(*content) -> F.Column:
    """What tells whether two notifications say the same: a digest of their content, nulls told from empty texts."""
    return F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)


class Changes(StatefulProcessor):
    """Keeps each source's last signature and its time; lets through what differs.

    With quiet (milliseconds) the state of a source goes, by a timer in event time, when nothing came for so long: the next
    notification is then new, whatever it says. Rows of one source in one batch are put in order by (ts, id), so
    a batch holds no more of a source than the trigger lets in; batches follow in order.
    """

    def __init__(self, quiet: int | None = None):
        self.quiet = quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "signature string, at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values(["ts", "id"], kind="stable")
        before, at = self.last.get() if self.last.exists() else (None, None)
        keep = []
        for ts, own in zip(found["ts"], found["signature"], strict=True):
            now = int(pd.Timestamp(ts).value // 1_000_000)
            lapsed = self.quiet is not None and at is not None and now - at > self.quiet
            keep.append(lapsed or own != before)
            before, at = own, now
        self.last.update((before, at))
        if self.quiet is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at + self.quiet + 1)
        yield found[keep]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def changed(alerts: DataFrame, quiet: int | None = None, late: str = "0 seconds") -> DataFrame:
    """Alerts (source, id, ts, signature) that differ from the one before of their source."""
    rows = alerts.select("source", "id", "ts", "signature")
    if quiet is not None:
        rows = rows.withWatermark("ts", late)
    alerts.sparkSession.conf.set(*STATE_STORE)
    return rows.groupBy("source").transformWithStateInPandas(Changes(quiet), rows.schema, "append", "None" if quiet is None else "EventTime")
