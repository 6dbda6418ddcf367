"""Keyed state with a life time: running counts and running labels.

Each key keeps one number and the event time its state lasts until. A new row moves that to its event time plus the life time; when
the watermark passes it the state is removed. So state holds the keys that were seen within the life time, not all keys ever.
A row that comes after its key's state has gone starts the key again; choose a life time that no key is silent for.

Keys are dealt to ``BUCKETS`` by a hash. A bucket keeps its keys' numbers in one value and has one event-time timer, for the
key that goes first, so a micro-batch takes a few calls of the state store a bucket, where it took several a key.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cartflow.operators.labels import ITEM, add_is_purchased, targets

BUCKETS = 1024


class _Lasting(StatefulProcessor):
    """One number a key (``keys``), kept for ``life_ms`` of event time (``ms``) after the key's last row."""

    def __init__(self, life_ms: int, keys: list[str]):
        self.life_ms, self.keys = life_ms, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", "kept binary, first long")

    def _kept(self) -> tuple[dict[tuple, tuple[int, int]], int | None]:
        """(number, until) by key, and when the timer goes off."""
        found = self.value.get()
        return ({}, None) if found is None else (pickle.loads(bytes(found[0])), found[1])

    def _keep(self, kept: dict[tuple, tuple[int, int]], before: int | None) -> None:
        """Store what is kept, and have the timer go off with the first key to leave."""
        first = min((until for _, until in kept.values()), default=None)
        if before is not None and before != first:
            self.handle.deleteTimer(before)
        if first is None:
            self.value.clear()
            return
        if before != first:
            self.handle.registerTimer(first)
        self.value.update((pickle.dumps(kept), first))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept, before = self._kept()
        now = timerValues.getCurrentWatermarkInMs()
        of_key: dict[tuple, list[Row]] = {}
        for row in rows:
            of_key.setdefault(tuple(row[k] for k in self.keys), []).append(row)
        out: list[Row] = []
        for one, own in of_key.items():
            number, until = kept.get(one, (0, 0))
            last = max(now if row["ms"] is None else row["ms"] for row in own)
            kept[one] = self.take(one, number, own, out), max(until, last + self.life_ms)
        self._keep(kept, before)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept, before = self._kept()
        gone = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        # The timer that went off is removed by itself.
        self._keep({k: v for k, v in kept.items() if v[1] > gone}, None if before is not None and before <= gone else before)
        return iter(())

    def close(self) -> None:
        pass

    def take(self, key: tuple, number: int, rows: list[Row], out: list[Row]) -> int:
        """A key's new number; what it emits goes to ``out``. A key's rows of one micro-batch are bounded by the source."""
        raise NotImplementedError


class _RunningCount(_Lasting):
    """Every row with its number inside the key, in order of time and id; rows without a time come last."""

    def take(self, key, number, rows, out):
        for row in sorted(rows, key=lambda r: (r["ms"] is None, r["ms"] is not None and r["event_time"], r["event_id"])):
            number += 1
            out.append(Row(event_id=row["event_id"], event_time=row["event_time"], user_session=key[0], event_type=row["event_type"],
                           product_id=row["product_id"], activity_count=number))
        return number


class _RunningLabel(_Lasting):
    """Whether a purchase was seen, once a micro-batch."""

    def take(self, key, number, rows, out):
        number = max(number, *(r["is_purchased"] for r in rows))
        out.append(Row(user_session=key[0], product_id=key[1], is_purchased=number))
        return number


def _milliseconds(life: str) -> int:
    amount, unit = life.split()
    return int(float(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1000)


def _in_buckets(rows: DataFrame, keys: list[str], late: str, buckets: int):
    return (rows.withColumns({"ms": F.unix_millis("event_time"), "bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")})
            .withWatermark("event_time", late).groupBy("bucket"))


def running_counts(events: DataFrame, life: str = "8 days", late: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Every event with ``activity_count``: the session's events up to it (append mode).

    Needs ``event_time`` with a zone (``stream.zoned``). ``event_time`` goes on with its watermark, so other stateful operators may follow.
    Rows later than ``late`` are dropped. A session's rows count in order inside a micro-batch, and micro-batches as they come.
    """
    keys = ["user_session"]
    rows = events.select("event_id", "event_time", "user_session", "event_type", "product_id")
    return _in_buckets(rows, keys, late, buckets).transformWithState(
        statefulProcessor=_RunningCount(_milliseconds(life), keys),
        outputStructType="event_id long, event_time timestamp, user_session string, event_type string, product_id long, activity_count long",
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="event_time")


def session_counts(events: DataFrame, life: str = "8 days", late: str = "1 hour") -> DataFrame:
    """Running number of events per session: the newest row of a session is its count so far."""
    return running_counts(events, life, late).select("user_session", "activity_count")


def running_labels(events: DataFrame, life: str = "8 days", late: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Latest purchase label of each (session, product), one row for each micro-batch that touches it."""
    rows = add_is_purchased(targets(events)).select(*ITEM, "event_time", F.col("is_purchased").cast("int"))
    return _in_buckets(rows, ITEM, late, buckets).transformWithState(
        statefulProcessor=_RunningLabel(_milliseconds(life), ITEM),
        outputStructType="user_session string, product_id long, is_purchased int", outputMode="Append", timeMode="EventTime")
