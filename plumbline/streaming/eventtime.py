"""Alert states and counter rates on streams whose rows come late or out of order.

Rows wait in a buffer of their series until the watermark has passed them and are then taken in event
order, so any arrival order within the delay gives the results of the batch operators. Event-time timers
close what no row closes: a series that falls silent still resolves and still emits its last instants.

A row at or before the watermark is late and dropped. State per series: the rows of one delay, and for
rates the last sample and the buckets of one range. Both need the RocksDB state store
(plumbline.session.ROCKSDB).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

NONE = -1


class Buffered(StatefulProcessor):
    """Holds rows (at, value) until the watermark passes `at`, given in units of which `per_ms` make a
    millisecond (or `ms` milliseconds make one)."""

    row = ""  # schema of a waiting row, its first column being `at`

    def ms(self, at: int) -> int:
        """The first millisecond that is not before `at`."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", self.row)

    def hold(self, rows: Iterator[pd.DataFrame], watermark: int) -> list[int]:
        """Keep what is not late; returns the least time kept."""
        least: list[int] = []
        for frame in rows:
            kept = [r for r in frame.itertuples(index=False, name=None) if self.ms(r[0]) > watermark]
            if kept:
                self.pending.appendList(kept)
                least.append(min(r[0] for r in kept))
        return [min(least)] if least else []

    def due(self, watermark: int) -> list[tuple]:
        """Waiting rows that the watermark has passed, in order; the others go on waiting."""
        waiting = list(self.pending.get()) if self.pending.exists() else []
        passed = sorted(r for r in waiting if self.ms(r[0]) <= watermark)
        if passed:
            rest = [r for r in waiting if self.ms(r[0]) > watermark]
            if rest:
                self.pending.put(rest)
            else:
                self.pending.clear()
        return passed

    def least_waiting(self) -> int | None:
        return min((r[0] for r in self.pending.get()), default=None) if self.pending.exists() else None

    def close(self) -> None:
        pass


class EventTimeAlerts(Buffered):
    """Rows (t, breach): one evaluation of a rule and series. Emits transitions (state, at)."""

    row = "t long, breach boolean"

    def __init__(self, step_s: int, for_s: int):
        self.step_s, self.for_s = step_s, for_s

    def ms(self, at: int) -> int:
        return at * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.run = handle.getValueState("run", "since long, last long, firing boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for t in self.hold((f[["t", "breach"]] for f in rows), timerValues.getCurrentWatermarkInMs()):
            self.handle.registerTimer(self.ms(t))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        since, last, firing = self.run.get() if self.run.exists() else (NONE, NONE, False)
        held: dict[int, bool] = {}
        for t, breach in self.due(watermark):  # a repeated evaluation holds if one of its rows does
            held[t] = held.get(t, False) or bool(breach)
        out: list[tuple[str, int]] = []

        def end() -> None:
            nonlocal since, firing
            if firing:
                out.append(("resolved", last + self.step_s))
            since, firing = NONE, False

        for t, breach in held.items():
            if since != NONE and (not breach or t > last + self.step_s):
                end()
            if breach:
                if since == NONE:
                    since = t
                    if self.for_s > 0:
                        out.append(("pending", t))
                last = t
                if not firing and t - since >= self.for_s:
                    firing = True
                    out.append(("firing", t))
        if since != NONE and self.ms(last + self.step_s) <= watermark:
            end()  # the next evaluation never came
        if since != NONE:
            self.run.update((since, last, firing))
            self.handle.registerTimer(self.ms(last + self.step_s))
        elif self.run.exists():
            self.run.clear()
        waiting = self.least_waiting()
        if waiting is not None:
            self.handle.registerTimer(self.ms(waiting))
        if out:
            states, at = zip(*out)
            yield pd.DataFrame({"key": [key[0]] * len(out), "state": states, "at": at})


def alert_stream(evaluations: DataFrame, step_s: int = 60, for_s: int = 300, delay: str = "10 minutes") -> DataFrame:
    """(key, state, at) transitions of a stream of (key string, t bigint, breach boolean).

    Equals series.alert_states over the evaluations up to the watermark, with the watermark as `until`, in whatever order rows arrived; a firing series that stops resolves one step later.
    """
    timed = evaluations.select("key", "t", "breach", F.timestamp_seconds("t").alias("ts")).withWatermark("ts", delay)
    return timed.groupBy("key").transformWithStateInPandas(
        statefulProcessor=EventTimeAlerts(step_s, for_s),
        outputStructType=T.StructType.fromDDL("key string, state string, at long"),
        outputMode="Append",
        timeMode="EventTime",
    )


class CounterRates(Buffered):
    """Rows (us, value): samples of one counter. Emits (t, value), the rate over (t - range, t].

    A bucket ends at a multiple of the greatest common divisor of range and step and holds the number of
    its samples, their increases, the first one's increase, and the times of the first and the last.
    """

    row = "us long, value double"

    def __init__(self, by: Sequence[str], range_s: int, step_s: int):
        self.by, self.range_s, self.step_s, self.width = list(by), range_s, step_s, math.gcd(range_s, step_s)

    def ms(self, at: int) -> int:
        return -(-at // 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.buckets = handle.getListState("buckets", "ends long, n long, up double, opening double, first long, last long")
        self.seen = handle.getValueState("seen", "value double, next long")

    def instant(self, us: int) -> int:
        """The first instant whose range can hold a sample."""
        return -(-us // (self.step_s * 1_000_000)) * self.step_s

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for us in self.hold((f[["us", "value"]] for f in rows), timerValues.getCurrentWatermarkInMs()):
            self.handle.registerTimer(self.instant(us) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        before, start = self.seen.get() if self.seen.exists() else (None, None)
        ring = {b[0]: list(b[1:]) for b in self.buckets.get()} if self.buckets.exists() else {}
        for us, value in self.due(watermark):
            up = None if before is None else value if value < before else value - before
            before = value
            b = ring.setdefault(-(-us // (self.width * 1_000_000)) * self.width, [0, 0.0, up or 0.0, us, us])
            b[0], b[1], b[4] = b[0] + 1, b[1] + (up or 0.0), us
        following = (watermark // (self.step_s * 1000) + 1) * self.step_s
        rows: list[tuple[int, float]] = []
        for t in sorted({t for e in ring for t in range(-(-e // self.step_s) * self.step_s, e + self.range_s, self.step_s)}):
            if t >= following or (start is not None and t < start):
                continue
            inside = [ring[e] for e in sorted(ring) if t - self.range_s < e <= t]
            span = inside[-1][4] - inside[0][3]
            if sum(b[0] for b in inside) >= 2 and span > 0:
                rows.append((t, (sum(b[1] for b in inside) - inside[0][2]) * 1e6 / span))
        kept = sorted((e, *b) for e, b in ring.items() if e > following - self.range_s)
        if kept:
            self.buckets.put(kept)
            self.handle.registerTimer(following * 1000)
        elif self.buckets.exists():
            self.buckets.clear()
        if before is not None:
            self.seen.update((before, following))
        waiting = self.least_waiting()
        if waiting is not None:
            self.handle.registerTimer(self.instant(waiting) * 1000)
        if rows:
            out = pd.DataFrame(rows, columns=["t", "value"])
            for i, c in enumerate(self.by):
                out.insert(i, c, key[i])
            yield out


def counter_rates(samples: DataFrame, by: Sequence[str], range_s: int, step_s: int, delay: str = "10 minutes", ts: str = "ts", value: str = "value") -> DataFrame:
    """(*by, t, value): series.rate of a stream of counter samples, for the instants up to the watermark.

    Samples of a series have distinct times; a null value is no sample.
    """
    timed = samples.where(F.col(value).isNotNull()).select(*by, F.col(ts).alias("ts"), F.unix_micros(ts).alias("us"), F.col(value).cast("double").alias("value"))
    keys = [T.StructField(c, samples.schema[c].dataType) for c in by]
    return timed.withWatermark("ts", delay).groupBy(*by).transformWithStateInPandas(
        statefulProcessor=CounterRates(by, range_s, step_s),
        outputStructType=T.StructType([*keys, T.StructField("t", T.LongType()), T.StructField("value", T.DoubleType())]),
        outputMode="Append",
        timeMode="EventTime",
    )
