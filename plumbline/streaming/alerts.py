"""Alert states on a stream of rule evaluations, one small state per rule and series."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = T.StructType(
    [
        T.StructField("since", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("firing", T.BooleanType()),
    ]
)
NONE = -1


class AlertTracker(StatefulProcessor):
    """Input rows (key, t, breach): t in epoch seconds, one per evaluation. Emits transitions only."""

    def __init__(self, step_s: int, for_s: int):
        self.step_s, self.for_s = step_s, for_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, last, firing = self.state.get() if self.state.exists() else (NONE, NONE, False)
        evaluations = pd.concat(list(rows))[["t", "breach"]].sort_values("t")
        out: list[tuple[str, int]] = []
        for t, breach in zip(evaluations["t"], evaluations["breach"]):
            t = int(t)
            ended = since != NONE and (not breach or t > last + self.step_s)
            if ended:
                if firing:
                    out.append(("resolved", last + self.step_s))
                since, firing = NONE, False
            if breach:
                if since == NONE:
                    since = t
                    if self.for_s > 0:
                        out.append(("pending", t))
                last = t
                if not firing and t - since >= self.for_s:
                    firing = True
                    out.append(("firing", t))
        self.state.update((since, last, firing))
        if out:
            states, at = zip(*out)
            yield pd.DataFrame({"key": [key[0]] * len(out), "state": states, "at": at})

    def close(self) -> None:
        pass


OUTPUT = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("state", T.StringType()), T.StructField("at", T.LongType())]
)


def alert_stream(evaluations: DataFrame, step_s: int = 60, for_s: int = 300) -> DataFrame:
    """(key, state, at) transitions of a stream of (key string, t bigint, breach boolean).

    Needs the RocksDB state store (plumbline.session.ROCKSDB). Evaluations are one row per series
    and step, so a key's rows in a micro-batch are bounded by time, not by the data.
    """
    return (
        evaluations.select("key", "t", "breach")
        .groupBy("key")
        .transformWithStateInPandas(
            statefulProcessor=AlertTracker(step_s, for_s),
            outputStructType=OUTPUT,
            outputMode="Append",
            timeMode="None",
        )
    )
