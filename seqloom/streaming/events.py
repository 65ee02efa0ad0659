"""Event-time counterparts of the positional windows, for streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def window_content(events: DataFrame, late: str = "1 hour", size: str = "1 day", slide: str | None = None) -> DataFrame:
    """(beg, event_type, n, total) of event-time windows over (ts, event_type, value); later rows than ``late`` are dropped."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    counts = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counts.select(F.col("w.start").alias("beg"), "event_type", "n", "total")


def flag_runs(events: DataFrame) -> DataFrame:
    """(key, beg, end, len): runs of flag 1 in (key, pos, flag) rows that come in order of pos for each key.

    A run is given out when its key's next 0 comes; the open run is the state.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        beg, last = state.get if state.exists else (0, 0)
        out = []
        for pdf in batches:
            for pos, flag in pdf.sort_values("pos")[["pos", "flag"]].itertuples(index=False):
                if flag == 1 and beg and pos == last + 1:
                    last = pos
                    continue
                if beg:
                    out.append((key[0], beg, last, last - beg + 1))
                beg, last = (pos, pos) if flag == 1 else (0, 0)
        state.update((int(beg), int(last)))
        yield pd.DataFrame(out, columns=["key", "beg", "end", "len"])

    return events.groupBy("key").applyInPandasWithState(step, "key long, beg long, end long, len long", "beg long, last long", "append", GroupStateTimeout.NoTimeout)
