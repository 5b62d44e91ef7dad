"""Token buckets over events, by key: a batch fold and its stateful streaming form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def admitted(seconds: np.ndarray, rate: float, burst: float, tokens: float, last: float) -> tuple[np.ndarray, float, float]:
    """Whether each event, in order of time, finds a token; and the bucket afterwards."""
    out = np.zeros(len(seconds), bool)
    for i, t in enumerate(seconds.tolist()):
        tokens = min(burst, tokens + max(0.0, t - last) * rate)
        last = max(t, last)
        if rate <= 0 or tokens >= 1:
            out[i] = True
            tokens -= rate > 0
    return out, tokens, last


def replay(events: DataFrame, key: str, time: str, event: str, rate: float, burst: float = 1) -> DataFrame:
    """(key, event, admitted): an ordered fold over each key's events; ties go by event.

    A bucket is sequential, so a key's events meet in one task, streamed through it in order;
    keys are spread and sorted by Spark, which spills."""
    kinds = {c: events.schema[c].dataType.simpleString() for c in (key, event)}
    rows = events.select(F.col(key).alias("k"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col(event).alias("e")).repartition("k").sortWithinPartitions("k", "t", "e")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key_now, tokens, last = object(), burst, 0.0
        for pdf in batches:
            parts = []
            for k, group in pdf.groupby("k", sort=False, dropna=False):
                t = group["t"].to_numpy() / 1e6
                if k != key_now:
                    key_now, tokens, last = k, burst, float(t[0])
                ok, tokens, last = admitted(t, rate, burst, tokens, last)
                parts.append(pd.DataFrame({"k": group["k"], "e": group["e"], "admitted": ok}))
            if parts:
                yield pd.concat(parts)

    out = rows.mapInPandas(run, f"k {kinds[key]}, e {kinds[event]}, admitted boolean")
    return out.withColumnsRenamed({"k": key, "e": event})


def limit_stream(events: DataFrame, key: str, time: str, event: str, rate: float, burst: float = 1) -> DataFrame:
    """The same on a stream: the bucket of each key is kept as state between batches."""
    kinds = {c: events.schema[c].dataType.simpleString() for c in (key, event)}

    def fold(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(pdfs)).sort_values(["t", "e"])
        t = pdf["t"].to_numpy() / 1e6
        tokens, last = state.get if state.exists else (float(burst), float(t[0]))
        ok, tokens, last = admitted(t, rate, burst, tokens, last)
        state.update((tokens, last))
        yield pd.DataFrame({key: pdf["k"], event: pdf["e"], "admitted": ok})

    rows = events.select(F.col(key).alias("k"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col(event).alias("e"))
    return rows.groupBy("k").applyInPandasWithState(fold, f"{key} {kinds[key]}, {event} {kinds[event]}, admitted boolean", "tokens double, last double", "append", GroupStateTimeout.NoTimeout)
