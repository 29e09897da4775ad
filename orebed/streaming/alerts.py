"""Lag alert that fires while the lag is still high."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orebed.operators.observe import LAG_HOLD_SECONDS, LAG_THRESHOLD
from orebed.streaming.bronze import BACKFILL

ALERT = (
    "consumergroup string, topic string, started_at timestamp, fired_at timestamp, lag bigint"
)
TOTAL = "ts timestamp, consumergroup string, topic string, lag bigint"
_STATE = "since bigint, last bigint, fired boolean"


def _breach(threshold: float, hold_seconds: int, max_gap_seconds: int):
    """State per series: when the breach began, the last sample, whether the alert is out."""
    hold, max_gap = hold_seconds * 10**6, max_gap_seconds * 10**6

    def update(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Closed totals only, one per interval: 16 bytes each, whatever the samples behind them.
        chunks = [(c["micros"].to_numpy(), c["lag"].to_numpy()) for c in rows]
        micros, lag = (np.concatenate(x) for x in zip(*chunks, strict=True))
        order = np.argsort(micros, kind="stable")
        micros, lag = micros[order], lag[order]
        since, last, fired = state.get if state.exists else (None, None, False)

        high = lag > threshold
        was_high = np.append(since is not None, high[:-1])
        gap = np.diff(micros, prepend=micros[0] if last is None else last) > max_gap
        begins = high & (~was_high | gap)
        # Period 0 is the one that earlier batches left open.
        period = np.cumsum(begins)
        starts = np.append(0 if since is None else since, micros[begins])
        due = np.flatnonzero(high & (micros - starts[period] >= hold))
        periods, first = np.unique(period[due], return_index=True)
        alert = due[first][~((periods == 0) & fired)]
        out = bool(high[-1]) and (period[-1] in periods or bool(fired and period[-1] == 0))
        state.update((int(starts[period[-1]]) if high[-1] else None, int(micros[-1]), out))
        yield pd.DataFrame(
            {
                "consumergroup": key[0],
                "topic": key[1],
                "started_at": pd.to_datetime(starts[period[alert]], unit="us", utc=True),
                "fired_at": pd.to_datetime(micros[alert], unit="us", utc=True),
                "lag": lag[alert],
            }
        )

    return update


def lag_totals(
    samples: DataFrame, delay: str = "30 seconds", bucket: str = "15 seconds"
) -> DataFrame:
    """Lag over all partitions per scrape interval, once the interval is closed, of a
    stream of ``(ts, consumergroup, topic, partition, lag)``."""
    return (
        samples.withWatermark("ts", delay)
        .groupBy(F.window("ts", bucket).alias("w"), "consumergroup", "topic")
        .agg(F.sum("lag").alias("lag"))
        .select(F.col("w.start").alias("ts"), "consumergroup", "topic", "lag")
    )


def lag_alerts(
    totals: DataFrame,
    threshold: float = LAG_THRESHOLD,
    hold_seconds: int = LAG_HOLD_SECONDS,
    max_gap_seconds: int = 60,
) -> DataFrame:
    """Alerts of a stream of closed totals, fired at the first total that reaches the
    hold time and not again before the lag was low."""
    return (
        totals.select("consumergroup", "topic", F.unix_micros("ts").alias("micros"), "lag")
        .groupBy("consumergroup", "topic")
        .applyInPandasWithState(
            _breach(threshold, hold_seconds, max_gap_seconds),
            ALERT,
            _STATE,
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet table; its log makes every row appear once."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BACKFILL))
        .start(path)
    )
