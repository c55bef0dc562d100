"""Range bars: the sequential labelling of ticks, and everything of a bar that grouping gives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.config import DAY, DEFAULT, BarConfig

LABELLED = "contract string, trade_date date, id long, DateTime timestamp_ntz, Price double, AskVolume long, BidVolume long, bar_idx int, seq int, is_open boolean, is_change boolean"
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class Labeller:
    """State of the open bar of one session; the only sequential part of the engine."""

    def __init__(self, bar_range: float):
        self.range = bar_range
        self.key = None

    def feed(self, key, prices: list[float]) -> tuple[list[int], list[int], list[bool], list[bool]]:
        """Bars, positions, and flags of the next prices of session ``key``."""
        if key != self.key:
            self.key, self.bar, self.seq = key, 0, 0
            self.high = self.low = self.close = prices[0]
        high, low, close, bar, reach = self.high, self.low, self.close, self.bar, self.range
        bars, opens, changes = [], [], []
        for p in prices:
            if high - p <= reach and p - low <= reach:
                opens.append(False)
                changes.append(p != close)
                high, low = max(high, p), min(low, p)
            else:
                bar += 1
                opens.append(True)
                changes.append(False)
                high = low = p
            close = p
            bars.append(bar)
        seq = list(range(self.seq + 1, self.seq + 1 + len(prices)))
        self.high, self.low, self.close, self.bar, self.seq = high, low, close, bar, self.seq + len(prices)
        return bars, seq, opens, changes


def sessions(batch: pa.RecordBatch) -> list[int]:
    """Where the sessions of a batch, sorted by contract and date, begin, and its number of rows."""
    contract, day = batch.column(0), batch.column(1).cast(pa.int32()).to_numpy()
    codes = contract.dictionary_encode().indices.to_numpy()
    cut = np.flatnonzero((codes[1:] != codes[:-1]) | (day[1:] != day[:-1])) + 1
    return [0, *cut.tolist(), batch.num_rows]


def label(ticks: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """Ticks with bar_idx (from 0 in each session), seq, is_open (opens a bar after the first) and is_change.

    Sessions are sorted inside partitions and flow through in batches, so a session needs no more memory than a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Labeller(config.bar_range)
        for batch in batches:
            if not batch.num_rows:
                continue
            out: tuple[list, ...] = ([], [], [], [])
            prices = batch.column(4).to_pylist()
            at = sessions(batch)
            for a, b in zip(at, at[1:]):
                for acc, x in zip(out, state.feed((batch.column(0)[a].as_py(), batch.column(1)[a].as_py()), prices[a:b])):
                    acc.extend(x)
            made = [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2]), pa.array(out[3])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *made], names=[*batch.schema.names[:7], "bar_idx", "seq", "is_open", "is_change"])

    # a window's distribution and order, which ticks that a window has made already have, instead of a shuffle in any case
    row = F.row_number().over(Window.partitionBy(*DAY).orderBy("id"))
    flow = ticks.select("contract", "trade_date", "id", "DateTime", "Price", "AskVolume", "BidVolume", row.alias("seq"))
    return flow.mapInArrow(run, LABELLED)


def bars(labelled: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """One row per bar: OHLC, volume, deltas, times, signal. ``closed`` is false for the last bar of a session."""
    v = F.col("AskVolume") + F.col("BidVolume")
    b = labelled.groupBy(*DAY, "bar_idx").agg(
        F.min_by("Price", "seq").alias("open"), F.max("Price").alias("high"), F.min("Price").alias("low"), F.max_by("Price", "seq").alias("close"),
        F.sum(v).alias("volume"), F.sum(F.when(F.col("is_open"), v).otherwise(0)).alias("opening"), F.sum(F.col("AskVolume") - F.col("BidVolume")).alias("delta"),
        F.count("*").alias("n_ticks"), F.sum(F.when(F.col("is_open"), 0).otherwise(1)).alias("n_in_range"), F.max("is_change").alias("changed"),
        F.min_by("DateTime", "seq").alias("first_time"), F.max_by("DateTime", F.when(F.col("is_change"), F.col("seq"))).alias("last_change"),
    )
    day = Window.partitionBy(*DAY).orderBy("bar_idx")
    total = F.col("volume") + (F.col("opening") if config.parity else 0)
    text = lambda c: F.date_format(c, TIME)
    start = F.when(F.col("bar_idx") == 0, F.lit("-1") if config.parity else text("first_time")).otherwise(text("first_time"))
    return b.select(
        *DAY, "bar_idx", start.alias("startTime"), F.coalesce(F.lead(text("first_time")).over(day), text("last_change"), F.lit("-1")).alias("endTime"),
        "open", "high", "low", "close", total.alias("barTotalVolume"), "delta", F.coalesce(F.col("delta") - F.lag("delta").over(day), F.lit(0)).alias("barDeltaChange"),
        F.sum("delta").over(day.rowsBetween(Window.unboundedPreceding, 0)).alias("cumDeltaAtBar"), "n_ticks",
        F.when(F.col("n_in_range") > 0, 1).otherwise(0).cast("long").alias("signal"), F.when(F.col("n_in_range") > 0, 1).otherwise(0).cast("long").alias("signalID"), (F.col("n_in_range") > 0).alias("signalStatus"),
        F.lead("bar_idx").over(day).isNotNull().alias("closed"), F.lead("open").over(day).alias("next_open"), ((F.col("bar_idx") > 0) | F.col("changed")).alias("moved"),
    )


def with_signal(frame: DataFrame, signal, name: str = "signal") -> DataFrame:
    """Bars with the column that a signal hook gives: a function from the DataFrame to a Column."""
    return frame.withColumn(name, signal(frame))
