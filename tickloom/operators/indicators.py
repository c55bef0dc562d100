"""Indicators over closed bars of a session or week. Input is ``bars.bars``; ``k`` counts bars of the session from 1."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.config import DAY, DEFAULT, BarConfig
from .bars import sessions

_RUN = lambda *keys: Window.partitionBy(*keys).orderBy("trade_date", "bar_idx").rowsBetween(Window.unboundedPreceding, 0)


def add_day_vwap(bars: DataFrame) -> DataFrame:
    """Volume-weighted mean of the typical price with one and two deviations; values of closed bars count."""
    v = F.col("barTotalVolume").cast("double")
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    w = _RUN(*DAY)
    t = bars.select("*", F.sum("barTotalVolume").over(w).alias("V_"), F.sum(tp * v).over(w).alias("PV_"), F.sum(v * tp * tp).over(w).alias("SPV_"), F.first("open").over(w).alias("seed_"))
    t = t.withColumn("vwap", F.when(F.col("V_") > 0, F.col("PV_") / F.col("V_")).otherwise(F.col("seed_")))
    t = t.withColumn("var_", F.when(F.col("V_") > 0, F.col("SPV_") / F.col("V_") - F.col("vwap") * F.col("vwap")))
    s = F.when(F.col("V_") > 0, F.when(F.col("var_") > 0, F.sqrt("var_")).otherwise(0.0))
    band = lambda k: F.coalesce(F.col("vwap") + k * s, F.lit(0.0))
    t = t.select("*", band(1).alias("vwapUpperStdDev1"), band(-1).alias("vwapLowerStdDev1"), band(2).alias("vwapUpperStdDev2"), band(-2).alias("vwapLowerStdDev2"), (band(1) - band(-1)).alias("vwapBandWidth"), F.col("V_").alias("totalVolume"), F.col("PV_").alias("cumulativePV"), F.col("SPV_").alias("cumulativeSquarePV"))
    return t.drop("V_", "PV_", "SPV_", "seed_", "var_")


def add_week_vwap(bars: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """Weekly mean of closes by volume. In parity mode the denominator is the week profile's total at the previous close
    (which holds earlier sessions' unclosed last bars) plus the bar's own volume; else the running volume of closed bars."""
    w = _RUN("contract", "week_no")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("barTotalVolume").cast("double")
    real = F.when(F.col("closed"), v).otherwise(0.0)
    # what the profile held at each close: every bar of the week up to it, then as of the close before
    t = bars.select("*", F.sum(v).over(w).alias("held_"), F.sum(real * F.col("close")).over(w).alias("PV_"), F.sum(real * F.col("close") * F.col("close")).over(w).alias("SPV_"), F.sum(real).over(w).alias("own_"))
    last = F.last(F.when(F.col("closed"), F.col("held_")), ignorenulls=True).over(before)
    t = t.withColumn("V_", (F.coalesce(last, F.lit(0.0)) + v) if config.parity else F.col("own_"))
    used = F.col("closed") & (F.col("barTotalVolume") > 0)
    t = t.withColumn("m_", F.when(used, F.col("PV_") / F.col("V_")))
    t = t.withColumn("x_", F.when(used, F.col("SPV_") / F.col("V_") - F.col("m_") * F.col("m_")))
    t = t.withColumn("s_", F.when(used, F.when(F.col("x_") > 1e-9, F.sqrt("x_")).otherwise(0.0)))
    keep = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.lit(0.0))
    t = t.withColumns({"weekVwap": keep("m_"), "k_": keep("s_")})
    t = t.withColumns({"weekVwapUpperStdDev1": F.col("weekVwap") + F.col("k_"), "weekVwapLowerStdDev1": F.col("weekVwap") - F.col("k_")})
    return t.withColumn("weekVwapBandWidth", F.col("weekVwapUpperStdDev1") - F.col("weekVwapLowerStdDev1")).drop("held_", "PV_", "SPV_", "own_", "V_", "m_", "x_", "s_", "k_")


def add_zscore(bars: DataFrame, config: BarConfig = DEFAULT, window: int | None = None) -> DataFrame:
    """Deviation of a bar's delta in the last ``window`` bars; the first bar has its delta itself (0 when not in parity)."""
    n = window or config.z_window
    w = Window.partitionBy(*DAY).orderBy("bar_idx").rowsBetween(1 - n, 0)
    d = F.col("delta").cast("double")
    t = bars.select("*", F.sum(d).over(w).alias("s_"), F.sum(d * d).over(w).alias("q_"), F.count("*").over(w).alias("n_"))
    mean = F.col("s_") / F.col("n_")
    var = F.col("q_") / F.col("n_") - mean * mean
    z = F.when(F.col("bar_idx") == 0, d if config.parity else F.lit(0.0)).when(var > 0, (d - mean) / F.sqrt(var)).otherwise(0.0)
    return t.withColumn("deltaZscore", z).drop("s_", "q_", "n_")


def add_slope(bars: DataFrame) -> DataFrame:
    """Least-squares slope of the cumulative delta over five bars; 0 before the fifth."""
    w = Window.partitionBy(*DAY).orderBy("bar_idx")
    y = [F.lag("cumDeltaAtBar", k).over(w) for k in range(5)]
    slope = (2 * y[0] + y[1] - y[3] - 2 * y[4]) / 10.0
    return bars.withColumn("cumDelta5barSlope", F.coalesce(slope.cast("double"), F.lit(0.0)))


def add_high_low(bars: DataFrame) -> DataFrame:
    """Session high, low and close (price of the tick that broke the bar) and week high and low, at every bar close."""
    day = _RUN(*DAY)
    t = bars.select("*", F.max("high").over(day).alias("dayHigh"), F.min("low").over(day).alias("dayLow"), F.first("open").over(day).alias("o_"), F.col("next_open").alias("dayClose"))
    week = _RUN("contract", "week_no")
    seed = F.first("o_").over(week)
    hi = F.max(F.when(F.col("closed"), F.col("dayHigh"))).over(week)
    lo = F.min(F.when(F.col("closed"), F.col("dayLow"))).over(week)
    t = t.withColumns({"weekHigh": F.when(F.col("week_no") == 1, F.greatest(hi, seed)).otherwise(F.greatest(hi, F.lit(0.0))), "weekLow": F.least(lo, seed)})
    return t.drop("o_")


_DAY_VWAP = ["vwap", "vwapUpperStdDev1", "vwapLowerStdDev1", "vwapUpperStdDev2", "vwapLowerStdDev2", "vwapBandWidth", "totalVolume"]
_WEEK_VWAP = ["weekVwap", "weekVwapUpperStdDev1", "weekVwapLowerStdDev1", "weekVwapBandWidth"]
_HIGH_LOW = ["dayHigh", "dayLow", "dayClose", "weekHigh", "weekLow"]


def _at_close(t: DataFrame, columns: list[str]) -> DataFrame:
    return t.where("closed").select(*DAY, "bar_idx", *columns)


def day_vwap(bars: DataFrame) -> DataFrame:
    return _at_close(add_day_vwap(bars), _DAY_VWAP)


def week_vwap(bars: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    return _at_close(add_week_vwap(bars, config), _WEEK_VWAP)


def delta_zscore(bars: DataFrame, config: BarConfig = DEFAULT, window: int | None = None) -> DataFrame:
    return _at_close(add_zscore(bars, config, window), ["deltaZscore"])


def cum_delta_slope(bars: DataFrame) -> DataFrame:
    return _at_close(add_slope(bars), ["cumDelta5barSlope"])


def high_low_close(bars: DataFrame) -> DataFrame:
    return _at_close(add_high_low(bars), _HIGH_LOW)


def windowed(bars: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """All indicators that windows can state, at every bar close, over one distribution by session and one by week."""
    t = add_slope(add_zscore(add_day_vwap(bars), config))
    return _at_close(add_week_vwap(add_high_low(t), config), [*_DAY_VWAP, "cumulativePV", "cumulativeSquarePV", "deltaZscore", "cumDelta5barSlope", *_HIGH_LOW, *_WEEK_VWAP])


RECURRENT = "contract string, trade_date date, bar_idx int, bbMiddle double, variance double, bbUpper double, bbLower double, BBandWidth double, rsi double, avgGain double, avgLoss double"


class Recurrences:
    """Bollinger bands and RSI of a series, one close after the other."""

    def __init__(self, bb_period: int = 21, bb_width: float = 2.4, rsi_period: int = 14):
        self.bb, self.width, self.rsi = bb_period, bb_width, rsi_period
        self.k, self.closes, self.gains, self.losses = 0, [], [], []
        self.gain = self.loss = None
        self.mid = self.var = None

    def push(self, close: float) -> tuple:
        self.k += 1
        k = self.k
        if k <= self.bb:
            self.closes.append(close)
            mid = sum(self.closes) / k
            if k == 1:
                self.first = close
                self.mid, self.var = close, 0.0
            else:
                self.mid, self.var = mid, sum((c - mid) ** 2 for c in self.closes) / k
        else:
            self.mid += (close - self.mid) / self.bb
            self.var = (self.bb - 1) / self.bb * self.var + (close - self.mid) ** 2 / self.bb
        if k >= 2:
            change = close - self.last
            up, down = max(change, 0.0), max(-change, 0.0)
            if k <= self.rsi:
                self.gains.append(up)
                self.losses.append(down)
                self.gain, self.loss = sum(self.gains) / (k - 1), sum(self.losses) / (k - 1)
            else:
                self.gain = (self.gain * (self.rsi - 1) + up) / self.rsi
                self.loss = (self.loss * (self.rsi - 1) + down) / self.rsi
        self.last = close
        s = self.width * math.sqrt(self.var) if self.var > 0 else 0.0
        rsi = None if k < 2 else 100.0 if self.loss == 0 else 100.0 - 100.0 / (1.0 + self.gain / self.loss)
        return self.mid, self.var, self.mid + s, self.mid - s, 2 * s, rsi, self.gain, self.loss


def bands_and_rsi(bars: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """Bollinger bands (mean and population variance up to the period, Wilder after it) and Wilder's RSI of closed bars.

    First-order recurrences along a session; one pass in Arrow batches that keeps a constant state.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            at, closes, out = sessions(batch), batch.column(3).to_pylist(), []
            for a, b in zip(at, at[1:]):
                mine = (batch.column(0)[a].as_py(), batch.column(1)[a].as_py())
                if mine != key:
                    key, state = mine, Recurrences(config.bb_period, config.bb_width, config.rsi_period)
                out += [state.push(c) for c in closes[a:b]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(x, pa.float64()) for x in zip(*out)]], names=[c.split()[0] for c in RECURRENT.split(", ")])

    flow = bars.where("closed").select(*DAY, "bar_idx", "close").repartition(*DAY).sortWithinPartitions(*DAY, "bar_idx")
    return flow.mapInArrow(run, RECURRENT)


def rsi_series(closes: DataFrame, period: int = 14) -> DataFrame:
    """RSI with its mean gain and loss of any (series, step, Close)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            series, out = batch.column(0).to_pylist(), []
            for s, c in zip(series, batch.column(2).to_pylist()):
                if state is None or s != key:
                    key, state = s, Recurrences(rsi_period=period)
                out.append(state.push(c)[5:])
            cols = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(x, pa.float64()) for x in cols]], names=["series", "step", "rsi", "avgGain", "avgLoss"])

    flow = closes.select(F.col("series").cast("long"), F.col("step").cast("long"), F.col("Close").cast("double")).repartition("series").sortWithinPartitions("series", "step")
    return flow.mapInArrow(run, "series long, step long, rsi double, avgGain double, avgLoss double")


TICK_STATE = "contract string, trade_date date, bar_idx int, priceCumDeltaDivergence5bar double, priceCumDeltaDivergence10bar double, avgAbsDelta10 double, interactionReversal double, interactionReversal20barAvg double"


class Divergence:
    """State of one session for the measures that move with every price change."""

    def __init__(self, config: BarConfig):
        self.parity, self.range = config.parity, config.bar_range
        self.closes, self.cums = [], []
        self.bar, self.delta, self.cum = -1, 0, 0
        self.ema = self.turn = self.turn_avg = self.d5 = self.d10 = 0.0

    def divergence(self, n: int, price: float) -> float:
        if len(self.closes) + 1 < n:
            return 0.0
        if self.parity or n == 5:
            size = abs(float(self.delta))
            self.ema = size if self.ema == 0.0 else (self.ema * 9.0 + size) / 10.0
        p, c = [*self.closes[-(n - 1) :], price], [*self.cums[-(n - 1) :], self.cum]
        denominator, sx = (50.0, 10.0) if n == 5 else (330.0 if self.parity else 825.0, 45.0)
        slope = lambda y: (n * sum(i * v for i, v in enumerate(y)) - sx * sum(y)) / denominator
        scale = 1.0 / self.ema if self.ema > 0 else 0.001
        return math.degrees(math.atan(slope(c) * scale)) - math.degrees(math.atan(slope(p) * (1.0 / 2.5 if self.parity else 1.0 / self.range)))

    def tick(self, bar: int, price: float, change: int, moved: bool, z: float, vwap: float) -> None:
        if bar != self.bar:
            if self.bar >= 0:
                self.closes = [*self.closes, self.price][-9:]
                self.cums = [*self.cums, self.cum][-9:]
            self.bar, self.delta = bar, 0
        self.delta += change
        self.cum += change
        self.price = price
        if moved:
            self.d5, self.d10 = self.divergence(5, price), self.divergence(10, price)
            self.turn = z * (price - vwap)
            self.turn_avg = abs(self.turn) if self.turn_avg == 0.0 else (self.turn_avg * 19.0 + abs(self.turn)) / 20.0

    def row(self) -> tuple:
        return self.d5, self.d10, self.ema, self.turn, self.turn_avg


def divergence(labelled: DataFrame, bars: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """Price/delta divergence over 5 and 10 bars, mean absolute delta, and interaction reversal, as each bar leaves them.

    They move with every price change and use z-score and VWAP as of the last closed bar; one pass over the ticks.
    """
    w = Window.partitionBy(*DAY).orderBy("bar_idx")
    first = F.first("open").over(w.rowsBetween(Window.unboundedPreceding, 0))
    known = add_zscore(add_day_vwap(bars), config)
    asof = known.select(*DAY, "bar_idx", F.coalesce(F.lag("deltaZscore").over(w), F.lit(0.0)).alias("z"), F.coalesce(F.lag("vwap").over(w), first).alias("vwap"))
    flow = labelled.select(*DAY, "bar_idx", "seq", "Price", (F.col("AskVolume") - F.col("BidVolume")).alias("d"), (F.col("is_open") | F.col("is_change")).alias("m")).join(asof, [*DAY, "bar_idx"])
    flow = flow.select(*DAY, "bar_idx", "Price", "d", "m", "z", "vwap", "seq").repartition(*DAY).sortWithinPartitions(*DAY, "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[]] * 8
            types = [pa.string(), pa.date32(), pa.int32(), *[pa.float64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=[c.split()[0] for c in TICK_STATE.split(", ")])

        for batch in batches:
            if not batch.num_rows:
                continue
            at = sessions(batch)
            cols = [batch.column(i).to_pylist() for i in range(2, 8)]
            for a, b in zip(at, at[1:]):
                mine = (batch.column(0)[a].as_py(), batch.column(1)[a].as_py())
                if mine != key:
                    if state is not None:
                        out.append((*key, state.bar, *state.row()))
                    key, state = mine, Divergence(config)
                for bar, price, d, moved, z, vwap in zip(*[c[a:b] for c in cols]):
                    if bar != state.bar and state.bar >= 0:
                        out.append((*key, state.bar, *state.row()))
                    state.tick(bar, price, d, moved, z, vwap)
            yield flush()
            out = []
        if state is not None:
            out.append((*key, state.bar, *state.row()))
            yield flush()

    return flow.mapInArrow(run, TICK_STATE)
