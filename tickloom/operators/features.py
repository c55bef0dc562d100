"""Price differences as of the last closed bar, session and week summaries, and the flat bar table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.config import DAY, DEFAULT, BarConfig
from ..functions.hooks import NONE, Hooks
from ..sources import sinks
from . import bars as bars_, footprint, indicators, profile

BAR = [*DAY, "bar_idx"]
_DAY_PRICE = ["vwap", "poc", "vah", "val", "bbMiddle", "bbUpper", "bbLower", "dayHigh", "dayLow", "dayClose"]
_DAY_BAND = ["vwapUpperStdDev1", "vwapLowerStdDev1", "vwapUpperStdDev2", "vwapLowerStdDev2"]
_WEEK = ["weekVwap", "weekVwapUpperStdDev1", "weekVwapLowerStdDev1", "weekPoc", "weekVah", "weekVal", "weekHigh", "weekLow"]


def with_weeks(bars: DataFrame) -> DataFrame:
    """Bars with week_no: calendar weeks of a contract from that of its first session."""
    start = bars.groupBy("contract").agg(F.min("trade_date").alias("s"))
    return bars.join(start, "contract").withColumn("week_no", (F.floor(F.datediff("trade_date", F.trunc("s", "week")) / 7) + 1).cast("int")).drop("s")


def closed_values(levels: DataFrame, bars: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """All indicators at every bar close, one row per closed bar."""
    day = profile.developing(levels, bars, DAY, config)
    week = profile.developing(levels, bars, ["contract", "week_no"], config)
    week = week.select(*BAR, F.col("poc").alias("weekPoc"), F.col("vah").alias("weekVah"), F.col("val").alias("weekVal"), F.col("profile_total").alias("weekTotal"))
    out = indicators.windowed(bars, config)
    for more in (indicators.bands_and_rsi(bars, config), day, week):
        out = out.join(more, BAR)
    return out


def asof(bars: DataFrame, closed: DataFrame) -> DataFrame:
    """Every bar with the indicators as of the last bar closed before it; what a session or week starts with before."""
    t = bars.select(*BAR, "week_no", "closed", "open", "close", "moved").join(closed, BAR, "left")
    day = Window.partitionBy(*DAY).orderBy("bar_idx")
    first = F.first("open").over(day.rowsBetween(Window.unboundedPreceding, 0))
    week = Window.partitionBy("contract", "week_no").orderBy("trade_date", "bar_idx").rowsBetween(Window.unboundedPreceding, -1)
    opening = F.first("open").over(Window.partitionBy("contract", "week_no").orderBy("trade_date", "bar_idx").rowsBetween(Window.unboundedPreceding, 0))
    one = F.col("week_no") == 1

    def week_seed(c: str):
        if c == "weekLow":
            return opening
        return F.lit(0.0) if c.endswith("StdDev1") else F.when(one, opening).otherwise(F.lit(0.0))

    return t.select(*BAR, "week_no", "close", "moved",
                    *[F.coalesce(F.lag(c).over(day), first).alias(c) for c in _DAY_PRICE], *[F.coalesce(F.lag(c).over(day), F.lit(0.0)).alias(c) for c in _DAY_BAND],
                    *[F.coalesce(F.last(c, ignorenulls=True).over(week), week_seed(c)).alias(c) for c in _WEEK])


def day_summary(bars: DataFrame, closed: DataFrame) -> DataFrame:
    """Final values of every session, with its seeds where no bar closed."""
    last = closed.groupBy(*DAY).agg(*[F.max_by(c, "bar_idx").alias(c) for c in [*_DAY_PRICE, *_DAY_BAND, "deltaZscore", "cumDelta5barSlope", "rsi", "totalVolume"]])
    base = bars.groupBy(*DAY, "week_no").agg(F.min_by("open", "bar_idx").alias("seed"), F.sum("delta").alias("cumulativeDelta"), F.count("*").alias("n_bars"))
    t = base.join(last, DAY, "left")
    return t.select(*DAY, "week_no", "cumulativeDelta", "n_bars", *[F.coalesce(c, "seed").alias(c) for c in _DAY_PRICE], *[F.coalesce(c, F.lit(0.0)).alias(c) for c in [*_DAY_BAND, "deltaZscore", "cumDelta5barSlope"]], F.when(F.col("n_bars") == 1, F.lit(0.0)).otherwise(F.col("rsi")).alias("rsi"), F.coalesce("totalVolume", F.lit(0)).alias("totalVolume"))


def week_summary(bars: DataFrame, closed: DataFrame) -> DataFrame:
    """Final high and low of every calendar week from the first to the last, weeks without sessions included (0.0)."""
    t = bars.select(*BAR, "week_no", "open").join(closed.select(*BAR, "weekHigh", "weekLow"), BAR, "left")
    order = F.struct("trade_date", "bar_idx")
    w = t.groupBy("contract", "week_no").agg(F.max_by("weekHigh", F.when(F.col("weekHigh").isNotNull(), order)).alias("h"), F.max_by("weekLow", F.when(F.col("weekLow").isNotNull(), order)).alias("l"), F.min_by("open", order).alias("o"))
    span = w.groupBy("contract").agg(F.max("week_no").alias("n")).select("contract", F.explode(F.sequence(F.lit(1), "n")).alias("week_no"))
    full = span.join(w, ["contract", "week_no"], "left")
    high = F.coalesce("h", F.when(F.col("week_no") == 1, F.col("o")), F.lit(0.0))
    return full.select("contract", "week_no", high.alias("weekHigh"), F.coalesce("l", "o", F.lit(0.0)).alias("weekLow"))


def previous(bars: DataFrame, closed: DataFrame, config: BarConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(session, values of the session before it) and (week, high and low of the week before it).

    In parity mode the session before must be of the same week.
    """
    cols = ["vwap", "poc", "vah", "val", "dayHigh", "dayLow", "dayClose"]
    keys = ["contract", "week_no"] if config.parity else ["contract"]
    d = Window.partitionBy(*keys).orderBy("trade_date")
    days = day_summary(bars, closed).select(*DAY, *[F.lag(c).over(d).alias(f"prev_{c}") for c in cols])
    w = Window.partitionBy("contract").orderBy("week_no")
    weeks = week_summary(bars, closed).select("contract", "week_no", F.lag("weekHigh").over(w).alias("prev_weekHigh"), F.lag("weekLow").over(w).alias("prev_weekLow"))
    return days, weeks


#: Name of each difference, and the value that is taken from the price.
DIFFS = {
    "priceCurrentDayVwapDiff": "vwap", "priceCurrentDayVwapUpperStdDev1Diff": "vwapUpperStdDev1", "priceCurrentDayVwapUpperStdDev2Diff": "vwapUpperStdDev2",
    "priceCurrentDayVwapLowerStdDev1Diff": "vwapLowerStdDev1", "priceCurrentDayVwapLowerStdDev2Diff": "vwapLowerStdDev2", "pricePreviousDayVwapDiff": "prev_vwap",
    "priceWeeklyVwapDiff": "weekVwap", "priceWeeklyVwapUpperStdDevDiff": "weekVwapUpperStdDev1", "priceWeeklyVwapLowerStdDevDiff": "weekVwapLowerStdDev1",
    "priceBBandUpperDiff": "bbUpper", "priceBBandLowerDiff": "bbLower", "PriceBBandMiddleDiff": "bbMiddle", "priceCurrDayVAHDiff": "vah", "priceCurrDayVALDiff": "val",
    "pricePrevDayPOCDiff": "prev_poc", "pricePrevDayVAHDiff": "prev_vah", "pricePrevDayVALDiff": "prev_val", "pricePrevDayHighDiff": "prev_dayHigh", "pricePrevDayLowDiff": "prev_dayLow",
    "pricePrevDayCloseDiff": "prev_dayClose", "priceCurrentWeekHighDiff": "weekHigh", "priceCurrentWeekLowDiff": "weekLow", "pricePrevWeekHighDiff": "prev_weekHigh", "pricePrevWeekLowDiff": "prev_weekLow",
}


def price_diffs(bars: DataFrame, closed: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """Differences of each bar's close from indicators; 0.0 in a first bar whose price never changed. Value-area flags."""
    days, weeks = previous(bars, closed, config)
    t = asof(bars, closed).join(days, DAY, "left").join(weeks, ["contract", "week_no"], "left")
    diff = lambda c: F.when(F.col("moved"), F.col("close") - F.col(c)).otherwise(F.lit(0.0))
    inside = lambda low, high: F.when(F.col("moved"), (F.col("close") > F.col(low)) & (F.col("close") < F.col(high))).otherwise(F.lit(False))
    still = F.when(F.col("moved"), F.col("close")).otherwise(F.lit(0.0))
    return t.select(*BAR, "week_no", *[diff(v).alias(k) for k, v in DIFFS.items()], inside("val", "vah").alias("isPriceInCurrentDayVA"), inside("prev_val", "prev_vah").alias("isPriceInPrevDayVA"),
                    still.alias("priceIBHighDiff"), still.alias("priceIBLowDiff"), *[F.lit(0.0).alias(c) for c in ("priceLastSwingHighDiff", "priceLastSwingLowDiff", "priceLastHVNDiff")])


FLAT = """startTime endTime open high low close barTotalVolume footprint buyImbalanceCount sellImbalanceCount delta barDeltaChange barHighDelta
barLowDelta barPOCPrice barPOCVol signal signalID signalStatus priceCurrentDayVwapDiff priceCurrentDayVwapUpperStdDevDiff
priceCurrentDayVwapLowerStdDevDiff pricePreviousDayVwapDiff priceWeeklyVwapDiff priceWeeklyVwapUpperStdDevDiff priceWeeklyVwapLowerStdDevDiff
priceBBandUpperDiff priceBBandLowerDiff PriceBBandMiddleDiff isPriceInCurrentDayVA isPriceInPrevDayVA priceCurrDayVAHDiff priceCurrDayVALDiff
pricePrevDayPOCDiff pricePrevDayVAHDiff pricePrevDayVALDiff priceIBHighDiff priceIBLowDiff pricePrevDayHighDiff pricePrevDayLowDiff
pricePrevDayCloseDiff priceCurrentWeekHighDiff priceCurrentWeekLowDiff pricePrevWeekHighDiff pricePrevWeekLowDiff priceLastSwingHighDiff
priceLastSwingLowDiff priceLastHVNDiff dayOfTheWeek weekOfTheContract""".split()


def bars_flat(ticks: DataFrame, config: BarConfig = DEFAULT, keys: bool = True) -> DataFrame:
    """One row per bar with all features, in the columns of the training table; with ``keys`` also what names the bar."""
    # each has several consumers; they spill to disk and are computed anew where an executor is lost
    labelled = bars_.label(ticks, config).persist()
    b = with_weeks(bars_.bars(labelled, config)).persist()
    lv = footprint.levels(labelled, config).persist()
    closed = closed_values(lv, b, config).persist()
    out = b.join(footprint.nested(lv), BAR).join(footprint.level_summary(lv), BAR).join(footprint.bar_poc(labelled), BAR).join(price_diffs(b, closed, config).drop("week_no"), BAR)
    out = out.withColumns({
        "priceCurrentDayVwapUpperStdDevDiff": F.col("priceCurrentDayVwapUpperStdDev2Diff"), "priceCurrentDayVwapLowerStdDevDiff": F.col("priceCurrentDayVwapLowerStdDev2Diff"),
        "dayOfTheWeek": (F.weekday("trade_date") + 1).cast("string"), "weekOfTheContract": F.lit("-1") if config.parity else F.col("week_no").cast("string"),
    })
    return out.select(*(BAR if keys else []), *FLAT)


#: Scalars of a session in its document, and where they come from.
DAY_SCALARS = {
    "deltaZscore11bars": "deltaZscore", "cumDelta5barSlope": "cumDelta5barSlope", "priceCumDeltaDivergence5bar": "priceCumDeltaDivergence5bar", "priceCumDeltaDivergence10bar": "priceCumDeltaDivergence10bar",
    "interactionReversal": "interactionReversal", "vwap": "vwap", "vwapUpperStdDev1": "vwapUpperStdDev1", "vwapUpperStdDev2": "vwapUpperStdDev2", "vwapLowerStdDev1": "vwapLowerStdDev1", "vwapLowerStdDev2": "vwapLowerStdDev2",
    "vwapBandWidth": "vwapBandWidth", "bbMiddle": "bbMiddle", "bbUpper": "bbUpper", "bbLower": "bbLower", "BBandWidth": "BBandWidth", "rsi": "rsi", "poc": "poc", "vah": "vah", "val": "val", "ibHigh": None, "ibLow": None,
    "dayHigh": "dayHigh", "dayLow": "dayLow", "dayClose": "dayClose", "totalVolume": "totalVolume", "cumulativeDelta": "cumulativeDelta", "lastSwingHigh": None, "lastSwingLow": None, "lastHighVolumeNode": "hvn",
    "prevAvgGain": "avgGain", "prevAvgLoss": "avgLoss", "variance": "variance", "cumulativePV": "cumulativePV", "cumulativeSquarePV": "cumulativeSquarePV",
}


def day_scalars(bars: DataFrame, closed: DataFrame, moving: DataFrame) -> DataFrame:
    """All final scalars of every session; ``moving`` is what ``indicators.divergence`` gives."""
    base = day_summary(bars, closed)
    rest = ["vwapBandWidth", "BBandWidth", "hvn", "avgGain", "avgLoss", "variance", "cumulativePV", "cumulativeSquarePV"]
    last = closed.groupBy(*DAY).agg(*[F.max_by(c, "bar_idx").alias(c) for c in rest])
    state = moving.groupBy(*DAY).agg(*[F.max_by(c, "bar_idx").alias(c) for c in ("priceCumDeltaDivergence5bar", "priceCumDeltaDivergence10bar", "interactionReversal")])
    t = base.join(last, DAY, "left").join(state, DAY, "left")
    keep = {"avgGain", "avgLoss", "rsi"}  # undefined before the second close
    value = lambda v: F.lit(0.0) if v is None else F.col(v) if v in keep else F.coalesce(F.col(v), F.lit(0))
    return t.select(*DAY, "week_no", *[value(v).alias(k) for k, v in DAY_SCALARS.items()])


WEEK_SCALARS = {"totalVolume": "weekTotal", "vwap": "weekVwap", "vwapUpperStdDev1": "weekVwapUpperStdDev1", "vwapLowerStdDev1": "weekVwapLowerStdDev1", "vwapBandWidth": "weekVwapBandWidth", "poc": "weekPoc", "vah": "weekVah", "val": "weekVal"}


def week_scalars(bars: DataFrame, closed: DataFrame) -> DataFrame:
    """All final scalars of every calendar week; weeks without a closed bar keep what a week starts with."""
    order = F.struct("trade_date", "bar_idx")
    t = bars.select(*BAR, "week_no", "open").join(closed.select(*BAR, *WEEK_SCALARS.values()), BAR, "left")
    last = t.groupBy("contract", "week_no").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in WEEK_SCALARS.values()], F.min_by("open", order).alias("o"))
    full = week_summary(bars, closed).join(last, ["contract", "week_no"], "left")
    first = F.when(F.col("week_no") == 1, F.col("o"))
    seed = lambda v: F.lit(0.0) if v in ("weekTotal", "weekVwapBandWidth") or v.endswith("StdDev1") else F.coalesce(first, F.lit(0.0))
    return full.select("contract", "week_no", *[F.coalesce(F.col(v).cast("double"), seed(v)).alias(k) for k, v in WEEK_SCALARS.items()], "weekHigh", "weekLow")


def state_vector(bars: DataFrame, closed: DataFrame) -> DataFrame:
    """Fourteen numbers of every closed bar: OHLC, volume, VWAP with its band, Bollinger bands, RSI."""
    mine = ["vwap", "vwapUpperStdDev1", "vwapLowerStdDev1", "vwapBandWidth", "bbMiddle", "bbUpper", "bbLower", "BBandWidth", "rsi"]
    return bars.select(*BAR, "open", "high", "low", "close", "barTotalVolume").join(closed.select(*BAR, *mine), BAR)


def contract_start(ticks: DataFrame) -> DataFrame:
    """Per contract the price of its first tick, which seeds its first week. Raises where there is no tick at all."""
    first = ticks.groupBy("contract").agg(F.min_by("Price", F.struct("DateTime", "id")).alias("seed"), F.min("trade_date").alias("start"))
    if not first.take(1):
        raise ValueError("a contract without ticks has no start")
    return first


def contract_documents(ticks: DataFrame, config: BarConfig = DEFAULT, hooks: Hooks = NONE) -> DataFrame:
    """Nested documents of all contracts, after the hooks of bars, sessions, weeks and contracts."""
    contract_start(ticks)
    return hooks.contracts(sinks.nested_contracts(*documents(ticks, config, hooks)))


def documents(ticks: DataFrame, config: BarConfig = DEFAULT, hooks: Hooks = NONE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Flat bars (with week_no), sessions and weeks of a contract's document, after the hooks of each level."""
    labelled = bars_.label(ticks, config).persist()
    b = with_weeks(bars_.bars(labelled, config)).persist()
    closed = closed_values(footprint.levels(labelled, config), b, config).persist()
    flat = bars_flat(ticks, config).join(b.select(*BAR, "week_no"), BAR)
    return hooks.bars(flat), hooks.days(day_scalars(b, closed, indicators.divergence(labelled, b, config))), hooks.weeks(week_scalars(b, closed))
