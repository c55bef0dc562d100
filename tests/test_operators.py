"""Order-flow operators against known values and against plain loops."""

import dataclasses
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions.config import DEFAULT
from tickloom.operators import bars, clean, features, footprint, indicators, portfolio, profile

DAY = dt.date(2024, 1, 3)
TICKS = "contract string, id long, DateTime timestamp_ntz, trade_date date, Price double, AskVolume long, BidVolume long"


def make_ticks(spark, rows, day=DAY, contract="A"):
    start = dt.datetime.combine(day, dt.time())
    data = [(contract, i, start + dt.timedelta(seconds=i), day, float(p), a, b) for i, (p, a, b) in enumerate(rows)]
    return spark.createDataFrame(data, TICKS)


GOLD = [(100, 5, 3), (100.25, 2, 7), (100.25, 4, 0), (101, 6, 1), (100.75, 0, 9), (102.5, 3, 3), (103, 8, 2), (103.5, 1, 4), (103.25, 2, 2), (100.5, 7, 5)]


def test_bars_and_footprint_known(spark):
    lab = bars.label(make_ticks(spark, GOLD))
    b = bars.bars(lab).orderBy("bar_idx").collect()
    got = [(r.open, r.high, r.low, r.close, r.barTotalVolume, r.delta, r.signal) for r in b]
    assert got == [(100, 102.5, 100, 102.5, 43, -3, 1), (103, 103.5, 103, 103.25, 29, 3, 1), (100.5, 100.5, 100.5, 100.5, 24, 2, 0)]
    assert b[0].startTime == "-1" and b[0].endTime == b[1].startTime
    lv = footprint.levels(lab)
    s = footprint.level_summary(lv).orderBy("bar_idx").collect()
    assert [(r.buyImbalanceCount, r.sellImbalanceCount, r.barHighDelta, r.barLowDelta) for r in s] == [(3, 0, 0, -1), (0, 1, 3, -6), (0, 0, -2, -2)]
    p = footprint.bar_poc(lab).orderBy("bar_idx").collect()
    assert [(r.barPOCPrice, r.barPOCVol) for r in p] == [(100.25, 13), (103, 10), (100.5, 12)]
    rows = lv.orderBy("bar_idx", "price").collect()
    assert [(r.price, r.bidVolume, r.askVolume, r.isBuyImbalance, r.isSellImbalance, r.volumeAtPrice, r.deltaAtPrice, r.is_phantom) for r in rows if r.bar_idx == 0] == [
        (100, 5, 3, False, False, 8, -2, False), (100.25, 6, 7, False, False, 13, 1, False), (100.5, 0, 0, False, False, 0, 0, True), (100.75, 0, 9, True, False, 9, 9, False),
        (101, 6, 1, True, False, 7, -5, False), (102.25, 0, 0, False, False, 0, 0, True), (102.5, 3, 3, True, False, 6, 0, False)]
    fixed = bars.bars(lab, dataclasses.replace(DEFAULT, parity=False)).orderBy("bar_idx").collect()
    assert [r.barTotalVolume for r in fixed] == [43, 19, 12]
    plain = footprint.levels(lab, dataclasses.replace(DEFAULT, parity=False))
    assert plain.where("is_phantom").count() == 0
    per_bar = {r.bar_idx: r.s for r in plain.groupBy("bar_idx").agg(F.sum("deltaAtPrice").alias("s")).collect()}
    assert per_bar == {r.bar_idx: r.delta for r in fixed}


def loop(rows, reach=2.5, theta=3.0):
    """Bars and levels tick by tick, in parity mode."""
    out, bar = [], None
    for i, (p, a, b) in enumerate(rows):
        opened = False
        if bar is None:
            bar = {"high": p, "low": p, "close": p, "v": 0, "delta": 0, "lv": {}}
            out.append(bar)
        elif not (bar["high"] - p <= reach and p - bar["low"] <= reach):
            bar = {"high": p, "low": p, "close": p, "v": a + b, "delta": 0, "lv": {p: [b, a, False, False, 0, 0]}}
            out.append(bar)
            opened = True
        lv = bar["lv"]
        x = lv.setdefault(p, [0, 0, False, False, 0, 0])
        x[0] += a
        x[1] += b
        x[4] += a + b
        x[5] += b - a
        bar["high"], bar["low"], bar["close"] = max(bar["high"], p), min(bar["low"], p), p
        bar["v"] += a + b
        bar["delta"] += a - b
        rule = lambda m, o: (o == 0 and m > 0) or (o > 0 and m / o >= theta)
        if p > min(lv):
            low = lv.setdefault(p - 0.25, [0, 0, False, False, 0, 0])
            x[2] = rule(x[1], low[0])
            low[3] = rule(low[0], x[1])
        if p < max(lv):
            up = lv.setdefault(p + 0.25, [0, 0, False, False, 0, 0])
            x[3] = rule(x[0], up[1])
            up[2] = rule(up[1], x[0])
        del opened, i
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_bars_against_loop(spark, seed):
    rnd = random.Random(seed)
    price, rows = 4000.0, []
    for _ in range(600):
        price += 0.25 * rnd.choice([-3, -2, -1, -1, 0, 0, 1, 1, 2, 3, 12 if rnd.random() < 0.02 else 0])
        rows.append((price, *((rnd.randrange(20), 0) if rnd.random() < 0.5 else (0, rnd.randrange(20)))))
    want = loop(rows)
    lab = bars.label(make_ticks(spark, rows)).persist()
    got = bars.bars(lab).orderBy("bar_idx").collect()
    assert [(r.high, r.low, r.close, r.barTotalVolume, r.delta) for r in got] == [(w["high"], w["low"], w["close"], w["v"], w["delta"]) for w in want]
    assert all(r.high - r.low <= 2.5 for r in got)
    assert got[-1].cumDeltaAtBar == sum(a - b for _, a, b in rows)
    lv = {(r.bar_idx, r.price): r for r in footprint.levels(lab).collect()}
    assert set(lv) == {(i, p) for i, w in enumerate(want) for p in w["lv"]}
    for i, w in enumerate(want):
        for p, x in w["lv"].items():
            r = lv[i, p]
            assert (r.bidVolume, r.askVolume, r.volumeAtPrice, r.deltaAtPrice) == (x[0], x[1], x[4], x[5])
    lab.unpersist()


def bars_of(spark, deltas=None, ohlcv=None):
    n = len(deltas or ohlcv)
    rows, cum = [], 0
    for i in range(n + 1):
        d = deltas[i] if deltas and i < n else 0
        h, low, c, v = ohlcv[i] if ohlcv and i < n else (100.0, 100.0, 100.0, 10)
        cum += d
        rows.append(("A", DAY, i, float(c), float(h), float(low), float(c), v, d, cum, i < n, 1))
    return spark.createDataFrame(rows, "contract string, trade_date date, bar_idx int, open double, high double, low double, close double, barTotalVolume long, delta long, cumDeltaAtBar long, closed boolean, week_no int")


@pytest.mark.parametrize(("deltas", "window", "z"), [([10], 11, 10), ([10, 12], 11, 1), (list(range(1, 21)), 20, 1.64751), (list(range(1, 22)), 20, 1.64751), ([5] * 20, 20, 0), (list(range(1, 12)), 11, 1.5811388300841895), (list(range(1, 13)), 11, 1.5811388300841895)])
def test_zscore_known(spark, deltas, window, z):
    got = indicators.delta_zscore(bars_of(spark, deltas), window=window).orderBy("bar_idx").collect()[-1].deltaZscore
    assert abs(got - z) < 1e-5


CLOSES = [100, 101, 102, 101, 102, 103, 104, 103, 102, 103, 104, 105, 106, 105, 106, 107, 108, 109, 110, 109, 108, 107, 106, 107, 108, 109, 110, 111, 112, 111, 110, 109, 108, 107, 106, 107, 108, 109, 110, 111, 112, 113, 114, 113, 112, 111, 110, 109, 108, 107]


def test_rsi_and_bands_known(spark):
    b = bars_of(spark, ohlcv=[(c, c, c, 1) for c in CLOSES])
    r = {x.bar_idx + 1: x for x in indicators.bands_and_rsi(b).collect()}
    for n, want in {1: None, 2: 100, 5: 75, 14: 69.23076923076923, 15: 71.42857142857143, 16: 73.46938775510205, 25: 64.26339397827064, 50: 42.11171961423779}.items():
        assert r[n].rsi == want if want is None else abs(r[n].rsi - want) < 1e-9
    for n, (mid, var, up, width) in {2: (100.5, 0.25, 101.7, 2.4), 21: (104.66666666666667, 8.412698412698413, 111.62778316167973, 13.922232990026114), 22: (104.77777777777779, 8.247249517090784, 111.6701037435489, 13.784651931542255), 50: (108.50092140073683, 10.06805902796957, 116.11617057598413, 15.230498350494605)}.items():
        assert all(abs(a - b) < 1e-9 for a, b in [(r[n].bbMiddle, mid), (r[n].variance, var), (r[n].bbUpper, up), (r[n].BBandWidth, width)])
    series = spark.createDataFrame([(1, i, float(c)) for i, c in enumerate(CLOSES)], "series long, step long, Close double")
    assert abs(indicators.rsi_series(series).where("step = 49").first().rsi - 42.11171961423779) < 1e-9


def test_vwap_and_slope_known(spark):
    v = indicators.day_vwap(bars_of(spark, ohlcv=[(101, 99, 100, 10), (102, 100, 101, 20), (103, 101, 103, 30)])).orderBy("bar_idx").collect()
    # the typical price of the third bar is 307/3
    assert [round(r.vwap, 6) for r in v] == [100.0, 100.666667, round((1000 + 2020 + 30 * 307 / 3) / 60, 6)]
    assert abs(v[1].vwapUpperStdDev1 - v[1].vwap - 0.47140452079) < 1e-6
    s = indicators.cum_delta_slope(bars_of(spark, [3, 2, -1, 4, 4])).orderBy("bar_idx").collect()
    assert [r.cumDelta5barSlope for r in s] == [0, 0, 0, 0, 2.1]


def test_divergence_known():
    d = indicators.Divergence(DEFAULT)
    d.closes, d.cums, d.bar, d.delta, d.cum, d.ema = [100, 101, 100.5, 102], [3, 5, 4, 8], 4, 4, 12, 4.0
    assert abs(d.divergence(5, 103) - 12.057226350846271) < 1e-9


@pytest.mark.parametrize(("levels", "want"), [({100: 10, 100.25: 30, 100.5: 50, 100.75: 30, 101: 20, 101.25: 5}, (100.5, 100.25, 100.75, 100.25, 145)), ({100: 40, 100.25: 0, 100.5: 50, 100.75: 0, 101: 40}, (100.5, 100.0, 100.5, 100.5, 130)), ({100: 0, 100.25: 0}, (0.0, 0.0, 100.0, 100.0, 0))])
def test_profile_known(spark, levels, want):
    lv = spark.createDataFrame([("A", DAY, 0, float(p), v, 0) for p, v in levels.items()], "contract string, trade_date date, bar_idx int, price double, bidVolume long, askVolume long")
    r = profile.developing(lv, bars_of(spark, [0]), ["contract", "trade_date"]).first()
    assert (r.poc, r.hvn, r.vah, r.val, r.profile_total) == want


def test_calendar_and_zones(spark):
    rows = clean.calendar(spark, "2024-02-13", "2024-03-13").groupBy("week_no").agg(F.min("date").alias("a"), F.max("date").alias("b")).orderBy("week_no").collect()
    assert [(str(r.a)[5:], str(r.b)[5:]) for r in rows] == [("02-13", "02-18"), ("02-19", "02-25"), ("02-26", "03-03"), ("03-04", "03-10"), ("03-11", "03-13")]
    assert clean.calendar(spark, "2024-02-13", "2024-02-12").count() == 0
    raw = spark.createDataFrame([("A", 1, "2024/03/10", "07:00:00", 1.0, 1, 1), ("A", 2, "2024/03/10", "bad", 1.0, 1, 1), ("A", 3, None, "07:00:00", 1.0, 1, 1)], "contract string, id long, Date string, Time string, Close double, AskVolume long, BidVolume long")
    assert [str(r.DateTime) for r in clean.clean(raw).collect()] == ["2024-03-10 03:00:00"]
    ist = spark.createDataFrame([("A", 1, "2024/01/03", "04:00:00", 1.0, 1, 1)], raw.schema)
    assert str(clean.clean(ist, "Asia/Kolkata", "UTC").first().DateTime) == "2024-01-02 22:30:00"


def test_roll_map_tie(spark):
    v = spark.createDataFrame([("A", "2024/01/02", 10), ("B", "2024/01/02", 12), ("A", "2024/01/03", 15), ("B", "2024/01/03", 15)], "contract string, Date string, daily_volume long")
    assert {r.Date: r.contract for r in clean.roll_map(v).collect()} == {"2024/01/02": "B", "2024/01/03": "A"}


def test_portfolio_known(spark):
    steps = spark.createDataFrame([(1, i, c, a) for i, (c, a) in enumerate(zip([100.0, 110.0, 99.0, 120.0], [0.5, -0.25, 1.0, 0.0]))], "series long, step long, Close double, action double")
    got = [(r.balance, r.shares, r.net_worth, r.reward, r.done, r.next_close) for r in portfolio.fold(steps).orderBy("step").collect()]
    assert got[:2] == [(5000, 50, 10000, 0, False, 110), (6375, 37.5, 10500, 500, False, 99)]
    assert got[2][0] == 0 and abs(got[2][1] - 101.89393939393939) < 1e-9 and abs(got[2][2] - 10087.5) < 1e-9 and got[2][4] and got[2][5] == 120


def test_edges_of_days_and_weeks(spark):
    one = make_ticks(spark, [(100, 1, 1)])
    later = make_ticks(spark, [(p, 1, 0) for p in (100, 103, 106)], dt.date(2024, 1, 17))
    zero = make_ticks(spark, [(100, 0, 0), (104, 0, 0), (100, 0, 0)], dt.date(2024, 1, 4))
    lab = bars.label(one.unionByName(later).unionByName(zero))
    b = features.with_weeks(bars.bars(lab))
    closed = features.closed_values(footprint.levels(lab), b)
    assert {(str(r.trade_date), r.n) for r in b.groupBy("trade_date").agg(F.count("*").alias("n")).collect()} == {("2024-01-03", 1), ("2024-01-04", 3), ("2024-01-17", 3)}
    d = {str(r.trade_date): r for r in features.day_summary(b, closed).collect()}
    assert d["2024-01-03"].rsi == 0.0 and d["2024-01-03"].vwap == 100
    weeks = {r.week_no: (r.weekHigh, r.weekLow) for r in features.week_summary(b, closed).collect()}
    assert weeks[2] == (0.0, 0.0) and set(weeks) == {1, 2, 3}
    diffs = {(str(r.trade_date), r.bar_idx): r for r in features.price_diffs(b, closed).collect()}
    assert diffs["2024-01-03", 0].priceCurrentDayVwapDiff == 0.0
    assert diffs["2024-01-17", 1].pricePrevWeekHighDiff == 103 and diffs["2024-01-17", 1].pricePreviousDayVwapDiff is None
    assert not math.isnan(diffs["2024-01-04", 2].priceCurrentDayVwapDiff)
    flat = features.bars_flat(one.unionByName(zero), keys=False)
    assert flat.columns == features.FLAT and len(flat.columns) == 50 and flat.count() == 4


def test_empty(spark):
    none = make_ticks(spark, GOLD).where("false")
    lab = bars.label(none)
    assert bars.bars(lab).count() == 0 and footprint.levels(lab).count() == 0
    assert indicators.bands_and_rsi(features.with_weeks(bars.bars(lab))).count() == 0
