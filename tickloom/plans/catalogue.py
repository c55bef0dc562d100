"""The registered queries of the order-flow engine, each with its DuckDB counterpart where SQL can state it.

Numbers are rounded to six places on both sides, integers are 64 bits wide, dates and times are text.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.config import DAY, DEFAULT
from ..operators import bars as bars_, clean, features, footprint, indicators, portfolio, profile
from ..sources import sinks, sqlite, ticks as ticks_
from .sql import query

BAR = [*DAY, "bar_idx"]
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Columns in the types that both engines give: bigint, rounded double, text for dates and times."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TIME)
        out.append(c.alias(f.name))
    return df.select(*out)


def sql_shown(text: dict[str, str] | str, digits: int = 6) -> str:
    """Select list for the same: "name:kind" words, where kind is i(nteger), n(umber), d(ate), t(ime) or nothing."""
    out = []
    for word in text.split():
        name, _, kind = word.partition(":")
        form = {"": "{0}", "i": "CAST({0} AS BIGINT)", "n": f"round(CAST({{0}} AS DOUBLE), {digits}) + 0.0E0", "d": "strftime({0}, '%Y-%m-%d')", "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"}[kind]
        out.append(f"{form.format(name)} AS {name}")
    return ", ".join(out)


KEYS = "contract trade_date:d bar_idx:i "
_found: dict[str, tuple] = {}


def registered(sql: str | None):
    def add(f):
        _found[f.__name__] = (f, sql)
        return f

    return add


def _simple(columns: str, source: str, *parts: str, where: str = "", digits: int = 6) -> str:
    return query(f"SELECT {sql_shown(columns, digits)} FROM {source} {where}", *parts)


def _ticks(spark: SparkSession, d: str) -> DataFrame:
    return ticks_.event_ticks(spark, d)


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return bars_.label(_ticks(spark, d))


def _bars(spark: SparkSession, d: str) -> DataFrame:
    return features.with_weeks(bars_.bars(_labelled(spark, d)))


def _closed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    labelled = _labelled(spark, d).persist()
    b = features.with_weeks(bars_.bars(labelled)).persist()
    return b, features.closed_values(footprint.levels(labelled), b).persist()


def _folder(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{os.environ.get('TMPDIR', '/tmp')}/tickloom"
    return f"{base}/{name}-{uuid.uuid4().hex}"


# --- cleaning, roll map, calendar -------------------------------------------------------------------------------------

_CLEAN = """SELECT contract, CAST(id AS BIGINT) AS id, strftime({zone}, '%Y-%m-%d %H:%M:%S.%f') AS DateTime, Close AS Price, CAST(AskVolume AS BIGINT) AS AskVolume, CAST(BidVolume AS BIGINT) AS BidVolume
FROM (SELECT *, try_strptime(Date || ' ' || Time, '%Y/%m/%d %H:%M:%S') AS ts FROM raw) WHERE ts IS NOT NULL"""


@registered(query(_CLEAN.format(zone="(ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'"), "raw"))
def tick_clean_ny(spark, d):
    return shown(clean.clean(ticks_.event_raw_ticks(spark, d)))


@registered(query(_CLEAN.format(zone="ts - INTERVAL 330 MINUTE"), "raw"))
def tick_clean_ist(spark, d):
    return shown(clean.clean(ticks_.event_raw_ticks(spark, d), "Asia/Kolkata", "UTC"))


@registered(_simple("contract id:i DateTime:t trade_date:d Price:n AskVolume:i BidVolume:i", "ticks", "ticks", where="WHERE trade_date = DATE '2024-01-10'"))
def day_scan(spark, d):
    return shown(_ticks(spark, d).where(F.col("trade_date") == F.lit("2024-01-10").cast("date")).select("contract", "id", "DateTime", "trade_date", "Price", "AskVolume", "BidVolume"))


@registered(_simple("contract trade_date:d id:i DateTime:t Price:n AskVolume:i BidVolume:i", "ticks", "ticks", where="QUALIFY row_number() OVER (PARTITION BY contract, trade_date ORDER BY DateTime, id) = 1"))
def first_tick_of_day(spark, d):
    return shown(clean.first_tick(_ticks(spark, d)))


@registered("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY")
def last_30_days(spark, d):
    return shown(clean.last_days(ticks_.table(spark, d, "orders").select("o_orderkey", "o_orderdate")))


@registered(_simple("id:i DateTime:t Price:n", "ticks", "ticks", where="ORDER BY ticks.id DESC LIMIT 5"))
def tail5(spark, d):
    return shown(_ticks(spark, d).orderBy(F.desc("id")).limit(5).select("id", "DateTime", "Price"))


@registered(_simple("contract Date daily_volume:i", "volumes", "volumes"))
def daily_volume(spark, d):
    return shown(clean.daily_volume(ticks_.event_raw_ticks(spark, d)))


@registered(_simple("Date contract daily_volume:i", "rolls", "rolls"))
def roll_map(spark, d):
    return shown(clean.roll_map(clean.daily_volume(ticks_.event_raw_ticks(spark, d))))


@registered(query(f"SELECT {sql_shown('Date contract id:i Time Close:n')} FROM raw SEMI JOIN rolls USING (Date, contract)", "raw", "rolls"))
def continuous_series(spark, d):
    raw = ticks_.event_raw_ticks(spark, d)
    return shown(clean.continuous(raw, clean.roll_map(clean.daily_volume(raw))).select("Date", "contract", "id", "Time", "Close"))


@registered(query("SELECT contract, Date, CAST(daily_volume AS BIGINT) AS daily_volume FROM volumes UNION ALL SELECT 'all', Date, CAST(sum(daily_volume) AS BIGINT) FROM volumes GROUP BY Date", "volumes"))
def volume_union(spark, d):
    v = clean.daily_volume(ticks_.event_raw_ticks(spark, d))
    return shown(v.unionByName(v.groupBy("Date").agg(F.sum("daily_volume").alias("daily_volume")).withColumn("contract", F.lit("all"))).select("contract", "Date", "daily_volume"))


@registered("""SELECT CAST(floor(date_diff('day', DATE '2024-02-12', x) / 7) + 1 AS BIGINT) AS week_no, CAST(isodow(x) AS BIGINT) AS day_number, strftime(x, '%Y-%m-%d') AS date
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-02-13', TIMESTAMP '2024-03-13', INTERVAL 1 DAY)) AS DATE) AS x)""")
def week_calendar(spark, d):
    return shown(clean.calendar(spark, "2024-02-13", "2024-03-13"))


@registered(query("""SELECT CAST(floor(date_diff('day', DATE '2024-01-01', trade_date) / 7) + 1 AS BIGINT) AS week_no, CAST(isodow(trade_date) AS BIGINT) AS day_number, strftime(trade_date, '%Y-%m-%d') AS trade_date, count(*) AS n
FROM ticks WHERE trade_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-19' GROUP BY ALL""", "ticks"))
def calendar_ticks(spark, d):
    days = clean.calendar(spark, "2024-01-03", "2024-01-19").withColumnRenamed("date", "trade_date")
    return shown(_ticks(spark, d).join(F.broadcast(days), "trade_date").groupBy("week_no", "day_number", "trade_date").agg(F.count("*").alias("n")).select("week_no", "day_number", "trade_date", "n"))


@registered(_simple("contract id:i trade_date:d Price:n AskVolume:i BidVolume:i", "(SELECT *, CAST(trunc(AskVolume / 3.0) AS BIGINT) AS a, CAST(trunc(BidVolume / 3.0) AS BIGINT) AS b FROM ticks)", "ticks").replace("CAST(AskVolume AS BIGINT) AS AskVolume", "a AS AskVolume").replace("CAST(BidVolume AS BIGINT) AS BidVolume", "b AS BidVolume"))
def processing_ticks(spark, d):
    t = _ticks(spark, d).withColumns({c: F.col(c) / 3.0 for c in ("AskVolume", "BidVolume")})
    return shown(clean.processing_ticks(t).select("contract", "id", "trade_date", "Price", "AskVolume", "BidVolume"))


# --- bars -------------------------------------------------------------------------------------------------------------


@registered(_simple("contract trade_date:d id:i bar_idx:i is_open is_change", "lab", "lab"))
def range_bars(spark, d):
    return shown(_labelled(spark, d).select("contract", "trade_date", "id", "bar_idx", "is_open", "is_change"))


@registered(_simple(KEYS + "open:n high:n low:n close:n barTotalVolume:i delta:i barDeltaChange:i cumDeltaAtBar:i n_ticks:i", "bars", "bars"))
def bar_ohlcv(spark, d):
    return shown(bars_.bars(_labelled(spark, d)).select(*BAR, "open", "high", "low", "close", "barTotalVolume", "delta", "barDeltaChange", "cumDeltaAtBar", "n_ticks"))


@registered(_simple(KEYS + "startTime endTime", "bars", "bars"))
def bar_times(spark, d):
    return shown(bars_.bars(_labelled(spark, d)).select(*BAR, "startTime", "endTime"))


@registered(_simple(KEYS + "delta:i barDeltaChange:i cumDeltaAtBar:i", "bars", "bars"))
def bar_delta(spark, d):
    return shown(bars_.bars(_labelled(spark, d)).select(*BAR, "delta", "barDeltaChange", "cumDeltaAtBar"))


@registered(query(f"SELECT {sql_shown(KEYS + 'signal:i')}, CAST(signal AS BIGINT) AS signalID, signal = 1 AS signalStatus, CASE WHEN delta > 0 THEN 2 WHEN delta < 0 THEN 1 ELSE 0 END AS side FROM bars".replace("ELSE 0 END AS side", "ELSE 0 END::BIGINT AS side"), "bars"))
def bar_signal(spark, d):
    side = lambda b: F.when(b["delta"] > 0, 2).when(b["delta"] < 0, 1).otherwise(0)
    return shown(bars_.with_signal(bars_.bars(_labelled(spark, d)), side, "side").select(*BAR, "signal", "signalID", "signalStatus", "side"))


# --- footprint --------------------------------------------------------------------------------------------------------


@registered(_simple(KEYS + "price:n bidVolume:i askVolume:i volumeAtPrice:i deltaAtPrice:i", "levels", "levels", where="WHERE NOT is_phantom"))
def footprint_levels(spark, d):
    return shown(footprint.levels(_labelled(spark, d)).where("NOT is_phantom").select(*BAR, "price", "bidVolume", "askVolume", "volumeAtPrice", "deltaAtPrice"))


@registered(_simple(KEYS + "price:n", "levels", "levels", where="WHERE is_phantom"))
def footprint_phantoms(spark, d):
    return shown(footprint.levels(_labelled(spark, d)).where("is_phantom").select(*BAR, "price"))


@registered(_simple(KEYS + "price:n isBuyImbalance isSellImbalance", "levels", "levels"))
def imbalance_flags(spark, d):
    return shown(footprint.levels(_labelled(spark, d)).select(*BAR, "price", "isBuyImbalance", "isSellImbalance"))


@registered(_simple(KEYS + "buyImbalanceCount:i sellImbalanceCount:i", "edges", "edges"))
def imbalance_counts(spark, d):
    return shown(footprint.level_summary(footprint.levels(_labelled(spark, d))).select(*BAR, "buyImbalanceCount", "sellImbalanceCount"))


@registered(_simple(KEYS + "barHighDelta:i barLowDelta:i", "edges", "edges"))
def edge_delta(spark, d):
    return shown(footprint.level_summary(footprint.levels(_labelled(spark, d))).select(*BAR, "barHighDelta", "barLowDelta"))


@registered(_simple(KEYS + "barPOCPrice:n barPOCVol:i", "poc", "poc"))
def bar_poc(spark, d):
    return shown(footprint.bar_poc(_labelled(spark, d)))


# --- indicators -------------------------------------------------------------------------------------------------------


@registered(_simple(KEYS + "vwap:n vwapUpperStdDev1:n vwapLowerStdDev1:n vwapUpperStdDev2:n vwapLowerStdDev2:n vwapBandWidth:n totalVolume:i", "dvwap", "dvwap", digits=4))
def day_vwap_bands(spark, d):
    return shown(indicators.day_vwap(_bars(spark, d)), 4)


@registered(_simple(KEYS + "weekVwap:n weekVwapUpperStdDev1:n weekVwapLowerStdDev1:n weekVwapBandWidth:n", "wvwap", "wvwap", digits=4))
def week_vwap_bands(spark, d):
    return shown(indicators.week_vwap(_bars(spark, d)), 4)


@registered(query(f"""SELECT {sql_shown(KEYS)}, round(PV / V, 4) + 0.0E0 AS weekVwap FROM (
  SELECT *, sum(CAST(barTotalVolume AS DOUBLE)) OVER w AS V, sum(barTotalVolume * close) OVER w AS PV FROM bars WHERE closed
  WINDOW w AS (PARTITION BY contract, week_no ORDER BY trade_date, bar_idx ROWS UNBOUNDED PRECEDING)) WHERE V > 0""", "bars"))
def week_vwap_corrected(spark, d):
    import dataclasses

    own = indicators.week_vwap(_bars(spark, d), dataclasses.replace(DEFAULT, parity=False))
    return shown(own.select(*BAR, "weekVwap").where("weekVwap > 0"), 4)


# variances of 16 closes on the tick grid end in a 5 that either rounding may take; the small number decides for both
@registered(_simple(KEYS + "bbMiddle:n variance:n bbUpper:n bbLower:n BBandWidth:n", "(SELECT * REPLACE (variance + 1e-9 AS variance) FROM rec)", "rec"))
def bbands(spark, d):
    t = indicators.bands_and_rsi(_bars(spark, d)).withColumn("variance", F.col("variance") + F.lit(1e-9))
    return shown(t.select(*BAR, "bbMiddle", "variance", "bbUpper", "bbLower", "BBandWidth"))


@registered(_simple(KEYS + "rsi:n avgGain:n avgLoss:n", "rec", "rec"))
def rsi(spark, d):
    return shown(indicators.bands_and_rsi(_bars(spark, d)).select(*BAR, "rsi", "avgGain", "avgLoss"))


_ORDER_CLOSES = """closes AS (SELECT o_custkey % 16 AS series, row_number() OVER (PARTITION BY o_custkey % 16 ORDER BY o_orderkey, round(o_totalprice, 2)) - 1 AS step, round(o_totalprice, 2) AS Close FROM orders)"""


@registered(f"""WITH RECURSIVE {_ORDER_CLOSES}, mv AS (
  SELECT *, step + 1 AS k, CASE WHEN lag(Close) OVER o IS NOT NULL THEN greatest(Close - lag(Close) OVER o, 0) END AS up, CASE WHEN lag(Close) OVER o IS NOT NULL THEN greatest(lag(Close) OVER o - Close, 0) END AS down FROM closes WINDOW o AS (PARTITION BY series ORDER BY step)
), mv2 AS (SELECT *, avg(up) OVER w AS g0, avg(down) OVER w AS l0 FROM mv WINDOW w AS (PARTITION BY series ORDER BY step ROWS UNBOUNDED PRECEDING)
), r AS (
  SELECT series, k, CAST(NULL AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS l FROM mv2 WHERE k = 1
  UNION ALL
  SELECT m.series, m.k, CASE WHEN m.k <= 14 THEN m.g0 ELSE (13 * r.g + m.up) / 14 END, CASE WHEN m.k <= 14 THEN m.l0 ELSE (13 * r.l + m.down) / 14 END FROM r JOIN mv2 m ON m.series = r.series AND m.k = r.k + 1)
SELECT CAST(series AS BIGINT) AS series, CAST(k - 1 AS BIGINT) AS step, round(CASE WHEN k < 2 THEN NULL WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END, 6) + 0.0E0 AS rsi, round(g + 1e-6, 4) + 0.0E0 AS avgGain, round(l + 1e-6, 4) + 0.0E0 AS avgLoss FROM r""")
def rsi_close_series(spark, d):
    r = indicators.rsi_series(ticks_.order_closes(spark, d))
    return shown(r.select("series", "step", "rsi", *[F.round(F.col(c) + F.lit(1e-6), 4).alias(c) for c in ("avgGain", "avgLoss")]))


@registered(_simple(KEYS + "deltaZscore:n", "zs", "zs"))
def delta_zscore(spark, d):
    return shown(indicators.delta_zscore(_bars(spark, d)))


@registered(query("""SELECT contract, strftime(trade_date, '%Y-%m-%d') AS trade_date, CAST(bar_idx AS BIGINT) AS bar_idx, round(CASE WHEN bar_idx = 0 THEN d WHEN q / n - (s / n) * (s / n) > 0 THEN (d - s / n) / sqrt(q / n - (s / n) * (s / n)) ELSE 0 END, 6) + 0.0E0 AS deltaZscore
  FROM (SELECT contract, trade_date, bar_idx, CAST(delta AS DOUBLE) AS d, sum(CAST(delta AS DOUBLE)) OVER w AS s, sum(CAST(delta AS DOUBLE) * CAST(delta AS DOUBLE)) OVER w AS q, count(*) OVER w AS n
        FROM bars WHERE closed WINDOW w AS (PARTITION BY contract, trade_date ORDER BY bar_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""", "bars"))
def delta_zscore20(spark, d):
    return shown(indicators.delta_zscore(_bars(spark, d), window=20))


@registered(_simple(KEYS + "cumDelta5barSlope:n", "slope", "slope"))
def cum_delta_slope(spark, d):
    return shown(indicators.cum_delta_slope(_bars(spark, d)))


_EMA = f"""psens AS (
  SELECT *, row_number() OVER (PARTITION BY contract, trade_date ORDER BY seq) AS e FROM (
    SELECT contract, trade_date, bar_idx, seq, Price, is_open OR is_change AS m, abs(sum(AskVolume - BidVolume) OVER (PARTITION BY contract, trade_date, bar_idx ORDER BY seq ROWS UNBOUNDED PRECEDING)) AS ad,
           sum(AskVolume - BidVolume) OVER (PARTITION BY contract, trade_date ORDER BY seq ROWS UNBOUNDED PRECEDING) AS cd FROM lab) WHERE m
), ema AS (
  SELECT contract, trade_date, 0::BIGINT AS e, 0.0E0 AS x5, 0.0E0 AS x10 FROM (SELECT DISTINCT contract, trade_date FROM psens)
  UNION ALL
  SELECT p.contract, p.trade_date, p.e, s.a, CASE WHEN p.bar_idx >= 9 THEN CASE WHEN s.a = 0 THEN p.ad ELSE (s.a * 9 + p.ad) / 10 END ELSE s.a END
  FROM ema z JOIN psens p ON p.contract = z.contract AND p.trade_date = z.trade_date AND p.e = z.e + 1,
       LATERAL (SELECT CASE WHEN p.bar_idx >= 4 THEN CASE WHEN z.x10 = 0 THEN CAST(p.ad AS DOUBLE) ELSE (z.x10 * 9 + p.ad) / 10 END ELSE z.x10 END AS a) s
), lastp AS (SELECT * FROM psens QUALIFY row_number() OVER (PARTITION BY contract, trade_date, bar_idx ORDER BY seq DESC) = 1
), diverge AS (
  SELECT b.contract, b.trade_date, b.bar_idx, p.Price AS price, p.cd, e.x5, e.x10,
         [{", ".join(f"lag(b.close, {k}) OVER o" for k in range(9, 0, -1))}] AS c, [{", ".join(f"lag(b.cumDeltaAtBar, {k}) OVER o" for k in range(9, 0, -1))}] AS u
  FROM bars b LEFT JOIN lastp p USING (contract, trade_date, bar_idx) LEFT JOIN ema e ON e.contract = p.contract AND e.trade_date = p.trade_date AND e.e = p.e
  WINDOW o AS (PARTITION BY b.contract, b.trade_date ORDER BY b.bar_idx))"""


def _diverge(n: int, denominator: str, sx: int, x: str) -> str:
    pick = lambda a, last: " + ".join([f"{i} * {a}[{9 - (n - 1) + i + 1}]" for i in range(1, n - 1)] + [f"{n - 1} * {last}"])
    total = lambda a, last: " + ".join([f"{a}[{9 - (n - 1) + i + 1}]" for i in range(n - 1)] + [last])
    slope = lambda a, last: f"(({n} * ({pick(a, last)}) - {sx} * ({total(a, last)})) / {denominator})"
    return f"CASE WHEN bar_idx >= {n - 1} THEN degrees(atan({slope('u', 'cd')} * CASE WHEN {x} > 0 THEN 1 / {x} ELSE 0.001 END)) - degrees(atan({slope('c', 'price')} * (1 / 2.5))) ELSE 0 END"


def _with(extra: str, select: str, *parts: str) -> str:
    head = query("", *parts).rstrip()
    return f"{head},\n{extra}\n{select}"


@registered(_with(_EMA, f"SELECT {sql_shown(KEYS)}, round(coalesce({_diverge(5, '50.0E0', 10, 'x5')}, 0), 4) + 0.0E0 AS priceCumDeltaDivergence5bar, round(coalesce({_diverge(10, '330.0E0', 45, 'x10')}, 0), 4) + 0.0E0 AS priceCumDeltaDivergence10bar, round(coalesce(x10, 0), 4) + 0.0E0 AS avgAbsDelta10 FROM diverge", "bars"))
def divergence(spark, d):
    labelled = _labelled(spark, d)
    out = indicators.divergence(labelled, bars_.bars(labelled))
    return shown(out.select(*BAR, "priceCumDeltaDivergence5bar", "priceCumDeltaDivergence10bar", "avgAbsDelta10"), 4)


_TURN = """psens AS (
  SELECT *, row_number() OVER (PARTITION BY contract, trade_date ORDER BY seq) AS e FROM (
    SELECT l.contract, l.trade_date, l.bar_idx, l.seq, coalesce(z.deltaZscore, 0) * (l.Price - coalesce(v.vwap, f.open)) AS t
    FROM lab l JOIN bars f ON f.contract = l.contract AND f.trade_date = l.trade_date AND f.bar_idx = 0
    LEFT JOIN zs z ON z.contract = l.contract AND z.trade_date = l.trade_date AND z.bar_idx = l.bar_idx - 1
    LEFT JOIN dvwap v ON v.contract = l.contract AND v.trade_date = l.trade_date AND v.bar_idx = l.bar_idx - 1 WHERE l.is_open OR l.is_change)
), ema AS (
  SELECT contract, trade_date, 0::BIGINT AS e, 0.0E0 AS x FROM (SELECT DISTINCT contract, trade_date FROM psens)
  UNION ALL
  SELECT p.contract, p.trade_date, p.e, CASE WHEN z.x = 0 THEN abs(p.t) ELSE (z.x * 19 + abs(p.t)) / 20 END FROM ema z JOIN psens p ON p.contract = z.contract AND p.trade_date = z.trade_date AND p.e = z.e + 1
), lastp AS (SELECT * FROM psens QUALIFY row_number() OVER (PARTITION BY contract, trade_date, bar_idx ORDER BY seq DESC) = 1)"""


@registered(_with(_TURN, f"SELECT {sql_shown('b.contract b.trade_date:d b.bar_idx:i'.replace('b.', ''))}, round(coalesce(t, 0), 4) + 0.0E0 AS interactionReversal, round(coalesce(x, 0), 4) + 0.0E0 AS interactionReversal20barAvg FROM (SELECT b.contract, b.trade_date, b.bar_idx, p.t, e.x FROM bars b LEFT JOIN lastp p USING (contract, trade_date, bar_idx) LEFT JOIN ema e ON e.contract = p.contract AND e.trade_date = p.trade_date AND e.e = p.e)", "zs", "dvwap", "lab"))
def interaction_reversal(spark, d):
    labelled = _labelled(spark, d)
    return shown(indicators.divergence(labelled, bars_.bars(labelled)).select(*BAR, "interactionReversal", "interactionReversal20barAvg"), 4)


# --- profiles ---------------------------------------------------------------------------------------------------------

_PROFILE = KEYS + "poc:n hvn:n vah:n val:n profile_total:i"


@registered(_simple(_PROFILE, "dayp", "dayp"))
def day_profile(spark, d):
    labelled = _labelled(spark, d)
    b = features.with_weeks(bars_.bars(labelled))
    return shown(profile.developing(footprint.levels(labelled), b, DAY))


@registered(_simple(_PROFILE, "weekp", "weekp"))
def week_profile(spark, d):
    labelled = _labelled(spark, d)
    b = features.with_weeks(bars_.bars(labelled))
    return shown(profile.developing(footprint.levels(labelled), b, ["contract", "week_no"]))


# --- sessions, weeks, features ----------------------------------------------------------------------------------------


@registered(_simple(KEYS + "dayHigh:n dayLow:n dayClose:n weekHigh:n weekLow:n", "hilo", "hilo"))
def day_week_high_low(spark, d):
    return shown(indicators.high_low_close(_bars(spark, d)))


@registered(_simple("contract trade_date:d week_no:i cumulativeDelta:i n_bars:i vwap:n poc:n vah:n val:n bbMiddle:n bbUpper:n bbLower:n dayHigh:n dayLow:n dayClose:n vwapUpperStdDev1:n vwapLowerStdDev1:n vwapUpperStdDev2:n vwapLowerStdDev2:n deltaZscore:n cumDelta5barSlope:n rsi:n totalVolume:i", "dsummary", "dsummary", digits=4))
def day_summary(spark, d):
    return shown(features.day_summary(*_closed(spark, d)), 4)


@registered(_simple("contract week_no:i weekHigh:n weekLow:n", "wsummary", "wsummary"))
def week_summary(spark, d):
    b = _bars(spark, d)
    return shown(features.week_summary(b, indicators.high_low_close(b)))


@registered(_simple("contract trade_date:d prev_vwap:n prev_poc:n prev_vah:n prev_val:n prev_dayHigh:n prev_dayLow:n prev_dayClose:n", "prevd", "prevs", digits=4))
def prev_day_levels(spark, d):
    return shown(features.previous(*_closed(spark, d))[0], 4)


@registered(_simple("contract week_no:i prev_weekHigh:n prev_weekLow:n", "prevw", "prevs"))
def prev_week_levels(spark, d):
    b = _bars(spark, d)
    w = Window.partitionBy("contract").orderBy("week_no")
    s = features.week_summary(b, indicators.high_low_close(b))
    return shown(s.select("contract", "week_no", F.lag("weekHigh").over(w).alias("prev_weekHigh"), F.lag("weekLow").over(w).alias("prev_weekLow")))


_DIFF_SQL = ", ".join(f"round(CASE WHEN moved THEN close - {v} ELSE 0 END, 4) + 0.0E0 AS {k}" for k, v in features.DIFFS.items())
_IN = "CASE WHEN moved THEN close > {0} AND close < {1} ELSE false END"
_FEATURES = f"""SELECT {sql_shown(KEYS)}, {_DIFF_SQL}, {_IN.format("val", "vah")} AS isPriceInCurrentDayVA, {_IN.format("prev_val", "prev_vah")} AS isPriceInPrevDayVA,
  CASE WHEN moved THEN close ELSE 0 END + 0.0E0 AS priceIBHighDiff, CASE WHEN moved THEN close ELSE 0 END + 0.0E0 AS priceIBLowDiff, 0.0E0 AS priceLastSwingHighDiff, 0.0E0 AS priceLastSwingLowDiff, 0.0E0 AS priceLastHVNDiff
FROM asofv JOIN prevd USING (contract, trade_date) JOIN prevw USING (contract, week_no)"""


@registered(query(_FEATURES, "asofv", "prevs"))
def price_diffs(spark, d):
    return shown(features.price_diffs(*_closed(spark, d)).drop("week_no"), 4)


@registered(query(f"SELECT {sql_shown(KEYS)}, {_IN.format('val', 'vah')} AS isPriceInCurrentDayVA, {_IN.format('prev_val', 'prev_vah')} AS isPriceInPrevDayVA FROM asofv JOIN prevd USING (contract, trade_date)", "asofv", "prevs"))
def value_area_flags(spark, d):
    return shown(features.price_diffs(*_closed(spark, d)).select(*BAR, "isPriceInCurrentDayVA", "isPriceInPrevDayVA"))


_LEVELS_TEXT = "string_agg(price || ':' || bidVolume || ':' || askVolume || ':' || CAST(isBuyImbalance AS INTEGER) || ':' || CAST(isSellImbalance AS INTEGER) || ':' || volumeAtPrice || ':' || deltaAtPrice, ';' ORDER BY price)"
_FLAT = f"""SELECT {sql_shown(KEYS)}, startTime, endTime, open, high, low, close, barTotalVolume, f.footprint, buyImbalanceCount, sellImbalanceCount, delta, barDeltaChange, barHighDelta, barLowDelta, barPOCPrice, barPOCVol, signal,
  round(v.priceCurrentDayVwapUpperStdDev2Diff, 4) + 0.0E0 AS priceCurrentDayVwapUpperStdDevDiff, round(v.priceWeeklyVwapDiff, 4) + 0.0E0 AS priceWeeklyVwapDiff, round(v.priceCurrDayVAHDiff, 4) + 0.0E0 AS priceCurrDayVAHDiff, v.isPriceInCurrentDayVA,
  CAST(isodow(trade_date) AS VARCHAR) AS dayOfTheWeek, '-1' AS weekOfTheContract
FROM bars JOIN (SELECT contract, trade_date, bar_idx, {_LEVELS_TEXT} AS footprint FROM levels GROUP BY ALL) f USING (contract, trade_date, bar_idx)
JOIN edges USING (contract, trade_date, bar_idx) JOIN poc USING (contract, trade_date, bar_idx)
JOIN (SELECT contract, trade_date, bar_idx, {_DIFF_SQL}, {_IN.format("val", "vah")} AS isPriceInCurrentDayVA FROM asofv JOIN prevd USING (contract, trade_date) JOIN prevw USING (contract, week_no)) v USING (contract, trade_date, bar_idx)"""


@registered(query(_FLAT, "bars", "edges", "poc", "asofv", "prevs"))
def bars_flat(spark, d):
    flag = lambda c: c.cast("int").cast("string")
    text = F.array_join(F.transform("footprint", lambda x: F.concat_ws(":", x["price"], x["bidVolume"], x["askVolume"], flag(x["isBuyImbalance"]), flag(x["isSellImbalance"]), x["volumeAtPrice"], x["deltaAtPrice"])), ";")
    out = features.bars_flat(_ticks(spark, d)).withColumn("footprint", text)
    return shown(out.select(*BAR, "startTime", "endTime", "open", "high", "low", "close", "barTotalVolume", "footprint", "buyImbalanceCount", "sellImbalanceCount", "delta", "barDeltaChange", "barHighDelta", "barLowDelta", "barPOCPrice", "barPOCVol", "signal", "priceCurrentDayVwapUpperStdDevDiff", "priceWeeklyVwapDiff", "priceCurrDayVAHDiff", "isPriceInCurrentDayVA", "dayOfTheWeek", "weekOfTheContract"), 4)


@registered(None)
def bars_training_table(spark, d):
    """The flat table itself, 50 columns with the footprint as an array."""
    return features.bars_flat(_ticks(spark, d), keys=False)


@registered(_simple(KEYS + "open:n high:n low:n close:n barTotalVolume:i vwap:n vwapUpperStdDev1:n vwapLowerStdDev1:n vwapBandWidth:n bbMiddle:n bbUpper:n bbLower:n BBandWidth:n rsi:n", "bars JOIN closedv USING (contract, trade_date, bar_idx)", "closedv", digits=4))
def state_vector(spark, d):
    return shown(features.state_vector(*_closed(spark, d)), 4)


_DAY_DOC = "vwap:n vwapBandWidth:n BBandWidth:n rsi:n poc:n lastHighVolumeNode:n prevAvgGain:n prevAvgLoss:n cumulativePV:n totalVolume:i cumulativeDelta:i"
_DAY_DOC_SQL = f"""SELECT contract AS contractName, CAST(isodow(trade_date) AS VARCHAR) AS dayOfTheWeek, n_bars, {sql_shown(_DAY_DOC, 4)} FROM (
  SELECT s.contract, s.trade_date, s.n_bars, s.vwap, s.rsi, s.poc, s.totalVolume, s.cumulativeDelta, coalesce(l.vwapBandWidth, 0) AS vwapBandWidth, coalesce(l.BBandWidth, 0) AS BBandWidth, coalesce(l.hvn, 0) AS lastHighVolumeNode,
         l.avgGain AS prevAvgGain, l.avgLoss AS prevAvgLoss, coalesce(p.PV, 0) AS cumulativePV
  FROM dsummary s LEFT JOIN dlast l USING (contract, trade_date) LEFT JOIN (SELECT contract, trade_date, max_by(PV, bar_idx) AS PV FROM dsum GROUP BY ALL) p USING (contract, trade_date))"""


def _documents(spark: SparkSession, d: str) -> DataFrame:
    flat, days, weeks = features.documents(_ticks(spark, d))
    return sinks.nested_contracts(flat, days, weeks)


@registered(query(_DAY_DOC_SQL, "dsummary"))
def contract_document_days(spark, d):
    """Scalars of all sessions of the document, written as JSON and read again."""
    docs, path = _documents(spark, d), _folder(spark, "contract-document")
    sinks.write_json(docs, path)
    back = sinks.read_json(spark, path, docs.schema).select("contractName", F.explode("weeks").alias("w")).select("contractName", F.explode("w.days").alias("x"))
    return shown(back.select("contractName", "x.dayOfTheWeek", F.size("x.bars").alias("n_bars"), *[f"x.{w.split(':')[0]}" for w in _DAY_DOC.split()]), 4)


_WEEK_DOC = "totalVolume:i vwap:n poc:n vah:n val:n weekHigh:n weekLow:n"


@registered(query(f"""SELECT contract, week_no, {sql_shown(_WEEK_DOC, 4)} FROM (
  SELECT s.contract, CAST(s.week_no AS BIGINT) AS week_no, s.weekHigh, s.weekLow, coalesce(l.profile_total, 0) AS totalVolume, coalesce(l.weekVwap, f.x, 0) AS vwap, coalesce(l.poc, f.x, 0) AS poc, coalesce(l.vah, f.x, 0) AS vah, coalesce(l.val, f.x, 0) AS val
  FROM wsummary s LEFT JOIN (SELECT b.contract, b.week_no, p.*, v.weekVwap FROM weekp p JOIN bars b USING (contract, trade_date, bar_idx) JOIN wvwap v USING (contract, trade_date, bar_idx)
    QUALIFY row_number() OVER (PARTITION BY b.contract, b.week_no ORDER BY b.trade_date DESC, b.bar_idx DESC) = 1) l ON l.contract = s.contract AND l.week_no = s.week_no
  LEFT JOIN (SELECT contract, week_no, o AS x FROM wopen WHERE week_no = 1) f ON f.contract = s.contract AND f.week_no = s.week_no)""", "wsummary", "weekp", "wvwap"))
def week_scalars(spark, d):
    return shown(features.week_scalars(*_closed(spark, d)).select("contract", "week_no", *[w.split(":")[0] for w in _WEEK_DOC.split()]), 4).withColumn("totalVolume", F.col("totalVolume").cast("long"))


# --- documents, files, tables -----------------------------------------------------------------------------------------


def _small_documents(spark: SparkSession, d: str) -> DataFrame:
    labelled = _labelled(spark, d)
    b = features.with_weeks(bars_.bars(labelled))
    cols = b.join(footprint.nested(footprint.levels(labelled)), BAR)
    flat = cols.select(*BAR, "week_no", "startTime", "endTime", "open", "high", "low", "close", "barTotalVolume", "footprint", "delta", (F.weekday("trade_date") + 1).cast("string").alias("dayOfTheWeek"), F.col("week_no").cast("string").alias("weekOfTheContract"))
    return flat


@registered(query("SELECT contract AS contractName, count(DISTINCT week_no) AS n_weeks, count(DISTINCT trade_date) AS n_days, count(*) AS n_bars, CAST(sum(n) AS BIGINT) AS n_levels, CAST(sum(barTotalVolume) AS BIGINT) AS volume FROM bars JOIN (SELECT contract, trade_date, bar_idx, count(*) AS n FROM levels GROUP BY ALL) USING (contract, trade_date, bar_idx) GROUP BY contract", "bars", "levels"))
def contract_nested(spark, d):
    total = lambda a, f: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + f(x))
    days = lambda f: total("weeks", lambda w: total(w["days"], f))
    return shown(sinks.nested_contracts(_small_documents(spark, d)).select("contractName", F.size("weeks").alias("n_weeks"), days(lambda x: F.lit(1)).alias("n_days"), days(lambda x: F.size(x["bars"])).alias("n_bars"), days(lambda x: total(x["bars"], lambda b: F.size(b["footprint"]))).alias("n_levels"), days(lambda x: total(x["bars"], lambda b: b["barTotalVolume"])).alias("volume")))


@registered(query("SELECT contract AS contractName, CAST(week_no AS VARCHAR) AS weekOfTheContract, CAST(isodow(trade_date) AS VARCHAR) AS dayOfTheWeek, startTime, endTime, open, high, low, close, barTotalVolume, delta, n AS n_levels FROM bars JOIN (SELECT contract, trade_date, bar_idx, count(*) AS n FROM levels GROUP BY ALL) USING (contract, trade_date, bar_idx)", "bars", "levels"))
def contract_json_roundtrip(spark, d):
    docs, path = sinks.nested_contracts(_small_documents(spark, d)), _folder(spark, "contract-json")
    sinks.write_json(docs, path)
    back = sinks.flatten(sinks.read_json(spark, path, docs.schema))
    return shown(back.select("contractName", "weekOfTheContract", "dayOfTheWeek", "startTime", "endTime", "open", "high", "low", "close", "barTotalVolume", "delta", F.size("footprint").alias("n_levels")))


@registered(query("SELECT contract AS contractName, CAST(week_no AS VARCHAR) AS weekOfTheContract, CAST(isodow(trade_date) AS VARCHAR) AS dayOfTheWeek, startTime, endTime, open, high, low, close, barTotalVolume FROM bars", "bars"))
def nested_parquet_roundtrip(spark, d):
    path = _folder(spark, "contract-parquet")
    sinks.write_nested_parquet(_small_documents(spark, d), path)
    return shown(sinks.flatten(spark.read.parquet(path)).select("contractName", "weekOfTheContract", "dayOfTheWeek", "startTime", "endTime", "open", "high", "low", "close", "barTotalVolume"))


@registered(_simple("contract id:i DateTime:t Price:n", "ticks", "ticks").replace("SELECT contract", "SELECT strftime(DateTime, '%Y') AS year, strftime(DateTime, '%m') AS month, strftime(DateTime, '%d') AS day, contract"))
def partitioned_roundtrip(spark, d):
    path = _folder(spark, "ticks-by-day")
    sinks.write_days(_ticks(spark, d), path)
    return shown(sinks.read_days(spark, path).select("year", "month", "day", "contract", "id", "DateTime", "Price"))


@registered(_simple("contract id:i Price:n AskVolume:i BidVolume:i", "ticks", "ticks"))
def contracts_roundtrip(spark, d):
    path = _folder(spark, "ticks-by-contract")
    sinks.write_contracts(_ticks(spark, d), path)
    return shown(spark.read.parquet(path).select("contract", "id", "Price", "AskVolume", "BidVolume"))


@registered(_simple("contract id:i Price:n AskVolume:i BidVolume:i", "ticks", "ticks"))
def sqlite_roundtrip(spark, d):
    path = _folder(spark, "ticks").removeprefix("file://") + ".db"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    sqlite.register(spark)
    _ticks(spark, d).select("id", "Price", "AskVolume", "BidVolume").coalesce(2).write.format("sqlite").option("path", path).option("table", "ESH4_TICK").mode("overwrite").save()
    return shown(spark.read.format("sqlite").option("path", path).option("rows", 2000).load().where(clean.is_contract_table()).select("contract", "id", "Price", "AskVolume", "BidVolume"))


@registered(_simple("contract id:i Price:n AskVolume:i BidVolume:i", "(SELECT 'early' AS contract, id, Price, AskVolume, BidVolume FROM ticks WHERE id % 2 = 0 UNION ALL SELECT 'late', id, Price, AskVolume, BidVolume FROM ticks WHERE id % 2 = 1)", "ticks"))
def parquet_folder_to_sqlite(spark, d):
    """A table for each file of a folder, written twice: the second writing replaces the first."""
    base = _folder(spark, "folder").removeprefix("file://")
    t = _ticks(spark, d).select("id", "Price", "AskVolume", "BidVolume")
    for name, odd in (("late", 1), ("early", 0)):
        t.where(F.col("id") % 2 == odd).write.parquet(f"{base}/in/{name}.parquet")
    for _ in range(2):
        if sqlite.write_folder(spark, f"{base}/in", f"{base}/all.db") != ["early", "late"]:
            raise ValueError("files are not in the order of their paths")
    back = spark.read.format("sqlite").option("path", f"{base}/all.db").load()
    return shown(back.select("contract", "id", "Price", "AskVolume", "BidVolume"))


@registered(_simple("contract id:i Price:n", "ticks", "ticks"))
def sqlite_append(spark, d):
    """The first chunk replaces a table, the others are appended."""
    path = _folder(spark, "append").removeprefix("file://") + ".db"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    sqlite.register(spark)
    t = _ticks(spark, d).select("id", "Price")
    for k, mode in enumerate(("overwrite", "overwrite", "append", "append")):
        t.where(F.col("id") % 3 == max(0, k - 1)).write.format("sqlite").option("path", path).option("table", "ESH4_TICK").mode(mode).save()
    return shown(spark.read.format("sqlite").option("path", path).load().select("contract", "id", "Price"))


@registered(query("SELECT file_stem, CAST(count(*) AS BIGINT) AS n, CAST(min(id) AS BIGINT) AS first_id FROM (SELECT CASE WHEN id % 2 = 0 THEN 'even' ELSE 'odd' END AS file_stem, id FROM ticks) GROUP BY 1", "ticks"))
def folder_scan(spark, d):
    """All files of a folder in the order of paths, with the stem of the file of each row."""
    path = _folder(spark, "scan")
    t = _ticks(spark, d).select("id")
    for name, odd in (("odd", 1), ("even", 0)):
        t.where(F.col("id") % 2 == odd).write.parquet(f"{path}/{name}.parquet")
    parts = [spark.read.parquet(*files).withColumn("file_stem", F.lit(stem)) for stem, files in ticks_.files_by_stem(spark, path).items()]
    return shown(parts[0].unionByName(parts[1]).groupBy("file_stem").agg(F.count("*").alias("n"), F.min("id").alias("first_id")))


@registered(_simple(KEYS + "startTime endTime open:n high:n low:n close:n barTotalVolume:i n_levels:i", "bars JOIN (SELECT contract, trade_date, bar_idx, count(*) AS n_levels FROM levels GROUP BY ALL) USING (contract, trade_date, bar_idx)", "bars", "levels"))
def flat_parquet_roundtrip(spark, d):
    """The flat bar table with its 50 columns written as Parquet and read again."""
    path = _folder(spark, "bars-flat")
    flat = features.bars_flat(_ticks(spark, d))
    sinks.write_flat(flat, path)
    back = spark.read.parquet(path)
    if [c for c in back.columns if c not in BAR] != features.FLAT:
        raise ValueError("columns of the flat table have changed")
    return shown(back.select(*BAR, "startTime", "endTime", "open", "high", "low", "close", "barTotalVolume", F.size("footprint").alias("n_levels")))


@registered(query("SELECT contract, round(min_by(Price, struct_pack(a := DateTime, b := id)), 6) + 0.0E0 AS seed, strftime(min(trade_date), '%Y-%m-%d') AS start FROM ticks GROUP BY 1", "ticks"))
def contract_start(spark, d):
    return shown(features.contract_start(_ticks(spark, d)))


@registered(query("SELECT contract AS contractName, CAST(count(DISTINCT week_no) AS BIGINT) AS n_weeks, CAST(count(*) AS BIGINT) AS n_bars, CAST(count_if(delta > 0) AS BIGINT) AS n_rising FROM bars GROUP BY 1", "bars"))
def contract_hooks(spark, d):
    """Hooks of bars and contracts: bars get a column, contracts a summary of it."""
    from ..functions.hooks import Hooks

    bar = lambda b: F.aggregate("weeks", F.lit(0).cast("long"), lambda s, w: s + F.aggregate(w["days"], F.lit(0).cast("long"), lambda t, x: t + b(x["bars"])))
    hooks = Hooks(bars=lambda b: b.withColumn("rising", F.col("delta") > 0), contracts=lambda c: c.select(
        "contractName", F.size("weeks").alias("n_weeks"), bar(F.size).alias("n_bars"), bar(lambda b: F.size(F.filter(b, lambda x: x["rising"]))).alias("n_rising")))
    t = _ticks(spark, d)
    return shown(features.contract_documents(t, hooks=hooks))


# --- episodes, streams, samples ---------------------------------------------------------------------------------------


@registered(f"""WITH RECURSIVE {_ORDER_CLOSES}, acts AS (SELECT *, (CAST(step % 5 AS DOUBLE) - 2) / 512 AS a, lead(Close) OVER (PARTITION BY series ORDER BY step) AS nxt, max(step) OVER (PARTITION BY series) AS top FROM closes
), run AS (
  SELECT series, -1::BIGINT AS step, 10000.0E0 AS balance, 0.0E0 AS shares FROM (SELECT DISTINCT series FROM acts)
  UNION ALL
  SELECT c.series, c.step, CASE WHEN c.a > 0 THEN r.balance - r.balance * c.a WHEN c.a < 0 THEN r.balance + r.shares * -c.a * c.Close ELSE r.balance END, CASE WHEN c.a > 0 THEN r.shares + r.balance * c.a / c.Close WHEN c.a < 0 THEN r.shares - r.shares * -c.a ELSE r.shares END
  FROM run r JOIN acts c ON c.series = r.series AND c.step = r.step + 1 WHERE c.nxt IS NOT NULL)
SELECT CAST(series AS BIGINT) AS series, CAST(step AS BIGINT) AS step, round(balance, 4) + 0.0E0 AS balance, round(shares, 4) + 0.0E0 AS shares, round(balance + shares * Close, 4) + 0.0E0 AS net_worth, round(balance + shares * Close - 10000, 4) + 0.0E0 AS reward, step >= top - 1 AS done, round(nxt, 4) + 0.0E0 AS next_close
FROM run JOIN acts USING (series, step)""")
def rl_portfolio_fold(spark, d):
    steps = ticks_.order_closes(spark, d).withColumn("action", ((F.col("step") % 5).cast("double") - 2) / 512)
    return shown(portfolio.fold(steps), 4)


@registered(_simple("contract trade_date:d id:i bar_idx:i is_open is_change", "lab", "lab"))
def streaming_range_bars(spark, d):
    from ..streaming.range_bars import label_stream

    base = _folder(spark, "stream")
    t = _ticks(spark, d)
    t.repartition(1).sortWithinPartitions("id").write.parquet(f"{base}/in")
    flow = label_stream(spark.readStream.schema(t.schema).parquet(f"{base}/in"))
    flow.writeStream.format("parquet").option("checkpointLocation", f"{base}/state").option("path", f"{base}/out").trigger(availableNow=True).start().awaitTermination()
    return shown(spark.read.schema(flow.schema).parquet(f"{base}/out").select("contract", "trade_date", "id", "bar_idx", "is_open", "is_change"))


@registered("SELECT CAST(i // 10000 AS BIGINT) AS file, count(*) AS n, CAST(min(i) AS BIGINT) AS first_id, CAST(max(i) AS BIGINT) AS last_id, true AS in_range, true AS known FROM range(20000) t(i) GROUP BY 1")
def sample_data(spark, d):
    s = ticks_.sample_data(spark)
    return shown(s.groupBy("file").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.min((F.col("value") >= 0) & (F.col("value") < 1)).alias("in_range"), F.min(F.col("category").isin("A", "B", "C")).alias("known")))


@registered("SELECT 'events' AS name, 'ts' AS first_timestamp UNION ALL SELECT 'orders', 'o_orderdate' UNION ALL SELECT 'nation', NULL")
def first_timestamp_columns(spark, d):
    rows = [(n, ticks_.first_timestamp_column(ticks_.table(spark, d, n))) for n in ("events", "orders", "nation")]
    return spark.createDataFrame(rows, "name string, first_timestamp string")


def queries() -> dict:
    return {name: f for name, (f, _) in _found.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _found.items() if sql}
