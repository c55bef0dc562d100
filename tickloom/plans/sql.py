"""DuckDB counterparts as common table expressions over the driver's tables, put together by name."""

from __future__ import annotations

TICKS = """ticks AS (
  SELECT 'ESH4_TICK' AS contract, event_id AS id, ts AS DateTime, CAST(ts AS DATE) AS trade_date,
         4000 + 0.25E0 * CAST(sum(CAST(floor(value) AS BIGINT) % 7 - 3) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS DOUBLE) AS Price,
         CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(floor(value) AS BIGINT) % 50 ELSE 0 END AS AskVolume,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 0 ELSE CAST(floor(value) AS BIGINT) % 50 END AS BidVolume
  FROM events)"""

RAW = """raw AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'ESH4_TICK' WHEN 1 THEN 'ESM4_TICK' ELSE 'ESU4_TICK' END AS contract, event_id AS id, strftime(ts, '%Y/%m/%d') AS Date,
         CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE strftime(ts, '%H:%M:%S') END AS Time, 4000 + 0.25E0 * CAST(CAST(floor(value) AS BIGINT) % 40 AS DOUBLE) AS Close,
         CAST(floor(value) AS BIGINT) % 50 + 1 AS Volume,
         CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(floor(value) AS BIGINT) % 50 ELSE 0 END AS AskVolume,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 0 ELSE CAST(floor(value) AS BIGINT) % 50 END AS BidVolume
  FROM events)"""

PARTS = {
    "ticks": ([], TICKS),
    "raw": ([], RAW),
    "volumes": (["raw"], "volumes AS (SELECT contract, Date, CAST(sum(Volume) AS BIGINT) AS daily_volume FROM raw GROUP BY ALL)"),
    "rolls": (["volumes"], "rolls AS (SELECT Date, contract, daily_volume FROM volumes QUALIFY row_number() OVER (PARTITION BY Date ORDER BY daily_volume DESC, contract) = 1)"),
    "numbered": (["ticks"], "numbered AS (SELECT *, row_number() OVER (PARTITION BY contract, trade_date ORDER BY id) AS seq FROM ticks)"),
    "walk": (["numbered"], """walk AS (
  SELECT contract, trade_date, seq, Price AS hi, Price AS lo, 0 AS bar_idx, false AS is_open FROM numbered WHERE seq = 1
  UNION ALL
  SELECT t.contract, t.trade_date, t.seq,
         CASE WHEN w.hi - t.Price <= 2.5 AND t.Price - w.lo <= 2.5 THEN greatest(w.hi, t.Price) ELSE t.Price END,
         CASE WHEN w.hi - t.Price <= 2.5 AND t.Price - w.lo <= 2.5 THEN least(w.lo, t.Price) ELSE t.Price END,
         CASE WHEN w.hi - t.Price <= 2.5 AND t.Price - w.lo <= 2.5 THEN w.bar_idx ELSE w.bar_idx + 1 END,
         NOT (w.hi - t.Price <= 2.5 AND t.Price - w.lo <= 2.5)
  FROM walk w JOIN numbered t ON t.contract = w.contract AND t.trade_date = w.trade_date AND t.seq = w.seq + 1)"""),
    "lab": (["walk"], """lab AS (
  SELECT n.*, w.bar_idx, w.is_open, (NOT w.is_open) AND n.seq > 1 AND n.Price <> lag(n.Price) OVER (PARTITION BY n.contract, n.trade_date ORDER BY n.seq) AS is_change
  FROM numbered n JOIN walk w USING (contract, trade_date, seq))"""),
    "grouped": (["lab"], """grouped AS (
  SELECT contract, trade_date, bar_idx, arg_min(Price, seq) AS open, max(Price) AS high, min(Price) AS low, arg_max(Price, seq) AS close,
         CAST(sum(AskVolume + BidVolume) + sum(CASE WHEN is_open THEN AskVolume + BidVolume ELSE 0 END) AS BIGINT) AS barTotalVolume,
         CAST(sum(AskVolume - BidVolume) AS BIGINT) AS delta, count(*) AS n_ticks, sum(CASE WHEN is_open THEN 0 ELSE 1 END) AS n_in, bool_or(is_change) AS changed,
         strftime(arg_min(DateTime, seq), '%Y-%m-%d %H:%M:%S.%f') AS first_time, strftime(arg_max(DateTime, seq) FILTER (WHERE is_change), '%Y-%m-%d %H:%M:%S.%f') AS last_change
  FROM lab GROUP BY ALL)"""),
    "bars": (["grouped"], """bars AS (
  SELECT contract, trade_date, bar_idx, CASE WHEN bar_idx = 0 THEN '-1' ELSE first_time END AS startTime,
         coalesce(lead(first_time) OVER d, last_change, '-1') AS endTime, open, high, low, close, barTotalVolume, delta,
         coalesce(delta - lag(delta) OVER d, 0) AS barDeltaChange, CAST(sum(delta) OVER (d ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumDeltaAtBar, n_ticks,
         CAST(CASE WHEN n_in > 0 THEN 1 ELSE 0 END AS BIGINT) AS signal, lead(bar_idx) OVER d IS NOT NULL AS closed, lead(open) OVER d AS next_open, (bar_idx > 0 OR changed) AS moved,
         CAST(floor(date_diff('day', date_trunc('week', min(trade_date) OVER (PARTITION BY contract)), trade_date) / 7) + 1 AS INTEGER) AS week_no
  FROM grouped WINDOW d AS (PARTITION BY contract, trade_date ORDER BY bar_idx))"""),
    "touch": (["lab"], """touch AS (
  SELECT contract, trade_date, bar_idx, seq, is_open, AskVolume AS a, BidVolume AS b, CAST(round(Price / 0.25) AS BIGINT) AS p,
         min(CAST(round(Price / 0.25) AS BIGINT)) OVER w AS lo, max(CAST(round(Price / 0.25) AS BIGINT)) OVER w AS hi
  FROM lab WINDOW w AS (PARTITION BY contract, trade_date, bar_idx ORDER BY seq ROWS UNBOUNDED PRECEDING))"""),
    "traded": (["touch"], """traded AS (
  SELECT contract, trade_date, bar_idx, p, sum(a + CASE WHEN is_open THEN b ELSE 0 END) AS bid, sum(b + CASE WHEN is_open THEN a ELSE 0 END) AS ask, sum(a + b) AS vol, sum(b - a) AS d,
         arg_max(p > lo, seq) AS above, arg_max(p < hi, seq) AS below FROM touch GROUP BY ALL)"""),
    "everylevel": (["traded"], """everylevel AS (
  SELECT *, true AS real FROM traded
  UNION ALL
  SELECT x.contract, x.trade_date, x.bar_idx, x.p, 0, 0, 0, 0, false, false, false
  FROM (SELECT DISTINCT contract, trade_date, bar_idx, p + 1 AS p FROM touch WHERE p < hi UNION SELECT DISTINCT contract, trade_date, bar_idx, p - 1 FROM touch WHERE p > lo) x
  LEFT JOIN traded t USING (contract, trade_date, bar_idx, p) WHERE t.p IS NULL)"""),
    "levels": (["everylevel"], """levels AS (
  SELECT e.contract, e.trade_date, e.bar_idx, e.p, e.p * 0.25E0 AS price, CAST(e.bid AS BIGINT) AS bidVolume, CAST(e.ask AS BIGINT) AS askVolume,
         coalesce(e.real AND CASE WHEN l.p IS NOT NULL THEN (l.bid = 0 AND e.ask > 0) OR (l.bid > 0 AND e.ask / CAST(nullif(l.bid, 0) AS DOUBLE) >= 3.0) ELSE e.above AND e.ask > 0 END, false) AS isBuyImbalance,
         coalesce(e.real AND CASE WHEN u.p IS NOT NULL THEN (u.ask = 0 AND e.bid > 0) OR (u.ask > 0 AND e.bid / CAST(nullif(u.ask, 0) AS DOUBLE) >= 3.0) ELSE e.below AND e.bid > 0 END, false) AS isSellImbalance,
         CAST(e.vol AS BIGINT) AS volumeAtPrice, CAST(e.d AS BIGINT) AS deltaAtPrice, NOT e.real AS is_phantom
  FROM everylevel e
  LEFT JOIN traded l ON l.contract = e.contract AND l.trade_date = e.trade_date AND l.bar_idx = e.bar_idx AND l.p = e.p - 1
  LEFT JOIN traded u ON u.contract = e.contract AND u.trade_date = e.trade_date AND u.bar_idx = e.bar_idx AND u.p = e.p + 1)"""),
    "poc": (["lab"], """poc AS (
  SELECT contract, trade_date, bar_idx, CASE WHEN v > 0 THEN Price ELSE 0.0E0 END AS barPOCPrice, CAST(v AS BIGINT) AS barPOCVol
  FROM (SELECT *, sum(AskVolume + BidVolume) OVER (PARTITION BY contract, trade_date, bar_idx, Price ORDER BY seq ROWS UNBOUNDED PRECEDING) AS v FROM lab)
  QUALIFY row_number() OVER (PARTITION BY contract, trade_date, bar_idx ORDER BY v DESC, seq) = 1)"""),
    "edges": (["levels"], """edges AS (
  SELECT contract, trade_date, bar_idx, count(*) FILTER (WHERE isBuyImbalance) AS buyImbalanceCount, count(*) FILTER (WHERE isSellImbalance) AS sellImbalanceCount,
         CAST(sum(CASE WHEN t <= 2 THEN deltaAtPrice ELSE 0 END) AS BIGINT) AS barHighDelta, CAST(sum(CASE WHEN l <= 2 THEN deltaAtPrice ELSE 0 END) AS BIGINT) AS barLowDelta
  FROM (SELECT *, row_number() OVER (PARTITION BY contract, trade_date, bar_idx ORDER BY price DESC) AS t, row_number() OVER (PARTITION BY contract, trade_date, bar_idx ORDER BY price) AS l FROM levels)
  GROUP BY ALL)"""),
    "dvwap": (["bars"], """dsum AS (
  SELECT *, sum(barTotalVolume) OVER d AS V, sum((high + low + close) / 3 * CAST(barTotalVolume AS DOUBLE)) OVER d AS PV,
         sum(CAST(barTotalVolume AS DOUBLE) * ((high + low + close) / 3) * ((high + low + close) / 3)) OVER d AS SPV, first_value(open) OVER d AS seed
  FROM bars WHERE closed WINDOW d AS (PARTITION BY contract, trade_date ORDER BY bar_idx ROWS UNBOUNDED PRECEDING)
), dvwap AS (
  SELECT contract, trade_date, bar_idx, m AS vwap, coalesce(m + s, 0) AS vwapUpperStdDev1, coalesce(m - s, 0) AS vwapLowerStdDev1, coalesce(m + 2 * s, 0) AS vwapUpperStdDev2, coalesce(m - 2 * s, 0) AS vwapLowerStdDev2,
         coalesce(m + s, 0) - coalesce(m - s, 0) AS vwapBandWidth, CAST(V AS BIGINT) AS totalVolume
  FROM (SELECT *, CASE WHEN V > 0 THEN CASE WHEN SPV / V - m * m > 0 THEN sqrt(SPV / V - m * m) ELSE 0 END END AS s FROM (SELECT *, CASE WHEN V > 0 THEN PV / V ELSE seed END AS m FROM dsum)))"""),
    "wvwap": (["bars"], """wsum AS (
  SELECT *, sum(CAST(barTotalVolume AS DOUBLE)) OVER w AS held, sum(CASE WHEN closed THEN barTotalVolume * close ELSE 0 END) OVER w AS PV, sum(CASE WHEN closed THEN barTotalVolume * close * close ELSE 0 END) OVER w AS SPV
  FROM bars WINDOW w AS (PARTITION BY contract, week_no ORDER BY trade_date, bar_idx ROWS UNBOUNDED PRECEDING)
), wtot AS (
  SELECT *, coalesce(lag(held) OVER (PARTITION BY contract, week_no ORDER BY trade_date, bar_idx), 0) + barTotalVolume AS V FROM wsum WHERE closed
), wstep AS (
  SELECT *, CASE WHEN barTotalVolume > 0 THEN PV / V END AS m, CASE WHEN barTotalVolume > 0 THEN SPV / V - (PV / V) * (PV / V) END AS x FROM wtot
), wkeep AS (
  SELECT contract, trade_date, bar_idx, coalesce(last_value(m IGNORE NULLS) OVER w, 0) AS weekVwap,
         coalesce(last_value(CASE WHEN x > 1e-9 THEN sqrt(x) WHEN x IS NOT NULL THEN 0 END IGNORE NULLS) OVER w, 0) AS s
  FROM wstep WINDOW w AS (PARTITION BY contract, week_no ORDER BY trade_date, bar_idx ROWS UNBOUNDED PRECEDING)
), wvwap AS (
  SELECT contract, trade_date, bar_idx, weekVwap, weekVwap + s AS weekVwapUpperStdDev1, weekVwap - s AS weekVwapLowerStdDev1, (weekVwap + s) - (weekVwap - s) AS weekVwapBandWidth FROM wkeep)"""),
    "zs": (["bars"], """zs AS (
  SELECT contract, trade_date, bar_idx, CASE WHEN bar_idx = 0 THEN d WHEN q / n - (s / n) * (s / n) > 0 THEN (d - s / n) / sqrt(q / n - (s / n) * (s / n)) ELSE 0 END AS deltaZscore
  FROM (SELECT contract, trade_date, bar_idx, CAST(delta AS DOUBLE) AS d, sum(CAST(delta AS DOUBLE)) OVER w AS s, sum(CAST(delta AS DOUBLE) * CAST(delta AS DOUBLE)) OVER w AS q, count(*) OVER w AS n
        FROM bars WHERE closed WINDOW w AS (PARTITION BY contract, trade_date ORDER BY bar_idx ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)))"""),
    "slope": (["bars"], """slope AS (
  SELECT contract, trade_date, bar_idx, coalesce((2 * cumDeltaAtBar + lag(cumDeltaAtBar, 1) OVER w - lag(cumDeltaAtBar, 3) OVER w - 2 * lag(cumDeltaAtBar, 4) OVER w) / 10.0E0, 0) AS cumDelta5barSlope
  FROM bars WHERE closed WINDOW w AS (PARTITION BY contract, trade_date ORDER BY bar_idx))"""),
    "rec": (["bars"], """cl AS (
  SELECT contract, trade_date, bar_idx, bar_idx + 1 AS k, close, avg(close) OVER w AS mid0, var_pop(close) OVER w AS var0,
         CASE WHEN lag(close) OVER o IS NOT NULL THEN greatest(close - lag(close) OVER o, 0) END AS up, CASE WHEN lag(close) OVER o IS NOT NULL THEN greatest(lag(close) OVER o - close, 0) END AS down
  FROM bars WHERE closed WINDOW o AS (PARTITION BY contract, trade_date ORDER BY bar_idx), w AS (PARTITION BY contract, trade_date ORDER BY bar_idx ROWS UNBOUNDED PRECEDING)
), cl2 AS (
  SELECT *, avg(up) OVER w AS g0, avg(down) OVER w AS l0 FROM cl WINDOW w AS (PARTITION BY contract, trade_date ORDER BY bar_idx ROWS UNBOUNDED PRECEDING)
), rec0 AS (
  SELECT contract, trade_date, k, close AS mid, 0.0E0 AS var, CAST(NULL AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS l FROM cl2 WHERE k = 1
  UNION ALL
  SELECT c.contract, c.trade_date, c.k, CASE WHEN c.k <= 21 THEN c.mid0 ELSE r.mid + (c.close - r.mid) / 21 END,
         CASE WHEN c.k <= 21 THEN c.var0 ELSE (20.0E0 / 21) * r.var + (c.close - (r.mid + (c.close - r.mid) / 21)) * (c.close - (r.mid + (c.close - r.mid) / 21)) / 21 END,
         CASE WHEN c.k <= 14 THEN c.g0 ELSE (13 * r.g + c.up) / 14 END, CASE WHEN c.k <= 14 THEN c.l0 ELSE (13 * r.l + c.down) / 14 END
  FROM rec0 r JOIN cl2 c ON c.contract = r.contract AND c.trade_date = r.trade_date AND c.k = r.k + 1
), rec AS (
  SELECT contract, trade_date, CAST(k - 1 AS INTEGER) AS bar_idx, mid AS bbMiddle, var AS variance, mid + 2.4E0 * sqrt(greatest(var, 0)) AS bbUpper, mid - 2.4E0 * sqrt(greatest(var, 0)) AS bbLower, 2 * (2.4E0 * sqrt(greatest(var, 0))) AS BBandWidth,
         CASE WHEN k < 2 THEN NULL WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END AS rsi, g AS avgGain, l AS avgLoss FROM rec0)"""),
    "hilo": (["bars"], """dhl AS (
  SELECT *, max(high) OVER d AS dayHigh, min(low) OVER d AS dayLow, first_value(open) OVER d AS o FROM bars WINDOW d AS (PARTITION BY contract, trade_date ORDER BY bar_idx ROWS UNBOUNDED PRECEDING)
), hilo AS (
  SELECT contract, trade_date, bar_idx, dayHigh, dayLow, dayClose, greatest(h, CASE WHEN week_no = 1 THEN f ELSE 0 END) AS weekHigh, least(l, f) AS weekLow
  FROM (SELECT *, next_open AS dayClose, max(dayHigh) FILTER (WHERE closed) OVER w AS h, min(dayLow) FILTER (WHERE closed) OVER w AS l, first_value(o) OVER w AS f
        FROM dhl WINDOW w AS (PARTITION BY contract, week_no ORDER BY trade_date, bar_idx ROWS UNBOUNDED PRECEDING)) WHERE closed)"""),
}


def profile(name: str, scope: str) -> tuple[list[str], str]:
    """CTE ``name``: poc, hvn, vah, val and total at every bar close, of the profile that ``scope`` names."""
    n = name
    return ["levels", "bars"], f"""{n}_ord AS (
  SELECT contract, {scope} AS scope, trade_date, bar_idx, closed, row_number() OVER (PARTITION BY contract, {scope} ORDER BY trade_date, bar_idx) AS ord FROM bars
), {n}_put AS (
  SELECT o.contract, o.scope, o.ord, l.p, l.bidVolume + l.askVolume AS v FROM levels l JOIN {n}_ord o USING (contract, trade_date, bar_idx)
), {n}_grid AS (
  SELECT o.contract, o.scope, o.ord, o.closed, f.p, coalesce(u.v, 0) AS v
  FROM (SELECT contract, scope, p, min(ord) AS first FROM {n}_put GROUP BY ALL) f
  JOIN {n}_ord o ON o.contract = f.contract AND o.scope = f.scope AND o.ord >= f.first
  LEFT JOIN {n}_put u ON u.contract = o.contract AND u.scope = o.scope AND u.ord = o.ord AND u.p = f.p
), {n}_cum AS (
  SELECT contract, scope, ord, closed, p, CAST(sum(v) OVER (PARTITION BY contract, scope, p ORDER BY ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS v FROM {n}_grid
), {n}_pos AS (
  SELECT *, row_number() OVER (PARTITION BY contract, scope, ord ORDER BY p) AS i, row_number() OVER (PARTITION BY contract, scope, ord ORDER BY v DESC, p) AS r,
         count(*) OVER (PARTITION BY contract, scope, ord) AS n, sum(v) OVER (PARTITION BY contract, scope, ord) AS total FROM {n}_cum WHERE closed
), {n}_va AS (
  SELECT contract, scope, ord, CASE WHEN v > 0 THEN i ELSE 1 END AS a, CASE WHEN v > 0 THEN i ELSE 1 END AS b, v AS cum, CAST(trunc(CAST(total AS DOUBLE) * 0.7E0) AS BIGINT) AS target, false AS stop FROM {n}_pos WHERE r = 1
  UNION ALL
  SELECT s.contract, s.scope, s.ord, CASE WHEN s.up > s.down THEN s.a ELSE s.a - 1 END, CASE WHEN s.up > s.down THEN s.b + 1 ELSE s.b END, s.cum + CASE WHEN s.up > s.down THEN s.up ELSE s.down END, s.target, false
  FROM (SELECT w.*, coalesce(u.v, 0) AS up, coalesce(d.v, 0) AS down FROM {n}_va w
        LEFT JOIN {n}_pos u ON u.contract = w.contract AND u.scope = w.scope AND u.ord = w.ord AND u.i = w.b + 1
        LEFT JOIN {n}_pos d ON d.contract = w.contract AND d.scope = w.scope AND d.ord = w.ord AND d.i = w.a - 1) s
  WHERE s.cum < s.target AND NOT (s.up = 0 AND s.down = 0)
), {n}_end AS (SELECT contract, scope, ord, min(a) AS a, max(b) AS b FROM {n}_va GROUP BY ALL
), {name} AS (
  SELECT o.contract, o.trade_date, o.bar_idx,
         coalesce(max(CASE WHEN x.r = 1 AND x.v > 0 THEN x.p * 0.25E0 END), 0) AS poc, coalesce(max(CASE WHEN x.r = 2 AND x.v > 0 THEN x.p * 0.25E0 END), 0) AS hvn,
         max(CASE WHEN x.i = e.b THEN x.p * 0.25E0 END) AS vah, max(CASE WHEN x.i = e.a THEN x.p * 0.25E0 END) AS val, CAST(max(x.total) AS BIGINT) AS profile_total
  FROM {n}_ord o JOIN {n}_pos x USING (contract, scope, ord) JOIN {n}_end e USING (contract, scope, ord) GROUP BY ALL)"""


PARTS["dayp"] = profile("dayp", "trade_date")
PARTS["weekp"] = profile("weekp", "week_no")

_DAY = ["vwap", "poc", "vah", "val", "bbMiddle", "bbUpper", "bbLower", "dayHigh", "dayLow", "dayClose"]
_BAND = ["vwapUpperStdDev1", "vwapLowerStdDev1", "vwapUpperStdDev2", "vwapLowerStdDev2"]
_WEEK = ["weekVwap", "weekVwapUpperStdDev1", "weekVwapLowerStdDev1", "weekHigh", "weekLow"]

PARTS["closedv"] = (
    ["dvwap", "wvwap", "rec", "dayp", "zs", "slope", "hilo"],
    """closedv AS (
  SELECT * FROM dvwap JOIN wvwap USING (contract, trade_date, bar_idx) JOIN rec USING (contract, trade_date, bar_idx) JOIN dayp USING (contract, trade_date, bar_idx)
  JOIN zs USING (contract, trade_date, bar_idx) JOIN slope USING (contract, trade_date, bar_idx) JOIN hilo USING (contract, trade_date, bar_idx))""",
)


def _week_seed(c: str) -> str:
    opening = "first_value(b.open) OVER wk"
    return opening if c == "weekLow" else "0" if c.endswith("StdDev1") else f"CASE WHEN b.week_no = 1 THEN {opening} ELSE 0 END"


PARTS["asofv"] = (
    ["closedv"],
    f"""asofv AS (
  SELECT b.contract, b.trade_date, b.bar_idx, b.week_no, b.close, b.moved,
         {", ".join(f"coalesce(lag(c.{c}) OVER dy, first_value(b.open) OVER dy) AS {c}" for c in _DAY)},
         {", ".join(f"coalesce(lag(c.{c}) OVER dy, 0) AS {c}" for c in _BAND)},
         {", ".join(f"coalesce(last_value(c.{c} IGNORE NULLS) OVER wb, {_week_seed(c)}) AS {c}" for c in _WEEK)}
  FROM bars b LEFT JOIN closedv c USING (contract, trade_date, bar_idx)
  WINDOW dy AS (PARTITION BY b.contract, b.trade_date ORDER BY b.bar_idx), wk AS (PARTITION BY b.contract, b.week_no ORDER BY b.trade_date, b.bar_idx),
         wb AS (PARTITION BY b.contract, b.week_no ORDER BY b.trade_date, b.bar_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
)
PARTS["dsummary"] = (
    ["closedv"],
    f"""dlast AS (SELECT * FROM closedv QUALIFY row_number() OVER (PARTITION BY contract, trade_date ORDER BY bar_idx DESC) = 1
), dsummary AS (
  SELECT b.contract, b.trade_date, b.week_no, b.cumulativeDelta, b.n_bars, {", ".join(f"coalesce(l.{c}, b.seed) AS {c}" for c in _DAY)}, {", ".join(f"coalesce(l.{c}, 0) AS {c}" for c in [*_BAND, "deltaZscore", "cumDelta5barSlope"])},
         CASE WHEN b.n_bars = 1 THEN 0 ELSE l.rsi END AS rsi, coalesce(l.totalVolume, 0) AS totalVolume
  FROM (SELECT contract, trade_date, week_no, arg_min(open, bar_idx) AS seed, CAST(sum(delta) AS BIGINT) AS cumulativeDelta, count(*) AS n_bars FROM bars GROUP BY ALL) b
  LEFT JOIN dlast l USING (contract, trade_date))""",
)
PARTS["wsummary"] = (
    ["hilo"],
    """wlast AS (SELECT b.contract, b.week_no, h.weekHigh, h.weekLow FROM hilo h JOIN bars b USING (contract, trade_date, bar_idx) QUALIFY row_number() OVER (PARTITION BY b.contract, b.week_no ORDER BY b.trade_date DESC, b.bar_idx DESC) = 1
), wopen AS (SELECT contract, week_no, open AS o FROM bars QUALIFY row_number() OVER (PARTITION BY contract, week_no ORDER BY trade_date, bar_idx) = 1
), wspan AS (SELECT contract, CAST(unnest(range(1, max(week_no) + 1)) AS INTEGER) AS week_no FROM bars GROUP BY contract
), wsummary AS (
  SELECT s.contract, s.week_no, coalesce(l.weekHigh, CASE WHEN s.week_no = 1 THEN o.o END, 0) AS weekHigh, coalesce(l.weekLow, o.o, 0) AS weekLow
  FROM wspan s LEFT JOIN wlast l USING (contract, week_no) LEFT JOIN wopen o USING (contract, week_no))""",
)
PARTS["prevs"] = (
    ["dsummary", "wsummary"],
    f"""prevd AS (SELECT contract, trade_date, {", ".join(f"lag({c}) OVER (PARTITION BY contract, week_no ORDER BY trade_date) AS prev_{c}" for c in ("vwap", "poc", "vah", "val", "dayHigh", "dayLow", "dayClose"))} FROM dsummary
), prevw AS (SELECT contract, week_no, lag(weekHigh) OVER (PARTITION BY contract ORDER BY week_no) AS prev_weekHigh, lag(weekLow) OVER (PARTITION BY contract ORDER BY week_no) AS prev_weekLow FROM wsummary)""",
)


def query(select: str, *parts: str) -> str:
    """``select`` with all parts that the named ones stand on."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in PARTS[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for p in parts:
        add(p)
    return "WITH RECURSIVE " + ",\n".join(PARTS[p][1] for p in order) + "\n" + select
