"""Secret scans in DataFrame functions: three base patterns, and character Markov models for what they miss.

Base kinds, leftmost and non-overlapping each: ``assign`` (a keyword with a value of 6 and more characters), ``access``
(AKIA..., 20 and more), ``hex`` (24 and more). The kind ``markov`` adds runs of 20 and more key characters with a digit
and a letter, outside of base spans, that read more like random strings than like ordinary identifiers: the mean
log-likelihood ratio of two first-order character models exceeds ``LIMIT``. The models are counted from labelled samples:
values of the base patterns in all documents, also in upper case, against the words of ``ORDINARY_DOCS`` documents of small
id hash; each is mixed with equal chances of all symbols (a larger part of the random one). Signs say nothing.

Positions are code points, end exclusive. Null texts are empty; empty texts have no spans; equal rows stay equal rows; an
empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import boxed

ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "markov")
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
SIDE = len(SYMBOLS) + 1
ORDINARY_DOCS, LIMIT, GROUP = 2000, 0.5, 128
NOWHERE = 2**31 - 1
SPAN = "array<struct<start:int,kind:int,end:int>>"
MASK = "[SECRET]"


def _let(value: Column, then) -> Column:
    """``then(value)``, with the value computed once however often it occurs, inside of lambdas too."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _scan(values: Column, fold, zero: Column) -> Column:
    """For each element the fold of all before it, from ``zero``; in groups, so that the work stays near linear."""

    def grouped(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / GROUP).cast("int")), lambda g: F.slice(v, g * GROUP + 1, F.lit(GROUP)))

    def folded(groups: Column) -> Column:
        return _let(F.transform(groups, lambda g: F.aggregate(g, zero, fold)), lambda sums: F.flatten(F.transform(groups, lambda g, k: _let(
            F.aggregate(F.slice(sums, F.lit(1), k), zero, fold), lambda base: F.transform(g, lambda x, i: F.aggregate(F.slice(g, F.lit(1), i), base, fold))))))

    return _let(values, lambda v: F.when(F.size(v) > 0, _let(grouped(v), folded)).otherwise(F.array().cast("array<int>")))


def _sum(a: Column, x: Column) -> Column:
    return a + x


def _larger(a: Column, x: Column) -> Column:
    return F.greatest(a, x)


def _smaller(a: Column, x: Column) -> Column:
    return F.least(a, x)


def _spans(text: str, found: str, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Spans of the matches ``found`` of ``pattern``: texts between matches and matches themselves give the positions."""
    between = F.transform(F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size(found)), F.length)

    def made(sizes: Column) -> Column:
        at = _scan(F.transform(sizes, lambda x: x["b"] + x["m"]), _sum, F.lit(0))
        return F.zip_with(at, sizes, lambda a, x: F.struct((a + x["b"]).alias("start"), F.lit(kind).alias("kind"), (a + x["b"] + x["m"]).alias("end")))

    spans = _let(F.arrays_zip(between.alias("b"), F.transform(found, F.length).alias("m")), made)
    if keep is not None:
        spans = F.transform(F.filter(F.arrays_zip(spans.alias("s"), keep.alias("v")), lambda x: F.length(x["v"]) >= 6), lambda x: x["s"])
    return F.when(F.size(found) > 0, spans.cast(SPAN)).otherwise(F.array().cast(SPAN))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, text, base): each row of ``docs`` as a struct, its text (never null), and its base spans sorted by start and kind."""
    t = boxed(docs, text).select("row", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    t = t.withColumn("assign", F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(0)))
    t = t.withColumn("values", F.when(F.size("assign") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))).otherwise(none))
    t = t.withColumn("access", F.when(F.contains("text", F.lit("AKIA")), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0))).otherwise(none))
    t = t.withColumn("hex", F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    parts = [_spans("text", "assign", ASSIGN, 0, F.col("values")), _spans("text", "access", ACCESS, 1), _spans("text", "hex", HEX, 2)]
    return t.select("row", "text", F.array_sort(F.concat(*parts)).alias("base"))


def _pairs(words: DataFrame, word: str) -> DataFrame:
    """Counts of symbol pairs over all ``word`` strings."""
    codes = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(SYMBOLS), c))
    pairs = words.where(F.length(word) >= 2).select(codes.alias("c")).select(F.explode(F.transform(F.sequence(F.lit(0), F.size("c") - 2), lambda i: F.get("c", i) * SIDE + F.get("c", i + 1))).alias("pair"))
    return pairs.groupBy("pair").count()


def train(docs: DataFrame, text: str = "text", ordinary_docs: int = ORDINARY_DOCS) -> list[float]:
    """Log-likelihood ratio (random against ordinary) of each symbol pair; SIDE * SIDE numbers."""
    t = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"), F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
    values = F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 12)
    random = t.where(F.col("t").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")).select(F.explode(F.concat(values, F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("t", F.lit(HEX), F.lit(0)))).alias("w"))
    total = max(1, docs.count())
    few = t.where(F.pmod("h", F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, ordinary_docs / total))))
    clean = F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), RUN, " ")  # long runs are what is judged, not what is learned
    ordinary = few.select(F.explode(F.regexp_extract_all(clean, F.lit(r"[A-Za-z0-9_]{4,}"), F.lit(0))).alias("w"))
    random = random.select(F.explode(F.array("w", F.upper("w"))).alias("w"))
    logs = []
    for words, uniform, weight in ((random, 0.3, 0.0), (ordinary, 0.02, 20.0)):
        counts = {r.pair: r["count"] for r in _pairs(words, "w").collect()}  # SIDE * SIDE rows at most
        rows = [[counts.get(a * SIDE + b, 0) if b else 0 for b in range(SIDE)] for a in range(SIDE)]
        total = sum(map(sum, rows[1:]))
        single = [(sum(r[b] for r in rows[1:]) + 1.0) / (total + len(SYMBOLS)) for b in range(SIDE)]  # what rare symbols fall back to
        table = []
        for a, row in enumerate(rows):
            n = sum(row) + weight
            table += [math.log((1 - uniform) * ((x + weight * single[b]) / n if n else 1 / len(SYMBOLS)) + uniform / len(SYMBOLS)) if a and b else 0.0 for b, x in enumerate(row)]
        logs.append(table)
    return [a - b for a, b in zip(*logs)]


def find(docs: DataFrame, ratios: list[float], text: str = "text") -> DataFrame:
    """(row, text, base, spans): ``base_spans`` with base and Markov spans together, sorted by start and kind."""
    t = base_spans(docs, text)
    t = t.withColumn("run", F.regexp_extract_all("text", F.lit(RUN), F.lit(0)))
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratios)), ",").cast("array<double>")

    def odd(word: Column) -> Column:
        codes = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(SYMBOLS), c))
        pairs = F.zip_with(codes, F.slice(codes, F.lit(2), F.greatest(F.length(word) - 1, F.lit(0))), lambda a, b: F.when(b.isNull(), F.lit(0.0)).otherwise(F.get(table, a * SIDE + b)))
        return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / F.length(word)

    judged = F.filter(
        F.arrays_zip(_spans("text", "run", RUN, 3).alias("s"), F.col("run").alias("w")),
        lambda x: x["w"].rlike("[0-9]") & x["w"].rlike("[A-Za-z]") & (odd(x["w"]) > LIMIT),
    )
    t = t.withColumn("odd", F.when(F.size("run") > 0, F.transform(judged, lambda x: x["s"]).cast(SPAN)).otherwise(F.array().cast(SPAN)))
    # by start, base spans before runs: a run is free where no base span before it reaches into it and the next one starts behind it
    t = t.withColumn("all", F.array_sort(F.concat("base", "odd")))
    ends = F.transform("all", lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0))
    starts = F.reverse(F.transform("all", lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(NOWHERE)))
    t = t.withColumn("reach", _scan(ends, _larger, F.lit(0)))
    t = t.withColumn("next", F.reverse(_scan(starts, _smaller, F.lit(NOWHERE))))
    free = F.filter(F.arrays_zip(F.col("all").alias("s"), F.col("reach").alias("r"), F.col("next").alias("n")), lambda x: (x["s"]["kind"] < 3) | ((x["r"] <= x["s"]["start"]) & (x["n"] >= x["s"]["end"])))
    spans = F.when(F.size("odd") > 0, F.transform(free, lambda x: x["s"]).cast(SPAN)).otherwise(F.col("base"))
    return t.select("row", "text", "base", spans.alias("spans"))


def redact(docs: DataFrame, ratios: list[float], text: str = "text") -> DataFrame:
    """``docs`` with every span, overlapping or touching ones as one, replaced by ``MASK``."""
    found = find(docs, ratios, text)
    found = found.withColumn("chars", F.when(F.size("spans") > 0, F.split("text", "")))
    # for each span how far those before it reach; text between is kept
    found = found.withColumn("reach", _scan(F.transform("spans", lambda s: s["end"]), _larger, F.lit(-1)))
    kept = lambda a, b: F.array_join(F.slice("chars", F.greatest(a, F.lit(0)) + 1, F.greatest(b - F.greatest(a, F.lit(0)), F.lit(0))), "")
    parts = F.zip_with("spans", "reach", lambda s, r: F.when(s["start"] > r, F.concat(kept(r, s["start"]), F.lit(MASK))).otherwise(F.lit("")))
    last = F.array_max(F.transform("spans", lambda s: s["end"]))
    clean = F.when(F.size("spans") == 0, F.col(f"row.`{text}`")).otherwise(F.concat(F.array_join(parts, ""), kept(last, F.length("text"))))
    return found.select(*[clean.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def named(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "text")
    found = find(slim, train(slim))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("row.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(named("base"), 256).alias("base_sha256"), named("spans").alias("spans"))
