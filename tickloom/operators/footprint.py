"""Footprints: volume by price inside bars, diagonal imbalances, bar POC and edge deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.config import DAY, DEFAULT, BarConfig

BAR = [*DAY, "bar_idx"]


def levels(labelled: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """Levels of every bar with imbalance flags; levels that were only looked at (phantoms) have no volume."""
    seen = Window.partitionBy(*BAR).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    idx = F.round(F.col("Price") / config.tick).cast("long")
    t = labelled.select(*BAR, "seq", "is_open", "AskVolume", "BidVolume", idx.alias("p"))
    t = t.select("*", F.min("p").over(seen).alias("lo"), F.max("p").over(seen).alias("hi"))
    a, b = ("AskVolume", "BidVolume") if config.parity else ("BidVolume", "AskVolume")
    twice = F.col("is_open") & F.lit(config.parity)
    touch = lambda at, on: F.when(on, F.struct(at.alias("p"), F.lit(False).alias("traded")))
    looked = F.array(F.struct(F.col("p"), F.lit(True).alias("traded")), touch(F.col("p") + 1, F.col("p") < F.col("hi")), touch(F.col("p") - 1, F.col("p") > F.col("lo")))
    if not config.parity:
        looked = F.slice(looked, 1, 1)
    rows = t.select(*BAR, "seq", twice.alias("twice"), F.col(a).alias("a"), F.col(b).alias("b"), (F.col("p") > F.col("lo")).alias("above"), (F.col("p") < F.col("hi")).alias("below"),
                    F.explode(F.filter(looked, lambda x: x.isNotNull())).alias("l")).select("*", "l.p", "l.traded")
    on = lambda c: F.when(F.col("traded"), c)
    zero = F.lit(0).cast("long")
    sums = rows.groupBy(*BAR, "p").agg(
        F.coalesce(F.sum(on(F.col("a") + F.when(F.col("twice"), F.col("b")).otherwise(0))), zero).alias("bidVolume"),
        F.coalesce(F.sum(on(F.col("b") + F.when(F.col("twice"), F.col("a")).otherwise(0))), zero).alias("askVolume"),
        F.coalesce(F.sum(on(F.col("a") + F.col("b"))), zero).alias("volumeAtPrice"), F.coalesce(F.sum(on(F.col("b") - F.col("a"))), zero).alias("deltaAtPrice"),
        F.max("traded").alias("traded"), F.max_by("above", on(F.col("seq"))).alias("above"), F.max_by("below", on(F.col("seq"))).alias("below"),
    )
    by_price = Window.partitionBy(*BAR).orderBy("p")

    def flag(mine: str, other: str, step: int, looked_at: str):
        side = (lambda c: F.lag(c).over(by_price)) if step < 0 else (lambda c: F.lead(c).over(by_price))
        there = (side("p") == F.col("p") + step) & side("traded")
        y = F.when(F.coalesce(there, F.lit(False)), side(other)).otherwise(F.when(F.col(looked_at), F.lit(0)))
        rule = ((y == 0) & (F.col(mine) > 0)) | ((y > 0) & (F.col(mine) / F.when(y > 0, y) >= config.theta))
        return F.coalesce(F.col("traded") & rule, F.lit(False))

    return sums.select(*BAR, (F.col("p") * F.lit(config.tick)).alias("price"), "bidVolume", "askVolume", flag("askVolume", "bidVolume", -1, "above").alias("isBuyImbalance"),
                       flag("bidVolume", "askVolume", 1, "below").alias("isSellImbalance"), "volumeAtPrice", "deltaAtPrice", (~F.col("traded")).alias("is_phantom"))


def bar_poc(labelled: DataFrame) -> DataFrame:
    """Price of most volume in a bar; of equal ones that which had it first. Without volume 0.0."""
    v = F.col("AskVolume") + F.col("BidVolume")
    # a price has all of its volume from its last tick with any on, and none from its first one
    t = labelled.groupBy(*BAR, "Price").agg(F.sum(v).alias("v"), F.coalesce(F.max(F.when(v > 0, F.col("seq"))), F.min("seq")).alias("seq"))
    best = t.groupBy(*BAR).agg(F.max_by(F.struct("Price", "v"), F.struct(F.col("v"), -F.col("seq"))).alias("m"))
    return best.select(*BAR, F.when(F.col("m.v") > 0, F.col("m.Price")).otherwise(F.lit(0.0)).alias("barPOCPrice"), F.col("m.v").alias("barPOCVol"))


def level_summary(lv: DataFrame) -> DataFrame:
    """Per bar the counts of imbalances and the deltas of the two highest and the two lowest levels."""
    top = F.row_number().over(Window.partitionBy(*BAR).orderBy(F.desc("price")))
    low = F.row_number().over(Window.partitionBy(*BAR).orderBy("price"))
    t = lv.select("*", top.alias("top"), low.alias("low"))
    part = lambda c: F.sum(F.when(F.col(c) <= 2, F.col("deltaAtPrice")).otherwise(0))
    return t.groupBy(*BAR).agg(F.count_if("isBuyImbalance").alias("buyImbalanceCount"), F.count_if("isSellImbalance").alias("sellImbalanceCount"), part("top").alias("barHighDelta"), part("low").alias("barLowDelta"))


def nested(lv: DataFrame) -> DataFrame:
    """Per bar the levels as an array sorted by price."""
    cols = ["price", "bidVolume", "askVolume", "isBuyImbalance", "isSellImbalance", "volumeAtPrice", "deltaAtPrice"]
    return lv.groupBy(*BAR).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("footprint"))
