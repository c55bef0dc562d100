"""Sinks: partitioned Parquet, nested contract documents as JSON or Parquet, flat tables back from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.config import DAY

LEVEL = "struct<price:double,bidVolume:bigint,askVolume:bigint,isBuyImbalance:boolean,isSellImbalance:boolean,volumeAtPrice:bigint,deltaAtPrice:bigint>"


def write_contracts(ticks: DataFrame, path: str, max_records: int = 1_000_000) -> None:
    """Snappy Parquet, one folder per contract; contracts without rows make none."""
    ticks.write.mode("overwrite").partitionBy("contract").option("compression", "snappy").option("maxRecordsPerFile", max_records).parquet(path)


def write_days(ticks: DataFrame, path: str, column: str = "DateTime") -> None:
    """Parquet in folders year=YYYY/month=MM/day=DD of zero-padded text."""
    part = lambda f: F.date_format(column, f)
    ticks.withColumns({"year": part("yyyy"), "month": part("MM"), "day": part("dd")}).write.mode("overwrite").partitionBy("year", "month", "day").parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_days`` wrote, with year, month and day as text."""
    plain = spark.read.parquet(path)
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in ("year", "month", "day") else f for f in plain.schema])
    return spark.read.schema(schema).parquet(path)


def nested_contracts(flat: DataFrame, days: DataFrame | None = None, weeks: DataFrame | None = None) -> DataFrame:
    """One document per contract: weeks of days of bars, each level in order. ``flat`` has contract, week_no, trade_date,
    bar_idx and the columns of a bar; the scalars of ``days`` and ``weeks`` stand beside what they contain."""
    bar_cols = [c for c in flat.columns if c not in (*DAY, "bar_idx", "week_no", "dayOfTheWeek", "weekOfTheContract")]
    strip = lambda col, names: F.transform(F.array_sort(F.collect_list(col)), lambda x: F.struct(*[x[n].alias(n) for n in names]))
    d = flat.groupBy("contract", "week_no", "trade_date").agg(F.first("dayOfTheWeek").alias("dayOfTheWeek"), F.first("weekOfTheContract").alias("weekOfTheContract"), strip(F.struct("bar_idx", *bar_cols), bar_cols).alias("bars"))
    day_cols = [] if days is None else [c for c in days.columns if c not in (*DAY, "week_no")]
    if days is not None:
        d = d.join(days.drop("week_no"), DAY)
    w = d.groupBy("contract", "week_no").agg(F.first("weekOfTheContract").alias("weekOfTheContract"), strip(F.struct("trade_date", "dayOfTheWeek", "bars", *day_cols), ["dayOfTheWeek", "bars", *day_cols]).alias("days"))
    week_cols = [] if weeks is None else [c for c in weeks.columns if c not in ("contract", "week_no")]
    if weeks is not None:
        w = w.join(weeks, ["contract", "week_no"])
    top = strip(F.struct("week_no", "weekOfTheContract", "days", *week_cols), ["weekOfTheContract", "days", *week_cols])
    return w.groupBy("contract").agg(top.alias("weeks")).select(F.col("contract").alias("contractName"), "weeks")


def write_nested_parquet(flat: DataFrame, path: str) -> None:
    """Documents of weeks of days of bars with their seven basic columns only, as nested Parquet."""
    basic = ["startTime", "endTime", "open", "high", "low", "close", "barTotalVolume"]
    nested_contracts(flat.select(*DAY, "bar_idx", "week_no", *basic, "dayOfTheWeek", "weekOfTheContract")).write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_flat(flat: DataFrame, path: str) -> None:
    """The flat bar table as Snappy Parquet; the footprint stays a list column."""
    flat.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_json(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Documents with a given schema; columns that are null throughout would be read as text without it."""
    return spark.read.schema(schema).json(path)


def flatten(documents: DataFrame) -> DataFrame:
    """One row per bar of nested documents; the footprint stays an array, names of day and week go beside the bar."""
    w = documents.select("contractName", F.explode("weeks").alias("w"))
    d = w.select("contractName", F.col("w.weekOfTheContract").alias("weekOfTheContract"), F.posexplode("w.days").alias("d_pos", "d"))
    b = d.select("contractName", "weekOfTheContract", F.col("d.dayOfTheWeek").alias("dayOfTheWeek"), F.explode("d.bars").alias("b"))
    return b.select("contractName", "b.*", "dayOfTheWeek", "weekOfTheContract")
