"""Cleaning of raw text ticks, roll maps and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.ticks import first_timestamp_column


def clean(raw: DataFrame, from_zone: str = "UTC", to_zone: str = "America/New_York") -> DataFrame:
    """Text dates and times as wall clock of another zone; rows that do not parse go."""
    ts = F.try_to_timestamp(F.concat_ws(" ", "Date", "Time"), F.lit("yyyy/MM/dd HH:mm:ss")).cast("timestamp_ntz")
    out = raw.withColumn("DateTime", F.convert_timezone(F.lit(from_zone), F.lit(to_zone), ts)).where(F.col("DateTime").isNotNull())
    return out.select("contract", "id", "DateTime", F.col("Close").cast("double").alias("Price"), F.col("AskVolume").cast("long"), F.col("BidVolume").cast("long"))


def processing_ticks(ticks: DataFrame) -> DataFrame:
    """Fractional volumes are cut toward zero; the day of the wall clock becomes the session; missing numbers are 0."""
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return ticks.select("contract", "id", "DateTime", F.to_date("DateTime").alias("trade_date"), F.coalesce("Price", F.lit(0.0)).alias("Price"), whole("AskVolume"), whole("BidVolume"))


def is_contract_table(name: str = "contract"):
    return F.upper(name).startswith("ES") & F.upper(name).endswith("_TICK")


def daily_volume(raw: DataFrame) -> DataFrame:
    return raw.groupBy("contract", "Date").agg(F.sum("Volume").cast("long").alias("daily_volume"))


def roll_map(volumes: DataFrame) -> DataFrame:
    """Per date the contract of most volume, the first by name on ties."""
    best = F.min_by(F.struct("contract", "daily_volume"), F.struct(-F.col("daily_volume"), F.col("contract"))).alias("b")
    return volumes.groupBy("Date").agg(best).select("Date", "b.contract", "b.daily_volume")


def continuous(raw: DataFrame, rolls: DataFrame) -> DataFrame:
    """Ticks of the contract that its date's roll map names. The map has one row a day, so it is small beside the ticks;
    Spark broadcasts it while its size stays under the session's threshold."""
    return raw.join(rolls.select("Date", "contract"), ["Date", "contract"], "left_semi")


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """All days from start to end with ISO day number; weeks count from 1 and end on Sundays. No rows if end < start."""
    one = spark.range(1).select(F.to_date(F.lit(start)).alias("s"), F.to_date(F.lit(end)).alias("e")).where("e >= s")
    days = one.select("s", F.explode(F.sequence("s", "e")).alias("date"))
    return with_week(days, "date", F.col("s")).select("week_no", (F.weekday("date") + 1).alias("day_number"), "date")


def with_week(df: DataFrame, date: str, start) -> DataFrame:
    return df.withColumn("week_no", (F.floor(F.datediff(F.col(date), F.trunc(start, "week")) / 7) + 1).cast("int"))


def last_days(df: DataFrame, days: int = 30, column: str | None = None) -> DataFrame:
    """Rows of the last ``days`` days of data, ends included."""
    column = column or first_timestamp_column(df)
    latest = df.agg(F.max(column).alias("latest"))
    newest = latest.first().latest  # one value: footers or partial maxima, never rows
    if newest is None:
        return df.where("false")
    return df.where(F.col(column) >= F.lit(newest) - F.expr(f"INTERVAL {int(days)} DAYS"))


def first_tick(ticks: DataFrame) -> DataFrame:
    """First tick of every session by time, then id."""
    row = F.min_by(F.struct("id", "DateTime", "Price", "AskVolume", "BidVolume"), F.struct("DateTime", "id")).alias("t")
    return ticks.groupBy("contract", "trade_date").agg(row).select("contract", "trade_date", "t.*")


def prev_in_week(days: DataFrame, columns: list[str]) -> DataFrame:
    """Values of the previous session with data in the same week, as prev_<column>."""
    w = Window.partitionBy("contract", "week_no").orderBy("trade_date")
    return days.select("*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in columns])
