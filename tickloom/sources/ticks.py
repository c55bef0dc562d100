"""Tick sources: the adapters over the event and order tables, Parquet with nanoseconds, and raw tick text columns."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

#: Smallest seen price of the derived walk.
BASE_PRICE, TICK = 4000.0, 0.25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ticks(spark: SparkSession, sf_dir: str, contract: str = "ESH4_TICK") -> DataFrame:
    """Ticks of one contract derived from ``events``: an on-grid walk with gaps, restarted every day."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.floor("value").cast("long").alias("v"))
    day = Window.partitionBy("trade_date").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    buy = F.col("event_type").isin("purchase", "signup")
    base = e.select(
        F.lit(contract).alias("contract"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp_ntz").alias("DateTime"), F.to_date("ts").alias("trade_date"),
        (F.col("v") % 7 - 3).alias("step"), F.when(buy, F.col("v") % 50).otherwise(F.lit(0)).cast("long").alias("AskVolume"), F.when(buy, F.lit(0)).otherwise(F.col("v") % 50).cast("long").alias("BidVolume"),
    )
    return base.withColumn("Price", F.lit(BASE_PRICE) + F.sum("step").over(day).cast("double") * F.lit(TICK)).drop("step")


def event_raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text ticks of three contracts derived from ``events``; every 97th time is unparseable."""
    e = table(spark, sf_dir, "events")
    name = F.element_at(F.array(F.lit("ESH4_TICK"), F.lit("ESM4_TICK"), F.lit("ESU4_TICK")), (F.col("user_id") % 3 + 1).cast("int"))
    v = F.floor("value").cast("long")
    buy = F.col("event_type").isin("purchase", "signup")
    time = F.when(F.col("event_id") % 97 == 0, F.lit("bad")).otherwise(F.date_format("ts", "HH:mm:ss"))
    return e.select(name.alias("contract"), F.col("event_id").alias("id"), F.date_format("ts", "yyyy/MM/dd").alias("Date"), time.alias("Time"), (F.lit(BASE_PRICE) + (v % 40).cast("double") * F.lit(TICK)).alias("Close"),
                    (v % 50 + 1).alias("Volume"), F.when(buy, v % 50).otherwise(F.lit(0)).alias("AskVolume"), F.when(buy, F.lit(0)).otherwise(v % 50).alias("BidVolume"))


def order_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series of closes per customer segment derived from ``orders``: (series, step, Close)."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 16).alias("series"), "o_orderkey", F.round("o_totalprice", 2).alias("Close"))
    return o.withColumn("step", F.row_number().over(Window.partitionBy("series").orderBy("o_orderkey", "Close")).cast("long") - 1)


def read_parquet_ns(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose timestamps may have nanoseconds: they become TIMESTAMP_NTZ of microseconds."""
    before = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false")
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018  resolved while the setting holds
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", before)
    return df


def nanos_to_ntz(df: DataFrame, column: str = "DateTime") -> DataFrame:
    """A bigint column of nanoseconds as TIMESTAMP_NTZ; other types stay."""
    if isinstance(df.schema[column].dataType, T.LongType):
        return df.withColumn(column, F.timestamp_micros(F.floor(F.col(column) / 1000)).cast("timestamp_ntz"))
    return df


def first_timestamp_column(df: DataFrame) -> str | None:
    """Name of the first timestamp column, or None."""
    return next((f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))), None)


def read_sorted_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files of a folder, with the stem of the file each row comes from."""
    df = spark.read.parquet(folder)
    return df.select("*", F.regexp_extract("_metadata.file_name", r"^(.*?)(?:-[0-9a-f-]{20,}.*)?\.[^.]*(?:\.parquet)?$", 1).alias("file_stem"))


def files_by_stem(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Paths of the Parquet files of a folder in order, by the stem of their names (that of the folder for a written one)."""
    paths = sorted(spark.read.parquet(f"{folder}/*.parquet").inputFiles())
    out: dict[str, list[str]] = {}
    for path in paths:
        parts = unquote(path).split("/")
        name = parts[-2] if parts[-2].endswith(".parquet") else parts[-1]
        out.setdefault(name.removesuffix(".parquet"), []).append(unquote(path))
    return out


def sample_data(spark: SparkSession, files: int = 2, rows: int = 10_000, seed: int = 7) -> DataFrame:
    """(file, id, value, category): random values in [0, 1) and categories A, B, C; file i has ids i * rows and up."""
    df = spark.range(files * rows)
    return df.select((F.col("id") / rows).cast("int").alias("file"), "id", F.rand(seed).alias("value"), F.element_at(F.array(*map(F.lit, "ABC")), (F.floor(F.rand(seed + 1) * 3) + 1).cast("int")).alias("category"))
