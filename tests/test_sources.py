import datetime as dt
import sqlite3

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tickloom.operators import clean
from tickloom.sources import sinks, sqlite, ticks


@pytest.fixture
def database(tmp_path):
    path = str(tmp_path / "ticks.db")
    with sqlite3.connect(path) as db:
        for t, n in (("ESH4_TICK", 25), ("esm4_tick", 5), ("other", 3), ("ES_empty_TICK", 0)):
            db.execute(f'CREATE TABLE "{t}" (id INTEGER, Date TEXT, Time TEXT, Close REAL, Volume INTEGER)')
            db.executemany(f'INSERT INTO "{t}" VALUES (?, ?, ?, ?, ?)', [(i, "2024/01/03", "10:00:00", 100.0 + i, i) for i in range(n)])
    return path


def test_sqlite_tables_and_read(spark, database):
    assert sqlite.contract_tables(database) == ["ESH4_TICK", "ES_empty_TICK", "esm4_tick"]
    sqlite.register(spark)
    df = spark.read.format("sqlite").option("path", database).option("rows", 10).load()
    assert df.columns == ["contract", "id", "Date", "Time", "Close", "Volume"]
    assert {r.contract: r["count"] for r in df.groupBy("contract").count().collect()} == {"ESH4_TICK": 25, "esm4_tick": 5, "other": 3}
    assert df.where(clean.is_contract_table()).count() == 30
    one = spark.read.format("sqlite").option("path", database).option("table", "ESH4_TICK").option("rows", 10).load()
    assert one.rdd.getNumPartitions() == 3 and [r.id for r in one.orderBy("id").collect()] == list(range(25))


def test_sqlite_write(spark, tmp_path):
    sqlite.register(spark)
    path = str(tmp_path / "out.db")
    df = spark.range(100).selectExpr("id", "cast(id as string) as name", "id / 2 as half", "timestamp'2024-01-01 00:00:00' as t")
    write = lambda d, mode: d.write.format("sqlite").option("path", path).option("table", "x").mode(mode).save()
    write(df, "overwrite")
    write(df.limit(5), "append")
    back = spark.read.format("sqlite").option("path", path).option("table", "x").load()
    assert back.count() == 105 and back.where("name = '7'").first().half == 3.5
    write(df.limit(2), "overwrite")
    assert back.count() == 2 and not list(tmp_path.glob("*.part"))


def test_nanoseconds_and_schema(spark, tmp_path):
    path = str(tmp_path / "ns.parquet")
    pq.write_table(pa.table({"id": [1], "DateTime": pa.array([1704276000123456789], pa.timestamp("ns"))}), path)
    df = ticks.nanos_to_ntz(ticks.read_parquet_ns(spark, path))
    assert df.first().DateTime == dt.datetime(2024, 1, 3, 10, 0, 0, 123456)
    assert ticks.first_timestamp_column(df) == "DateTime" and ticks.first_timestamp_column(spark.range(1)) is None


def test_folders_and_last_days(spark, tmp_path):
    t = spark.range(40).selectExpr("'A' as contract", "id", "cast(timestamp'2024-01-01 12:00:00' + make_dt_interval(cast(id as int)) as timestamp_ntz) as DateTime")
    sinks.write_days(t, str(tmp_path / "days"))
    back = sinks.read_days(spark, str(tmp_path / "days"))
    assert back.where("year = '2024' and month = '02' and day = '03'").count() == 1
    assert clean.last_days(t, 30).count() == 31 and clean.last_days(t.where("false")).count() == 0
    pq.write_table(pa.table({"id": [1, 2]}), str(tmp_path / "sample_data_1.parquet"))
    stems = ticks.read_sorted_folder(spark, str(tmp_path / "sample_data_1.parquet")).select("file_stem").distinct().collect()
    assert [r.file_stem for r in stems] == ["sample_data_1"]
