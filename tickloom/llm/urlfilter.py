"""URL filters by a temporal list join, in DataFrame functions.

Dated list entries (list, key, action ``add`` or ``remove``, day) become validity intervals [day, day of the next entry
of the same list and key); of several entries of one day ``remove`` wins. A capture (url and day of fetch) is looked up
under its host, all parent domains of the host, and the host with the first path segment; it is blocked if an interval of
any of these keys holds its day. Captures meet intervals by key and salt: the list, which is small for a key, is copied
``SALT`` times, so a host with a third of all captures spreads over that many tasks.

Captures without url, host or day match nothing and are not blocked. Entries without key or day are ignored. Equal
captures (same id, url and day) give one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SALT = 16
#: Days of the derived list and captures count from here.
EPOCH = "2024-01-01"


def host(url: Column) -> Column:
    """Lower-case host without user and port; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def intervals(entries: DataFrame) -> DataFrame:
    """list, key, from_day, to_day (null: still valid) of dated entries."""
    day = entries.where(F.col("key").isNotNull() & F.col("day").isNotNull()).groupBy("list", "key", "day").agg(F.max("action").alias("action"))
    nxt = F.lead("day").over(Window.partitionBy("list", "key").orderBy("day"))
    return day.select("list", "key", "action", F.col("day").alias("from_day"), nxt.alias("to_day")).where(F.col("action") == "add").drop("action")


def keys(url: Column) -> Column:
    """Keys of a capture: host, parent domains of two labels and more, host/segment."""
    h = host(url)
    labels = F.split(h, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segment = F.regexp_extract(url, r"://[^/?#]+/([^/?#]+)", 1)
    return F.when(h.isNotNull(), F.array_distinct(F.concat(domains, F.when(segment != "", F.array(F.concat(h, F.lit("/"), segment))).otherwise(F.array().cast("array<string>")))))


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", day: str = "day", salt: int = SALT) -> DataFrame:
    """Per capture: n_lists that hold it at its day, their names, the most specific matching key, blocked."""
    base = captures.select(F.col(key), F.col(url), F.col(day).alias("day"))
    wide = base.select("*", F.explode_outer(keys(F.col(url))).alias("key"), F.pmod(F.xxhash64(key, url), F.lit(salt)).alias("salt"))
    valid = intervals(entries).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))).alias("salt"))
    cond = (wide["key"] == valid["key"]) & (wide["salt"] == valid["salt"]) & (wide["day"] >= valid["from_day"]) & (valid["to_day"].isNull() | (wide["day"] < valid["to_day"]))
    hit = wide.join(valid, cond, "left").select(wide[key], wide[url], wide["day"], valid["list"], valid["key"].alias("entry"))
    found = hit.groupBy(key, url, "day").agg(F.array_sort(F.collect_set("list")).alias("__lists"), F.max(F.struct(F.length("entry"), F.col("entry")))["entry"].alias("entry"))
    return found.select(key, url, "day", F.size("__lists").cast("long").alias("n_lists"), F.array_join("__lists", ",").alias("lists"), "entry", (F.size("__lists") > 0).alias("blocked"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A list for tables that come without one: by the md5 of each host, when it and its domain were listed and delisted."""
    number = lambda c: F.conv(F.substring(F.md5(c), 1, 7), 16, 10).cast("long")
    hosts = pages.select(host(F.col("url")).alias("h")).where(F.col("h").isNotNull()).groupBy("h").count().select("h")
    h = number(F.col("h"))
    day = lambda n: F.date_add(F.lit(EPOCH).cast("date"), n.cast("int"))
    row = lambda name, key, action, n: F.struct(F.lit(name).alias("list"), key.alias("key"), F.lit(action).alias("action"), day(n).alias("day"))
    listed = hosts.where(h % 3 == 0).select(F.explode(F.array(
        row("spam", F.col("h"), "add", h % 300), row("spam", F.col("h"), "remove", h % 300 + 20 + h % 50), row("spam", F.col("h"), "add", h % 300 + 60 + h % 41),
    )).alias("e")).select("e.*")
    domain = F.regexp_extract(F.col("h"), r"([^.]+\.[^.]+)$", 1)
    d = number(F.col("d"))
    domains = hosts.select(domain.alias("d")).where(F.col("d") != "").groupBy("d").count().where(d % 2 == 0)
    malware = domains.select(F.explode(F.array(row("malware", F.col("d"), "add", d % 200), row("malware", F.col("d"), "remove", d % 200 + 45))).alias("e")).select("e.*")
    return listed.unionByName(malware)


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url and day of fetch (a year of days dealt by page_id)."""
    return pages.select("page_id", "url", F.date_add(F.lit(EPOCH).cast("date"), F.pmod("page_id", F.lit(366)).cast("int")).alias("day"))


def digest(pages: DataFrame) -> DataFrame:
    return evaluate(captures(pages), derived_entries(pages)).select("page_id", "url", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_lists", "lists", "entry", "blocked")


SQL = r"""
WITH cap AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS day,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS h,
         regexp_extract(url, '://[^/?#]+/([^/?#]+)', 1) AS seg
  FROM pages
), hosts AS (SELECT DISTINCT h, CAST('0x' || substr(md5(h), 1, 7) AS BIGINT) AS n FROM cap WHERE h IS NOT NULL),
doms AS (SELECT DISTINCT regexp_extract(h, '([^.]+\.[^.]+)$', 1) AS d FROM hosts),
entries AS (
  SELECT 'spam' AS list, h AS key, 'add' AS action, DATE '2024-01-01' + CAST(n % 300 AS INTEGER) AS day FROM hosts WHERE n % 3 = 0
  UNION ALL SELECT 'spam', h, 'remove', DATE '2024-01-01' + CAST(n % 300 + 20 + n % 50 AS INTEGER) FROM hosts WHERE n % 3 = 0
  UNION ALL SELECT 'spam', h, 'add', DATE '2024-01-01' + CAST(n % 300 + 60 + n % 41 AS INTEGER) FROM hosts WHERE n % 3 = 0
  UNION ALL SELECT 'malware', d, 'add', DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(d), 1, 7) AS BIGINT) % 200 AS INTEGER) FROM doms WHERE d <> '' AND CAST('0x' || substr(md5(d), 1, 7) AS BIGINT) % 2 = 0
  UNION ALL SELECT 'malware', d, 'remove', DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(d), 1, 7) AS BIGINT) % 200 + 45 AS INTEGER) FROM doms WHERE d <> '' AND CAST('0x' || substr(md5(d), 1, 7) AS BIGINT) % 2 = 0
), days AS (SELECT list, key, day, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT list, key, action, day AS from_day, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS to_day FROM days),
valid AS (SELECT * FROM spans WHERE action = 'add'),
hit AS (
  SELECT c.page_id, c.url, c.day, v.list, v.key
  FROM cap c LEFT JOIN valid v
    ON c.day >= v.from_day AND (v.to_day IS NULL OR c.day < v.to_day)
   AND (v.key = c.h OR (ends_with(c.h, '.' || v.key) AND contains(v.key, '.')) OR (c.seg <> '' AND v.key = c.h || '/' || c.seg))
)
SELECT page_id, url, strftime(day, '%Y-%m-%d') AS day, count(DISTINCT list) AS n_lists,
       coalesce(string_agg(DISTINCT list, ',' ORDER BY list), '') AS lists,
       (max(struct_pack(n := length(key), k := key)) FILTER (WHERE key IS NOT NULL)).k AS entry, count(DISTINCT list) > 0 AS blocked
FROM hit GROUP BY page_id, url, day
"""
