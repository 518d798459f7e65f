"""URL filter against a dated list: every capture is judged by the entries that were active when it was fetched.

The entries of a domain, in order of their dates, become validity intervals: each holds until the next one.
A capture's host matches its own domain and all parent domains; the longest domain with an active entry
decides. Intervals are first gathered per host and month, once for each host and month that occurs, so that
a host with very many captures meets its list in one equi-join that splits like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuro.runtime import written

HOST = r"(?i)^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?\[?([^/?#:\]\s]+)"


def host(url: str) -> Column:
    """The lower-cased host without a final dot, or null where the URL has none."""
    found = F.lower(F.regexp_extract(F.col(url), HOST, 1))
    return F.nullif(F.regexp_replace(found, r"\.+$", ""), F.lit(""))


def _month(time: Column) -> Column:
    """Months since year 0."""
    return F.year(time) * 12 + F.month(time)


def intervals(entries: DataFrame) -> DataFrame:
    """(domain, action, since, until) of dated entries (domain, listed_at, action): from each entry to the next.

    Of several entries of one domain and time the greatest action counts ("block" before "allow"). The action
    "remove" ends the one before it. Entries without a domain, time or action count for nothing.
    """
    known = entries.select(
        F.regexp_replace(F.lower(F.trim("domain")), r"^\*?\.+|\.+$", "").alias("domain"), "listed_at", "action"
    ).where("domain != '' AND listed_at IS NOT NULL AND action IS NOT NULL")
    known = known.groupBy("domain", F.col("listed_at").alias("since")).agg(F.max("action").alias("action"))
    # As many rows to a domain as the list has dates for it.
    later = Window.partitionBy("domain").orderBy("since")
    return known.withColumn("until", F.lead("since").over(later)).where("action != 'remove'")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, fetched, verdict, matched, since) for captures (page_id, url, fetched).

    `verdict` is the action of the longest matching domain that has an active entry, else "none";
    `matched` and `since` name the entry. An entry is active from its own time on, up to but not including that of
    the next. A capture without a readable host or without a fetch time gets "none". Repeated rows each give a
    row, other columns are left out, and an empty list gives "none" everywhere.
    """
    captures = captures.select("page_id", "url", "fetched").withColumn("host", host("url"))
    captures = captures.withColumn("month", _month(F.col("fetched")))
    seen = written(captures.select("host", "month").where("host IS NOT NULL AND month IS NOT NULL").distinct(), "hosts")
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    asked = seen.withColumn("domain", F.explode(parents))
    span = written(seen.agg(F.min("month").alias("low"), F.max("month").alias("high")), "span").first()
    active = intervals(entries)
    if span.low is None:
        active = active.limit(0)
    first = F.greatest(_month(F.col("since")), F.lit(span.low or 0))
    last = F.least(F.coalesce(_month(F.col("until")), F.lit(span.high or 0)), F.lit(span.high or 0))
    # One row per month of the captures in which an interval holds.
    active = active.where(first <= last).withColumn("month", F.explode(F.sequence(first, last)))
    rules = asked.join(active, ["domain", "month"])
    rule = F.struct(F.length("domain").alias("depth"), "since", "until", "action", "domain")
    rules = written(rules.groupBy("host", "month").agg(F.collect_list(rule).alias("rules")), "rules")
    joined = captures.join(rules, ["host", "month"], "left")
    holds = F.filter("rules", lambda r: (r["since"] <= F.col("fetched")) & (r["until"].isNull() | (F.col("fetched") < r["until"])))
    best = joined.withColumn("best", F.array_max(holds))
    return best.select(
        "page_id",
        "url",
        "fetched",
        F.coalesce("best.action", F.lit("none")).alias("verdict"),
        F.col("best.domain").alias("matched"),
        F.col("best.since").alias("since"),
    )


def _number(c: Column, start: int) -> Column:
    """Four hex digits of the MD5 of a text as a number."""
    return F.conv(F.substr(F.md5(c), F.lit(start), F.lit(4)), 16, 10).cast("int")


def _day(days: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), days).cast("timestamp_ntz")


def sample_fetch_time(page_id: str) -> Column:
    """The tables have no fetch time: a day of 2024 by the page's number."""
    return _day(F.pmod(F.col(page_id), F.lit(360)).cast("int"))


def sample_list(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of the pages and their parent domains: listed, changed or removed on days that follow from the name."""
    hosts = pages.select(host("url").alias("name")).where("name IS NOT NULL").distinct()
    names = hosts.union(hosts.select(F.regexp_replace("name", r"^[^.]+\.", ""))).distinct()
    kind = F.pmod(_number(F.col("name"), 1), F.lit(4))
    start = F.pmod(_number(F.col("name"), 5), F.lit(200))
    after = start + 30 + F.pmod(_number(F.col("name"), 9), F.lit(100))
    first = names.where(kind < 3).select(
        F.col("name").alias("domain"), _day(start).alias("listed_at"), F.when(kind == 1, "allow").otherwise("block").alias("action")
    )
    second = names.where((kind == 0) | (kind == 1)).select(
        F.col("name").alias("domain"), _day(after).alias("listed_at"), F.when(kind == 0, "remove").otherwise("block").alias("action")
    )
    return first.unionByName(second)


SQL = r"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_days(CAST(page_id % 360 AS INT)) AS fetched,
    nullif(regexp_replace(lower(regexp_extract(url, '(?i)^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?\[?([^/?#:\]\s]+)', 1)),
      '\.+$', ''), '') AS host FROM pages),
hosts AS (SELECT DISTINCT host AS name FROM captures WHERE host IS NOT NULL),
names AS (SELECT name FROM hosts UNION SELECT regexp_replace(name, '^[^.]+\.', '') FROM hosts),
drawn AS (SELECT name, CAST('0x' || substr(md5(name), 1, 4) AS INT) % 4 AS kind,
  CAST('0x' || substr(md5(name), 5, 4) AS INT) % 200 AS start,
  CAST('0x' || substr(md5(name), 9, 4) AS INT) % 100 AS gap FROM names),
entries AS (
  SELECT name AS domain, start AS day, CASE WHEN kind = 1 THEN 'allow' ELSE 'block' END AS action FROM drawn WHERE kind < 3
  UNION ALL
  SELECT name, start + 30 + gap, CASE WHEN kind = 0 THEN 'remove' ELSE 'block' END FROM drawn WHERE kind < 2),
spans AS (SELECT domain, action, TIMESTAMP '2024-01-01' + to_days(day) AS since,
  lead(TIMESTAMP '2024-01-01' + to_days(day)) OVER (PARTITION BY domain ORDER BY day) AS until FROM entries),
matches AS (
  SELECT c.page_id, s.action, s.domain, s.since FROM captures c JOIN spans s
  ON (c.host = s.domain OR c.host LIKE '%.' || s.domain) AND s.since <= c.fetched
  AND (s.until IS NULL OR c.fetched < s.until) AND s.action <> 'remove'),
best AS (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC) = 1)
SELECT c.page_id, c.url, c.fetched, coalesce(b.action, 'none') AS verdict, b.domain AS matched, b.since
FROM captures c LEFT JOIN best b USING (page_id)
"""
