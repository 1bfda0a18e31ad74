"""URL filters with dated lists: every capture meets the entries that were active when it was fetched.

A list is a history of dated additions and removals of patterns.  The history of a
pattern becomes validity intervals; a capture's URL gives the patterns that could
match it (its host, the host's parent domains, its path prefixes), and an as-of
join on pattern and day finds the intervals that hold on the day of the fetch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.llm.common import let

#: Kinds of patterns: one host; a domain with all its subdomains; a host with the first parts of a path.
HOST, DOMAIN, PREFIX = "host", "domain", "prefix"
URL_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?(/[^?#]*)?"


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_to): when a pattern is on a list; valid_to is the first day after, null for open.

    ``entries``: (list, kind, pattern, day, action) with action ``add`` or
    ``remove``, valid from that day on.  On one day a removal wins over an
    addition.  Repeated additions and removals of what is not there change
    nothing.  Entries with a null in any column are left out.
    """
    at = ["list", "kind", "pattern"]
    days = (entries.select(*at, "day", "action").dropna()
            .groupBy(*at, "day").agg(F.max((F.col("action") == "remove")).alias("off")))
    order = Window.partitionBy(*at).orderBy("day")
    turns = (days.withColumn("was_off", F.coalesce(F.lag("off").over(order), F.lit(True)))
             .where("off != was_off").withColumn("valid_to", F.lead("day").over(order)))
    return turns.where("not off").select(*at, F.col("day").alias("valid_from"), "valid_to")


def patterns(url: Column) -> Column:
    """array<struct<kind, pattern>> of all patterns that match a URL; empty for null and for URLs without a host."""
    host = F.lower(F.regexp_extract(url, URL_RE, 1))
    parts = F.filter(F.split(F.regexp_extract(url, URL_RE, 2), "/"), lambda x: x != "")

    def of(h: Column) -> Column:
        labels = F.split(h, r"\.")
        domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
            F.lit(DOMAIN).alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
        prefixes = let(parts, lambda p: F.when(F.size(p) == 0, F.array().cast("array<struct<kind:string,pattern:string>>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: F.struct(
                F.lit(PREFIX).alias("kind"), F.concat(h, F.lit("/"), F.array_join(F.slice(p, 1, i), "/")).alias("pattern")))))
        return F.concat(F.array(F.struct(F.lit(HOST).alias("kind"), h.alias("pattern"))), domains, prefixes)

    return F.when(F.coalesce(host, F.lit("")) == "", F.array().cast("array<struct<kind:string,pattern:string>>")).otherwise(let(host, of))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """All rows and columns of ``captures`` with ``lists`` (sorted names of the lists that hold it) and ``blocked`` added.

    Verdicts are found once for each different URL and day.  The as-of join runs
    on different (pattern, day) pairs, so a host with a third of all captures
    costs one row per pattern and day there.

    * null URL, null day, or a URL without a host: on no list.
    * repeated captures get the same verdict.  No captures give no rows, no entries block nothing.
    """
    u, d = captures[f"`{url}`"], captures[f"`{day}`"].cast("date")
    asked = captures.select(u.alias("u"), d.alias("d")).dropna().distinct()
    keys = asked.select("u", "d", F.explode(F.array_distinct(patterns(F.col("u")))).alias("k")).select("u", "d", "k.kind", "k.pattern")
    valid = intervals(entries)
    on_list = valid.select("kind", "pattern").distinct()
    keys = keys.join(on_list, ["kind", "pattern"], "left_semi")
    hits = (keys.select("kind", "pattern", "d").distinct().join(valid, ["kind", "pattern"])
            .where((F.col("valid_from") <= F.col("d")) & (F.col("valid_to").isNull() | (F.col("d") < F.col("valid_to"))))
            .select("kind", "pattern", "d", "list"))
    verdicts = (keys.join(hits, ["kind", "pattern", "d"]).groupBy("u", "d")
                .agg(F.array_sort(F.collect_set("list")).alias("found")))
    kept = [c for c in captures.columns if c not in ("lists", "blocked")]
    out = captures.join(verdicts, (u == verdicts["u"]) & (d == verdicts["d"]), "left")
    found = F.coalesce(verdicts["found"], F.array().cast("array<string>"))
    return out.select(*[captures[f"`{c}`"] for c in kept], F.array_join(found, ",").alias("lists"), (F.size(found) > 0).alias("blocked"))


#: Lists of the registered query: name and a word of the hosts it holds.
HOST_WORDS = (("adult", "adult"), ("ads", "ads-"), ("gambling", "bets"), ("pharma", "pills"), ("spam", "spam"))


def demo_captures(pages: DataFrame) -> DataFrame:
    """Every page with a day of 2024 on which it was fetched, from id and URL."""
    n = F.pmod(F.coalesce("page_id", F.lit(0)) * 37 + F.length(F.coalesce("url", F.lit(""))), F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), n).alias("fetched_on"))


def demo_entries(pages: DataFrame) -> DataFrame:
    """A dated list history from the hosts of all pages.

    Hosts with a list's word are on it as domains from some day to a later one
    and again at the end of the year; a tenth of all hosts is under review for 20
    days; on a seventh the path /de is held from some day on.
    """
    host = F.lower(F.regexp_extract("url", URL_RE, 1))
    hosts = pages.select(host.alias("host")).where("host != ''").distinct()

    def number(at: int) -> Column:
        return F.conv(F.substring(F.md5("host"), at, 6), 16, 10).cast("int")

    hosts = hosts.select("host", number(1).alias("a"), number(7).alias("b"), number(13).alias("c"))

    def entry(name: Column, kind: str, pattern: Column, day: Column, action: str) -> Column:
        return F.struct(name.alias("list"), F.lit(kind).alias("kind"), pattern.alias("pattern"),
                        F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("day"), F.lit(action).alias("action"))

    domain = F.regexp_replace("host", r"^(www|m|blog)\.", "")
    rows = []
    for name, word in HOST_WORDS:
        first, last = F.col("a") % 200, F.col("a") % 200 + 30 + F.col("b") % 100
        own = F.array(entry(F.lit(name), DOMAIN, domain, first, "add"), entry(F.lit(name), DOMAIN, domain, last, "remove"),
                      entry(F.lit(name), DOMAIN, domain, F.lit(335), "add"))
        rows.append(hosts.where(F.contains("host", F.lit(word))).select(F.explode(own).alias("e")))
    start = F.col("b") % 300
    rows.append(hosts.where("c % 10 = 0").select(F.explode(F.array(
        entry(F.lit("review"), HOST, F.col("host"), start, "add"), entry(F.lit("review"), HOST, F.col("host"), start + 20, "remove"))).alias("e")))
    rows.append(hosts.where("c % 7 = 0").select(entry(F.lit("hold"), PREFIX, F.concat("host", F.lit("/de")), F.col("a") % 300, "add").alias("e")))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.select("e.*")


#: The registered query in DuckDB SQL.
ORACLE = """
WITH hosts AS (
  SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS INT) AS a, CAST('0x' || substr(md5(host), 7, 6) AS INT) AS b,
         CAST('0x' || substr(md5(host), 13, 6) AS INT) AS c
  FROM (SELECT DISTINCT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host FROM pages)
  WHERE host <> ''),
listed AS (
  SELECT w.name AS list, 'domain' AS kind, regexp_replace(host, '^(www|m|blog)\\.', '') AS pattern, a, b
  FROM hosts JOIN (VALUES ('adult', 'adult'), ('ads', 'ads-'), ('gambling', 'bets'), ('pharma', 'pills'), ('spam', 'spam')) w(name, word)
    ON contains(host, word)),
entries AS (
  SELECT list, kind, pattern, a % 200 AS n, FALSE AS off FROM listed
  UNION ALL SELECT list, kind, pattern, a % 200 + 30 + b % 100, TRUE FROM listed
  UNION ALL SELECT list, kind, pattern, 335, FALSE FROM listed
  UNION ALL SELECT 'review', 'host', host, b % 300, FALSE FROM hosts WHERE c % 10 = 0
  UNION ALL SELECT 'review', 'host', host, b % 300 + 20, TRUE FROM hosts WHERE c % 10 = 0
  UNION ALL SELECT 'hold', 'prefix', host || '/de', a % 300, FALSE FROM hosts WHERE c % 7 = 0),
days AS (SELECT list, kind, pattern, n, bool_or(off) AS off FROM entries GROUP BY ALL),
captures AS (
  SELECT page_id, url, CAST((coalesce(page_id, 0) * 37 + length(coalesce(url, ''))) % 366 AS INT) AS n,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         [x for x in string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?', 1), '/') if x <> ''] AS parts
  FROM pages),
asked AS (
  SELECT page_id, url, n, 'host' AS kind, host AS pattern FROM captures WHERE host <> ''
  UNION ALL SELECT page_id, url, n, 'domain', unnest([array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')
      for i in range(1, len(string_split(host, '.')) + 1)]) FROM captures WHERE host <> ''
  UNION ALL SELECT page_id, url, n, 'prefix', unnest([host || '/' || array_to_string(list_slice(parts, 1, i), '/')
      for i in range(1, len(parts) + 1)]) FROM captures WHERE host <> ''),
latest AS (
  SELECT q.page_id, q.url, d.list, arg_max(d.off, d.n) AS off
  FROM asked q JOIN days d ON q.kind = d.kind AND q.pattern = d.pattern AND d.n <= q.n
  GROUP BY q.page_id, q.url, d.list, d.kind, d.pattern),
found AS (SELECT page_id, url, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM latest WHERE NOT off GROUP BY ALL)
SELECT c.page_id, c.url, CAST(DATE '2024-01-01' + c.n AS DATE) AS fetched_on, coalesce(f.lists, '') AS lists, f.lists IS NOT NULL AS blocked
FROM captures c LEFT JOIN found f ON c.page_id = f.page_id AND c.url = f.url
"""
