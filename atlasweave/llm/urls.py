"""URL filters: captures meet the list entries that were active when they were fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, free_name

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)"
ADDRESS = r"^(\[.*|[0-9]+(\.[0-9]+){3})$"  # hosts that have no parent domains


def url_host(url: Column) -> Column:
    """Lower-case host without dots at its end; '' where the url has none or is null."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", ""), F.lit(""))


def url_keys(url: Column, depths: list[int] | None = None) -> Column:
    """What list entries may name: the host, its parent domains of two labels or more, and host and first path segments.

    Path keys are made of every number of segments, or of those in ``depths`` only.
    A numeric address has no parent domains.
    """
    host = url_host(url)
    labels = F.split(host, r"\.")
    last = F.when(host.rlike(ADDRESS), 1).otherwise(F.greatest(F.size(labels) - 1, F.lit(1)))
    domains = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segments = F.filter(F.split(F.coalesce(F.regexp_extract(url, PATH, 1), F.lit("")), "/"), lambda s: s != "")
    n, none = F.size(segments), F.array().cast("array<int>")
    wanted = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(none) if depths is None else F.filter(F.array(*[F.lit(d) for d in depths]) if depths else none, lambda d: d <= n)
    paths = F.transform(wanted, lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, paths)))


def validity(entries: DataFrame) -> DataFrame:
    """``key``, ``category``, ``start``, ``until`` (null: still) from dated entries (``list``, ``key``, ``action``, ``category``, ``dated``).

    An entry holds from its day until the list's next entry for the key; of entries
    of one day the last by action and category decides, so a removal wins.
    """
    name = F.substring_index("key", "/", 1)
    named = F.concat(F.lower(name), F.regexp_replace(F.substr("key", F.char_length(name) + 1), "/+$", ""))  # hosts have no case, paths have
    days = entries.where("key is not null and dated is not null").select("list", named.alias("key"), "action", "category", F.col("dated").cast("date").alias("start")).distinct()
    last = days.groupBy("list", "key", "start").agg(F.max(F.struct("action", "category")).alias("e"))
    until = F.lead("start").over(Window.partitionBy("list", "key").orderBy("start"))
    return last.withColumn("until", until).where("e.action = 'add'").select("key", F.col("e.category").alias("category"), "start", "until")


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", fetched_col: str = "fetched") -> DataFrame:
    """``captures`` with a struct ``_url``: ``host``, ``blocked``, ``n_active``, ``key``, ``category``, ``listed_on``.

    ``key`` is the longest listed one that was active on the day of the fetch, of
    equally long ones the first, with its latest entry.  Keys and days of captures
    are made distinct before they meet the intervals, so a host with a third of all
    captures brings at most one row a day to that join.

    A null or hostless url and a null fetch time match nothing.  Entries without key
    or date are left out, repeated ones count once; a path's slashes at its end don't
    count.  Repeated captures get equal results; other columns pass through, whatever
    their names, one named ``_url`` is replaced.
    """
    scratch = Scratch(captures.sparkSession, "urls")
    captures = captures.drop("_url")
    uid, hit = free_name("uid", captures.columns), free_name("hit", captures.columns)
    rows = scratch.write(captures.withColumn(uid, F.monotonically_increasing_id()), "captures")
    spans = scratch.write(validity(entries), "validity")
    depth = F.size(F.split("key", "/")) - 1
    depths = sorted(r.d for r in spans.select(depth.alias("d")).where("d > 0").distinct().collect())  # no more than a path has segments
    keyed = rows.select(F.col(uid).alias("uid"), F.col(fetched_col).cast("date").alias("day"), F.explode(url_keys(F.col(url_col), depths)).alias("key"))
    listed = scratch.write(keyed.join(spans.select("key").distinct(), "key", "left_semi"), "listed")
    met = listed.select("key", "day").distinct().join(spans, "key").where("start <= day and (until is null or day < until)")
    active = met.groupBy("key", "day").agg(F.count("*").alias("n"), F.max(F.struct("start", "category")).alias("e"))
    best = F.min(F.struct((-F.char_length("key")).alias("short"), "key", "e")).alias("best")
    found = listed.join(active, ["key", "day"]).groupBy("uid").agg(F.sum("n").alias("n"), best)
    out = rows.join(found.select(F.col("uid").alias(uid), F.struct("n", "best").alias(hit)), uid, "left")
    url = F.struct(
        url_host(F.col(url_col)).alias("host"),
        F.col(hit).isNotNull().alias("blocked"),
        F.coalesce(F.col(f"{hit}.n"), F.lit(0)).cast("long").alias("n_active"),
        F.col(f"{hit}.best.key").alias("key"),
        F.col(f"{hit}.best.e.category").alias("category"),
        F.col(f"{hit}.best.e.start").alias("listed_on"),
    )
    return out.select(*captures.columns, url.alias("_url"))


def _digit(text: Column, at: int) -> Column:
    return F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(text.cast("binary")), at, 1)) - 1


def history(pages: DataFrame) -> DataFrame:
    """Dated entries for a part of the hosts, domains and sections of ``pages``, which come without lists.

    The md5 of a key decides whether it is listed, when, and when it is taken off
    and put on again.
    """
    keys = pages.select(F.explode(url_keys(F.col("url"))).alias("key")).distinct().where(_digit(F.col("key"), 1) < 5)
    first = F.date_add(F.lit("2024-01-01").cast("date"), (_digit(F.col("key"), 2) * 16 + _digit(F.col("key"), 3)).cast("int"))
    category = F.when(_digit(F.col("key"), 4) < 8, "spam").otherwise("adult")
    return (
        keys.withColumn("first", first)
        .withColumn("e", F.explode(F.array(F.struct(F.lit("add").alias("action"), F.lit(0).alias("after")), F.struct(F.lit("remove").alias("action"), F.lit(60).alias("after")), F.struct(F.lit("add").alias("action"), F.lit(110).alias("after")))))
        .select(F.lit("blocklist").alias("list"), "key", "e.action", F.when(F.col("e.after") == 110, "malware").otherwise(category).alias("category"), F.expr("date_add(first, e.after)").alias("dated"))
    )


def op2_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("fetched", F.expr("timestamp '2024-01-01 00:00:00' + make_dt_interval(cast(pmod(page_id * 7, 366) as int), 12)"))
    judged = filter_urls(captures, history(pages))
    return judged.select("page_id", "url", F.col("fetched").cast("date").cast("string").alias("fetched_on"), "_url.host", "_url.blocked", "_url.n_active", "_url.key", "_url.category", F.col("_url.listed_on").cast("string").alias("listed_on"))


OP2_SQL = r"""
WITH u AS (SELECT page_id, url, CAST(DATE '2024-01-01' + CAST((page_id * 7) % 366 AS INTEGER) AS DATE) AS day,
                  regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)', 1)), '\.+$', '') AS host,
                  list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)', 1), '/'), lambda s: s <> '') AS seg FROM pages),
k AS (SELECT page_id, day, unnest(list_distinct(list_concat(
        list_transform(range(1, CASE WHEN regexp_matches(host, '^(\[.*|[0-9]+(\.[0-9]+){3})$') THEN 2 ELSE greatest(len(string_split(host, '.')), 2) END), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
        list_transform(range(1, len(seg) + 1), lambda i: host || '/' || array_to_string(seg[1:i], '/'))))) AS key FROM u WHERE host <> ''),
h AS (SELECT key, md5(key) AS m FROM (SELECT DISTINCT key FROM k)),
x AS (SELECT key, strpos('0123456789abcdef', substr(m, 1, 1)) - 1 AS d1, strpos('0123456789abcdef', substr(m, 2, 1)) - 1 AS d2,
             strpos('0123456789abcdef', substr(m, 3, 1)) - 1 AS d3, strpos('0123456789abcdef', substr(m, 4, 1)) - 1 AS d4 FROM h),
e AS (SELECT key, DATE '2024-01-01' + CAST(d2 * 16 + d3 AS INTEGER) AS first, CASE WHEN d4 < 8 THEN 'spam' ELSE 'adult' END AS cat FROM x WHERE d1 < 5),
v AS (SELECT key, cat AS category, first AS start, first + 60 AS until FROM e UNION ALL SELECT key, 'malware', first + 110, NULL FROM e),
a AS (SELECT k.page_id, k.key, category, start FROM k JOIN v ON k.key = v.key AND start <= day AND (until IS NULL OR day < until)),
b AS (SELECT page_id, count(*) AS n, arg_min((key, category, start), (-length(key), key)) AS best FROM a GROUP BY page_id)
SELECT u.page_id, url, CAST(day AS VARCHAR) AS fetched_on, host, b.page_id IS NOT NULL AS blocked, coalesce(n, 0) AS n_active,
       best[1] AS key, best[2] AS category, CAST(best[3] AS VARCHAR) AS listed_on
FROM u LEFT JOIN b ON b.page_id = u.page_id"""
