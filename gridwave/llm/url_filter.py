"""URL filters: captures against dated lists, in DataFrame expressions only.

A list is a history: dated entries that put a host pattern on the list or take
it off.  Entries become validity intervals [from, until).  A capture is blocked
if its host, or a parent domain of it, has an interval that holds its fetch
day: an as-of join, since each interval is the state left by the latest entry
on or before that day.

A verdict hangs only on (host, fetch day), so captures are first reduced to
those pairs (a partial aggregate that shrinks hot hosts before the shuffle),
joined there, and the verdicts joined back on both columns: a hot host is
spread over its days.  Parent domains are emitted per pair, not per capture.

Defined cases: no host or no fetch day gives ``blocked`` false and no category;
several entries of a pattern on one day: the last in (action, category) order
holds, so ``remove`` wins; an entry with a null pattern, day or action is
ignored; repeated captures keep one row each.  No
captures give no rows; no entries block nothing.  Extra columns of either table,
whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
FOREVER = "9999-12-31"


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL without a trailing dot; else null."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    return F.when(host != "", host)


def parent_domains(host: Column, most: int) -> Column:
    """The host and every domain above it: a.b.c, b.c, c; those of ``most`` labels at most."""
    labels = F.split(host, r"\.")
    first = F.greatest(F.lit(1), F.size(labels) - F.lit(most - 1))
    return F.transform(F.sequence(first, F.size(labels)),
                       lambda i: F.array_join(F.slice(F.split(host, r"\."), i, F.size(labels)), "."))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Dated entries (pattern, day, action add|remove, category) as intervals.

    Each ``add`` holds until the pattern's next entry, exclusive.
    """
    good = entries.filter(F.col("pattern").isNotNull() & F.col("day").isNotNull()
                          & F.col("action").isin("add", "remove"))
    daily = good.groupBy("pattern", "day").agg(F.max(F.struct("action", "category")).alias("e"))
    until = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    held = daily.select("pattern", F.col("day").alias("valid_from"),
                        F.coalesce(until, F.lit(FOREVER).cast("date")).alias("valid_until"),
                        F.col("e.action").alias("action"), F.col("e.category").alias("category"))
    return held.filter(F.col("action") == "add").drop("action")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str,
             day_col: str) -> DataFrame:
    """Per capture: id, host, fetch day, ``blocked``, the number of active
    entries and their categories (distinct, sorted, comma-joined)."""
    rows = captures.select(F.col(id_col), url_host(F.col(url_col)).alias("host"),
                           F.col(day_col).alias("fetch_day"))
    pairs = rows.filter(F.col("host").isNotNull() & F.col("fetch_day").isNotNull()) \
        .groupBy("host", "fetch_day").agg(F.lit(1).alias("one")).drop("one")
    # A longer domain than the longest pattern cannot be listed.
    most = entries.agg(F.max(F.size(F.split("pattern", r"\.")))).first()[0] or 1
    wanted = pairs.withColumn("pattern", F.explode(parent_domains(F.col("host"), max(1, most))))
    spans = validity_intervals(entries)
    hits = wanted.join(spans, "pattern").filter(
        (F.col("valid_from") <= F.col("fetch_day")) & (F.col("fetch_day") < F.col("valid_until")))
    verdicts = hits.groupBy("host", "fetch_day").agg(
        F.count(F.lit(1)).alias("n_active"),
        F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"))
    return rows.join(verdicts, ["host", "fetch_day"], "left").select(
        id_col, "host", "fetch_day", F.col("n_active").isNotNull().alias("blocked"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("categories", F.lit("")).alias("categories"))


# --- captures and list entries derived from ``pages`` ---------------------------------

FIRST_DAY = "2024-01-01"
DAYS = 366
STRIDE = 37             # spreads page ids over the days
CATEGORIES = ("adult", "malware", "spam")


def _digits(value: Column, start: int, n: int) -> Column:
    """``n`` hex digits of the value's md5 as a number."""
    return F.conv(F.substring(F.md5(value), start, n), 16, 10).cast("int")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """``pages`` holds no fetch time; give each page a day of 2024 by its id."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"),
                     F.pmod(F.col("page_id") * STRIDE, F.lit(DAYS)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetch_day"))


def entries_of_pages(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of ``pages`` and the two-label domains above them.

    Every pattern gets 0 to 3 entries by its md5: added, removed, added again.
    """
    host = url_host(F.col("url"))
    hosts = pages.select(host.alias("host")).filter("host IS NOT NULL").distinct()
    above = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    patterns = hosts.select(F.explode(F.array_distinct(F.array("host", above))).alias("pattern")) \
        .filter("pattern <> ''").distinct()
    p = F.col("pattern")
    n = F.pmod(_digits(p, 1, 2), F.lit(4))
    category = F.element_at(F.array(*map(F.lit, CATEGORIES)), _digits(p, 3, 2) % len(CATEGORIES) + 1)
    first = F.lit(FIRST_DAY).cast("date")
    day = lambda i: F.date_add(first, _digits(p, 5 + 2 * i, 2) % 120 + 120 * i)
    entry = lambda i, action: F.struct(F.lit(i).alias("i"), day(i).alias("day"),
                                       F.lit(action).alias("action"))
    all_entries = F.array(entry(0, "add"), entry(1, "remove"), entry(2, "add"))
    return patterns.withColumn("e", F.explode(F.slice(all_entries, F.lit(1), n))) \
        .select("pattern", "e.day", "e.action", category.alias("category"))
