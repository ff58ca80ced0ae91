"""URL filters by a temporal list join, as column expressions and joins only.

Filter lists change: an entry is added on one day and removed on another. Dated entries become validity intervals, and each capture is judged by the
entries that were active when it was fetched, not by today's list. An entry names a host and covers its subdomains.

Captures are first folded to distinct (host, day) pairs, so a host with a third of all captures costs one row a day in the join; entries are folded to one
action per list, host and day, so the ordered pass over a host's history is bounded by the number of days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

FOREVER = "9999-12-31"  # the end of an interval that is still open


def host_of(url: Column) -> Column:
    """The lower-case host of a URL without user, port and trailing dot; null when there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    bare = F.regexp_replace(host, r"\.+$", "")
    return F.when(bare != "", bare)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, host, valid_from, valid_to): when each entry of (list, host, day, action) holds, the last day excluded.

    ``action`` is `add` or `remove`; of several actions on one day `remove` wins. Adding an active entry again and removing an absent one change nothing. Rows with a
    null or another action are ignored.
    """
    known = entries.filter(
        F.col("list").isNotNull() & F.col("host").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove")
    )
    daily = known.groupBy("list", "host", "day").agg(F.min((F.col("action") == "add").cast("int")).alias("active"))
    history = Window.partitionBy("list", "host").orderBy("day")  # one row per day at most
    spans = daily.withColumn("valid_to", F.lead("day").over(history)).filter("active = 1")
    return spans.select("list", "host", F.col("day").alias("valid_from"), F.coalesce("valid_to", F.lit(FOREVER).cast("date")).alias("valid_to"))


def suffixes(host: Column) -> Column:
    """The host and its parent domains of at least two labels; a host of one label has itself."""
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "day") -> DataFrame:
    """(page_id, host, day, lists, blocked) for every row of ``captures``.

    ``lists`` are the names of the lists with an entry for the host or a parent domain that was active on the day, in order; ``blocked`` says whether there is one. A
    null or unparsable url or a null day has no lists. Repeated rows stay. An empty list blocks nothing; other columns are not read.
    """
    rows = captures.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), F.col(day_col).cast("date").alias("day"))
    asked = rows.filter(F.col("host").isNotNull() & F.col("day").isNotNull()).select("host", "day").distinct()
    asked = asked.select("host", "day", F.explode(suffixes(F.col("host"))).alias("domain"))
    spans = intervals(entries).withColumnRenamed("host", "domain")
    active = asked.join(spans, "domain").filter((F.col("day") >= F.col("valid_from")) & (F.col("day") < F.col("valid_to")))
    verdicts = active.groupBy("host", "day").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    joined = rows.join(verdicts, ["host", "day"], "left")
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return joined.select("page_id", "host", "day", F.array_join(lists, ",").alias("lists"), (F.size(lists) > 0).alias("blocked"))
