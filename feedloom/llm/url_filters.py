"""URL filters with history: captures against the list entries active when they were fetched.

Dated entries become validity intervals. A capture asks for its URL, its host, the
parent domains and the folders above its path; an as-of join on those and the month
finds the intervals that hold its fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm.common import free_name

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)\.?(?::[0-9]*)?([^?#]*)"


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, null for anything else."""
    host = F.lower(F.regexp_extract(url, _URL, 1))
    return F.when(host != "", F.rtrim(host, F.lit(".")))


def validity(entries: DataFrame) -> DataFrame:
    """(list, kind, value, start, stop) of dated entries (list, kind, value, dated, action).

    An 'add' holds from its date up to, not including, the next entry for the same list, kind and
    value, without end if there is none. On one date an 'add' comes after a 'remove'; other actions,
    null dates and values are left out; repeated entries count once.
    """
    known = entries.filter(F.col("action").isin("add", "remove")).dropna(
        subset=["list", "kind", "value", "dated"]
    )
    known = known.select("list", "kind", "value", "dated", "action").distinct()
    history = Window.partitionBy("list", "kind", "value").orderBy("dated", F.desc("action"))
    return (
        known.withColumn("stop", F.lead("dated").over(history))
        .filter("action = 'add' and (stop is null or stop > dated)")
        .select("list", "kind", "value", F.col("dated").alias("start"), "stop")
    )


def questions(url: Column, depth: int | None = None) -> Column:
    """The (kind, value) pairs a URL asks for, as an array.

    url: the URL without scheme and fragment; host; domain: the host and every parent with
    a dot; folder: host and the first parts of the path, 1 to ``depth`` or all of them.
    """
    host, path = host_of(url), F.regexp_extract(url, _URL, 2)
    labels = F.split(host, r"\.")
    n = F.size(labels)

    def pair(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    rest = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[^:]*://[^/?]*", "")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: pair("domain", F.array_join(F.slice(labels, i, n), ".")),
    )
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    top = F.size(parts) if depth is None else F.least(F.size(parts), F.lit(depth))
    folders = F.when(
        top > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(top, F.lit(1))),
            lambda i: pair("folder", F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))),
        ),
    ).otherwise(F.filter(domains, lambda _: F.lit(False)))
    asked = F.concat(F.array(pair("url", F.concat(host, rest)), pair("host", host)), domains, folders)
    return F.when(host.isNotNull(), F.array_distinct(asked))


def judged(
    captures: DataFrame,
    entries: DataFrame,
    url: str = "url",
    fetched: str = "fetched",
    depth: int | None = None,
) -> DataFrame:
    """The input rows with host, n_entries (intervals that hold), blocked and first_list added.

    ``fetched`` is a date or timestamp, of the type of the entries' ``dated``. Every
    row stays; null or relative URLs and null times match nothing. first_list is the
    first list by name that blocks. Repeated captures are rows of their own; input columns named
    like an added one are replaced, all others stay whatever their names. Intervals are cut at months, so that a host with
    many captures or entries meets in pieces of one month; an interval without
    end is cut off after the last capture.
    """
    rest = [c for c in captures.columns if c.lower() not in ("host", "n_entries", "blocked", "first_list")]
    rid, asks, n, least = (free_name(captures.columns, c) for c in ("rid", "asks", "n", "least"))
    held = written(captures.withColumn(rid, F.monotonically_increasing_id()))
    asked = held.filter(F.col(fetched).isNotNull()).select(
        F.col(rid).alias(asks),
        F.col(fetched).alias("at"),
        F.trunc(F.col(fetched).cast("date"), "month").alias("month"),
        F.inline(questions(F.col(url), depth)),
    )
    first, last = (
        held.agg(*[f(F.trunc(F.col(fetched).cast("date"), "month")) for f in (F.min, F.max)]).first()
    )
    start = F.greatest(F.trunc(F.col("start").cast("date"), "month"), F.lit(first))
    stop = F.least(F.trunc(F.coalesce("stop", F.lit(last)).cast("date"), "month"), F.lit(last))
    intervals = validity(entries).select("*", start.alias("from"), stop.alias("to"))
    months = F.sequence("from", "to", F.expr("interval 1 month"))
    pieces = written(
        intervals.filter(F.col("from") <= F.col("to")).select(
            "list", "kind", "value", "start", "stop", F.explode(months).alias("month")
        )
    )
    holds = (F.col("start") <= F.col("at")) & (F.col("stop").isNull() | (F.col("at") < F.col("stop")))
    found = (
        asked.join(pieces, ["kind", "value", "month"])
        .filter(holds)
        .groupBy(asks)
        .agg(F.count("*").alias(n), F.min("list").alias(least))
    )
    return held.join(found, F.col(rid) == F.col(asks), "left").select(
        *rest,
        host_of(F.col(url)).alias("host"),
        F.coalesce(n, F.lit(0)).alias("n_entries"),
        F.col(n).isNotNull().alias("blocked"),
        F.col(least).alias("first_list"),
    )
