"""URL filtering against dated lists.

List entries come as dated events (pattern, listed or delisted).  Events of
one pattern become validity intervals: a change holds until the pattern's
next one.  A capture is blocked when, at its fetch time, an interval of its
host or of one of the host's parent domains is open (from <= fetched < until).

Captures are reduced to their distinct (host, fetch time) before the join,
so a host with a third of all rows is joined once a time; decisions are
joined back on both.

Defined cases: a null or hostless URL and a null fetch time are not blocked;
events with a null pattern or time are ignored; of several events of one
pattern and time a listing wins; repeated captures get equal rows; an empty
list blocks nothing; columns named as a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.llm.common import without


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null if there is none."""
    host = F.regexp_extract(F.lower(url), "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.regexp_replace(host, "\\.$", "")
    return F.when(host != "", host)


def validity(events: DataFrame, pattern: str = "pattern", at: str = "at", listed: str = "listed") -> DataFrame:
    """Intervals (pattern, valid_from, valid_until) in which patterns are listed."""
    state = (events.where(F.col(pattern).isNotNull() & F.col(at).isNotNull())
             .groupBy(F.lower(F.col(pattern)).alias("pattern"), F.col(at).alias("valid_from"))
             .agg(F.max(F.coalesce(F.col(listed), F.lit(False))).alias("on")))
    following = Window.partitionBy("pattern").orderBy("valid_from")
    return (state.withColumn("valid_until", F.lead("valid_from").over(following)).where("on")
            .select("pattern", "valid_from", "valid_until"))


def filter_urls(captures: DataFrame, intervals: DataFrame, url_col: str = "url", at_col: str = "fetched") -> DataFrame:
    """All columns of ``captures`` plus ``host``, ``pattern`` (the longest
    open one) and ``blocked``."""
    captures = without(captures, "host", "pattern", "blocked")
    c = captures.withColumn("host", url_host(F.col(f"`{url_col}`")))
    seen = c.select("host", F.col(f"`{at_col}`").alias("at")).where("host is not null and at is not null").distinct()
    labels = F.split("host", "\\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keyed = seen.select("host", "at", F.explode(domains).alias("key"))
    hits = keyed.join(intervals, (F.col("key") == F.col("pattern")) & (F.col("at") >= F.col("valid_from"))
                      & (F.col("valid_until").isNull() | (F.col("at") < F.col("valid_until"))))
    found = (hits.groupBy(F.col("host").alias("f_host"), F.col("at").alias("f_at"))
             .agg(F.max_by("pattern", F.struct(F.length("pattern"), "pattern")).alias("pattern")))
    out = c.join(found, (F.col("host") == F.col("f_host")) & (F.col(f"`{at_col}`") == F.col("f_at")), "left")
    return out.select(*[F.col(f"`{x}`") for x in captures.columns], "host", "pattern", F.col("pattern").isNotNull().alias("blocked"))
