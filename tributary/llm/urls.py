"""URL filters as a temporal list join (operator 7).

The list is a log of dated entries ``(entry, at, action)``: a host (which
covers its subdomains) or a host with the first path segment is added or
removed. Per entry the log becomes validity intervals ``[from, to)``. Every
capture has a few candidate entries (its host's suffixes and its path prefix);
an equi-join on the entry and the test ``from <= fetched < to`` give the
entries active when it was fetched.

Captures are reduced to distinct ``(url, fetched)`` first, an entry's
intervals are one row, so a host with a third of all captures makes rows in
proportion to its captures, and adaptive execution can split its key.

Defined results: a null or unparsable url has no candidates and is allowed; a
null fetch time matches no interval; several log lines of one entry at one time
count by the last action in ``add`` < ``remove``; repeated captures stay
rows; an empty list allows all; clashing extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def host(url: F.Column) -> F.Column:
    """Lower-case host without user, port, trailing dot; null if there is none."""
    h = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(h, r"\.$", ""), F.lit(""))


def candidates(url: F.Column) -> F.Column:
    """The entries that could cover a url: every suffix of its host of two labels or more, and host/segment."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                           lambda i: F.array_join(F.slice(labels, i, n), "."))
    segment = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    path = F.when(segment != "", F.array(F.concat(host(url), F.lit("/"), segment))).otherwise(F.array().cast("array<string>"))
    return F.when(host(url).isNotNull(), F.array_distinct(F.concat(suffixes, path)))


def intervals(log: DataFrame) -> DataFrame:
    """``(entry, spans)``: the validity intervals of each listed entry, in one row per entry."""
    one = log.where("entry is not null and at is not null").groupBy("entry", "at").agg(F.max("action").alias("action"))
    w = W.partitionBy("entry").orderBy("at")  # an entry has as many rows as it has changes
    spans = one.select("entry", "action", F.col("at").alias("from"), F.lead("at").over(w).alias("to")).where("action = 'add'")
    return spans.groupBy("entry").agg(F.collect_list(F.struct("from", "to")).alias("spans"))


def blocked(captures: DataFrame, log: DataFrame) -> DataFrame:
    """Captures ``(page_id, url, fetched)`` with n_entries, first_entry (smallest active entry) and blocked."""
    rows = captures.select("page_id", "url", "fetched")
    distinct = rows.where("url is not null and fetched is not null").select("url", "fetched").distinct()
    each = distinct.select("url", "fetched", F.explode(candidates(F.col("url"))).alias("entry"))
    active = each.join(intervals(log), "entry").where(
        "exists(spans, s -> fetched >= s.from and (s.to is null or fetched < s.to))")
    hits = active.groupBy("url", "fetched").agg(F.count(F.lit(1)).alias("n"), F.min("entry").alias("first_entry"))
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return rows.join(hits, ["url", "fetched"], "left").select("page_id", "url", "fetched", n.alias("n_entries"),
                                                              "first_entry", (n > 0).alias("blocked"))
