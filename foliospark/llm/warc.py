"""Not-modified revisit resolution: an as-of join of revisit records to full responses.

A revisit belongs to the latest full response of the same canonical URL with an earlier time
(strictly; of responses at one time, the largest record id).  Then its validators are
checked: the ETag if both records have one (weak comparison), else Last-Modified if both
have one, else the payload digest if both have one.  Only a revisit that passes gets the
response's headers, with its own value for the headers that a 304 may update.

Outcome, a string: etag, modified or digest (resolved by that validator), mismatch (it has that
validator, with another value), unvalidated (no validator in common), orphan (no earlier
response).  Null or unreadable URLs and null times can't be joined: orphan.  Header names
are compared in lower case; of names that differ only by case the first in order counts.  Equal rows are
resolved alike, each in a row of its own.  Extra columns are ignored; empty tables give
empty results.

Payloads never move: only ids, times, headers and digests do.  A URL may hold a third of all
records, and any number of them one time: records of one (URL, time) become one row before the
shuffle; the times of a URL with more than ``rows`` records are cut at approximate quantiles
of its own into buckets of about that many; only one bucket's times meet in a window, and the last
response of each bucket is carried over to those after it.  The cuts, at most a number for each
``rows`` records, are counted and broadcast if they are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize, short

#: Header fields that a 304 response may carry to update a stored one (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Records of a URL whose times meet in one window.
ROWS = 100_000
_HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """host/path?query: no scheme, user, default port, leading www, utm_ parameters, fragment or final slash."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^#]*)", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), r"^www\.|:(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, r"\?(.*)$", 1), r"(?:^|&)utm_[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _headers(c: Column) -> Column:
    low = F.transform(F.map_entries(c), lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("value")))
    low = F.array_sort(F.filter(low, lambda e: e["value"].isNotNull()))
    return F.filter(low, lambda e, i: (i == 0) | (F.get(low, i - 1)["name"] != e["name"]))


def _value(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda e: e["name"] == name), 0)["value"]


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def _buckets(good: DataFrame, rows: int) -> DataFrame:
    """The records with the number of their bucket among those of their URL."""
    heavy = good.groupBy("url_key").agg(F.count("*").alias("n")).where(F.col("n") > rows)
    heavy = materialize(heavy, "warc-heavy", merge=False)
    if not heavy.take(1):
        return good.withColumn("bucket", F.lit(0))
    brief = short(heavy)
    times = good.select("url_key", "ts").join(F.broadcast(heavy) if brief else heavy, "url_key")
    # A histogram of fixed size for each URL, then its quantiles.
    cuts = times.groupBy("url_key").agg(F.max("n").alias("n"), F.percentile_approx("ts", [k / 1000 for k in range(1, 1000)], 10_000).alias("q"))
    step = F.greatest(F.lit(1), F.floor(F.lit(1000) * rows / F.col("n")).cast("int"))
    cuts = cuts.select("url_key", F.array_sort(F.array_distinct(F.filter("q", lambda x, i: (i + 1) % step == 0))).alias("cuts"))
    cuts = materialize(cuts, "warc-cuts", merge=False)
    met = good.join(F.broadcast(cuts) if brief else cuts, "url_key", "left")
    return met.withColumn("bucket", F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col("ts"))), F.lit(0))).drop("cuts")


def resolve(records: DataFrame, rows_per_bucket: int = ROWS) -> DataFrame:
    """records: record_id, url, ts (long), kind ('response' or 'revisit'), headers map, digest.

    A row a revisit: record_id, url_key, ts, response_id, outcome, digest, headers (array of
    name and value, by name; null unless resolved).
    """
    rows = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"), "kind", _headers(F.col("headers")).alias("headers"), "digest").where("kind in ('response', 'revisit')")
    rows = materialize(rows, "warc-records")
    can_join = "url_key is not null and ts is not null"
    good = _buckets(rows.where(can_join), rows_per_bucket)

    stored = F.struct("ts", "record_id", "headers", "digest")
    times = good.groupBy("url_key", "bucket", "ts").agg(F.max(F.when(F.col("kind") == "response", stored)).alias("own"), F.max(F.col("kind") == "revisit").alias("asked"))
    times = materialize(times, "warc-times", merge=False)
    # A bucket's carry is the last response of any earlier one; a URL has few buckets.
    last = times.groupBy("url_key", "bucket").agg(F.max("own").alias("own"))
    before = W.partitionBy("url_key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    carry = last.withColumn("carry", F.last("own", ignorenulls=True).over(before)).where("carry is not null").select("url_key", "bucket", "carry")
    inside = W.partitionBy("url_key", "bucket").orderBy("ts").rowsBetween(W.unboundedPreceding, -1)
    near = times.withColumn("near", F.last("own", ignorenulls=True).over(inside)).where("asked")
    hits = near.join(carry, ["url_key", "bucket"], "left").select("url_key", "ts", F.coalesce("near", "carry").alias("hit"))
    found = rows.where(f"kind = 'revisit' and {can_join}").join(hits, ["url_key", "ts"]).select("record_id", "url_key", "ts", "headers", "digest", "hit")
    lost = rows.where(f"kind = 'revisit' and not ({can_join})").select("record_id", "url_key", "ts", "headers", "digest")
    found = found.unionByName(lost, allowMissingColumns=True)

    tag, old_tag = _weak(_value(F.col("headers"), "etag")), _weak(_value(F.col("hit.headers"), "etag"))
    date, old_date = _value(F.col("headers"), "last-modified"), _value(F.col("hit.headers"), "last-modified")
    outcome = (
        F.when(F.col("hit").isNull(), "orphan")
        .when(tag.isNotNull() & old_tag.isNotNull(), F.when(tag == old_tag, "etag").otherwise("mismatch"))
        .when(date.isNotNull() & old_date.isNotNull(), F.when(date == old_date, "modified").otherwise("mismatch"))
        .when(F.col("digest").isNotNull() & F.col("hit.digest").isNotNull(), F.when(F.col("digest") == F.col("hit.digest"), "digest").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    fresh = F.filter(F.col("headers"), lambda e: e["name"].isin(*PERMITTED))
    names = F.transform(fresh, lambda e: e["name"])
    merged = F.array_sort(F.concat(F.filter(F.col("hit.headers"), lambda e: ~F.array_contains(names, e["name"])), fresh))
    resolved = F.col("outcome").isin("etag", "modified", "digest")
    return found.withColumn("outcome", outcome).select(
        "record_id",
        "url_key",
        "ts",
        F.col("hit.record_id").alias("response_id"),
        "outcome",
        F.when(resolved, F.coalesce("hit.digest", "digest")).alias("digest"),
        F.when(resolved, merged).cast(_HEADERS).alias("headers"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Two records a page: its full response, at time page_id, and a later revisit of its URL.

    The revisit's delay and validators come from the md5 of the URL, so that later captures
    of one canonical URL come in between, tags go stale, and some records have only a date or
    a digest.
    """
    v = F.conv(F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 7), 16, 10).cast("long")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", tag.alias("tag"), v.alias("v"))
    day = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    full = base.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        F.col("page_id").alias("ts"),
        F.lit("response").alias("kind"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), day, F.lit("ETag"), F.when(F.col("v") % 5 != 0, F.col("tag")), F.lit("Last-Modified"), F.when(F.col("v") % 10 != 0, day), F.lit("Cache-Control"), F.when(F.col("v") % 2 == 0, "max-age=60"), F.lit("Server"), F.lit("old")).alias("headers"),
        F.col("tag").alias("digest"),
    )
    later = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        "url",
        (F.col("page_id") + 1 + F.col("v") % 1000).alias("ts"),
        F.lit("revisit").alias("kind"),
        F.create_map(F.lit("Content-Type"), F.lit("message/http"), F.lit("Date"), F.lit("now"), F.lit("Expires"), F.lit("later"), F.lit("ETag"), F.when(F.col("v") % 7 == 0, F.lit('"stale"')).otherwise(F.concat(F.lit("W/"), F.col("tag"))), F.lit("Last-Modified"), day, F.lit("cache-control"), F.when(F.col("v") % 3 == 0, "no-store"), F.lit("SERVER"), F.lit("new")).alias("headers"),
        F.col("tag").alias("digest"),
    )
    return full.unionByName(later)
