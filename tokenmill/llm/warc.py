"""Not-modified revisits resolved against the latest earlier full response.

An as-of join by canonical URL: each revisit (status 304) takes the latest full
response (status 200) that precedes it in the order (time, record id). Validators
must agree; then the stored headers are updated by those a 304 may change.

A URL may hold a third of all captures, so its history is split by time: a running
window finds the latest full response inside (URL, time slice), and one row per
slice carries the last full response over to later slices. Captures are shuffled
once; the carry works on one row per URL and slice.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower

FULL, REVISIT = 200, 304
#: Time slices of a URL's history, in seconds.
SLICE_SECONDS = 6 * 3600
#: Query parameters that do not name another resource.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "fbclid", "gclid")
#: Fields that describe a stored body or one connection; a 304 never changes them.
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
              "proxy-authenticate", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default ports, fragment, tracking parameters, the order of the
    others and a final slash don't count; null for null or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(
        ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?]*)", 1)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, r"(?s)\?(.*)$", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING)))
    out = F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))
    return F.when(F.contains(url, F.lit("://")), out)


#: What a record must have.
RECORD = ("record_id", "url", "ts", "status", "etag", "last_modified", "headers")


def _weak(etag: Column) -> Column:
    """Weak comparison: the opaque tag alone."""
    return F.regexp_replace(etag, "^W/", "")


def merged_headers(stored: Column, update: Column, not_merged: tuple[str, ...] = NOT_MERGED) -> Column:
    """The stored map with the permitted fields of the 304; names are lower-case, null maps are empty."""
    empty = F.create_map().cast("map<string,string>")
    permitted = F.map_filter(F.coalesce(update, empty), lambda k, _: ~k.isin(*not_merged))
    kept = F.map_filter(F.coalesce(stored, empty), lambda k, _: ~F.map_contains_key(permitted, k))
    return F.map_concat(kept, permitted)


def resolve_revisits(records: DataFrame, payload: tuple[str, ...] = (), slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every record with its outcome, the full response it stands for and the merged headers.

    ``records``: record_id (long), url, ts (timestamp), status (int), etag,
    last_modified (strings), headers (map of lower-case names); ``payload`` names
    further columns of a full response to carry over. Result: all columns of
    ``records`` (payload columns and headers as resolved) and

    * ``refers_to``: record id of the full response; its own for a full response
    * ``outcome``: ``full``; ``resolved`` (a validator agrees); ``mismatch`` (the
      validators differ); ``unvalidated`` (the revisit has no validator that the
      full response has too); ``orphan`` (no earlier full response); ``other``
      (another status)

    An ETag decides where both have one, else Last-Modified. Only ``resolved`` rows
    take payload and headers. A null or relative url has no history: a revisit is an
    orphan. A null time precedes every other; ties in time go by record id; a
    repeated record counts each time and results are alike. Columns called like an
    output are replaced.
    """
    cols = [c for c in records.columns if c not in ("refers_to", "outcome")]
    # Other columns, whatever they are called, travel in one struct.
    others = [c for c in cols if c not in RECORD and c not in payload]
    records = records.select(*RECORD, *[F.col(f"`{c}`").alias(f"__p{i}") for i, c in enumerate(payload)],
                             F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in others]).alias("__rest"))
    key = canonical_url(F.col("url"))
    # Without a key nothing can match, so those rows are dealt by record id.
    at = F.coalesce(F.floor(F.col("ts").cast("double") / slice_seconds), F.lit(-2 ** 62)).cast("long")
    rows = (records.withColumn("__key", key)
            .withColumn("__slice", F.when(key.isNull(), F.xxhash64("record_id")).otherwise(at)))
    order = [F.col("ts").asc_nulls_first(), F.col("record_id").asc_nulls_first()]
    full = F.struct(F.col("record_id").alias("id"), F.col("etag").alias("etag"),
                    F.col("last_modified").alias("modified"), F.col("headers").alias("headers"),
                    *[F.col(f"__p{i}").alias(f"p{i}") for i in range(len(payload))])
    is_full = (F.col("status") == FULL) & F.col("__key").isNotNull()
    inside = Window.partitionBy("__key", "__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("__near", F.last(F.when(is_full, full), ignorenulls=True).over(inside))

    # The last full response of each slice, then the latest one of any slice before.
    lasts = (records.withColumn("__key", key).withColumn("__slice", at).filter(is_full)
             .groupBy("__key", "__slice")
             .agg(F.max_by(F.col("record_id"), F.struct("ts", "record_id")).alias("id"),
                  F.max_by(full, F.struct("ts", "record_id")).alias("__last")).drop("id"))
    slices = rows.filter("__key is not null").select("__key", "__slice").distinct()
    history = Window.partitionBy("__key").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (slices.join(lasts, ["__key", "__slice"], "left")
               .withColumn("__carried", F.last("__last", ignorenulls=True).over(history))
               .select(F.col("__key").alias("__c_key"), F.col("__slice").alias("__c_slice"), "__carried"))
    both = near.join(carried, (F.col("__key") == F.col("__c_key")) & (F.col("__slice") == F.col("__c_slice")), "left")

    found = F.coalesce(F.col("__near"), F.col("__carried"))
    etags = F.col("etag").isNotNull() & F.col("__found.etag").isNotNull()
    dates = F.col("last_modified").isNotNull() & F.col("__found.modified").isNotNull()
    outcome = (F.when(F.col("status") == FULL, "full").when(F.col("status").isNull() | (F.col("status") != REVISIT), "other")
               .when(F.col("__found").isNull(), "orphan")
               .when(etags, F.when(_weak(F.col("etag")) == _weak(F.col("__found.etag")), "resolved").otherwise("mismatch"))
               .when(dates, F.when(F.col("last_modified") == F.col("__found.modified"), "resolved").otherwise("mismatch"))
               .otherwise("unvalidated"))
    done = both.withColumn("__found", found).withColumn("__outcome", outcome)
    taken = F.col("__outcome") == "resolved"
    out = []
    for c in cols:
        if c == "headers":
            out.append(F.when(taken, merged_headers(F.col("__found.headers"), F.col(c))).otherwise(F.col(c)).alias(c))
        elif c in payload:
            i = payload.index(c)
            out.append(F.when(taken, F.col(f"__found.p{i}")).otherwise(F.col(f"__p{i}")).alias(c))
        else:
            out.append(F.col(c) if c in RECORD else F.col("__rest").getField(c).alias(c))
    refers = F.when(F.col("__outcome") == "full", F.col("record_id")).when(
        F.col("__outcome").isin("resolved", "mismatch", "unvalidated"), F.col("__found.id"))
    return done.select(*out, refers.alias("refers_to"), F.col("__outcome").alias("outcome"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A capture history from a table of pages: each page is fetched one to four times.

    The first fetch is a full response with the page's digest and length; a later one
    answers 304, or in one of seven cases 200 with another body. ETags are weak on
    revisits, missing for one page in five, and outdated on some revisits; times
    follow the page id. All values derive from page_id, url and html.
    """
    def number(c: Column) -> Column:
        return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long")
    h = number(F.col("page_id"))
    base = F.md5(F.coalesce(F.col("html"), F.lit("")))
    each = pages.select("page_id", "url", F.coalesce(F.length("html"), F.lit(0)).alias("n_chars"), base.alias("digest"),
                        h.alias("h"), F.explode(F.sequence(F.lit(0), (h % 4).cast("int"))).alias("visit"))
    record = F.col("page_id") * 4 + F.col("visit")
    kind = number(record)
    again = (F.col("visit") > 0) & (kind % 7 != 0)
    version = F.when(F.col("visit") == 0, F.lit("0")).otherwise(F.lit("1"))
    # What a fresh fetch serves; a revisit repeats the first version, one in eleven a stale tag.
    tag = F.substring(F.md5(F.concat(F.col("digest"), F.when(again, F.when(kind % 11 == 0, "stale").otherwise("0")).otherwise(version))), 1, 12)
    seconds = (F.col("page_id") * 37 % 86400) * 30 + F.col("visit") * 40000
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + seconds)
    has_tag = F.col("h") % 5 != 0
    headers = F.map_from_arrays(
        F.array(F.lit("date"), F.lit("content-length"), F.lit("x-visit")),
        F.array(F.concat(F.lit("t"), (F.lit(1_700_000_000) + seconds).cast("string")),
                F.when(again, F.lit("0")).otherwise(F.col("n_chars").cast("string")), F.col("visit").cast("string")))
    return each.select(
        record.alias("record_id"), "url", ts.alias("ts"), F.when(again, F.lit(REVISIT)).otherwise(F.lit(FULL)).alias("status"),
        F.when(has_tag, F.concat(F.when(again, F.lit("W/")).otherwise(F.lit("")), F.lit('"'), tag, F.lit('"'))).alias("etag"),
        F.when(F.col("h") % 3 != 0, F.concat(F.lit("m"), F.when(again, F.lit("0")).otherwise(version))).alias("last_modified"),
        headers.alias("headers"), F.when(~again, F.concat(F.col("digest"), F.lit("-"), version)).alias("digest"),
        F.when(~again, F.col("n_chars")).alias("n_chars"))
