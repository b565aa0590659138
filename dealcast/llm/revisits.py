"""Not-modified revisits of a web archive, resolved by an as-of join.

Records are ``record_id, url, ts, kind, headers, payload_digest``: full responses
(kind ``response``) and answers that the page is unchanged (kind ``revisit``). A
revisit refers to the latest response of its canonical URL that is earlier than
itself (of several at that time, the one with the largest id). Its validators
must agree with it: the ETag if the revisit has one (weak comparison), else
Last-Modified. Of its headers those that a 304 answer may renew replace the
response's; all others are the response's.

The join is distributed whatever one URL holds: records are cut into slices by
(canonical URL, time), each slice carries its last response forward in its own
window, and what a slice must know of the slices before it is one row a slice.
Only ids and times are sorted; headers are joined to the found pairs by id.

``outcome``: resolved, mismatch (a validator differs), unverified (the revisit
or the response has no validator to compare), orphan (no earlier response) or
no_url. Merged headers and the payload's digest are there for resolved and
unverified revisits only.

Defined results: each revisit gives one row, repeated rows their own; a null url
is ``no_url``; a null time is later than nothing, so ``orphan``; responses
without url or time are never referred to; null headers are empty, names are
compared in lower case. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from dealcast.llm import common as C

# Headers of a 304 answer that replace the stored ones.
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that don't name another page.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """Scheme-free, host in lower case without www. and default port, no
    fragment, no tracking parameters, others in order, no / at the path's end."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^([^/?]*)", 1)), "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, "^[^?]*\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def _lower_keys(headers: Column) -> Column:
    """Names in lower case; of names that differ in case only, the last counts."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(
        F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"]))


def earlier_responses(records: DataFrame, slices: int | None = None) -> DataFrame:
    """(row, refers_to_row): for each revisit row the response row it refers to,
    or null. ``records``: row, site (canonical URL), ts, record_id, kind."""
    n = slices or C.partitions(records.sparkSession)
    keys = (records.where(F.col("site").isNotNull() & F.col("ts").isNotNull())
            .select("site", "ts", (F.col("kind") == "response").cast("int").alias("full"), "record_id", "row"))
    # at one time revisits come first: a response of the same time isn't earlier
    cut = C.materialize(keys.repartitionByRange(n, "site", "ts", "full", "record_id", "row").withColumn("_slice", F.spark_partition_id()))
    order = [F.col("ts"), F.col("full"), F.col("record_id").asc_nulls_first(), F.col("row")]
    own = F.when(F.col("full") == 1, F.col("row"))
    within = Window.partitionBy("_slice", "site").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumn("_local", F.last(own, ignorenulls=True).over(within))
    # a slice can only continue its first site: a row a slice
    first = cut.groupBy("_slice").agg(F.min("site").alias("site"))
    wanted = first.select("site").distinct()
    last = (cut.where("full = 1").join(F.broadcast(wanted), "site")
            .groupBy("site", "_slice").agg(F.max(F.struct("ts", "record_id", "row"))["row"].alias("end")))
    steps = (first.join(last, ["site", "_slice"], "full_outer")
             .withColumn("_carry", F.last("end", ignorenulls=True).over(
                 Window.partitionBy("site").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))))
    carried = steps.where(F.col("_carry").isNotNull()).select("site", "_slice", "_carry")  # at most two rows a slice
    return (local.where("full = 0").join(F.broadcast(carried), ["site", "_slice"], "left")
            .select("row", F.coalesce("_local", "_carry").alias("refers_to_row")))


def resolve_revisits(records: DataFrame, slices: int | None = None) -> DataFrame:
    """A row for each revisit: record_id, site, ts, refers_to (a record_id),
    outcome, headers (merged, names in lower case) and payload_digest."""
    base = C.materialize(records.select("record_id", canonical_url(F.col("url")).alias("site"), F.col("ts").cast("long").alias("ts"), "kind",
                                        _lower_keys(F.col("headers")).alias("headers"), "payload_digest")
                         .withColumn("row", F.monotonically_increasing_id()))
    pairs = earlier_responses(base, slices)
    stored = base.where("kind = 'response'").select(F.col("row").alias("refers_to_row"), F.col("record_id").alias("refers_to"),
                                                    F.col("headers").alias("stored"), "payload_digest")
    found = (base.where("kind = 'revisit'").drop("payload_digest").join(pairs, "row", "left").join(stored, "refers_to_row", "left"))

    def weak(h: Column) -> Column:
        return F.regexp_replace(F.trim(h), "^W/", "")

    etag, modified = F.col("headers")["etag"], F.col("headers")["last-modified"]
    old_etag, old_modified = F.col("stored")["etag"], F.col("stored")["last-modified"]
    agrees = (F.when(etag.isNotNull() & old_etag.isNotNull(), weak(etag) == weak(old_etag))
              .when(etag.isNull() & modified.isNotNull() & old_modified.isNotNull(), F.trim(modified) == F.trim(old_modified)))
    outcome = (F.when(F.col("site").isNull(), "no_url").when(F.col("refers_to_row").isNull(), "orphan")
               .when(agrees.isNull(), "unverified").when(agrees, "resolved").otherwise("mismatch"))
    renewed = F.map_filter("headers", lambda k, v: k.isin(*RENEWED))
    merged = F.map_concat(F.map_filter("stored", lambda k, v: ~F.array_contains(F.map_keys(renewed), k)), renewed)
    good = F.col("outcome").isin("resolved", "unverified")
    return (found.withColumn("outcome", outcome)
            .select("record_id", "site", "ts", F.when(F.col("outcome") != "no_url", F.col("refers_to")).alias("refers_to"), "outcome",
                    F.when(good, merged).alias("headers"), F.when(good, F.col("payload_digest")).alias("payload_digest")))


def crawl_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records made of a table of pages: a response for each page, and by
    the page's number up to three revisits of its URL, some with validators that
    agree, some that differ, some with none, some before the response."""
    p = F.col("page_id").cast("long")
    ts = F.lit(1_700_000_000) + F.pmod(p * 7919, F.lit(100_000)) * 60
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    modified = (ts - 86_400).cast("string")

    def headers(at: Column, *more: tuple[str, Column]) -> Column:
        return F.create_map(F.lit("Date"), at.cast("string"), *[x for k, v in more for x in (F.lit(k), v)])

    def record(number: int, when: Column, at: Column, kind: str, head: Column, digest: Column) -> Column:
        return F.when(when, F.struct((p * 4 + number).alias("record_id"), at.alias("ts"), F.lit(kind).alias("kind"),
                                     head.alias("headers"), digest.alias("payload_digest")))

    none = F.lit(None).cast("string")
    second = ts + 7200 + F.pmod(p, F.lit(7)) * 3600
    rows = F.array(
        record(0, F.lit(True), ts, "response",
               headers(ts, ("Content-Type", F.lit("text/html")), ("ETag", tag), ("Last-Modified", modified), ("Server", F.lit("a"))),
               F.md5(F.coalesce("html", F.lit("")))),
        record(1, p % 2 == 0, ts + 3600, "revisit",
               headers(ts + 3600, ("etag", F.concat(F.lit("W/"), tag)), ("Cache-Control", F.lit("max-age=60")), ("Server", F.lit("b"))), none),
        record(2, (p % 3 == 0) & (p % 9 != 0), second, "revisit", headers(second, ("Last-Modified", modified), ("Expires", F.lit("0"))), none),
        record(2, p % 9 == 0, second, "revisit", headers(second, ("ETag", F.lit('"other"'))), none),
        record(3, p % 5 == 0, ts - 1800, "revisit", headers(ts - 1800, ("Content-Length", F.lit("0"))), none))
    return (pages.select("url", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("url", "r.*"))


def digest(found: DataFrame) -> DataFrame:
    """The registered query's columns: headers as sorted text."""
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return found.select("record_id", "site", "ts", "refers_to", "outcome", F.array_join(lines, "\n").alias("headers"), "payload_digest")
