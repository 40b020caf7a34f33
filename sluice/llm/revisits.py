"""WARC not-modified revisits, resolved by an as-of join on canonical URLs.

A revisit takes the payload of the latest earlier full response of its canonical URL, if their
validators agree; permitted headers of the revisit replace the stored ones. The as-of join is a
window in two levels: the last full response of each (URL, time bucket) is carried to the URL's
later buckets, so that a URL with very many captures is worked on bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_name, table

BUCKET_SECONDS = 4096

# Query parameters that don't tell pages apart, and headers a 304 may not replace.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sid|sessionid)(=|$)"
NOT_REPLACED = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate", "te", "trailer", "transfer-encoding", "upgrade"]


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.`` or ``m.``, port 80/443, fragment, final slashes and
    tracking parameters; the host in lower case, other parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[a-zA-Z]+://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(query), "&"))).otherwise(""))


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per record: record_id, canonical_url, status, refers_to, digest, length, headers.

    ``records``: record_id long, url string, date timestamp, revisit boolean, headers
    map<string,string> (lower-case names), digest string, length long; further columns are ignored.
    status: ``full`` (a full response), ``resolved``, ``no_earlier_response``,
    ``validator_mismatch`` (entity tags differ, or dates where a tag is missing),
    ``no_validator``. Only the latest earlier full response counts; of equal dates the smaller
    record_id is earlier. Unresolved revisits keep their own headers and have no digest or length.
    Null urls or dates match nothing; a null ``revisit`` means a full response; null headers are
    none. Repeated rows give repeated results.
    """
    h = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    rows = records.select(F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("canonical_url"), "date",
                          F.coalesce("revisit", F.lit(False)).alias("revisit"), h.alias("headers"), "digest", F.col("length").cast("long").alias("length"))
    rows = rows.withColumn("bucket", F.floor(F.unix_timestamp("date") / bucket_seconds))
    usable = F.col("canonical_url").isNotNull() & F.col("date").isNotNull()
    full = F.when(~F.col("revisit"), F.struct("record_id", "headers", "digest", "length"))
    rows = rows.withColumn("stored", full)
    lasts = rows.where(usable & ~F.col("revisit")).groupBy("canonical_url", "bucket").agg(F.max_by("stored", F.struct("date", "record_id")).alias("stored"))
    open_buckets = rows.where(usable & F.col("revisit")).groupBy("canonical_url", "bucket").agg(F.lit(True).alias("open"))
    # What stood last before each bucket that has revisits.
    known = lasts.join(open_buckets, ["canonical_url", "bucket"], "full")
    earlier = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = known.withColumn("stored", F.last("stored", ignorenulls=True).over(earlier)).where("open and stored is not null")
    empty = {c: F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns}
    carried = carried.select(*[F.col(c) if c in ("canonical_url", "bucket", "stored") else empty[c] for c in rows.columns])
    within = Window.partitionBy("canonical_url", "bucket").orderBy(F.col("date").asc_nulls_first(), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.where(usable).unionByName(carried).withColumn("target", F.last("stored", ignorenulls=True).over(within))
    joined = joined.where("date is not null").unionByName(rows.where(~usable).withColumn("target", F.lit(None).cast(joined.schema["target"].dataType)))

    mine, theirs = F.col("headers"), F.col("target.headers")
    def tag(headers: Column) -> Column:
        return F.regexp_replace(F.element_at(headers, "etag"), "^W/", "")

    def modified(headers: Column) -> Column:
        return F.element_at(headers, "last-modified")

    same = F.when(tag(mine).isNotNull() & tag(theirs).isNotNull(), tag(mine) == tag(theirs)).otherwise(F.coalesce(modified(mine) == modified(theirs), F.lit(False)))
    status = (F.when(~F.col("revisit"), "full").when(F.col("target").isNull(), "no_earlier_response")
              .when(tag(mine).isNull() & modified(mine).isNull(), "no_validator").when(same, "resolved").otherwise("validator_mismatch"))
    permitted = F.map_filter(mine, lambda k, v: ~k.isin(NOT_REPLACED) & v.isNotNull())
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.map_contains_key(permitted, k)), permitted)
    resolved = F.col("status") == "resolved"
    return joined.withColumn("status", status).select(
        "record_id", "canonical_url", "status", F.when(resolved, F.col("target.record_id")).alias("refers_to"),
        F.when(F.col("status") == "full", F.col("digest")).when(resolved, F.col("target.digest")).alias("digest"),
        F.when(F.col("status") == "full", F.col("length")).when(resolved, F.col("target.length")).alias("length"),
        F.when(resolved, merged).otherwise(mine).alias("headers"))


def with_payload(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Resolved records with the payload of the record they take it from, as column ``payload``."""
    begin = fresh_name(resolved, "from_record")
    source = records.select(F.col("record_id").cast("long").alias(begin), "payload")
    taken = F.when(F.col("status") == "full", F.col("record_id")).otherwise(F.col("refers_to"))
    return resolved.join(source, taken == F.col(begin), "left").drop(begin)


def page_records(pages: DataFrame) -> DataFrame:
    """Capture records made of all ``pages``: one a second in order of page_id.

    A page whose id's MD5 starts with 0 to 4 stands for a not-modified revisit, others for full
    responses. The entity tag goes by canonical URL and span of 20,000 ids, so that a site's
    captures agree until their span ends.
    """
    url = canonical_url(F.col("url"))
    revisit = F.substring(F.md5(F.col("page_id").cast("string")), 1, 1).isin(*"01234")
    when = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id"))
    stamp = F.date_format(when, "yyyy-MM-dd HH:mm:ss")
    etag = F.concat(F.substring(F.md5(url), 1, 12), F.lit("-"), F.floor(F.col("page_id") / 20000).cast("string"))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    kept = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), size.cast("string"), F.lit("date"), stamp, F.lit("etag"), etag)
    short = F.create_map(F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-length"), F.lit("0"), F.lit("date"), stamp, F.lit("etag"), etag)
    return pages.select(F.col("page_id").alias("record_id"), "url", when.alias("date"), revisit.alias("revisit"),
                        F.when(revisit, short).otherwise(kept).alias("headers"), F.md5(F.coalesce("html", F.lit(""))).alias("digest"), size.cast("long").alias("length"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(page_records(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return found.withColumn("headers", F.array_join(lines, "; "))


ORACLE = r"""
WITH parts AS (
  SELECT page_id, html, regexp_replace(regexp_replace(url, '#.*$', ''), '^[a-zA-Z]+://', '') AS bare FROM pages),
urls AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), '^(www|m)\.', ''), ':(80|443)$', '')
      || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
    list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|sid|sessionid)(=|$)'))) AS q FROM parts),
recs AS (
  SELECT page_id, base || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical_url,
    substr(md5(CAST(page_id AS VARCHAR)), 1, 1) IN ('0','1','2','3','4') AS revisit,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y-%m-%d %H:%M:%S') AS stamp,
    md5(coalesce(html, '')) AS own_digest, strlen(coalesce(html, '')) AS own_length FROM urls),
tagged AS (
  SELECT *, substr(md5(canonical_url), 1, 12) || '-' || CAST(page_id // 20000 AS VARCHAR) AS etag,
    last_value(CASE WHEN NOT revisit THEN page_id END IGNORE NULLS) OVER
      (PARTITION BY canonical_url ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS target FROM recs),
found AS (
  SELECT r.*, t.own_digest AS t_digest, t.own_length AS t_length,
    CASE WHEN NOT r.revisit THEN 'full' WHEN t.page_id IS NULL THEN 'no_earlier_response'
      WHEN r.etag = t.etag THEN 'resolved' ELSE 'validator_mismatch' END AS status
  FROM tagged r LEFT JOIN tagged t ON r.target = t.page_id)
SELECT page_id AS record_id, canonical_url, status, CASE WHEN status = 'resolved' THEN target END AS refers_to,
  CASE status WHEN 'full' THEN own_digest WHEN 'resolved' THEN t_digest END AS digest,
  CASE status WHEN 'full' THEN own_length WHEN 'resolved' THEN t_length END AS length,
  CASE status
    WHEN 'full' THEN 'content-length: ' || own_length || '; content-type: text/html; date: ' || stamp || '; etag: ' || etag
    WHEN 'resolved' THEN 'cache-control: max-age=60; content-length: ' || t_length || '; content-type: text/html; date: ' || stamp || '; etag: ' || etag
    ELSE 'cache-control: max-age=60; content-length: 0; date: ' || stamp || '; etag: ' || etag END AS headers
FROM found
"""
