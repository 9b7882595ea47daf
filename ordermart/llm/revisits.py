"""Operator 8: not-modified revisit records of web archives, resolved.

Method.  A revisit record (a 304 answer) has no payload.  It refers to the
latest earlier full response of the same canonical URL (as-of join).  The
validators are checked: entity tags, compared weakly, if both records have
one, else the last-modified dates, if both have one.  If they agree, the
stored response's headers are merged with those of the 304 that may update
them; framing and content headers (``KEPT``) stay as stored.

Canonical URL: scheme, fragment, ``www.``, default ports, tracking
parameters (``TRACKING``) and trailing slashes go, the host is lower-cased.

Scale.  JVM side only.  Time is cut into buckets at quantiles of all
records, so an outlying time widens no bucket; a window finds the latest
earlier response inside (URL, bucket), a pre-aggregated row per (URL,
bucket) carries the last response over from earlier buckets, and a join
puts both together.  So a URL with a third of all records is spread over
the buckets, and no window holds more of it than a bucket and a row per
bucket.  Only records of one URL at one and the same time cannot be parted.  The payload does not move: results name the response's record.

Results on edge cases.  A revisit without a URL or an earlier response is
``unresolved``, one whose validators differ or are missing is ``mismatch``;
both keep their own headers and no payload.  Earlier is strictly earlier;
of responses at one time the largest record_id counts.  Revisits or
responses without a time match nothing.  Repeated rows are each resolved.
Other columns take no part.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Fixed values (RFC 9111, 3.2 and 4.3.4): headers of the stored response that a 304 may not update.
KEPT = ("content-encoding", "content-length", "content-range", "content-type", "transfer-encoding", "connection")
#: Fixed: query parameters that do not select content.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"
#: Records that a bucket of time holds on average.
BUCKET_RECORDS = 100_000
#: Buckets at least, so that a frequent URL of a small archive is spread too.
LEAST_BUCKETS = 64

RECORD = "record_id long, url string, ts long, kind string, etag string, last_modified string, " \
         "headers array<struct<name:string,value:string>>, payload_digest string, payload_chars long"


def canonical_url(url: Column) -> Column:
    """Canonical form of a URL column (null stays null)."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    path, query = F.regexp_extract(rest, "^([^?]*)", 1), F.regexp_extract(rest, "[?](.*)$", 1)
    query = F.regexp_replace(F.concat(F.lit("&"), query), f"&({TRACKING})=[^&]*", "")
    query = F.regexp_replace(F.regexp_replace(query, "^&+", ""), "&+$", "")
    return F.concat(host, F.regexp_replace(path, "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """Headers of the stored response, updated by those of the 304 that may do so; by name."""
    allowed = F.filter(update, lambda h: ~F.lower(h["name"]).isin(*KEPT))
    names = F.transform(allowed, lambda h: F.lower(h["name"]))
    return F.array_sort(F.concat(F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"]))), allowed))


def time_bounds(timed: DataFrame) -> list[float]:
    """Bounds of ``moment`` between buckets of about BUCKET_RECORDS records, or a share of 1 / LEAST_BUCKETS.

    They are quantiles, so records far off in time move no other bound.
    One number per bucket reaches the driver.
    """
    n = timed.filter("moment is not null").count()
    buckets = max(LEAST_BUCKETS, -(-n // BUCKET_RECORDS))
    found = timed.agg(F.percentile_approx("moment", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()[0]
    return sorted(set(found or [0.0]))


def resolve(records: DataFrame) -> DataFrame:
    """Each revisit of ``records`` (RECORD) with outcome, refers_to, merged headers and the payload's digest and size."""
    timed = records.select(*[c.split()[0] for c in RECORD.split(", ")]).withColumn(
        "canonical", canonical_url(F.col("url"))).withColumn("moment", F.col("ts").cast("double"))
    splits = [float("-inf"), *time_bounds(timed), float("inf")]
    timed = (Bucketizer(splits=splits, inputCol="moment", outputCol="bucket", handleInvalid="keep").transform(timed)
             .withColumn("bucket", F.col("bucket").cast("int")))
    stored = F.when((F.col("kind") == "response") & F.col("canonical").isNotNull() & F.col("ts").isNotNull(), F.struct(
        "ts", "record_id", "etag", "last_modified", "headers", "payload_digest", "payload_chars"))
    timed = timed.withColumn("stored", stored)

    inside = Window.partitionBy("canonical", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = (timed.filter(F.col("canonical").isNotNull() & F.col("ts").isNotNull())
            .withColumn("near", F.max("stored").over(inside)).filter("kind = 'revisit'"))
    tails = (timed.filter("stored is not null").groupBy("canonical", "bucket").agg(F.max("stored").alias("tail")))
    # buckets of a URL that hold a revisit take the last response of earlier buckets
    slots = (timed.filter("kind = 'revisit' and canonical is not null and ts is not null")
             .select("canonical", "bucket").distinct().join(tails, ["canonical", "bucket"], "full"))
    before = Window.partitionBy("canonical").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.withColumn("far", F.max("tail").over(before)).select("canonical", "bucket", "far")
    found = near.join(carried, ["canonical", "bucket"], "left").withColumn("hit", F.coalesce("near", "far"))
    lost = (timed.filter("kind = 'revisit' and (canonical is null or ts is null)")
            .withColumn("hit", F.lit(None).cast(found.schema["hit"].dataType)))
    cols = ["record_id", "canonical", "ts", "etag", "last_modified", "headers", "hit"]
    every = found.select(*cols).unionByName(lost.select(*cols))

    tags = F.col("etag").isNotNull() & F.col("hit.etag").isNotNull()
    agree = F.when(tags, _strong(F.col("etag")) == _strong(F.col("hit.etag"))).otherwise(
        F.coalesce(F.col("last_modified") == F.col("hit.last_modified"), F.lit(False)))
    outcome = F.when(F.col("hit").isNull(), "unresolved").when(agree, "resolved").otherwise("mismatch")
    every = every.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    return every.select(
        "record_id", F.col("canonical").alias("canonical_url"), "ts", "outcome",
        F.when(good, F.col("hit.record_id")).alias("refers_to"),
        F.when(good, merged_headers(F.col("hit.headers"), F.col("headers"))).otherwise(F.array_sort("headers")).alias("headers"),
        F.when(good, F.col("hit.payload_digest")).alias("payload_digest"),
        F.when(good, F.col("hit.payload_chars")).alias("payload_chars"))


def with_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """``resolved`` with the payload of the response it refers to; ``payloads`` has (record_id, payload)."""
    return resolved.join(payloads.select(F.col("record_id").alias("refers_to"), "payload"), "refers_to", "left")


def _headers(**values: Column) -> Column:
    return F.array(*[F.struct(F.lit(k.replace("_", "-")).alias("name"), v.alias("value")) for k, v in sorted(values.items())])


def archive_of(pages: DataFrame) -> DataFrame:
    """An archive derived from ``pages`` (RECORD): every page's full response and a later revisit of it.

    Page i is fetched at 10 i; the revisit follows 5 to 6998 units later,
    under another spelling of the URL.  By i mod 5 its validators are a
    stale tag, a date only, a weak tag, or the tag; by i mod 11 it asks for
    a URL that was never fetched.
    """
    i, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    digest = F.md5(html.cast("binary"))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    base = pages.select("page_id", "url", digest.alias("digest"), tag.alias("tag"), F.length(html).cast("long").alias("chars"))
    ts = i * 10
    full = base.select(
        (i * 2).alias("record_id"), "url", ts.alias("ts"), F.lit("response").alias("kind"), F.col("tag").alias("etag"),
        ts.cast("string").alias("last_modified"),
        _headers(cache_control=F.lit("max-age=60"), content_length=F.col("chars").cast("string"),
                 content_type=F.lit("text/html"), date=ts.cast("string"), etag=F.col("tag")).alias("headers"),
        F.col("digest").alias("payload_digest"), F.col("chars").alias("payload_chars"))
    later = ts + 5 + 7 * (i % 1000)
    sent = F.when(i % 5 == 0, F.lit('"stale"')).when(i % 5 == 1, F.lit(None)).when(
        i % 5 == 2, F.concat(F.lit("W/"), F.col("tag"))).otherwise(F.col("tag"))
    again = base.select(
        (i * 2 + 1).alias("record_id"),
        F.when(i % 11 == 0, F.concat("url", F.lit("/gone"))).otherwise(
            F.regexp_replace(F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")), "^https://", "HTTP://")).alias("url"),
        later.alias("ts"), F.lit("revisit").alias("kind"), sent.alias("etag"), ts.cast("string").alias("last_modified"),
        _headers(cache_control=F.lit("max-age=120"), content_length=F.lit("0"), date=later.cast("string"),
                 vary=F.lit("accept")).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"), F.lit(None).cast("long").alias("payload_chars"))
    return full.unionByName(again)


def op8_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the archive derived from ``pages``, resolved; headers as sorted lines."""
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return resolve(archive_of(common.table(spark, sf_dir, "pages"))).withColumn("headers", lines)


#: DuckDB twin of op8 over the same derived archive.
OP8_SQL = r"""
WITH base AS (
    SELECT page_id AS i, url, md5(coalesce(html, '')) AS digest,
           '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag, length(coalesce(html, '')) AS chars
    FROM pages),
rec AS (
    SELECT i * 2 AS record_id, url, i * 10 AS ts, 'response' AS kind, tag AS etag, CAST(i * 10 AS VARCHAR) AS last_modified,
           digest, tag, chars, i FROM base
    UNION ALL
    SELECT i * 2 + 1,
           CASE WHEN i % 11 = 0 THEN url || '/gone'
                ELSE regexp_replace(regexp_replace(url, '#.*$', '') || '#again', '^https://', 'HTTP://') END,
           i * 10 + 5 + 7 * (i % 1000), 'revisit',
           CASE i % 5 WHEN 0 THEN '"stale"' WHEN 1 THEN NULL WHEN 2 THEN 'W/' || tag ELSE tag END,
           CAST(i * 10 AS VARCHAR), NULL, NULL, NULL, i FROM base),
bare AS (
    SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM rec),
parts AS (
    SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '') AS host,
           regexp_extract(regexp_replace(b, '^[^/?]*', ''), '^([^?]*)', 1) AS path,
           regexp_extract(regexp_replace(b, '^[^/?]*', ''), '[?](.*)$', 1) AS query FROM bare),
asked AS (
    SELECT *, regexp_replace(regexp_replace(regexp_replace('&' || query,
        '&(utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&]*', '', 'g'), '^&+', ''), '&+$', '') AS q FROM parts),
canon AS (
    SELECT *, host || regexp_replace(path, '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical FROM asked),
hit AS (
    SELECT r.record_id, max({'ts': s.ts, 'record_id': s.record_id, 'etag': s.etag, 'last_modified': s.last_modified,
                             'digest': s.digest, 'chars': s.chars}) AS h
    FROM canon r JOIN canon s ON r.canonical = s.canonical AND s.kind = 'response' AND s.ts < r.ts
    WHERE r.kind = 'revisit' GROUP BY r.record_id),
judged AS (
    SELECT r.*, h.h, CASE WHEN h.h IS NULL THEN 'unresolved'
        WHEN r.etag IS NOT NULL AND h.h.etag IS NOT NULL THEN
            CASE WHEN regexp_replace(r.etag, '^W/', '') = regexp_replace(h.h.etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
        WHEN r.last_modified = h.h.last_modified THEN 'resolved' ELSE 'mismatch' END AS outcome
    FROM canon r LEFT JOIN hit h USING (record_id) WHERE r.kind = 'revisit')
SELECT record_id, canonical AS canonical_url, ts, outcome,
       CASE WHEN outcome = 'resolved' THEN h.record_id END AS refers_to,
       CASE WHEN outcome = 'resolved' THEN
           'cache-control: max-age=120' || chr(10) || 'content-length: ' || h.chars || chr(10) || 'content-type: text/html'
           || chr(10) || 'date: ' || ts || chr(10) || 'etag: ' || h.etag || chr(10) || 'vary: accept'
       ELSE 'cache-control: max-age=120' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || ts
           || chr(10) || 'vary: accept' END AS headers,
       CASE WHEN outcome = 'resolved' THEN h.digest END AS payload_digest,
       CASE WHEN outcome = 'resolved' THEN h.chars END AS payload_chars
FROM judged
"""
