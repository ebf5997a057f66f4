"""Not-modified revisits resolved to the latest earlier full response of the same page.

Crawl archives hold full responses and, for pages that had not changed, revisit records with headers only. Each revisit is
joined as of its date to the latest earlier full response with the same canonical URL. The match stands if the validators
agree: an entity tag that the revisit names must equal the response's (weak marks aside); without one, a Last-Modified
that it names must. The result takes the response's headers, and over them those headers of the revisit that a
not-modified answer may carry.

The as-of join is one pass over the records per URL in time order, cut in spans of time so that a URL with a third of all
records is many groups: the last response in each span is aggregated first (combined on the map side), carried forward
over the spans that have one, and only then each span is scanned for its own records. Bodies do not take part; a match
names the record that holds the body.

Nulls: a record without URL or date, or of a kind other than response and revisit, is not resolved (status "no_target");
a response is its own match. Several responses of a moment: the largest record_id counts; responses of the moment of a
revisit are not earlier. Repeated records count once each. A null header map is empty. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerproof.llm.base import stored, table

NAME = "op4_resolve_revisits"
SPAN_SECONDS = 86_400

# Headers a 304 answer may update, and query parameters that do not identify a page.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"

SQL = r"""
WITH base AS (SELECT page_id, url, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n_bytes, md5(coalesce(html, '')) AS digest FROM pages),
parts AS (SELECT *, regexp_replace(trim(url), '#.*$', '', 's') AS u FROM base),
cut AS (SELECT *, regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS host,
        regexp_replace(regexp_replace(regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', ''), '\?.*$', ''), '(/|/index\.html?)$', '') AS path,
        CASE WHEN u LIKE '%?%' THEN regexp_replace(u, '^[^?]*\?', '') ELSE '' END AS q FROM parts),
canon AS (SELECT page_id, url, n_bytes, digest, CASE WHEN url IS NULL THEN NULL ELSE host || path ||
          CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS canonical
          FROM (SELECT *, list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_full_match(x, '(utm_[a-z]+|ref|fbclid|gclid)(=.*)?'))) AS args FROM cut)),
rec AS (SELECT 4 * page_id + k AS record_id, canonical, CASE WHEN k IN (0, 2) THEN 'response' ELSE 'revisit' END AS kind,
               1700000000 + 86400 * (page_id % 97) + 3600 * (k * 10 + page_id % 7) AS ts, digest, n_bytes, page_id, k,
               CASE WHEN k = 3 AND page_id % 5 = 0 THEN NULL WHEN k = 1 AND page_id % 11 = 0 THEN 'W/"stale"' WHEN k = 1 THEN 'W/"' || digest || '"' ELSE '"' || digest || '"' END AS etag
        FROM canon, (SELECT unnest([0, 1, 2, 3]) AS k)),
resp AS (SELECT canonical AS c, ts AS t, max(record_id) AS response_id FROM rec WHERE kind = 'response' AND canonical IS NOT NULL GROUP BY canonical, ts),
near AS (SELECT r.*, a.response_id FROM (SELECT * FROM rec WHERE kind = 'revisit') r ASOF LEFT JOIN resp a ON r.canonical = a.c AND r.ts > a.t),
res AS (SELECT n.record_id, n.canonical, n.kind, n.etag, n.ts, n.page_id, n.k, s.record_id AS response_id, s.etag AS s_etag, s.digest AS s_digest, s.n_bytes AS s_bytes, s.page_id AS s_page, s.ts AS s_ts
        FROM near n LEFT JOIN rec s ON s.record_id = n.response_id),
lm AS (SELECT *, 'day ' || CAST(page_id % 97 AS VARCHAR) AS modified, 'day ' || CAST(s_page % 97 AS VARCHAR) AS s_modified FROM res),
st AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_target'
                      WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(s_etag, '^W/', '') THEN 'resolved' ELSE 'changed' END
                      WHEN modified = s_modified THEN 'resolved' ELSE 'changed' END AS status FROM lm)
SELECT record_id, canonical, 'revisit' AS kind, status, CASE WHEN status = 'resolved' THEN response_id END AS response_id,
       CASE WHEN status = 'resolved' THEN s_digest END AS digest, CASE WHEN status = 'resolved' THEN s_bytes END AS n_bytes,
       CASE WHEN status = 'resolved' THEN 'cache-control=max-age=' || CAST(60 * k AS VARCHAR) || ';content-type=text/html;date=' || CAST(ts AS VARCHAR)
            || ';etag=' || coalesce(etag, s_etag) || ';last-modified=' || s_modified END AS headers FROM st
UNION ALL
SELECT record_id, canonical, kind, 'response', record_id, digest, n_bytes,
       'cache-control=max-age=' || CAST(60 * k AS VARCHAR) || ';content-type=text/html;date=' || CAST(ts AS VARCHAR) || ';etag=' || etag || ';last-modified=day ' || CAST(page_id % 97 AS VARCHAR) FROM rec WHERE kind = 'response'
"""


def canonical_url(url: Column) -> Column:
    """Host without www and default port, path without closing slash or index page, sorted parameters that identify a page."""
    u = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", ""), r"\?.*$", ""), r"(/|/index\.html?)$", "")
    query_ = F.when(F.contains(u, F.lit("?")), F.regexp_replace(u, r"^[^?]*\?", "")).otherwise("")
    args = F.array_sort(F.filter(F.split(query_, "&"), lambda x: (x != "") & ~x.rlike(f"^({TRACKING})(=.*)?$")))
    return F.concat(host, path, F.when(F.size(args) > 0, F.concat(F.lit("?"), F.array_join(args, "&"))).otherwise(""))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Per record (record_id, url, kind, ts, headers, digest, n_bytes): canonical, status, response_id, digest, n_bytes, headers.

    ``headers`` is a map of lower-cased names; ``ts`` is in seconds. Status: response, resolved, changed or no_target.
    """
    named = stored(records.select(F.monotonically_increasing_id().alias("row"), "record_id", canonical_url(F.col("url")).alias("canonical"), "kind", "ts", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "digest", "n_bytes")
                   .withColumn("span", F.floor(F.col("ts") / span_seconds)), "warc-records")
    ordered = named.where(F.col("kind").isin("response", "revisit") & F.col("canonical").isNotNull() & F.col("ts").isNotNull())
    # The last response of each span, carried to the spans after it.
    mark = F.struct("ts", "record_id", "row")
    spans = ordered.groupBy("canonical", "span").agg(F.max(F.when(F.col("kind") == "response", mark)).alias("last"))
    before = Window.partitionBy("canonical").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("canonical", "span", F.max("last").over(before).alias("carried"))
    # Within a span: responses of earlier moments.
    inside = Window.partitionBy("canonical", "span").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    own = ordered.select("row", "record_id", "canonical", "span", "ts", "kind").withColumn("inside", F.max(F.when(F.col("kind") == "response", mark)).over(inside)).where("kind = 'revisit'")
    near = own.join(stored(spans, "warc-spans"), ["canonical", "span"]).select(
        F.col("row").alias("revisit"), F.coalesce("inside.record_id", "carried.record_id").alias("target"), F.coalesce("inside.row", "carried.row").alias("target_row")).where("target_row IS NOT NULL")
    full = named.where("kind = 'response'").select(F.col("row").alias("target_row"), F.col("headers").alias("full"), F.col("digest").alias("full_digest"), F.col("n_bytes").alias("full_bytes"))
    found = near.join(full, "target_row")
    joined = named.join(found, F.col("row") == F.col("revisit"), "left")
    tag, full_tag = F.try_element_at("headers", F.lit("etag")), F.try_element_at("full", F.lit("etag"))
    agrees = F.when(tag.isNotNull(), _strong(tag).eqNullSafe(_strong(full_tag))).when(
        F.try_element_at("headers", F.lit("last-modified")).isNotNull(), F.try_element_at("headers", F.lit("last-modified")).eqNullSafe(F.try_element_at("full", F.lit("last-modified")))).otherwise(True)
    status = F.when(F.col("kind") == "response", "response").when(F.col("target").isNull() | (F.col("kind") != "revisit"), "no_target").when(agrees, "resolved").otherwise("changed")
    permitted = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("full", lambda k, _: ~F.array_contains(F.map_keys(permitted), k)), permitted)
    joined = joined.withColumn("status", F.coalesce(status, F.lit("no_target")))
    is_full, stands = F.col("status") == "response", F.col("status") == "resolved"
    return joined.select(
        "record_id", "canonical", "kind", "status", F.when(is_full, F.col("record_id")).when(stands, F.col("target")).alias("response_id"),
        F.when(is_full, F.col("digest")).when(stands, F.col("full_digest")).alias("digest"), F.when(is_full, F.col("n_bytes")).when(stands, F.col("full_bytes")).alias("n_bytes"),
        F.when(is_full, F.col("headers")).when(stands, merged).alias("headers"))


def header_text(headers: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def crawl_records(pages: DataFrame) -> DataFrame:
    """Four archive records for every page: two full responses, each followed by a revisit; some revisits are stale."""
    html = F.coalesce("html", F.lit(""))
    base = pages.select("page_id", "url", F.octet_length(html).cast("long").alias("n_bytes"), F.md5(html).alias("digest"))
    rec = base.withColumn("k", F.explode(F.array(*map(F.lit, range(4)))))
    tag = F.concat(F.lit('"'), "digest", F.lit('"'))
    etag = F.when((F.col("k") == 3) & (F.col("page_id") % 5 == 0), F.lit(None)).when((F.col("k") == 1) & (F.col("page_id") % 11 == 0), 'W/"stale"').when(F.col("k") == 1, F.concat(F.lit("W/"), tag)).otherwise(tag)
    ts = 1_700_000_000 + 86_400 * (F.col("page_id") % 97) + 3_600 * (F.col("k") * 10 + F.col("page_id") % 7)
    full = F.col("k") % 2 == 0
    headers = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("cache-control").alias("k"), F.concat(F.lit("max-age="), (60 * F.col("k")).cast("string")).alias("v")), F.struct(F.lit("content-type").alias("k"), F.when(full, F.lit("text/html")).alias("v")),
        F.struct(F.lit("date").alias("k"), ts.cast("string").alias("v")), F.struct(F.lit("etag").alias("k"), etag.alias("v")),
        F.struct(F.lit("last-modified").alias("k"), F.concat(F.lit("day "), (F.col("page_id") % 97).cast("string")).alias("v"))), lambda x: x["v"].isNotNull()))
    return rec.select((4 * F.col("page_id") + F.col("k")).alias("record_id"), "url", F.when(full, "response").otherwise("revisit").alias("kind"), ts.alias("ts"), headers.alias("headers"), F.when(full, F.col("digest")).alias("digest"), F.when(full, F.col("n_bytes")).alias("n_bytes"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_revisits(crawl_records(table(spark, sf_dir, "pages"))).withColumn("headers", header_text(F.col("headers")))
