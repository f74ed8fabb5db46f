"""Not-modified revisits of web archives: each is resolved to the capture whose body it stands for.

A revisit (HTTP 304) has no body. It is joined as of its time, by canonical
URL, to the latest earlier full response. If the validators agree (entity tags
weakly compared, else Last-Modified), the answer is that response with the
headers that a 304 may update replaced by the revisit's own.

Records: record_id, kind ("response" or "revisit"), url, ts (long), headers
(map<string, string>, names in any case), digest. Results for every revisit:
status "resolved", "stale" (validators differ), "unchecked" (the revisit has
none) or "missing" (no earlier response).

Nulls: a null url is the empty one, a null ts has no earlier response and is
nobody's, null headers are empty ones. Of responses with one time the largest
record_id counts. Repeated rows are answered one by one. Empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import bucket_of, kept

#: Fields of a 304 that replace those of the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
ROWS_A_SLICE = 100_000


def canonical_url(url: Column) -> Column:
    """Without scheme, "www.", default port, fragment, tracking parameters and a slash at the end; host in lower case."""
    bare = F.regexp_replace(F.trim(F.coalesce(url.cast("string"), F.lit(""))), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^(?i:https?)://(?i:www\.)?", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r":(80|443)$", ""))
    path = F.regexp_replace(bare, r"^[^/?]*", "")
    path = F.regexp_replace(path, r"(?<=[?&])(utm_[a-z]+|ref|sessionid)=[^&]*(&|$)", "")
    return F.concat(host, F.regexp_replace(path, r"[/?&]+$", ""))


def clean_headers(headers: Column) -> Column:
    """Names in lower case; of names that differ in case only, the last one counts."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    lower = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(lower, lambda e, i: ~F.exists(F.slice(lower, i + 2, F.size(lower)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def latest_before(records: DataFrame, wanted: DataFrame, rows_a_slice: int = ROWS_A_SLICE) -> DataFrame:
    """Rows (key, ts, found) of ``wanted`` (key, ts) with the ``value`` of the latest earlier row of ``records`` (key, ts, value).

    Time is cut into slices of about ``rows_a_slice`` rows over all keys, so a
    key that holds many rows is spread over the slices. A window finds the
    value within the slice; what comes from earlier slices is carried by one
    row a key and slice.
    """
    both = records.select("key", "ts", "value").unionByName(wanted.select("key", "ts"), allowMissingColumns=True)
    points = kept(both.groupBy("key", "ts").agg(F.max("value").alias("value")))
    count, low = points.agg(F.count(F.lit(1)), F.min("ts")).first()
    n = max(1, -(-count // rows_a_slice))
    cuts = points.agg(F.percentile_approx("ts", [i / n for i in range(1, n)] or [0.5], max(10_000, 8 * n))).first()[0] or []
    sliced = points.withColumn("slice", bucket_of(F.col("ts"), sorted({low, *cuts} - {None})))
    within = Window.partitionBy("key", "slice").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    last = sliced.where("value is not null").groupBy("key", "slice").agg(F.max_by("value", "ts").alias("value"))
    slots = sliced.select("key", "slice").distinct().join(last, ["key", "slice"], "left")
    across = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("key", "slice", F.last("value", ignorenulls=True).over(across).alias("carried"))
    own = sliced.withColumn("own", F.last("value", ignorenulls=True).over(within))
    return own.join(carried, ["key", "slice"]).select("key", "ts", F.coalesce("own", "carried").alias("found"))


def resolve(records: DataFrame) -> DataFrame:
    """One row a revisit: record_id, url_key, ts, status, response_id, digest, headers (merged, if resolved)."""
    clean = records.select(
        "record_id", "kind", canonical_url(F.col("url")).alias("key"), "ts", clean_headers(F.col("headers")).alias("headers"), "digest"
    )
    revisits = clean.where("kind = 'revisit'").drop("kind", "digest")
    # Maps have no order, so the struct that max() compares holds them as sorted entries.
    value = F.struct("record_id", "digest", F.array_sort(F.map_entries("headers")).alias("headers"))
    responses = clean.where("kind = 'response' and ts is not null").select("key", "ts", value.alias("value"))
    found = latest_before(responses, revisits.where("ts is not null").select("key", "ts"))
    rows = revisits.join(found, ["key", "ts"], "left")
    old = F.map_from_entries("found.headers")
    weak = r"^\s*W/"
    tag, was = (F.regexp_replace(h["etag"], weak, "") for h in (F.col("headers"), F.col("old")))
    agrees = F.when(tag.isNotNull(), F.coalesce(tag == was, F.lit(False))).when(
        F.col("headers")["last-modified"].isNotNull(), F.coalesce(F.col("headers")["last-modified"] == F.col("old")["last-modified"], F.lit(False))
    )
    status = F.when(F.col("found").isNull(), "missing").when(agrees.isNull(), "unchecked").when(agrees, "resolved").otherwise("stale")
    update = F.map_filter(F.col("headers"), lambda k, v: k.isin(*PERMITTED))
    stay = F.map_filter(F.col("old"), lambda k, v: ~F.array_contains(F.map_keys(F.col("update")), k))
    good = F.col("status") == "resolved"
    return (
        rows.withColumn("old", old)
        .withColumn("status", status)
        .withColumn("update", update)
        .select(
            "record_id",
            F.col("key").alias("url_key"),
            "ts",
            "status",
            F.when(good, F.col("found.record_id")).alias("response_id"),
            F.when(good, F.col("found.digest")).alias("digest"),
            F.when(good, F.map_concat(stay, "update")).alias("headers"),
        )
    )
