"""Not-modified revisits of a web archive, resolved to the latest earlier full response of the same canonical URL.

The search is an as-of join without a window over a whole URL: time is cut into slices, a slice
knows the last response before it, and only inside a slice are records ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Headers a not-modified response may change, and query parameters that only track.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
TRACKING = r"^(ref|utm_[a-z]+|gclid|fbclid|sessionid)(=|$)"
SLICES = 1024


def canonical_url(url: Column) -> Column:
    """Host and path in one form: no scheme, default port, ``www.`` or ``m.``, fragment, tracking parameter, index page or end slash.

    Host letters are lowered, parameters ordered. A null URL has none.
    """
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), r"^(www|m)[.]|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"(/index[.]html?|/+)$", "")
    query = F.filter(F.array_sort(F.split(F.regexp_extract(bare, r"[?](.*)$", 1), "&")), lambda p: (p != "") & ~p.rlike(TRACKING))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))


def _latest_full(records: DataFrame) -> DataFrame:
    """``records`` with ``original``: id and validators of the latest earlier full response of the key, or null."""
    at = F.struct("date", "record_id", "etag", "last_modified", "digest", "_id")
    full = F.when(F.col("type") == "response", at)
    span = records.agg(F.min("date"), F.max("date")).first()
    low, high = (span[0] or 0), (span[1] or 0)
    sliced = records.withColumn("slice", F.floor((F.col("date") - F.lit(low)) * F.lit(SLICES / (high - low + 1))).cast("int"))
    last = sliced.groupBy("key", "slice").agg(F.max(full).alias("last"))
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = last.select("key", "slice", F.last("last", ignorenulls=True).over(earlier).alias("before"))
    inside = Window.partitionBy("key", "slice").orderBy("date").rangeBetween(Window.unboundedPreceding, -1)
    return (sliced.join(before, ["key", "slice"]).withColumn("original", F.coalesce(F.max(full).over(inside), F.col("before")))
            .drop("slice", "before"))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id``, ``key``, ``refers_to``, ``outcome`` and merged ``headers``.

    ``records`` has ``record_id``, ``url``, ``date`` (long), ``type`` (``response`` or ``revisit``),
    ``etag``, ``last_modified``, ``digest`` and ``headers`` (map with lower-case names). A revisit
    looks up the latest response strictly before it; of equal dates the greatest record id. Its
    first validator that both sides have decides: entity tag (weakly compared), last modification,
    digest. Outcomes: ``merged`` (equal), ``mismatch`` (unequal), ``unverified`` (no common
    validator), ``missing`` (no earlier response). Only ``merged`` rows have headers: the
    original's, with those replaced that a not-modified response may change. Records without URL or
    date can't be found or find anything; types other than the two are ignored; a response given
    twice counts once, its headers being the lesser list. A record without id takes part like any other and is
    known by its content; a revisit of one refers to null. Other columns are not read.
    """
    rows = records.select("record_id", canonical_url(F.col("url")).alias("key"), F.col("date").cast("long").alias("date"), "type",
                          "etag", "last_modified", "digest", "headers")
    # A record without id is known by its content, so that it keeps its own headers.
    content = F.sha2(F.to_json(F.struct("key", "date", "type", "etag", "last_modified", "digest", F.array_sort(F.map_entries("headers")).alias("h"))), 256)
    rows = rows.withColumn("_id", F.coalesce(F.concat(F.lit("="), F.col("record_id").cast("string")), content))
    placed = rows.where("key is not null and date is not null and type in ('response', 'revisit')")
    found = _latest_full(placed.drop("headers")).where("type = 'revisit'").select(
        "record_id", "_id", "key", "date", "etag", "last_modified", "digest", "original")
    lost = rows.where("type = 'revisit' and (key is null or date is null)")
    lost = lost.select("record_id", "key", F.lit(None).cast("string").alias("refers_to"), F.lit("missing").alias("outcome"),
                       F.lit(None).cast("map<string,string>").alias("headers"))
    checks = [(_strong(F.col("etag")), _strong(F.col("original.etag"))), (F.col("last_modified"), F.col("original.last_modified")),
              (F.col("digest"), F.col("original.digest"))]
    outcome = F.when(F.col("original").isNull(), "missing")
    for mine, theirs in checks:
        both = mine.isNotNull() & theirs.isNotNull()
        outcome = outcome.when(both & (mine == theirs), "merged").when(both, "mismatch")
    judged = found.withColumn("outcome", outcome.otherwise("unverified")).withColumn("refers_to", F.col("original.record_id")).withColumn(
        "_original", F.col("original._id"))
    own = (rows.where("type = 'revisit'").groupBy("_id").agg(F.min(F.array_sort(F.map_entries("headers"))).alias("changed")))
    kept = (rows.where("type = 'response'").groupBy(F.col("_id").alias("_original"))
            .agg(F.min(F.array_sort(F.map_entries("headers"))).alias("stored")))
    whole = judged.join(kept, "_original", "left").join(own, "_id", "left")
    nothing = F.array().cast("array<struct<key:string,value:string>>")
    new = F.filter(F.coalesce("changed", nothing), lambda e: e["key"].isin(PERMITTED))
    replaced = F.transform(new, lambda e: e["key"])
    old = F.filter(F.coalesce("stored", nothing), lambda e: ~F.array_contains(replaced, e["key"]))
    merged = F.when(F.col("outcome") == "merged", F.map_from_entries(F.array_sort(F.concat(old, new))))
    return whole.select("record_id", "key", "refers_to", "outcome", merged.alias("headers")).unionByName(lost)
