"""WARC records: resolution of not-modified revisits to the response they stand for.

A revisit (status 304) is joined as of its time to the latest earlier full response of the same canonical URL.
Its validators are checked: entity tags by weak comparison, else modification dates, else that neither side has
any; payload digests must agree where both are known. A resolved revisit gets the response's payload and its
headers, updated with those headers of the revisit that a 304 may change.

The as-of join is a running maximum per URL. To keep a URL of very many captures out of one task, time is cut
into slices of about equal numbers of records: the maximum runs within (URL, slice), and what earlier slices
carry in comes from one row per URL and slice. Only times and record ids run through it; headers and payloads
are fetched afterwards by record id.

Defined results: every record comes back. Responses are ``response``; revisits are ``resolved``,
``no_earlier_response`` or ``validator_mismatch``, and the latter two keep their own headers and have no
payload. A
full response has status 200 and a payload. Earlier means strictly earlier; of responses at the same time the
one with the largest record id counts. Records without URL or time resolve to nothing and are resolved to by
none. Null headers count as none. Repeated rows give repeated results; an empty table gives an empty result.
Columns beside those of RECORD are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendworks.sizing import shuffle_width

RECORD = "record_id long, kind string, url string, ts timestamp, status int, headers array<struct<name:string,value:string>>, digest string, payload string"

#: Time slices at most; a URL that has all N records sends about N / SLICES of them to a task.
SLICES = 256

# Headers that a 304 response does not change in a stored response, and session parameters.
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
)
DROPPED_PARAMETER = "^(utm_[^=]*|jsessionid|phpsessid|sessionid|sid|ref)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, fragment, default port, ``www.``, closing slash and tracking parameters.

    Host letters are lower-cased and parameters sorted. What does not look like a URL gives null.
    """
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)(?:\?(.*))?$"
    host = F.lower(F.regexp_extract(plain, pattern, 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^[^@]*@", ""), ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(plain, pattern, 2), "/+$", "")
    kept = F.filter(
        F.split(F.regexp_extract(plain, pattern, 3), "&"), lambda p: (p != "") & ~F.lower(p).rlike(DROPPED_PARAMETER)
    )
    query = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(host != "", whole)


def header(headers: Column, name: str) -> Column:
    found = F.filter(headers, lambda h: F.lower(h["name"]) == name)
    return F.try_element_at(F.transform(found, lambda h: F.trim(h["value"])), F.lit(1))


def merged_headers(stored: Column, update: Column) -> Column:
    """``name: value`` lines in order of name: the stored ones, updated where permitted."""
    named = F.split(F.regexp_replace(F.lower(F.coalesce(header(update, "connection"), F.lit(""))), r"\s", ""), ",")
    permitted = F.filter(
        update, lambda h: ~F.lower(h["name"]).isin(*NOT_UPDATED) & ~F.array_contains(named, F.lower(h["name"]))
    )
    names = F.transform(permitted, lambda h: F.lower(h["name"]))
    stay = F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"])))
    return header_lines(F.concat(stay, permitted))


def header_lines(headers: Column) -> Column:
    return F.array_sort(F.transform(headers, lambda h: F.concat_ws(": ", F.lower(h["name"]), F.trim(h["value"]))))


def slice_of(records: DataFrame) -> Column:
    """The time slice of a record: how many of the slices' borders it has reached."""
    wanted = min(SLICES, max(8, shuffle_width(records.sparkSession)))
    shares = [i / wanted for i in range(1, wanted)]
    borders = records.agg(F.percentile_approx(F.unix_micros("ts"), shares, 10_000).alias("b")).first()["b"] or []
    literal = F.array(*(F.lit(b).cast("long") for b in sorted(set(borders)))) if borders else F.array().cast("array<long>")
    micros = F.unix_micros("ts")
    return F.size(F.filter(literal, lambda b: b <= micros))


def latest_earlier(events: DataFrame, slice_number: Column) -> DataFrame:
    """``events`` (key, ts, record_id, full) with ``earlier``: time and id of the latest earlier full one."""
    sliced = events.withColumn("slice", slice_number).withColumn("micros", F.unix_micros("ts"))
    own = F.when(F.col("full"), F.struct("micros", F.col("record_id").alias("id")))
    carried = (
        sliced.groupBy("key", "slice")
        .agg(F.max(own).alias("last"))
        .withColumn(
            "before",
            F.max("last").over(Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("key", "slice", "before")
    )
    within = Window.partitionBy("key", "slice").orderBy("micros").rangeBetween(Window.unboundedPreceding, -1)
    seen = sliced.withColumn("seen", F.max(own).over(within))
    return seen.join(carried, ["key", "slice"]).withColumn("earlier", F.coalesce("seen", "before"))


def resolve(records: DataFrame) -> DataFrame:
    """One row per record: ``record_id, kind, canonical_url, ts, resolution, refers_to, status, headers, payload``."""
    no_headers = F.array().cast("array<struct<name:string,value:string>>")
    rows = records.select(
        "record_id",
        "kind",
        canonical_url(F.col("url")).alias("canonical_url"),
        "ts",
        "status",
        F.coalesce("headers", no_headers).alias("headers"),
        "digest",
        "payload",
    )
    is_full = F.coalesce(
        (F.col("kind") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull() & F.col("record_id").isNotNull(),
        F.lit(False),
    )
    usable = F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    dated = rows.filter(usable)
    events = dated.select(
        F.col("canonical_url").alias("key"), "ts", "record_id", is_full.alias("full"), "kind", "headers", "digest", "status"
    )
    found = latest_earlier(events, slice_of(records)).filter("kind = 'revisit'")
    # Revisits without an earlier response match nothing; a hash spreads them over the tasks of the join.
    nowhere = F.when(F.col("earlier").isNull(), F.xxhash64("record_id"))
    revisits = found.select(
        "record_id",
        F.col("key").alias("canonical_url"),
        "ts",
        "status",
        "headers",
        "digest",
        F.col("earlier.id").alias("to"),
        F.coalesce(F.col("earlier.micros"), nowhere).alias("to_micros"),
    )
    # One row per record, whatever repeats; a revisit's own payload is not needed from here on.
    responses = (
        dated.filter(is_full)
        .groupBy(F.col("record_id").alias("of"), F.unix_micros("ts").alias("of_micros"))
        .agg(F.min(F.struct("payload", "headers", "digest")).alias("r"))
    )
    joined = revisits.join(
        responses, (F.col("to") == F.col("of")) & (F.col("to_micros") == F.col("of_micros")), "left"
    )
    weak = lambda tag: F.regexp_replace(tag, "^W/", "")
    etag, old_etag = header(F.col("headers"), "etag"), header(F.col("r.headers"), "etag")
    date, old_date = header(F.col("headers"), "last-modified"), header(F.col("r.headers"), "last-modified")
    valid = (
        F.when(etag.isNotNull(), F.coalesce(weak(etag) == weak(old_etag), F.lit(False)))
        .when(date.isNotNull(), F.coalesce(date == old_date, F.lit(False)))
        .otherwise(old_etag.isNull() & old_date.isNull())
    ) & F.coalesce(F.col("digest") == F.col("r.digest"), F.lit(True))
    resolution = F.when(F.col("of").isNull(), "no_earlier_response").when(valid, "resolved").otherwise("validator_mismatch")
    judged = joined.withColumn("resolution", resolution)
    is_resolved = F.col("resolution") == "resolved"
    resolved = judged.select(
        "record_id",
        F.lit("revisit").alias("kind"),
        "canonical_url",
        "ts",
        "resolution",
        F.when(is_resolved, F.col("of")).alias("refers_to"),
        F.when(is_resolved, F.lit(200)).otherwise(F.col("status")).alias("status"),
        F.when(is_resolved, merged_headers(F.col("r.headers"), F.col("headers"))).otherwise(header_lines(F.col("headers"))).alias("headers"),
        F.when(is_resolved, F.col("r.payload")).alias("payload"),
    )
    is_revisit = F.coalesce(F.col("kind") == "revisit", F.lit(False))
    others = rows.filter(~is_revisit | ~usable).select(
        "record_id",
        "kind",
        "canonical_url",
        "ts",
        F.when(is_revisit, "no_earlier_response").otherwise("response").alias("resolution"),
        F.lit(None).cast("long").alias("refers_to"),
        "status",
        header_lines(F.col("headers")).alias("headers"),
        F.when(~is_revisit, F.col("payload")).alias("payload"),
    )
    return resolved.unionByName(others)
