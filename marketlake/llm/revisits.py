"""Not-modified revisits of a web archive, resolved to the full response they refer to.

A revisit record (server-not-modified) holds headers only. It belongs to the latest earlier full response with the same
canonical URL, if their validators agree: the ETag where both have one, else Last-Modified where both have one, else
nothing speaks against it. The resolved record takes the response's body and headers, with those of the revisit
in place of the same name except the ones that describe the stored body.

The as-of join runs over slices of time: within a slice by a window per URL, before it by the last response of each
earlier slice, one row per URL and slice. So a URL with a third of all records is spread over as many tasks as there are
slices.

Defined results: a null URL matches nothing; of several responses at the same time the one with the largest id counts;
a response at the same time as the revisit is not earlier; records without a time are unresolved; repeated revisits are
resolved each; an empty table gives no rows; header names match without regard to case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlake.llm.common import tasks

#: Headers that describe the stored body; a not-modified answer does not replace them (fixed values).
OF_THE_BODY = ("content-encoding", "content-length", "content-range", "content-type", "transfer-encoding")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, no default port, no tracking parameters, no slash at the end."""
    u = F.regexp_replace(url, r"#.*$", "")
    u = F.regexp_replace(u, r"([?&])utm_[^=&]*=[^&]*", "$1")
    u = F.regexp_replace(u, r"[?&]+$", "")
    u = F.regexp_replace(u, r"\?&+", "?")
    u = F.regexp_replace(u, r"&&+", "&")
    top = F.lower(F.regexp_extract(u, r"^([^/]*//[^/?]*)", 1))
    rest = F.regexp_replace(u, r"^[^/]*//[^/?]*", "")
    top = F.regexp_replace(F.regexp_replace(top, r"^(http://.*):80$", "$1"), r"^(https://.*):443$", "$1")
    top = F.regexp_replace(top, r"^https?://(www\.)?", "")
    return F.regexp_replace(F.concat(top, rest), r"/+$", "")


def header(headers: Column, name: str) -> Column:
    return F.get(F.map_values(F.map_filter(headers, lambda k, v: k == name)), 0)


def _clean(headers: Column) -> Column:
    """Names in lower case, the last of equal names; null headers are none."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.lit(1 << 30)), lambda later: later["key"] == e["key"]))
    return F.coalesce(F.map_from_entries(last), F.create_map().cast("map<string,string>"))


def merge_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, updated by the permitted ones of the revisit."""
    permitted = F.map_filter(revisit, lambda k, v: ~k.isin(*OF_THE_BODY))
    own = F.map_filter(response, lambda k, v: ~F.map_contains_key(permitted, k))
    return F.map_concat(own, permitted)


def validators(response: Column, revisit: Column) -> Column:
    """'etag', 'last_modified' or 'none' for what agrees; 'mismatch'."""

    def agree(name: str, label: str) -> Column:
        a, b = header(response, name), header(revisit, name)
        return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, F.lit(label)).otherwise("mismatch"))

    return F.coalesce(agree("etag", "etag"), agree("last-modified", "last_modified"), F.lit("none"))


def resolve(records: DataFrame, slices: int | None = None) -> DataFrame:
    """``records`` (record_id, kind 'response' or 'revisit', url, time, headers, payload) to one row per revisit.

    Columns: record_id, url (canonical), time, status ('resolved', 'mismatch', 'missing'), response_id, checked (what
    agreed), headers (merged; the revisit's own where unresolved), payload. ``payload`` is what stands for the body,
    such as its digest or its place in the archive; bodies themselves need not travel.
    """
    n = slices or tasks(records.sparkSession, 8)
    rows = records.select(
        "record_id", "kind", canonical_url(F.col("url")).alias("url"), "time", _clean(F.col("headers")).alias("headers"), "payload"
    ).withColumn("is_response", F.col("kind") == "response")
    quantiles = F.percentile_approx("time", [i / n for i in range(1, n)], 1000)
    bounds = rows.where("time is not null").agg(quantiles).first()[0] or []  # n - 1 values
    cut = F.array(*[F.lit(b) for b in sorted(set(bounds))]) if bounds else F.array().cast(f"array<{dict(rows.dtypes)['time']}>")
    rows = rows.withColumn("slice", F.size(F.filter(cut, lambda b: b < F.col("time"))))
    usable = rows.where("url is not null and time is not null")
    found = F.struct("time", "record_id", "headers", "payload")

    # Last response of each URL and slice, then the last one of all earlier slices: at most n rows for a URL.
    ends = usable.where("is_response").groupBy("url", "slice").agg(F.max_by(found, F.struct("time", "record_id")).alias("end"))
    heads = usable.where("not is_response").select("url", "slice").distinct().withColumn("asks", F.lit(True))
    by_url = W.partitionBy("url").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.join(heads, ["url", "slice"], "full").withColumn("carried", F.last("end", True).over(by_url))
    carried = carried.where("asks").select("url", "slice", "carried")

    # At equal times revisits come first, so a response belongs only to later ones; the largest id comes last.
    in_order = W.partitionBy("url", "slice").orderBy("time", "is_response", "record_id").rowsBetween(W.unboundedPreceding, 0)
    asked = usable.withColumn("here", F.last(F.when(F.col("is_response"), found), True).over(in_order)).where("not is_response")
    joined = asked.join(carried, ["url", "slice"], "left").withColumn("got", F.coalesce("here", "carried"))
    lost = rows.where("not is_response and (url is null or time is null)")
    lost = lost.withColumn("got", F.lit(None).cast(joined.schema["got"].dataType))
    both = joined.select(*[F.col(c) for c in ("record_id", "url", "time", "headers", "got")]).unionByName(lost.select("record_id", "url", "time", "headers", "got"))
    checked = F.when(F.col("got").isNotNull(), validators(F.col("got.headers"), F.col("headers")))
    both = both.withColumn("checked", checked)
    resolved = F.col("got").isNotNull() & (F.col("checked") != "mismatch")
    return both.select(
        "record_id", "url", "time",
        F.when(F.col("got").isNull(), "missing").when(F.col("checked") == "mismatch", "mismatch").otherwise("resolved").alias("status"),
        F.col("got.record_id").alias("response_id"), "checked",
        F.when(resolved, merge_headers(F.col("got.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
        F.when(resolved, F.col("got.payload")).alias("payload"),
    )
