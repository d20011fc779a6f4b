"""Not-modified revisit resolution.

A revisit (304, no body) is joined as of its time to the latest strictly
earlier full response of the same canonical URL; then the validators are
checked and the headers that a 304 may change are merged into the stored ones.

The as-of join emits no pairs: records are range-partitioned by (URL, time),
so the captures of a hot URL spread over many tasks; each task carries the
last response along, and one head and one tail row per partition carry it
across the borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, materialize

# The header fields that a 304 response may carry and update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified", "age")
# Query parameters that never select content.
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|sessionid|jsessionid|phpsessid)(=|$)"
# Codes of the characters that mean the same escaped or not.
UNRESERVED = "^(2D|2E|5F|7E|3[0-9]|4[1-9A-F]|5[0-9A]|6[1-9A-F]|7[0-9A])$"


def _percent(text: Column) -> Column:
    """Escapes of unreserved characters undone, others in upper case."""
    def piece(x: Column, i: Column) -> Column:
        code, rest = F.upper(F.substring(x, 1, 2)), F.substring(x, 3, 1 << 30)
        return (F.when(i == 0, x).when(code.rlike(UNRESERVED), F.concat(F.char(F.conv(code, 16, 10).cast("int")), rest))
                .when(code.rlike("^[0-9A-F]{2}$"), F.concat(F.lit("%"), code, rest)).otherwise(F.concat(F.lit("%"), x)))

    return F.array_join(F.transform(F.split(text, "%"), piece), "")


def _no_dots(path: Column) -> Column:
    """``.`` and ``..`` segments resolved."""
    none = F.array().cast("array<string>")

    def step(done: Column, s: Column) -> Column:
        back = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(done)
        return F.when(s == ".", done).when(s == "..", back).otherwise(F.array_append(done, s))

    return F.array_join(F.aggregate(F.split(path, "/"), none, step), "/")


def canonical_url(url: Column) -> Column:
    """Scheme, user, "www.", the scheme's default port, fragment, tracking
    parameters and trailing slashes dropped, host lower-cased, dot segments and
    needless escapes resolved, parameters sorted. NULL and blank URLs are
    NULL."""
    bare = F.regexp_replace(F.trim(url.cast("string")), r"#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"^www[0-9]*\.", "")
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.regexp_replace(_no_dots(_percent(F.regexp_extract(rest, r"^[^?]*", 0))), r"/+$", "")
    query = F.filter(F.split(_percent(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))
    query = F.array_join(F.array_sort(query), "&")
    out = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(out != "", out)


def plain_headers(headers: Column) -> Column:
    """Lower-case names; of names that differ in case only the last stays;
    NULL is no headers."""
    items = F.transform(F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")),
                        lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(items, lambda e: e["key"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(items, lambda e: e["key"] == n), -1)["value"]))


def merged_headers(stored: Column, update: Column) -> Column:
    """``stored`` with the permitted, non-NULL fields of ``update``."""
    allowed = F.map_filter(update, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k)), allowed)


_WALK = "url string, ts timestamp, full int, id long, pid int, before long, head boolean, tail boolean"


def latest_before(records: DataFrame) -> DataFrame:
    """``records`` (id long, url string, ts timestamp, full int: 1 for a full
    response) -> (id, ts, url, before) for the others: the id of the latest
    strictly earlier full response (of equal times the largest id), or NULL."""
    n_parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["url", "ts", "full", "id"]  # at equal times full responses come last
    ranged = records.select(*order).repartitionByRange(n_parts, *order).sortWithinPartitions(*order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        names = ["url", "ts", "full", "id", "pid", "before", "head", "tail"]
        url = last = first = kind = None
        seen = False
        for b in batches:
            urls, full, ids = (b.column(i).to_pylist() for i in (0, 2, 3))
            before, head = [], []
            for u, f, i in zip(urls, full, ids):
                if not seen:
                    first, seen, url = u, True, u
                if u != url:
                    url, last = u, None
                before.append(last)
                head.append(u == first)
                if f:
                    last = i
            kind = b.schema.field(1).type
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([pid] * n, pa.int32()), pa.array(before, pa.int64()),
                                              pa.array(head, pa.bool_()), pa.array([False] * n)], names)
        if seen:  # the border row: the last URL here and its last response
            yield pa.RecordBatch.from_arrays(
                [pa.array([url], pa.string()), pa.nulls(1, kind), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.array([pid], pa.int32()),
                 pa.array([last], pa.int64()), pa.array([url == first]), pa.array([True])], names)

    walked = cut(ranged.mapInArrow(walk, _WALK))
    tails = walked.where("tail").select("url", "pid", F.lit(1).alias("side"), "before")
    heads = walked.where("head AND NOT tail").select("url", "pid").distinct().select("url", "pid", F.lit(0).alias("side"), F.lit(None).cast("long").alias("before"))
    along = Window.partitionBy("url").orderBy("pid", "side").rowsBetween(Window.unboundedPreceding, -1)
    carried = (heads.unionAll(tails).withColumn("carried", F.last("before", ignorenulls=True).over(along))
               .where("side = 0 AND carried IS NOT NULL").select("url", "pid", "carried"))
    return (walked.where("full = 0").join(F.broadcast(carried), ["url", "pid"], "left")  # at most one row a partition
            .select("id", "ts", "url", F.coalesce("before", "carried").alias("before")))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records``: record_id long, kind (response, revisit), url, ts
    timestamp, headers map<string,string>, digest. One row per revisit:
    record_id, url (canonical), status, refers_to (the response's id), headers
    (merged), digest (the response's).

    status: resolved (at least one validator compares, none differs: entity
    tag by weak comparison; without a pair of tags the modification date; the
    payload digest), mismatch, unverified (nothing to compare), no_response
    (no earlier one), no_url. Only a resolved revisit gets headers and digest.
    Records of another kind, with NULL id or (responses) NULL time are left
    out; a revisit with NULL time has no_response. Repeated rows give
    repeated results, repeated response ids count once. An empty table gives
    no rows; other columns are not read.
    """
    kind = F.lower(F.trim("kind"))
    rec = records.where(F.col("record_id").isNotNull() & kind.isin("response", "revisit")).select(
        F.col("record_id").cast("long").alias("id"), (kind == "response").cast("int").alias("full"),
        canonical_url(F.col("url")).alias("url"), F.col("ts").cast("timestamp").alias("ts"),
        plain_headers(F.col("headers")).alias("headers"), F.col("digest").cast("string").alias("digest"))
    rec = materialize(rec, "captures")
    stored = rec.where("full = 1").groupBy("id").agg(F.first(F.struct("headers", "digest")).alias("r"))
    timed = rec.where("url IS NOT NULL AND ts IS NOT NULL").select("id", "url", "ts", "full")
    # repeated rows of one revisit all find the same response
    found = cut(latest_before(timed.dropDuplicates()).select("id", "ts", "url", "before").distinct())
    stored = materialize(stored.select(F.col("id").alias("before"), "r"), "responses")
    asked = rec.where("full = 0").alias("q").join(
        found.alias("f"), F.expr("q.id = f.id AND q.ts <=> f.ts AND q.url <=> f.url"), "left").select("q.*", "f.before")
    both = asked.join(stored, "before", "left")

    tag = lambda h: F.regexp_replace(F.element_at(h, "etag"), r"^\s*[Ww]/", "")
    since = lambda h: F.element_at(h, "last-modified")
    theirs = F.col("r.headers")
    by_tag = tag(F.col("headers")) == tag(theirs)
    checks = F.array(F.coalesce(by_tag, since(F.col("headers")) == since(theirs)), F.col("digest") == F.col("r.digest"))
    status = (F.when(F.col("url").isNull(), "no_url").when(F.col("before").isNull(), "no_response")
              .when(F.exists(checks, lambda c: c == False), "mismatch")  # noqa: E712
              .when(F.exists(checks, lambda c: c == True), "resolved").otherwise("unverified"))  # noqa: E712
    out = both.select(F.col("id").alias("record_id"), "url", status.alias("status"), F.col("before").alias("refers_to"),
                      merged_headers(theirs, F.col("headers")).alias("merged"), F.col("r.digest").alias("found_digest"))
    ok = F.col("status") == "resolved"
    return out.select("record_id", "url", "status", "refers_to", F.when(ok, F.col("merged")).alias("headers"),
                      F.when(ok, F.col("found_digest")).alias("digest"))
