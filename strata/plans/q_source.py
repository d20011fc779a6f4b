"""Queries: sources, sinks and layout.

Each one writes a whole given table into a run folder of the shared
checkpoint folder in some landing format, ingests it, and returns what the
target holds.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strata.operators import layout, skipping
from strata.operators.skipping import IndexedTable
from strata.plans.registry import query
from strata.plans.sql import AGENTS, NATIONS, with_
from strata.plans.star import Star
from strata.sources import files, ingest, schema, sinks
from strata.sources.json_split import read_json_array_split
from strata.streaming import ops
from strata.streaming.runs import run_dir

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
EVENT = "event_id bigint, user_id bigint, event_type string, value double"
EVENT_SQL = "SELECT event_id, user_id, event_type, value FROM events"


@query("ingest_csv_roundtrip", CUSTOMER_SQL)
def ingest_csv_roundtrip(t):
    """A table landed as CSV and copied into a target, typed."""
    root = run_dir(t.spark, "csv")
    t.customer.select(*CUSTOMER_COLS).write.option("header", True).csv(f"{root}/land")
    ingest.copy_into(t.spark, f"{root}/land", f"{root}/t", "csv", f"{root}/ledger", schema=CUSTOMER, glob="*.csv")
    return t.spark.read.parquet(f"{root}/t").select(*CUSTOMER_COLS)


@query("ingest_csv_reordered_header", CUSTOMER_SQL)
def ingest_csv_reordered_header(t):
    """Half of the files carry their columns in another order; values
    follow the header."""
    root = run_dir(t.spark, "csv-order")
    c = t.customer.select(*CUSTOMER_COLS)
    odd = F.col("c_custkey") % 2 == 1
    c.where(odd).write.option("header", True).csv(f"{root}/land/a")
    c.where(~odd).select(*reversed(CUSTOMER_COLS)).write.option("header", True).csv(f"{root}/land/b")
    ingest.copy_into(t.spark, f"{root}/land", f"{root}/t", "csv", f"{root}/ledger", schema=CUSTOMER, glob="*.csv")
    return t.spark.read.parquet(f"{root}/t").select(*CUSTOMER_COLS)


@query("ingest_csv_stream", CUSTOMER_SQL)
def ingest_csv_stream(t):
    """A3: a table landed as CSV and ingested by a stream."""
    root = run_dir(t.spark, "csv-stream")
    t.customer.select(*CUSTOMER_COLS).write.option("header", True).csv(f"{root}/land")
    ingest.ingest_csv_stream(t.spark, f"{root}/land", f"{root}/t", f"{root}/ck", CUSTOMER, rescue=True)
    return t.spark.read.parquet(f"{root}/t").select(*CUSTOMER_COLS)


@query("ingest_ndjson_rescue", """
SELECT event_id, user_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 10 = 0 THEN '{"value":"n/a","event_type":"' || event_type || '"}' ELSE '{"event_type":"' || event_type || '"}' END AS rescued
FROM events""")
def ingest_ndjson_rescue(t):
    """Events as JSON lines; a field outside the schema and values
    of a wrong type are rescued, nothing is lost."""
    root = run_dir(t.spark, "ndjson")
    e = t.events.select("event_id", "user_id", F.when(F.col("event_id") % 10 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("v"),
                        "event_type")
    text = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"user_id":'), F.col("user_id"), F.lit(',"value":'),
                    F.when(F.col("v") == "n/a", F.lit('"n/a"')).otherwise(F.col("v")), F.lit(',"event_type":"'), F.col("event_type"), F.lit('"}'))
    e.select(text).write.text(f"{root}/land")
    ingest.copy_into(t.spark, f"{root}/land", f"{root}/t", "json", f"{root}/ledger", schema="event_id bigint, user_id bigint, value double",
                     glob="*.txt", rescue=True)
    return t.spark.read.parquet(f"{root}/t").select("event_id", "user_id", "value", F.col("_rescued_data").alias("rescued"))


@query("ingest_json_stream", EVENT_SQL)
def ingest_json_stream(t):
    """Events as JSON lines, ingested by a stream in several triggers."""
    root = run_dir(t.spark, "json-stream")
    t.events.select("event_id", "user_id", "event_type", "value").repartition(4).write.json(f"{root}/land")
    ingest.ingest_json_stream(t.spark, f"{root}/land", f"{root}/t", f"{root}/ck", EVENT, max_files_per_trigger=2)
    return t.spark.read.parquet(f"{root}/t").select("event_id", "user_id", "event_type", "value")


@query("read_json_array", "SELECT p_partkey, p_name, p_brand FROM part")
def read_json_array(t):
    """A4: files of one JSON array each (here arrays of at most 100 parts)."""
    root = run_dir(t.spark, "json-array")
    parts = t.part.select("p_partkey", "p_name", "p_brand")
    arrays = parts.groupBy(F.floor(F.col("p_partkey") / 100).alias("n")).agg(F.collect_list(F.struct(*parts.columns)).alias("a"))
    arrays.select(F.to_json("a").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{root}/land")
    return files.read_json_array(t.spark, f"{root}/land", "p_partkey bigint, p_name string, p_brand string").select("p_partkey", "p_name", "p_brand")


@query("read_json_array_split", "SELECT event_id, user_id, props FROM events")
def read_json_array_split_q(t):
    """A4: large arrays (one a partition of the events, whose ``props`` are
    JSON text themselves), each read in byte ranges."""
    def arrays(batches):
        yield pa.RecordBatch.from_arrays([pa.array(["["])], ["value"])
        first = True
        for b in batches:
            rows = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([r if first and i == 0 else "," + r for i, r in enumerate(rows)], pa.string())], ["value"])
            first = first and not rows
        yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])

    root = run_dir(t.spark, "json-split")
    e = t.events.select(F.to_json(F.struct("event_id", "user_id", "props")).alias("value"))
    e.mapInArrow(arrays, "value string").write.text(f"{root}/land")
    return read_json_array_split(t.spark, f"{root}/land", "event_id bigint, user_id bigint, props string")


@query("copy_into_twice", "SELECT s_suppkey, s_name, CAST(1 AS BIGINT) AS copies FROM supplier")
def copy_into_twice(t):
    """A second run over the same files, and a run after new ones, load
    every row exactly once."""
    root = run_dir(t.spark, "copy-twice")
    s = t.supplier.select("s_suppkey", "s_name")

    def load():
        ingest.copy_into(t.spark, f"{root}/land", f"{root}/t", "parquet", f"{root}/ledger", glob="*.parquet", max_files=2)

    s.where("s_suppkey % 2 = 0").repartition(3).write.parquet(f"{root}/land/a")
    load()
    load()
    s.where("s_suppkey % 2 = 1").write.parquet(f"{root}/land/b")
    load()
    return t.spark.read.parquet(f"{root}/t").groupBy("s_suppkey", "s_name").agg(F.count(F.lit(1)).alias("copies"))


@query("snapshot_recover", CUSTOMER_SQL)
def snapshot_recover(t):
    """A snapshot write that died before its pointer swap does not stop
    the next one."""
    root = run_dir(t.spark, "snapshot")
    sinks.write_snapshot(t.spark, t.nation, f"{root}/t")
    t.region.write.parquet(f"{root}/t/v=2-dead")
    sinks.write_snapshot(t.spark, t.customer.select(*CUSTOMER_COLS), f"{root}/t")
    return sinks.read_snapshot(t.spark, f"{root}/t")


@query("write_table_merge", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS c_acctbal FROM customer""")
def write_table_merge(t):
    """An append with a new column; older rows read it as NULL."""
    root = run_dir(t.spark, "write-table")
    sinks.write_table(t.customer.where("c_custkey % 2 = 0").select("c_custkey", "c_name"), f"{root}/t")
    sinks.write_table(t.customer.where("c_custkey % 2 = 1").select("c_custkey", "c_name", "c_acctbal"), f"{root}/t", merge_schema=True)
    return files.read_files(t.spark, f"{root}/t", "parquet", mergeSchema=True).select("c_custkey", "c_name", "c_acctbal")


@query("list_landing", "SELECT true AS all_listed, true AS all_filled")
def list_landing(t):
    """The inventory of a landed table names every file that holds its
    rows, without reading their contents."""
    root = run_dir(t.spark, "landing")
    t.events.write.option("maxRecordsPerFile", 5000).parquet(f"{root}/land")
    inv = files.list_landing(t.spark, f"{root}/land", "*.parquet").select("length", F.regexp_extract("path", "[^/]+$", 0).alias("name"))
    held = t.spark.read.parquet(f"{root}/land").select(F.col("_metadata.file_name").alias("name")).distinct().withColumn("held", F.lit(True))
    both = inv.join(held, "name", "full")
    return both.agg(F.bool_and(F.col("length").isNotNull() & F.col("held")).alias("all_listed"), F.bool_and(F.col("length") > 0).alias("all_filled"))


@query("schema_drift", """
SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events""")
def schema_drift(t):
    """A column that appears after the first run is read after one
    restart; older rows have NULL."""
    root = run_dir(t.spark, "drift")
    stored = StructType([StructField("event_id", t.events.schema["event_id"].dataType), StructField("user_id", t.events.schema["user_id"].dataType)])

    def run(s):
        ingest.stream_to_table(ingest.file_stream(t.spark, f"{root}/land", "json", s, recursiveFileLookup=True), f"{root}/t", f"{root}/ck")

    t.events.where("event_id % 2 = 0").select("event_id", "user_id").write.json(f"{root}/land/a")
    run(stored)
    t.events.where("event_id % 2 = 1").select("event_id", "user_id", "event_type").write.json(f"{root}/land/b")
    run(schema.drifted_schema(t.spark, f"{root}/land", "json", stored, recursiveFileLookup=True))
    return t.spark.read.option("mergeSchema", True).parquet(f"{root}/t").select("event_id", "user_id", "event_type")


@query("stream_expectations", """
SELECT count(*) AS rows, count(*) FILTER (WHERE value <= 300) AS passed, count(*) FILTER (WHERE value > 300) AS failed FROM events""")
def stream_expectations(t):
    """Expectation counts observed in every micro-batch, added up."""
    root = run_dir(t.spark, "expectations")
    t.events.select("event_id", "value").repartition(3).write.parquet(f"{root}/land")
    stream = ingest.file_stream(t.spark, f"{root}/land", "parquet", "event_id bigint, value double", max_files_per_trigger=1)
    q = ingest.stream_to_table(ops.observed_expectations(stream, "dq", [("in_range", F.col("value") <= 300)]), f"{root}/t", f"{root}/ck")
    seen = [p["observedMetrics"]["dq"] for p in q.recentProgress if "dq" in p["observedMetrics"]]
    counts = t.spark.createDataFrame([(int(m["rows"]), int(m["passed"]), int(m["failed_in_range"])) for m in seen], "r long, p long, f long")
    return counts.agg(F.sum("r").alias("rows"), F.sum("p").alias("passed"), F.sum("f").alias("failed"))


@query("compact_files", """
SELECT true AS fewer_files, true AS large_files_kept, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders""")
def compact_files(t):
    """Q1: small files packed together, large ones left as they are, same
    rows."""
    table = IndexedTable(t.spark, f"{run_dir(t.spark, 'compact')}/t")
    small = F.pmod(F.xxhash64("o_orderkey"), F.lit(4)) == 0
    table.append(t.orders.where(~small).coalesce(2))
    table.append(t.orders.where(small).repartition(24))
    before = table.index().select("file", "length").collect()  # 26 paths
    large = max(r["length"] for r in before)
    table.compact(target_bytes=large, small_bytes=large // 2)
    after = {r["file"] for r in table.index().select("file").collect()}
    kept = {r["file"] for r in before if r["length"] >= large // 2} <= after
    return table.read().agg(F.lit(len(after) < len(before)).alias("fewer_files"), F.lit(kept).alias("large_files_kept"), F.count(F.lit(1)).alias("rows"),
                            F.sum("o_orderkey").alias("key_sum"))


@query("cluster_two_keys", "SELECT true AS first_key_skips, true AS second_key_skips, count(*) AS rows FROM orders")
def cluster_two_keys(t):
    """Q2: files along a Hilbert curve over date and customer: a range of
    either key alone opens at most half of them."""
    table = IndexedTable(t.spark, f"{run_dir(t.spark, 'curve')}/t", ranges=["o_orderdate", "o_custkey"])
    table.append(skipping.curve_by(t.orders, ["o_orderdate", "o_custkey"], 64))
    top = t.orders.agg(F.max("o_custkey")).head()[0]
    first = table.files(between={"o_orderdate": ("1996-01-01", "1996-01-31")}).agg(F.count(F.lit(1))).scalar()
    second = table.files(between={"o_custkey": (top // 2, top // 2 + top // 50)}).agg(F.count(F.lit(1))).scalar()
    total = table.index().agg(F.count(F.lit(1))).scalar()
    return table.read().agg((first * 2 <= total).alias("first_key_skips"), (second * 2 <= total).alias("second_key_skips"), F.count(F.lit(1)).alias("rows"))


@query("skip_index_lookup", """
SELECT o_orderkey, o_custkey, o_totalprice, true AS few_files FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)""")
def skip_index_lookup(t):
    """Q2: a point lookup opens the files that the stored Bloom filters leave
    (minima and maxima leave all of them: the rows are in no order)."""
    table = IndexedTable(t.spark, f"{run_dir(t.spark, 'bloom')}/t", ranges=["o_orderkey"], lookups=["o_orderkey"])
    table.append(t.orders.repartition(16, "o_custkey"))
    key = {"o_orderkey": t.orders.agg(F.max("o_orderkey")).head()[0]}
    few = table.files(key).agg(F.count(F.lit(1)) * 4).scalar() <= table.index().agg(F.count(F.lit(1))).scalar()
    return table.read(key).select("o_orderkey", "o_custkey", "o_totalprice", few.alias("few_files"))


@query("cluster_files", "SELECT true AS skips_files, count(*) AS rows FROM orders")
def cluster_files(t):
    """Q2: files of a clustered table cover narrow key ranges."""
    root = run_dir(t.spark, "cluster")
    layout.cluster_by(t.orders, "o_orderdate", 8).write.parquet(f"{root}/t")
    touched = layout.files_touched(t.spark, f"{root}/t", "o_orderdate", "1996-01-01", "1996-01-31")
    return touched.select((F.col("files_touched") <= 2).alias("skips_files")).withColumn(
        "rows", t.spark.read.parquet(f"{root}/t").agg(F.count(F.lit(1))).scalar())


@query("dim_agent", with_(NATIONS, AGENTS) + "SELECT agent_id, agent_name, state, region, commission_base, true AS is_current FROM agt")
def dim_agent(t):
    """L4: the current agent dimension."""
    return Star(t).dim_agent.select("agent_id", "agent_name", "state", "region", "commission_base", "is_current")
