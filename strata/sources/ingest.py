"""Incremental, idempotent ingestion.

``copy_into`` is the batch form: a ledger table remembers the loaded files,
so a second run adds nothing. The streaming forms use a Structured
Streaming file source with a checkpoint and ``trigger(availableNow=True)``:
every new file is processed exactly once, then the query stops.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources import files
from strata.sources.pointer import exists, list_names
from strata.sources.schema import conform_to, with_rescued
from strata.sources.sinks import move_path

RESCUED = "_rescued_data"
LEDGER = "path string, load string, _loaded_ts timestamp"


def _read(spark: SparkSession, paths: list[str], fmt: str, schema=None, merge_schema: bool = False, rescue: bool = False, **opts) -> DataFrame:
    """The files of one load, with ``_source_file``. CSV columns are matched
    by header; with ``rescue`` malformed rows and fields outside the schema
    are kept in ``_rescued_data``."""
    if fmt == "csv" and schema is not None:
        return files.read_csv_by_header(spark, paths, schema, RESCUED if rescue else None, **opts)
    if fmt == "json" and schema is not None and rescue:
        text = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_source_file"))
        return with_rescued(text, "value", files.as_struct(schema), RESCUED)
    r = spark.read.format(fmt).options(**opts)
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", True)
    if merge_schema and fmt == "parquet":
        r = r.option("mergeSchema", True)
    if schema is not None:
        r = r.schema(schema)
    return r.load(paths).withColumn("_source_file", F.col("_metadata.file_path"))


def copy_into(spark: SparkSession, src: str, target: str, fmt: str, ledger: str, schema=None,
              merge_schema: bool = True, glob: str | None = None, rescue: bool = False, max_files: int = 10_000, **opts) -> int:
    """Load the files of ``src`` that the ledger has not seen, append
    them (with ``_source_file`` / ``_ingest_ts``) to ``target`` and record
    them in the ledger. Returns the number of new files (0 on a re-run).

    Data and ledger appear together: a load is staged in a hidden folder, its
    file list goes to the ledger under the load's id, and one rename publishes
    the folder as ``_load=<id>``. Ledger entries of a load that was not
    published do not count, so a crash at any point neither loses nor doubles
    rows. ``_load`` reads as a partition column.

    The new-file list is an anti join of the folder inventory against the
    ledger, evaluated on the executors; paths reach the driver in loads of at
    most ``max_files`` (the unit a reader needs).
    """
    done = 0
    while True:
        inventory = files.list_landing(spark, src, glob)
        published = [n.partition("=")[2] for n in list_names(spark, target) if n.startswith("_load=")]
        if exists(spark, ledger) and published:
            loads = spark.createDataFrame([(p,) for p in published], "load string")
            seen = spark.read.schema(LEDGER).parquet(ledger).join(F.broadcast(loads), "load", "left_semi")
            inventory = inventory.join(seen.select("path"), "path", "left_anti")
        paths = [r.path for r in inventory.select("path").orderBy("path").limit(max_files).collect()]
        if not paths:
            return done
        load = f"l{uuid.uuid4().hex}"
        df = _read(spark, paths, fmt, schema, merge_schema, rescue, **opts).withColumn("_ingest_ts", F.current_timestamp())
        if published:
            stored = spark.read.option("mergeSchema", True).parquet(target).schema
            df = conform_to(df, StructType([f for f in stored.fields if f.name != "_load"]))
            if not merge_schema:
                df = df.select(*[c for c in df.columns if c in stored.names])
        df.write.parquet(f"{target}/_staging-{load}")
        spark.createDataFrame([(p, load) for p in paths], "path string, load string").withColumn("_loaded_ts", F.current_timestamp()) \
            .select("path", "load", "_loaded_ts").write.mode("append").parquet(ledger)
        move_path(spark, f"{target}/_staging-{load}", f"{target}/_load={load}")
        done += len(paths)
        if len(paths) < max_files:
            return done


def file_stream(spark: SparkSession, src: str, fmt: str, schema: StructType | str,
                max_files_per_trigger: int | None = None, rescue: bool = False, **opts) -> DataFrame:
    """A streaming file source with a fixed schema (a stream
    needs one; see ``schema.evolve_schema`` for drift), with lineage columns.
    A CSV file whose header does not follow the schema fails the query instead
    of putting values under wrong names. With ``rescue`` malformed CSV rows,
    and malformed or additional JSON, are kept in ``_rescued_data``."""
    r = spark.readStream.options(**opts)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "json" and rescue:
        df = r.text(src).withColumn("_source_file", F.col("_metadata.file_path"))
        return with_rescued(df, "value", files.as_struct(schema), RESCUED).withColumn("_ingest_ts", F.current_timestamp())
    r = r.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("enforceSchema", False)
        if rescue:
            schema = StructType([*files.as_struct(schema).fields]).add(RESCUED, "string")
            r = r.option("columnNameOfCorruptRecord", RESCUED)
    df = r.schema(schema).load(src)
    return df.withColumn("_source_file", F.col("_metadata.file_path")).withColumn("_ingest_ts", F.current_timestamp())


def stream_to_table(stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet",
                    output_mode: str = "append", foreach_batch=None, query_name: str | None = None):
    """Run the stream over everything available, then stop.

    One checkpoint per source makes a restart exactly-once: files already
    committed are skipped. Returns the finished query (its
    ``recentProgress`` holds per-batch row counts).
    """
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).start(target)
    q.awaitTermination()
    return q


def ingest_csv_stream(spark: SparkSession, src: str, target: str, checkpoint: str, schema, **opts):
    """A3: incremental CSV ingestion (options as in :func:`file_stream`)."""
    return stream_to_table(file_stream(spark, src, "csv", schema, **opts), target, checkpoint)


def ingest_json_stream(spark: SparkSession, src: str, target: str, checkpoint: str, schema, **opts):
    """Incremental JSON-lines ingestion (high-volume events)."""
    return stream_to_table(file_stream(spark, src, "json", schema, **opts), target, checkpoint)


def ingest_ndjson(spark: SparkSession, src: str, target: str | None = None, checkpoint: str | None = None,
                  schema=None, stream: bool = False):
    """A5: newline JSON, batch (returns a frame) or stream (runs to the
    target)."""
    if not stream:
        from strata.sources.files import read_ndjson

        return read_ndjson(spark, src, schema)
    return ingest_json_stream(spark, src, target, checkpoint, schema)
