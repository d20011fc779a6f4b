"""Writes: tables, snapshots, quarantine (A14, K5) and the pointer swap
that replaces a snapshot which is also an input."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.sources.pointer import exists, file_system, read_text, replace_text
from strata.sources.schema import SchemaChanged


def write_table(df: DataFrame, path: str, mode: str = "append", overwrite_schema: bool = False,
                merge_schema: bool = False, partition_by=None, max_records_per_file: int | None = None) -> None:
    """Append or overwrite a parquet table folder.

    The columns of an existing table are kept: appending rows with new columns
    needs ``merge_schema`` (then read with ``mergeSchema``), overwriting with
    other columns or types needs ``overwrite_schema``. Rows that lack a column
    of the table read it as NULL. A type conflict on append is refused (see
    ``schema.conform_to``).
    """
    if mode in ("append", "overwrite") and exists(df.sparkSession, path):
        stored = {f.name: f.dataType for f in df.sparkSession.read.option("mergeSchema", True).parquet(path).schema.fields}
        rows = {f.name: f.dataType for f in df.schema.fields}
        conflicts = sorted(n for n in rows if n in stored and stored[n] != rows[n])
        new = sorted(set(rows) - set(stored))
        if mode == "append" and (conflicts or (new and not merge_schema)):
            raise SchemaChanged(f"append to {path}: new columns {new}, other types {conflicts}")
        if mode == "overwrite" and rows != stored and not overwrite_schema:
            raise SchemaChanged(f"overwrite of {path}: new columns {new}, other types {conflicts}, gone {sorted(set(stored) - set(rows))}")
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def move_path(spark: SparkSession, src: str, dst: str) -> None:
    """Move a folder within one file system (a landing arrival); creates
    the parent of ``dst``."""
    fs, s = file_system(spark, src)
    _, d = file_system(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise IOError(f"could not move {src} to {dst}")


def current_snapshot(spark: SparkSession, table_root: str) -> str | None:
    """Path of the table's current snapshot, from its ``_CURRENT`` pointer."""
    name = read_text(spark, os.path.join(table_root, "_CURRENT"))
    return os.path.join(table_root, name.strip()) if name else None


def read_snapshot(spark: SparkSession, table_root: str) -> DataFrame | None:
    cur = current_snapshot(spark, table_root)
    return spark.read.parquet(cur) if cur else None


def write_snapshot(spark: SparkSession, df: DataFrame, table_root: str) -> str:
    """Write the next snapshot ``v=<n+1>-<unique>`` beside the current one,
    then swap the small ``_CURRENT`` pointer file in one atomic rename.
    Readers of the old snapshot (including ``df``'s own lineage) are never
    overwritten; a run that died before the swap leaves a folder nobody
    names, and the next run writes its own."""
    cur = read_text(spark, os.path.join(table_root, "_CURRENT"))
    n = int(cur.split("=")[1].split("-")[0]) + 1 if cur else 1
    name = f"v={n}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(os.path.join(table_root, name))
    replace_text(spark, os.path.join(table_root, "_CURRENT"), name)
    return os.path.join(table_root, name)


def write_quarantine(df: DataFrame, table_root: str) -> None:
    """K5: append failed rows (with ``_dq_reason``) to ``<table>_quarantine``."""
    df.write.mode("append").parquet(table_root.rstrip("/") + "_quarantine")
