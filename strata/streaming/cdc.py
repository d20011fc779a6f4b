"""J8 in a stream: a CDC feed folded into a snapshot table, one
micro-batch at a time (``foreachBatch``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.scd import ChangeSpec, apply_changes, visible
from strata.sources import sinks
from strata.sources.keyed import KeyedTable


def apply_changes_stream(changes: DataFrame, table_root: str, checkpoint: str, spec: ChangeSpec):
    """Each micro-batch is applied to the table's current snapshot with
    :func:`apply_changes` and written as the next snapshot (pointer swap);
    only the keys of the batch are rebuilt. Type 1 snapshots keep tombstones,
    so an older change in a later batch cannot bring a deleted key back; read
    the table with :func:`read_table`.

    A retried batch applies the same changes to a snapshot that may hold them
    already, which changes nothing: type 1 takes the newest change, type 2
    drops a change that repeats the state it would open.
    """
    spark = changes.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        nxt = apply_changes(sinks.read_snapshot(spark, table_root), batch, spec, keep_tombstones=True)
        sinks.write_snapshot(spark, nxt, table_root)

    q = changes.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
    q.awaitTermination()
    return q


def apply_changes_keyed(changes: DataFrame, table: KeyedTable, checkpoint: str, spec: ChangeSpec):
    """The same into a :class:`KeyedTable`: a micro-batch reads and writes
    the buckets of its keys, all others keep their files. Type 1 rows carry
    ``_deleted`` (tombstones). A retried batch changes nothing, as above."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for its buckets and for the merge; stored by the stream's source
        try:
            table.update(batch, lambda old, new: apply_changes(old, new, spec, keep_tombstones=True))
        finally:
            batch.unpersist()

    q = changes.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
    q.awaitTermination()
    return q


def read_table(spark: SparkSession, table_root: str) -> DataFrame | None:
    """The current rows of a table kept by :func:`apply_changes_stream`."""
    cur = sinks.read_snapshot(spark, table_root)
    return None if cur is None else visible(cur)
