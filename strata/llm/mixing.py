"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of equal size in id order. With a share of a
out of H, its k-th block (from 0) is released at floor(k * H / a) and due at
ceil((k + 1) * H / a); earliest deadline first, one block a slot, meets all
deadlines because the shares add up to H, so after every slot each source is
less than one block away from its target weight. The schedule repeats after H
slots, so only one period is worked out (H is the sum of the given integer
shares, a bounded parameter) and every block's slot follows by arithmetic.
Nothing is dropped: slots of a source that has run out stay empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh_names, materialize, row_keys

MAX_PERIOD = 100_000


def period_schedule(shares: list[int]) -> list[tuple[int, int, int, int, int]]:
    """One period: (class, block in period, release, deadline, slot), by
    earliest deadline first; ties go to the earlier class."""
    total = sum(shares)
    if not 0 < total <= MAX_PERIOD or min(shares) < 1:
        raise ValueError(f"shares must be positive integers adding up to at most {MAX_PERIOD}")
    jobs = sorted((k * total // a, -(-(k + 1) * total // a), c, k) for c, a in enumerate(shares) for k in range(a))
    ready: list[tuple[int, int, int, int]] = []
    out, at = [], 0
    for slot in range(total):
        while at < len(jobs) and jobs[at][0] <= slot:
            release, due, c, k = jobs[at]
            heapq.heappush(ready, (due, c, k, release))
            at += 1
        due, c, k, release = heapq.heappop(ready)
        out.append((c, k, release, due, slot))
    return out


def schedule(docs: DataFrame, shares: dict[str, int], other_share: int, block_size: int, id_col: str = "doc_id",
             source_col: str = "source", text_col: str | None = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per input row: doc_id, source, size, before (size of the
    source's rows before it), block, release, deadline, slot, and the columns
    named in ``carry``. Ordering by (slot, before, doc_id) interleaves the
    sources.

    ``size`` is the number of characters of the text (NULL: 0), or 1 a row
    without ``text_col``. Sources not named in ``shares``, and NULL, form one
    class with ``other_share``. A text longer than a block occupies the slots
    of the blocks it spans. NULL ids come first in their source; repeated
    rows follow one another; an empty table gives no rows; other columns are
    not read. A hot source is spread over range partitions and only their
    totals meet.
    """
    spark = docs.sparkSession
    carry = carry or []
    names = sorted(shares)
    weights = [shares[n] for n in names] + [other_share]
    n_other, total = len(names), sum(weights)
    source = docs[source_col].cast("string")
    cls = F.lit(n_other)
    if names:
        known = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
        cls = F.coalesce(F.try_element_at(known, source), F.lit(n_other))
    size = F.lit(1) if text_col is None else F.coalesce(F.length(docs[text_col].cast("string")), F.lit(0))
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), source.alias("source"), cls.alias("cls"),
                         size.cast("long").alias("size"), *[docs[c].alias(f"c{i}") for i, c in enumerate(carry)])
    narrow = materialize(narrow, "mix-sizes")  # the texts are read once for their sizes
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = narrow.repartitionByRange(n_parts, "cls", "doc_id", "size").sortWithinPartitions("cls", "doc_id", "size")

    columns = [*narrow.columns, "pid", "before"]

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        last, seen = None, 0
        for b in batches:
            before = []
            for c, s in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if c != last:
                    last, seen = c, 0
                before.append(seen)
                seen += s
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([pid] * b.num_rows, pa.int32()), pa.array(before, pa.int64())],
                columns)

    # the pieces are stored once: offsets and rows must see the same ranges
    kinds = ", ".join(f"{c} {k}" for c, k in narrow.dtypes)
    pieces = materialize(ranged.mapInArrow(running, f"{kinds}, pid int, before long"), "mix-pieces")
    by_class = Window.partitionBy("cls").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (pieces.groupBy("cls", "pid").agg(F.sum("size").alias("total"))
               .select("cls", "pid", F.coalesce(F.sum("total").over(by_class), F.lit(0)).alias("offset")))
    offsets = F.broadcast(offsets)  # at most partitions + classes rows: the ranges are contiguous
    period = spark.createDataFrame(
        period_schedule(weights), "cls int, k long, r long, d long, s long")
    before = F.col("offset") + F.col("before")
    share_of = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("cls") + 1)
    placed = (pieces.join(offsets, ["cls", "pid"])
              .select("doc_id", "source", "cls", "size", before.alias("before"), share_of.alias("share"), *narrow.columns[4:])
              .withColumn("block", F.expr(f"before div {int(block_size)}"))
              .withColumns({"k": F.expr("block % share"), "turn": F.expr(f"(block div share) * {total}")}))
    return placed.join(F.broadcast(period), ["cls", "k"]).select(
        "doc_id", "source", "size", "before", "block", (F.col("turn") + F.col("r")).alias("release"),
        (F.col("turn") + F.col("d")).alias("deadline"), (F.col("turn") + F.col("s")).alias("slot"),
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])


def mixed(docs: DataFrame, shares: dict[str, int], other_share: int, block_size: int, id_col: str = "doc_id",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` in mix order: the partitions follow
    one another by (slot, size before, id), so do the written files.

    Every row has its own place, also rows that share an id or have none, and
    equal rows follow one another. NULL texts have size 0; sources as in
    ``schedule``; other columns may have any name; an empty table stays empty.
    The places are cut into partitions of equal size while they are narrow, so
    the texts move once and no sample of them is taken.
    """
    spark = docs.sparkSession
    docs, keys = row_keys(docs)
    order = fresh_names(docs, "mix_slot", "mix_before", "mix_part")
    placed = schedule(docs, shares, other_share, block_size, id_col, source_col, text_col, keys)
    placed = placed.select(*keys, F.col("slot").alias(order[0]), F.col("before").alias(order[1]), F.col("doc_id").alias("id"))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = placed.repartitionByRange(n_parts, *order[:2], "id", *keys)
    placed = materialize(ranged.withColumn(order[2], F.spark_partition_id()).drop("id"), "mix-places")
    out = docs.join(placed, keys).repartitionById(n_parts, order[2])
    return out.sortWithinPartitions(*order[:2], id_col, *keys).drop(*order, *keys)
