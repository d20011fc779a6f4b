"""Filter interaction audit over every order of a set of filters.

Which filters a document fails does not depend on their order, so one pass
gives its set of failures, and additive counts of these sets answer every
question about every order. The one filter that looks at other documents,
exact repeats, has a counting-Bloom prepass: each task counts the hashes of its
texts in partial sketches, merged sketches clear the texts whose counters show
a single occurrence (they are certainly unique), and only possible repeats
send their whole text through a shuffle for the smallest id of each.

Sketches are cut into slices by hash, their number follows the number of
documents, and a text that stands in a third of all documents reaches its
slice once a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import broadcast_within, cut, frees_memory, materialize, text_bytes

COUNTERS = 16  # a document
HASHES = 4
SLICE_DOCS = (1 << 10, 1 << 20)  # a slice serves at least, at most
TASK_HASHES = 1 << 20  # held by a task before it sends its partial sketches
MAX_BROADCAST_BYTES = 32 << 20
FILTERS = "ABCDE"
_UPPER = bytes(range(65, 91))
_SIGNS = b"#$%&*|"


# -- counting Bloom sketch --------------------------------------------------

def _places(h: np.ndarray, width: int) -> np.ndarray:
    """Counter places (hashes x HASHES) inside a slice."""
    x = h.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


def _slices(h: np.ndarray, slices: int) -> np.ndarray:
    return (h.view(np.uint64) % np.uint64(slices)).astype(np.int64)


def _runs(h: np.ndarray, slices: int) -> Iterator[tuple[int, slice]]:
    """(slice, its run) of hashes sorted by slice."""
    at = _slices(h, slices)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
    for lo, hi in zip(first, np.append(first[1:], len(at))):
        yield int(at[lo]), slice(lo, hi)


def _local(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct hashes of a task with their counts, sorted by slice, in
    portions of about ``TASK_HASHES``."""
    held: list[np.ndarray] = []
    size = 0

    def portion() -> tuple[np.ndarray, np.ndarray]:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        order = np.argsort(_slices(h, slices), kind="stable")
        return h[order], n[order]

    for b in batches:
        held.append(b.column(0).to_numpy(zero_copy_only=False))
        size += b.num_rows
        if size >= TASK_HASHES:
            yield portion()
            held, size = [], 0
    if size:
        yield portion()


def sketch_size(n: int, partitions: int) -> tuple[int, int]:
    """(slices, counters a slice) for ``n`` documents."""
    least, most = SLICE_DOCS
    slices = max(1, -(-n // most), min(partitions, -(-n // least)))
    return slices, COUNTERS * max(4, -(-n // slices))


def counting_sketch(hashes: DataFrame, slices: int, width: int) -> DataFrame:
    """(slice, counters binary): one saturating byte a counter; stored."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, n in _local(batches, slices):
            rows = []
            for s, run in _runs(h, slices):
                places = _places(h[run], width)
                at, back = np.unique(places, return_inverse=True)
                count = np.bincount(back.ravel(), weights=np.repeat(n[run], HASHES), minlength=len(at))
                rows.append((s, at.astype("<u4").tobytes(), np.minimum(count, 255).astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], ["slice", "at", "n"])

    def merge(t: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for at, n in zip(t["at"], t["n"]):
            total[np.frombuffer(at.as_buffer(), "<u4")] += np.frombuffer(n.as_buffer(), np.uint8)  # places of one part differ
        return pa.table([pa.array([t["slice"][0].as_py()], pa.int64()), pa.array([np.minimum(total, 255).astype(np.uint8).tobytes()], pa.binary())],
                        names=["slice", "counters"])

    parts = hashes.mapInArrow(frees_memory(partial), "slice long, at binary, n binary")
    return materialize(parts.groupBy("slice").applyInArrow(merge, "slice long, counters binary"), "audit-sketch")


def possible_repeats(hashes: DataFrame) -> DataFrame:
    """(h): the hashes of ``hashes`` (one long column, stored) that the merged
    sketch cannot clear: all that occur twice, and a few that do not."""
    n = hashes.count()
    slices, width = sketch_size(n, int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sketch = counting_sketch(hashes, slices, width)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, _ in _local(batches, slices):
            rows = [(s, h[run].astype("<i8").tobytes()) for s, run in _runs(h, slices)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary()))], ["slice", "h"])

    def clear(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())], names=["h"])
        h = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for x in left["h"]]))
        counters = np.frombuffer(right["counters"][0].as_buffer(), np.uint8)
        return pa.table([pa.array(h[counters[_places(h, width)].min(axis=1) > 1])], names=["h"])

    asked = hashes.mapInArrow(frees_memory(ask), "slice long, h binary")
    return cut(asked.groupBy("slice").cogroup(sketch.groupBy("slice")).applyInArrow(clear, "h long"))


# -- failures of each document ----------------------------------------------

def own_failures(text: str | None) -> str:
    """Letters of the filters that a text fails by itself: A under 100 words;
    B under 80 % distinct words; C over 10 % of its code points in A-Z; D a
    sign of ``#$%&*|``."""
    raw = text_bytes(text)
    words = raw.split()
    n = len(words)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return (("A" if n < 100 else "") + ("B" if 100 * len(set(words)) < 80 * n else "") + ("C" if 100 * upper > 10 * len(text or "") else "")
            + ("D" if len(raw.translate(None, _SIGNS)) < len(raw) else ""))


def first_ids(docs: DataFrame, repeats: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h, n_bytes, first): the smallest id of every whole text whose hash is
    among ``repeats`` (h). Other texts do not leave their task while
    ``repeats`` is small enough to be broadcast; beyond, it is a shuffle join
    with the same result. Equal texts meet once a task."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    src = docs.select(docs[id_col].cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h")).where("id IS NOT NULL")
    same = src.join(broadcast_within(repeats, MAX_BROADCAST_BYTES), "h", "left_semi").groupBy("h", "text").agg(F.min("id").alias("first"))
    return cut(same.select("h", F.octet_length("text").alias("n_bytes"), "first").distinct())


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, fails, good, toxic, n): additive counts of documents by their
    set of failed filters. ``good`` and ``toxic``: any label row of the id
    says so."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    src = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"), text.alias("text"),
                      F.xxhash64(text).alias("h"), F.octet_length(text).alias("n_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fails = [own_failures(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), b.column(4), pa.array(fails, pa.string())],
                                             ["id", "part", "h", "n_bytes", "own"])

    facts = materialize(src.mapInArrow(frees_memory(run), "id long, part string, h long, n_bytes int, own string"), "audit-facts")
    repeats = possible_repeats(facts.select("h"))
    firsts = first_ids(docs, repeats, id_col, text_col).withColumnRenamed("first", "id").withColumn("is_first", F.lit(True))
    marked = facts.where("id IS NOT NULL").join(broadcast_within(repeats, MAX_BROADCAST_BYTES).withColumn("maybe", F.lit(True)), "h", "left")
    marked = marked.join(firsts, ["h", "n_bytes", "id"], "left")
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marked = marked.join(known, "id", "left")
    no, yes = F.lit(False), F.lit(True)
    repeat = F.coalesce("maybe", no) & ~F.coalesce("is_first", no)
    fails = F.concat("own", F.when(repeat, "E").otherwise(""))
    rows = marked.select("part", fails.alias("fails"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    # a NULL id is neither larger nor smaller than another, and has no label
    rows = rows.unionAll(facts.where("id IS NULL").select("part", F.col("own").alias("fails"), (~yes).alias("good"), (~yes).alias("toxic")))
    return rows.groupBy("part", "fails", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))


# -- every order ------------------------------------------------------------

def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Per part, order of the five filters and step: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley (sum of the
    filter's removals over all orders); filter E fails a document whose text
    is identical to that of any smaller id in the table.

    NULL texts are empty texts and repeats of one another; NULL parts are the
    empty string; rows with a NULL id count but are no repeats, make none and
    have no label; rows that share id and text are no repeats of one another;
    an id labelled twice is good (toxic) if any of its rows says so; an empty
    table gives no rows; other columns are not read.
    """
    masks = cut(failure_masks(docs, labels, id_col, text_col, part_col))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    every = (masks.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(steps).alias("step"))
             .withColumn("filter", F.expr("substring(filter_order, step, 1)"))
             .withColumn("fails_it", F.expr("contains(fails, filter)"))
             .withColumn("gone", F.expr("translate(fails, substring(filter_order, 1, step - 1), '') <> fails")))
    removed = F.col("fails_it") & ~F.col("gone")

    def total(what, name):
        return F.sum(F.when(what, F.col("n")).otherwise(0)).alias(name)

    counted = every.groupBy("part", "filter_order", "step", "filter").agg(
        total(~F.col("fails_it") & ~F.col("gone"), "kept"), total(removed, "removed"), total(F.col("fails_it") & F.col("gone"), "redundant"),
        total(F.col("fails") == F.col("filter"), "unique_fails"), total(removed & F.col("good"), "good_lost"),
        total(removed & F.col("toxic"), "toxic_lost"))
    counted = cut(counted)
    shares = counted.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return counted.join(shares, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
