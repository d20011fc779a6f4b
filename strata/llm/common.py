"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import inspect
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import configure, ensure_checkpoint_dir

# Fixed values of the word definitions (see each operator's docstring).
WHITESPACE = b" \t\n\x0b\x0c\r"
SPACE_WORD = np.array([b not in WHITESPACE for b in range(256)])  # bytes of words between white space
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)  # A-Z only

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults; Arrow batches are bounded by bytes as well as rows,
    so a batch of very long texts stays small."""
    configure(spark)
    for limit in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(limit, "50m")  # the limits that these operators were checked under
    spark.conf.set(ARROW_BYTES, str(8 << 20))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-llm/{name}-{uuid.uuid4().hex}"


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, compression: str = "zstd", release: bool = False,
                task_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the
    lineage, survives lost executors, and later readers prune columns.
    ``release``: the shuffles of the write go when it has ended, not when the
    driver happens to collect garbage. ``task_bytes``: what Spark puts together
    for a task of the write's shuffles, if not the session's advisory size."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = {RELEASE: spark.conf.get(RELEASE, "false"), ADVISORY: spark.conf.get(ADVISORY)}
    spark.conf.set(RELEASE, "true" if release else before[RELEASE])
    spark.conf.set(ADVISORY, before[ADVISORY] if task_bytes is None else str(task_bytes))
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote, once nothing reads them."""
    for df in stored:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable eager checkpoint into the shared folder (narrow frames)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_within(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast hint only when the measured size of the (stored) rows is
    within the bound; beyond it the join is an ordinary shuffle join with the
    same result. Strings count their bytes, and every value 16 more."""
    size = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        value = F.array_join(F.col(name), " ") if kind.startswith("array") else F.col(name).cast("string")
        count = F.size(name) if kind.startswith("array") else F.lit(1)
        size = size + F.coalesce(F.octet_length(value), F.lit(0)) + 16 * count
    measured = df.agg(F.sum(size)).head()[0] or 0
    return F.broadcast(df) if measured <= max_bytes else df


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def frees_memory(run: Callable) -> Callable:
    """A ``mapInArrow`` function that gives the memory of its batches back to
    the system when the task ends: Python workers live on, and what their
    allocators keep would add up over the stages of a job."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return wrapped


def frees_after(run: Callable) -> Callable:
    """The same for a function on the rows of a group, or of two groups."""

    def one(t: pa.Table) -> pa.Table:
        out = run(t)
        _give_back()
        return out

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        _give_back()
        return out

    return one if len(inspect.signature(run).parameters) == 1 else two


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_keys(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with two more columns that tell its rows apart, also equal
    ones, and are the same in every read: hash of the file, place in the file.
    A frame that is not a plain read of files is stored first."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = materialize(docs, "rows")
    names = fresh_names(docs, "row_file", "row_index")
    meta = docs.metadataColumn("_metadata")
    return docs.select("*", F.xxhash64(meta["file_path"]).alias(names[0]), meta["row_index"].alias(names[1])), names


def stored_order(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with three more columns that sort its rows as they are stored:
    number of the part file, path, place in the file. A frame that is not a
    plain read of files is stored first."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = materialize(docs, "rows")
    names = fresh_names(docs, "row_part", "row_path", "row_index")
    meta = docs.metadataColumn("_metadata")
    part = F.try_to_number(F.nullif(F.regexp_extract(meta["file_name"], r"part-(\d{1,9})", 1), F.lit("")), F.lit("999999999")).cast("long")
    return docs.select("*", part.alias(names[0]), meta["file_path"].alias(names[1]), meta["row_index"].alias(names[2])), names


def text_bytes(text: str | None) -> bytes:
    """UTF-8 bytes of a text; NULL is the empty text."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def ascii_lower(text: bytes) -> bytes:
    """Lower-case A-Z only (``bytes.lower`` leaves other bytes alone)."""
    return text.lower()


def batch_words(texts: pa.Array, in_word: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The words of many texts in order, A-Z lower-cased: the number of words
    per text (NULL: none) and all words, dictionary-encoded. ``in_word``
    tells for each byte whether it belongs to words. Works on the UTF-8
    buffers, without a Python object per word."""
    texts = texts.fill_null("")
    bounds = np.concatenate([[0], np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])
    low = _LOWER[np.frombuffer(b"".join(memoryview(t.as_buffer()) for t in texts), np.uint8)]
    inside = in_word[low]
    # a word begins or ends where its neighbour is outside, or in another text
    edge = np.zeros(len(low) + 1, bool)
    edge[bounds] = True
    edge[1:-1] |= inside[1:] != inside[:-1]
    starts = np.flatnonzero(edge[:-1] & inside)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.flatnonzero(edge[1:] & inside) + 1 - starts, out=offsets[1:])
    packed = low[inside]
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return np.diff(np.searchsorted(starts, bounds)), words.dictionary_encode()


def bounded_runs(sizes: np.ndarray, max_size: int, max_rows: int) -> list[tuple[int, int]]:
    """(first, length) of consecutive rows within both bounds; a single row
    over ``max_size`` is a run of its own."""
    out, first, size = [], 0, 0
    for i, s in enumerate(sizes.tolist()):
        if i > first and (size + s > max_size or i - first >= max_rows):
            out.append((first, i - first))
            first, size = i, 0
        size += s
    if len(sizes) > first:
        out.append((first, len(sizes) - first))
    return out
