"""Data skipping: clustering on several keys, a file index, and compaction of
small files only (Q1, Q2).

``curve_by`` sorts rows along a Hilbert curve over the rank of each key, so a
predicate on any one of the keys meets few files. ``IndexedTable`` keeps a list
of its files with per-file minima, maxima and Bloom filters, cuts the list
before anything is read, and packs small files together without touching large
ones.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators._util import as_list
from strata.sources import sinks

SAMPLE_ROWS = 50_000


# -- space-filling curve ----------------------------------------------------

def hilbert_index(ranks: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows of ``ranks``, each
    coordinate below 2^bits; at most 62 bits in all), by Skilling's transform:
    undo the rotations from the highest bit down, Gray-decode, interleave."""
    x = [c.astype(np.int64).copy() for c in ranks.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[i]
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            out = (out << 1) | (((c ^ turn) >> b) & 1)
    return out


def rank_bounds(df: DataFrame, keys, bits: int) -> list[list]:
    """Per key at most 2^bits - 1 values that cut a bounded sample of it into
    equal parts."""
    keys = as_list(keys)
    total = df.count()
    share = min(1.0, SAMPLE_ROWS / max(1, total))
    sample = df.select(*keys).sample(share, seed=5).limit(2 * SAMPLE_ROWS).toArrow()  # bounded by the limit
    parts = 1 << bits
    out = []
    for i in range(len(keys)):
        values = sorted(v for v in sample.column(i).to_pylist() if v is not None)
        # a frequent value takes several places, so few values still span all ranks
        out.append([values[len(values) * k // parts] for k in range(1, parts)] if values else [])
    return out


def curve_by(df: DataFrame, keys, files: int, bits: int | None = None) -> DataFrame:
    """Range-partition ``df`` into ``files`` parts along the Hilbert curve of
    ``keys`` (numbers, dates, timestamps or strings; NULL sorts first). The
    coordinate of a key is its rank among sampled quantiles, so skewed values
    still use the whole curve."""
    keys = as_list(keys)
    bits = bits or min(10, 62 // len(keys))
    bounds = [np.array(b, dtype=object) for b in rank_bounds(df, keys, bits)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
        for columns in batches:
            ranks = np.zeros((len(columns[0]), len(keys)), np.int64)
            for i, c in enumerate(columns):
                values = np.array(c.to_pylist(), dtype=object)
                there = np.array([v is not None for v in values], bool)
                if there.any():
                    ranks[there, i] = np.searchsorted(bounds[i], values[there], "right")
            yield pa.array(hilbert_index(ranks, bits), pa.int64())

    name = "_curve"
    while name in df.columns:
        name += "_"
    curve = F.arrow_udf(_columns_of(place), "long")(*[F.col(k) for k in keys])
    return df.withColumn(name, curve).repartitionByRange(files, name).sortWithinPartitions(name).drop(name)


def _columns_of(run):
    def scalar(*columns: pa.Array) -> pa.Array:
        return next(run(iter([columns])))

    return scalar


# -- Bloom filters of files -------------------------------------------------

def _bits(values: pa.Array, size: int, hashes: int) -> np.ndarray:
    h = values.to_numpy(zero_copy_only=False).view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(hashes, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


def file_blooms(df: DataFrame, column: str, size: int, hashes: int = 4) -> DataFrame:
    """(file, bloom): a Bloom filter of the column's values for every data
    file behind ``df``; hashes are XXH64 of the value, made by Spark."""
    src = df.where(F.col(column).isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.xxhash64(column).alias("h"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[str, np.ndarray] = {}
        for b in batches:
            files = b.column(0).dictionary_encode()
            for i, f in enumerate(files.dictionary.to_pylist()):
                own = b.column(1).filter(pa.compute.equal(files.indices, i))
                maps.setdefault(f, np.zeros(size, bool))[_bits(own, size, hashes).ravel()] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.string()), pa.array([np.packbits(m, bitorder="little").tobytes() for m in maps.values()], pa.binary())],
                                         ["file", "bloom"])

    def merge(t: pa.Table) -> pa.Table:
        bloom = np.bitwise_or.reduce([np.frombuffer(b.as_buffer(), np.uint8) for b in t["bloom"]])
        return pa.table([pa.array([t["file"][0].as_py()]), pa.array([bloom.tobytes()], pa.binary())], names=["file", "bloom"])

    return src.mapInArrow(partial, "file string, bloom binary").groupBy("file").applyInArrow(merge, "file string, bloom binary")


# -- indexed table ----------------------------------------------------------

class IndexedTable:
    """Parquet files below ``root`` with a stored list of them: path, length,
    rows, and for ``ranges`` columns minimum and maximum, for ``lookups``
    columns a Bloom filter. The list is a snapshot behind a pointer, so files
    appear and disappear for readers together."""

    def __init__(self, spark: SparkSession, root: str, ranges=(), lookups=(), bloom_bits: int = 1 << 17, hashes: int = 4):
        self.spark, self.root = spark, root.rstrip("/")
        self.ranges, self.lookups = as_list(ranges), as_list(lookups)
        self.bloom_bits, self.hashes = bloom_bits, hashes

    def index(self) -> DataFrame | None:
        return sinks.read_snapshot(self.spark, f"{self.root}/index")

    def _describe(self, path: str) -> DataFrame:
        """Index rows of the files in a folder, or of one file: one pass for
        minima and maxima, one a Bloom filter."""
        df = self.spark.read.parquet(path)
        stats = df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length")).agg(
            F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in self.ranges for n, f in (("min", F.min), ("max", F.max))])
        for c in self.lookups:
            stats = stats.join(file_blooms(df, c, self.bloom_bits, self.hashes).withColumnRenamed("bloom", f"bloom_{c}"), "file", "left")
        return stats

    def append(self, df: DataFrame) -> None:
        """Write the rows as new files (one a partition of ``df``) and list them."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        known = self.index()
        new = self._describe(folder)
        sinks.write_snapshot(self.spark, new if known is None else known.unionByName(new), f"{self.root}/index")

    def files(self, equals: dict | None = None, between: dict | None = None) -> DataFrame:
        """The index rows of files that can hold a row with these values
        (column -> value) and ranges (column -> (low, high))."""
        out = self.index()
        for c, v in (equals or {}).items():
            value = F.lit(v)
            if c in self.ranges:
                out = out.where((F.col(f"min_{c}") <= value) & (F.col(f"max_{c}") >= value))
            if c in self.lookups:
                kind = self.spark.read.parquet(f"{self.root}/data/*").schema[c].dataType
                h = F.xxhash64(value.cast(kind))
                low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
                for i in range(self.hashes):
                    at = F.pmod(low + high * i, F.lit(self.bloom_bits))
                    byte = F.conv(F.hex(F.substring(f"bloom_{c}", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
                    out = out.where(F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        for c, (lo, hi) in (between or {}).items():
            out = out.where((F.col(f"min_{c}") <= F.lit(hi)) & (F.col(f"max_{c}") >= F.lit(lo)))
        return out

    def read(self, equals: dict | None = None, between: dict | None = None) -> DataFrame:
        """The matching rows; only the files that the index leaves are listed
        and opened."""
        paths = [r["file"] for r in self.files(equals, between).select("file").collect()]  # what a reader needs: paths
        df = self.spark.read.parquet(*paths) if paths else self.spark.read.parquet(f"{self.root}/data/*").limit(0)
        for c, v in (equals or {}).items():
            df = df.where(F.col(c) == F.lit(v))
        for c, (lo, hi) in (between or {}).items():
            df = df.where(F.col(c).between(F.lit(lo), F.lit(hi)))
        return df

    def compact(self, target_bytes: int = 128 << 20, small_bytes: int | None = None, jobs: int = 8) -> int:
        """Pack files below ``small_bytes`` (default: half the target) into
        files of about ``target_bytes``. Large files keep their names; a packed
        file holds whole small files one after another, so nothing is
        shuffled. One job a packed file, ``jobs`` at a time. Returns the number
        of files that went."""
        small_bytes = small_bytes or target_bytes // 2
        index = self.index()
        plan = pack(index.where(F.col("length") < small_bytes).select("file", "length"), target_bytes)
        plan = plan.groupBy("chunk", "bin").agg(F.sort_array(F.collect_list("file")).alias("files")).where("size(files) > 1")
        bins = [r["files"] for r in plan.select("files").collect()]  # paths of small files
        if not bins:
            return 0
        folder = f"{self.root}/data/{uuid.uuid4().hex}"

        def rewrite(numbered: tuple[int, list[str]]) -> None:
            n, files = numbered
            self.spark.read.parquet(*files).coalesce(1).write.parquet(f"{folder}/{n:06d}")

        with ThreadPoolExecutor(jobs) as pool:
            list(pool.map(rewrite, enumerate(bins)))
        gone = plan.select(F.explode("files").alias("file"))
        kept = index.join(gone, "file", "left_anti")
        sinks.write_snapshot(self.spark, kept.unionByName(self._describe(f"{folder}/*")), f"{self.root}/index")
        return sum(map(len, bins))


def pack(inventory: DataFrame, target_bytes: int, chunk: int = 20_000) -> DataFrame:
    """First-fit-decreasing plan: ``inventory`` (file, length) -> (chunk,
    bin, file). Chunks of about ``chunk`` files are packed apart, so planning
    spreads; a file over the target has a bin of its own."""
    chunks = max(1, math.ceil(inventory.count() / chunk))

    def fit(t: pa.Table) -> pa.Table:
        files = sorted(zip(t["length"].to_pylist(), t["file"].to_pylist()), key=lambda x: (-x[0], x[1]))
        room: list[int] = []
        out = []
        for length, file in files:
            at = next((i for i, r in enumerate(room) if r >= length), None)
            if at is None:
                at = len(room)
                room.append(target_bytes)
            room[at] -= length
            out.append((t["chunk"][0].as_py(), at, file))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.string()))], names=["chunk", "bin", "file"])

    dealt = inventory.withColumn("chunk", F.pmod(F.xxhash64("file"), F.lit(chunks)))
    return dealt.groupBy("chunk").applyInArrow(fit, "chunk long, bin int, file string")
