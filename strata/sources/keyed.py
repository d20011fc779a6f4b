"""A table kept by key, of which a batch writes only what it touches.

Rows are dealt to buckets by a hash of their key. A manifest names the folder
of every bucket; a batch reads the buckets of its keys, writes their next
version into a new folder (one partition a bucket) and names it in the next
manifest. Folders are never overwritten, so readers of the old manifest, and a
batch that died half-way, are safe; all other buckets stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators._util import as_list
from strata.sources.pointer import list_names, read_text, replace_text

BUCKET = "_bucket"
_HEX = r"^([0-9a-f]{2})+\z"


def _packed(c: str) -> Column:
    """A string key for the shuffle: a hash in hex takes half its length."""
    raw = F.col(c).cast("binary")
    return F.when(F.col(c).rlike(_HEX), F.concat(F.lit(b"\x01"), F.unhex(F.col(c)))).otherwise(F.concat(F.lit(b"\x00"), raw))


def _unpacked(c: str) -> Column:
    rest = F.expr(f"substring(`{c}`, 2)")
    return F.when(F.expr(f"substring(`{c}`, 1, 1) = X'01'"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


class KeyedTable:
    """``keys`` decide the bucket; ``buckets`` is fixed for the table (about
    one per 128 MB of the table to come)."""

    def __init__(self, spark: SparkSession, root: str, keys, buckets: int = 256):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), as_list(keys), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def current(self) -> dict[str, str]:
        """The published manifest: bucket -> folder."""
        return json.loads(read_text(self.spark, f"{self.root}/_MANIFEST") or "{}")

    def publish(self, manifest: dict[str, str]) -> None:
        replace_text(self.spark, f"{self.root}/_MANIFEST", json.dumps(manifest))

    def rows(self, manifest: dict[str, str] | None = None, only=None) -> DataFrame | None:
        """All rows under a manifest (default: the published one), or those
        of the buckets ``only``; None without any."""
        manifest = self.current() if manifest is None else manifest
        paths = [f"{self.root}/{f}" for b, f in manifest.items() if only is None or int(b) in only]
        return self.spark.read.parquet(*sorted(paths)) if paths else None

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets of the keys of ``changes`` (at most ``buckets`` numbers)."""
        return sorted(r[0] for r in changes.select(self.bucket()).distinct().collect())

    def write(self, manifest: dict[str, str], changes: DataFrame, step: Callable[[DataFrame | None, DataFrame], DataFrame]) -> dict[str, str]:
        """The next manifest: ``step(old rows, changes)`` gives the rows of
        the touched buckets. Nothing is published."""
        hit = self.touched(changes)
        if not hit:
            return dict(manifest)
        new = step(self.rows(manifest, set(hit)), changes)
        folder = f"data/{uuid.uuid4().hex}"
        new.withColumn(BUCKET, self.bucket()).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        out = {b: f for b, f in manifest.items() if int(b) not in set(hit)}
        for name in list_names(self.spark, f"{self.root}/{folder}"):
            if name.startswith(f"{BUCKET}="):
                out[name.partition("=")[2]] = f"{folder}/{name}"
        return out

    def merge(self, manifest: dict[str, str], changes: DataFrame, deleted: str = "_deleted") -> tuple[dict[str, str], DataFrame | None, DataFrame | None]:
        """As ``write`` with :func:`replace_keys`; also the old rows that
        ``changes`` replace or delete, and the rows that come (None without
        any). Old rows and changes move once: they meet in a window over the
        partitions that are written. A bucket is split further by key, so that
        a task stays small whatever the bucket holds. A table without rows
        reads ``changes`` once, any other twice."""
        hit = self.touched(changes) if manifest else []
        if manifest and not hit:
            return dict(manifest), None, None
        cols = [c for c in changes.columns if c != deleted]
        both = changes.withColumn("_rank", F.lit(1).cast("byte"))
        old = self.rows(manifest, set(hit))
        if old is None:
            both = both.where(~F.col(deleted))
        else:
            both = both.unionByName(old.select(*cols).withColumns({deleted: F.lit(False), "_rank": F.lit(0).cast("byte")}))
        text = [k for k in self.keys if dict(both.dtypes)[k] == "string"]
        parts = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        both = both.withColumns({BUCKET: self.bucket(), "_part": F.pmod(F.hash(*self.keys), F.lit(parts)).cast("short")})
        moved = both.withColumns({k: _packed(k) for k in text}).repartition(BUCKET, "_part")
        newest = F.max("_rank").over(Window.partitionBy(BUCKET, "_part", *self.keys))
        kind = F.when(F.col("_rank") < newest, "left").when(F.col(deleted), None).when(F.col("_rank") == 1, "came").otherwise("kept")
        if old is None:
            kind = F.lit("came")
        done = moved.withColumn("_kind", kind).where(F.col("_kind").isNotNull()).withColumns({k: _unpacked(k) for k in text})
        folder = f"data/{uuid.uuid4().hex}"
        done.select(*cols, "_kind", BUCKET).write.option("compression", "zstd").partitionBy("_kind", BUCKET).parquet(f"{self.root}/{folder}")
        out = {b: f for b, f in manifest.items() if int(b) not in set(hit)}
        there = [k for k in ("left", "came", "kept") if f"_kind={k}" in list_names(self.spark, f"{self.root}/{folder}")]
        for k in there:
            for name in list_names(self.spark, f"{self.root}/{folder}/_kind={k}") if k != "left" else []:
                if name.startswith(f"{BUCKET}="):
                    out[name.partition("=")[2]] = f"{folder}/_kind={{came,kept}}/{name}"  # whichever is there
        read = lambda k: self.spark.read.parquet(f"{self.root}/{folder}/_kind={k}").select(*cols) if k in there else None
        return out, read("left"), read("came")

    def update(self, changes: DataFrame, step: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
        """``write`` and publish."""
        self.publish(self.write(self.current(), changes, step))


def replace_keys(keys, deleted: str = "_deleted") -> Callable[[DataFrame | None, DataFrame], DataFrame]:
    """Step for :meth:`KeyedTable.write`: a change takes the place of its
    key's row, one flagged ``deleted`` removes it. One change a key."""
    keys = as_list(keys)

    def step(old: DataFrame | None, changes: DataFrame) -> DataFrame:
        new = changes.where(~F.col(deleted)).drop(deleted)
        if old is None:
            return new
        return old.join(changes.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)

    return step
