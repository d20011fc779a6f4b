"""SimHash near-duplicates by covering locality-sensitive hashing.

For radius r every bit position gets a non-zero vector of r + 1 bits; table v
(any non-zero vector) keeps the positions whose vector is not orthogonal to v.
Up to r differing positions span at most r dimensions, so some v is orthogonal
to all of them and drops them: every pair within the radius agrees on the kept
bits of at least one of the 2^(r+1) - 1 tables. Nothing is missed.

Buckets work on *different* fingerprints only (exact copies collapse first).
A bucket of more than ``pair_limit`` fingerprints emits no pairs: its members
write themselves to their one-bit neighbours instead. Two fingerprints within
two bits share such a neighbour, and two that share one are within two bits,
so linking each to the smallest one there loses no connection and never
costs more than 65 rows a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, cut, frees_memory, materialize, row_keys, text_bytes
from strata.llm.components import connected_components

SEED = 42
BITS = 64
_CHUNK = 1 << 15
_ONE_BIT = [*(1 << i for i in range(BITS - 1)), -(1 << (BITS - 1))]


def fingerprint(words: list[bytes], shingle: int = 3) -> int:
    """64 bits, each set if it is set in over half the shingle hashes; no
    words: zero; fewer words than the shingle: the whole sequence."""
    n = len(words)
    if n == 0:
        return 0
    if n < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    parts = zip(*(words[i:] for i in range(shingle)))
    h = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(SEED)), np.uint64, n - shingle + 1)
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(h), _CHUNK):
        bits = np.unpackbits(h[at:at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3, **keys: Column) -> DataFrame:
    """(keys, fp long): the fingerprint of every whole text, A-Z lower-cased,
    words are runs without white space, shingles counted with repeats. NULL
    texts have no words. ``keys`` (long columns) are passed on."""
    src = docs.select(*[c.cast("long").alias(k) for k, c in keys.items()], docs[text_col].cast("string").alias("text"))
    names = [*keys, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(ascii_lower(text_bytes(t.as_py())).split(), shingle) for t in b.columns[-1]]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(np.array(fp, np.uint64).view(np.int64), pa.int64())], names)

    return src.mapInArrow(frees_memory(run), ", ".join(f"{n} long" for n in names))


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """The 2^(radius+1) - 1 bit masks, as signed 64-bit integers. Vectors are
    dealt evenly to the positions in a seeded shuffle."""
    size = 1 << (radius + 1)
    vectors = 1 + np.arange(BITS) % (size - 1)
    np.random.default_rng(seed).shuffle(vectors)
    out = []
    for v in range(1, size):
        mask = sum(1 << i for i, m in enumerate(vectors) if bin(int(m) & v).count("1") % 2)
        out.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return out


def links(nodes: DataFrame, radius: int = 2, pair_limit: int = 32) -> DataFrame:
    """``nodes`` (node long, fp long; fingerprints all different) -> (a, b):
    edges between nodes within ``radius`` bits that connect exactly the nodes
    which the relation "within radius" connects. Small buckets give all their
    close pairs; larger ones give stars (defined for a radius of 1 or 2)."""
    if radius not in (1, 2):
        raise ValueError("the star step of large buckets links within one or two bits")
    keys = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for v, m in enumerate(covering_masks(radius))])
    placed = nodes.select("node", "fp", F.inline(keys))
    sizes = cut(placed.groupBy("v", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    shared = cut(placed.join(sizes, ["v", "key"]).select("v", "key", "size", "node", "fp"))

    member = F.struct("node", "fp")
    small = (shared.where(F.col("size") <= pair_limit).groupBy("v", "key")
             .agg(F.sort_array(F.collect_list(member)).alias("m")))
    pairs = F.flatten(F.transform("m", lambda x, i: F.transform(
        F.filter(F.slice("m", i + 2, pair_limit),
                 lambda y: F.bit_count(x["fp"].bitwiseXOR(y["fp"])) <= radius),
        lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))
    near = small.select(F.inline(pairs))

    large = shared.where(F.col("size") > pair_limit).select("node", "fp").distinct()
    spots = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(f)) for f in _ONE_BIT])
    around = large.select("node", F.explode(spots).alias("spot"))
    if radius == 2:
        hub = around.groupBy("spot").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    else:  # one bit: the common spot has to be a member itself
        hub = large.select(F.col("fp").alias("spot"), F.col("node").alias("a"))
    star = around.join(cut(hub), "spot").where("a <> node").select("a", F.col("node").alias("b"))
    return near.unionAll(star).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2, pair_limit: int = 32) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: 16 lower-case hex
    digits and the smallest id reachable over links of at most ``radius``
    differing bits.

    Texts without a word (also NULL) have fingerprint zero and are linked like
    any other. Rows with a NULL id keep a NULL component and link nothing;
    repeated rows give repeated results; an empty table gives no rows; other
    columns are not read.
    """
    fps = cut(fingerprints(docs, text_col, shingle, id=docs[id_col]))
    nodes = cut(fps.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("first")))
    named = nodes.join(groups(nodes.select("fp"), radius, pair_limit), "fp")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = cut(named.join(least, "root").select("fp", "component_id"))
    return fps.join(named, "fp", "left").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def groups(fps: DataFrame, radius: int = 2, pair_limit: int = 32) -> DataFrame:
    """(fp, root) for different fingerprints ``fps`` (fp): root is the same
    for those that links within ``radius`` bits connect."""
    labels = connected_components(links(fps.select(F.col("fp").alias("node"), "fp"), radius, pair_limit))
    return fps.join(labels, fps["fp"] == labels["node"], "left").select("fp", F.coalesce("component", "fp").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each near-duplicate group of ``docs``: that of the smallest
    id (NULL ids after all others); of several such rows one.

    The decision is taken by row, so rows that share an id but not a text are
    judged apart, and rows with a NULL id are grouped like any other. Texts
    without a word (also NULL) are one group; other columns may have any name;
    an empty table stays empty.
    """
    docs, keys = row_keys(docs)
    fps = cut(fingerprints(docs, text_col, shingle, id=docs[id_col], f=docs[keys[0]], r=docs[keys[1]]))
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "f", "r")
    nodes = cut(fps.groupBy("fp").agg(F.min(rank).alias("best")))
    best = nodes.join(groups(nodes.select("fp"), radius), "fp").groupBy("root").agg(F.min("best").alias("best"))
    keep = materialize(best.select(F.col("best.f").alias(keys[0]), F.col("best.r").alias(keys[1])), "simhash-keep")
    return docs.join(keep, keys, "left_semi").drop(*keys)
