"""URL filters with a Bloom filter cascade.

Level 0 of a cascade encodes the listed keys; level 1 the keys of the corpus
that pass level 0 without being listed; level 2 the listed keys that pass
level 1; and so on until no key passes wrongly. Because the levels are built
over the complete key universe (every key that any URL of the corpus can be
asked for, and every listed one), the answer is exact for each of them, and
neither keys nor lists are joined to the URLs.

How it is spread: keys are dealt to shards by hash; a shard's keys are
distinct, so a hot host costs one row, and each shard builds all of its levels
inside one task. A cascade takes a few bits a listed key; while its measured
size is within ``MAX_BYTES`` every task gets it and the URLs do not move.
Beyond that the addresses' keys are dealt to the shards instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, frees_memory, materialize

SHARD_KEYS = 1 << 15
MAX_BYTES = 64 << 20
CASCADE = "shard int, sizes array<int>, hashes array<int>, bits binary"


# -- one shard's cascade ----------------------------------------------------

def _places(keys: list[bytes], level: int, hashes: int, size: int) -> np.ndarray:
    """Bit places (keys x hashes) of a level; every level has its own seed."""
    h = np.fromiter((xxhash.xxh64_intdigest(k, level + 1) for k in keys), np.uint64, len(keys))
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(hashes, dtype=np.uint64)) % np.uint64(size)


def build_levels(listed: list[bytes], others: list[bytes]) -> tuple[list[int], list[int], bytes]:
    """(bits, hashes of each level, the bit maps one after another) of a
    cascade that holds ``listed`` and rejects ``others``. The first level
    passes so few others that the second is about half as large; the next
    ones use one hash."""
    sizes, hashes, maps = [], [], []
    holds, rejects, level = listed, others, 0
    while holds:
        share = min(0.5, math.sqrt(0.5) * len(holds) / max(1, len(rejects))) if level == 0 else 0.5
        k = max(1, round(-math.log2(share)))
        size = max(8, -(-math.ceil(len(holds) * k * 1.4427) // 8) * 8)
        bits = np.zeros(size, bool)
        bits[_places(holds, level, k, size).ravel().astype(np.int64)] = True
        sizes.append(size)
        hashes.append(k)
        maps.append(np.packbits(bits, bitorder="little").tobytes())
        passed = bits[_places(rejects, level, k, size).astype(np.int64)].all(axis=1) if rejects else []
        holds, rejects = [key for key, p in zip(rejects, passed) if p], holds
        level += 1
    return sizes, hashes, b"".join(maps)


class Cascade:
    """One shard, for lookups."""

    def __init__(self, sizes: list[int], hashes: list[int], bits: bytes):
        self.sizes, self.hashes = sizes, hashes
        ends = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) // 8)]).astype(np.int64)
        self.maps = [bits[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def __contains__(self, key: bytes) -> bool:
        """Exact for the keys of the universe."""
        for level, (size, hashes, bits) in enumerate(zip(self.sizes, self.hashes, self.maps)):
            h = xxhash.xxh64_intdigest(key, level + 1)
            low, high = h & 0xFFFFFFFF, (h >> 32) | 1
            for i in range(hashes):
                at = ((low + high * i) & 0xFFFFFFFFFFFFFFFF) % size
                if not bits[at >> 3] >> (at & 7) & 1:
                    return level % 2 == 1
        return len(self.sizes) % 2 == 1


def _shard(key: bytes, shards: int) -> int:
    return xxhash.xxh64_intdigest(key) % shards


def build_cascade(universe: DataFrame, listed: DataFrame) -> DataFrame:
    """``CASCADE`` rows, stored; both inputs have one string column ``key``.
    ``shards`` follows the number of keys."""
    keys = (universe.select("key", F.lit(False).alias("listed")).unionAll(listed.select("key", F.lit(True).alias("listed")))
            .where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed")))
    keys = materialize(keys, "url-keys")
    shards = max(1, -(-keys.count() // SHARD_KEYS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [_shard(k.encode(), shards) for k in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], ["key", "listed", "shard"])

    def build(t: pa.Table) -> pa.Table:
        text, flag = [k.encode() for k in t["key"].to_pylist()], t["listed"].to_pylist()
        sizes, hashes, bits = build_levels([k for k, f in zip(text, flag) if f], [k for k, f in zip(text, flag) if not f])
        return pa.table([pa.array([t["shard"][0].as_py()], pa.int32()), pa.array([sizes], pa.list_(pa.int32())),
                         pa.array([hashes], pa.list_(pa.int32())), pa.array([bits], pa.binary())], names=["shard", "sizes", "hashes", "bits"])

    placed = keys.mapInArrow(place, "key string, listed boolean, shard int")
    return materialize(placed.groupBy("shard").applyInArrow(build, CASCADE), "url-cascade").withColumn("shards", F.lit(shards))


# -- addresses and their keys -----------------------------------------------

def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host follows the first ``://`` up to ``/``, ``?``,
    ``#`` or the end, A-Z lower-cased; the path goes on up to ``?``, ``#`` or
    the end. NULL, or no ``://``: both empty."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.encode().lower().decode(), slash + path


def _suffixes(host: str) -> list[str]:
    out, at = [host], host.find(".")
    while at >= 0:
        out.append(host[at + 1:])
        at = host.find(".", at + 1)
    return out


def prefixes(host: str, path: str, lengths: list[int]) -> list[str]:
    """Every rule key that can fit, best first: the longest wins, among
    equally long ones that with the longer host."""
    found = [(h, path[:n]) for h in _suffixes(host) for n in lengths if n <= len(path)]
    return [h + p for h, p in sorted(found, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))]


def _keys(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    """All keys that a lookup of this address may ask for."""
    for p in prefixes(host, path, lengths):
        yield f"block {p}"
        yield f"allow {p}"
    for h in _suffixes(host):
        yield f"host {h}"
    yield f"page {host}{path}"


def judge(host: str, path: str, lengths: list[int], listed: Callable[[str], bool]) -> tuple[str | None, str, str]:
    """(rule, verdict, reason). A rule decides first (block before allow when
    the same key has both); then listed hosts (with subdomains) and listed
    pages block; the rest is allowed."""
    for p in prefixes(host, path, lengths):
        for verdict in ("block", "allow"):
            if listed(f"{verdict} {p}"):
                return p, verdict, "rule"
    if any(listed(f"host {h}") for h in _suffixes(host)):
        return None, "block", "host"
    if listed(f"page {host}{path}"):
        return None, "block", "page"
    return None, "allow", "none"


def addresses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", *more: str) -> DataFrame:
    """(id, host, path, *more) of every row."""
    src = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), *[pages[c] for c in more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, path = zip(*map(split_url, b.column(1).to_pylist())) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(host, pa.string()), pa.array(path, pa.string()), *b.columns[2:]],
                                             ["id", "host", "path", *more])

    kinds = "".join(f", `{c}` {pages.schema[c].dataType.simpleString()}" for c in more)
    return src.mapInArrow(run, f"id long, host string, path string{kinds}")


# -- the operator -----------------------------------------------------------

_VERDICT = "rule string, verdict string, reason string"


def filter_urls(pages: DataFrame, rules: DataFrame, hosts: DataFrame | None = None, listed_pages: DataFrame | None = None,
                id_col: str = "page_id", url_col: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict
    (allow or block), reason (rule, host, page, none).

    ``rules``: (host, path, verdict); a rule fits its host and all subdomains
    if the path starts with the rule's; the longest (host and path together;
    then the longer host) wins; the same key with both verdicts blocks. Where
    no rule fits, a host of ``hosts`` (host; with subdomains) and an address
    of ``listed_pages`` (host, path; exact) are blocked and the rest allowed.
    Rules' host and path NULL count as empty; other verdicts than block and
    allow are ignored.

    NULL URLs and those without ``://`` have an empty host and path and are
    allowed; NULL and repeated ids and repeated URLs give a row each; very
    long paths are asked for at the rules' path lengths only; an empty table
    gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    empty = F.lit("")
    rule_key = F.concat("verdict", F.lit(" "), F.coalesce("host", empty), F.coalesce("path", empty))
    named = cut(rules.where("verdict IN ('block', 'allow')").select(rule_key.alias("key"), F.length(F.coalesce("path", empty)).alias("n")))
    lengths = sorted(r["n"] for r in named.select("n").distinct().collect())  # at most the longest path
    listed = named.select("key")
    if hosts is not None:
        listed = listed.unionAll(hosts.select(F.concat(F.lit("host "), "host").alias("key")))
    if listed_pages is not None:
        listed = listed.unionAll(listed_pages.select(F.concat(F.lit("page "), "host", "path").alias("key")))
    rows = materialize(addresses(pages, id_col, url_col), "url-addresses")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {k for a in set(zip(*(c.to_pylist() for c in b.columns))) for k in _keys(*a, lengths)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["key"])

    universe = rows.select("host", "path").mapInArrow(frees_memory(ask), "key string")
    cascade = build_cascade(universe, listed)
    shards = cascade.agg(F.max("shards")).head()[0] or 1
    measured = cascade.agg(F.sum(F.octet_length("bits") + 16 * F.size("sizes"))).head()[0] or 0
    names = [F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "reason"]

    if measured <= max_bytes:
        held = spark.sparkContext.broadcast({r["shard"]: (r["sizes"], r["hashes"], bytes(r["bits"])) for r in cascade.collect()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cascades = {k: Cascade(*v) for k, v in held.value.items()}

            def is_listed(key: str) -> bool:
                raw = key.encode()
                at = cascades.get(_shard(raw, shards))
                return at is not None and raw in at

            for b in batches:
                known: dict[tuple, tuple] = {}
                found = []
                for a in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    if a not in known:
                        known[a] = judge(*a, lengths, is_listed)
                    found.append(known[a])
                cols = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, pa.string()) for c in cols]],
                                                 ["id", "host", "path", "rule", "verdict", "reason"])

        return rows.mapInArrow(run, f"id long, host string, path string, {_VERDICT}").select(*names)

    # too large for every task: distinct addresses send their keys to the shards
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(h, p, k, _shard(k.encode(), shards)) for h, p in zip(*(c.to_pylist() for c in b.columns)) for k in _keys(h, p, lengths)]
            cols = zip(*found) if found else ((), (), (), ())
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["host", "path", "key", "shard"])

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.slice(0, 0).select(["host", "path", "key"])
        at = Cascade(right["sizes"][0].as_py(), right["hashes"][0].as_py(), right["bits"][0].as_py())
        return left.select(["host", "path", "key"]).filter(pa.array([k.encode() in at for k in left["key"].to_pylist()], pa.bool_()))

    distinct = rows.select("host", "path").distinct()
    asked = distinct.mapInArrow(scatter, "host string, path string, key string, shard int")
    # few addresses share a key but a hot host does with all its pages: a salt
    # deals them to several groups, and only the small shard row is repeated
    salts = F.array(*map(F.lit, range(8)))
    salted = asked.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(8)).cast("int"))
    hits = salted.groupBy("shard", "salt").cogroup(cascade.withColumn("salt", F.explode(salts)).groupBy("shard", "salt")).applyInArrow(
        look, "host string, path string, key string").groupBy("host", "path").agg(F.collect_set("key").alias("keys"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [judge(h, p, lengths, set(k or ()).__contains__) for h, p, k in zip(*(c.to_pylist() for c in b.columns))]
            cols = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *[pa.array(c, pa.string()) for c in cols]], ["host", "path", "rule", "verdict", "reason"])

    verdicts = distinct.join(hits, ["host", "path"], "left").mapInArrow(decide, f"host string, path string, {_VERDICT}")
    return rows.join(verdicts, ["host", "path"]).select(*names)
