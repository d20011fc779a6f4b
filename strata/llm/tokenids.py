"""Token-id / binary output with a minimal perfect hash index.

File format (tables of a folder in shared storage, written by Spark's own
committed writers, so a lost executor leaves no half shard):

* ``payload``: one row a shard: ``shard``, ``width`` (bytes an id),
  ``payload`` (raw little-endian ids of its documents one after another);
  shards ascend in the write order.
* ``directory``: ``shard``, ``start`` (ids in all earlier shards).
* ``index``: one row a hash bucket of document keys: a minimal perfect hash
  (a cascade of bit maps: keys alone at their place stay, the rest go to the
  next level; the rank of the bit is the slot), and per slot a stored 32-bit
  fingerprint of the key, the shard, the offset in the shard and the length.
  A key is an id and an occurrence: 0 for the first document with that id in
  the write order, 1 for the second; documents without an id count too.

A key is found by hashing: bucket, slot, fingerprint check, then one slice of
one payload; its cost does not depend on the number of documents. A key that
was never written is rejected by the fingerprint (1 in 2^32 passes).
"""

from __future__ import annotations

import json
import string
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import SPACE_WORD, batch_words, bounded_runs, cut, frees_after, frees_memory, shared_path, text_bytes

SHARD_IDS = 1 << 20
BUCKET_KEYS = 20_000
CACHE_PIECES = 300_000
_PUNCTUATION = set(string.punctuation)

# The pre-tokenizer this module can split by itself, and the
# letters for which its own split is known to agree.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LAST = "ɏ"
_PLAIN = regex.compile(rf"[\x21-\x7eÀ-{_LAST}]+")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte:
    itself when printable, else the next code point from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Encoder:
    """Ids of whole texts with a ``tokenizers`` file.

    For files whose pre-tokenizer splits at white space and by ``_SPLIT``,
    white space separates independent words, so each distinct word of a batch
    is encoded once, from pieces that are remembered (about ``CACHE_PIECES``;
    then the memory starts anew). Other files encode whole texts. Results are
    the same.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        spec = json.loads(self.tok.to_str())
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        norms = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers") or []]
        self.by_word = (
            [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["pattern"] == {"Regex": _SPLIT}
            and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and not parts[1]["add_prefix_space"]
            and not parts[1]["use_regex"] and norms == ["NFC", "Replace", "Lowercase"] and not spec.get("post_processor"))
        self.special = [t["content"].lower() for t in spec["added_tokens"]]
        self.split = regex.compile(_SPLIT)
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}

    def _plain(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            level = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            found = self.pieces[piece] = self._plain([t.id for t in self.tok.model.tokenize(level)])
        return found

    def _word(self, text: str) -> bytes:
        body, tail = (text, "") if text.isalpha() else (text[:-1], text[-1:])
        if body.isalpha() and (not tail or tail in _PUNCTUATION) and (body.isascii() or max(body) <= _LAST):
            low = body if body.isascii() else body.lower()
            if len(low) == len(body):  # letters, at most one sign behind them
                ids = self.pieces.get(low) or self._piece(low)
                return ids + self._piece(tail) if tail else ids
        if _PLAIN.fullmatch(text):
            return b"".join([self._piece(p) for p in self.split.findall(text.lower())])
        return self._plain(self.tok.encode(text, add_special_tokens=False).ids)

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        """Raw little-endian ids of each text, ``width`` bytes an id; NULL is
        empty."""
        if not self.by_word:
            return [self._plain(self.tok.encode(text_bytes(t.as_py()).decode(), add_special_tokens=False).ids) for t in texts]
        per_text, words = batch_words(texts, SPACE_WORD)
        if len(self.pieces) > CACHE_PIECES:
            self.pieces.clear()
        distinct = words.dictionary.cast(pa.string()).to_numpy(zero_copy_only=False).tolist()
        odd = [i for i, w in enumerate(distinct) if any(s in w for s in self.special)]
        known = list(map(self._word, distinct))
        n_of = np.fromiter(map(len, known), np.int64, len(known)) // self.width
        flat = np.frombuffer(b"".join(known), self.dtype)
        first_of = np.cumsum(n_of) - n_of
        codes = words.indices.to_numpy(zero_copy_only=False)
        word_ends = np.concatenate([[0], np.cumsum(per_text)])
        found = []
        for at, n_texts in bounded_runs(per_text, 1 << 18, 1 << 16):
            mine = codes[word_ends[at]:word_ends[at + n_texts]]
            n = n_of[mine]
            ends = np.concatenate([[0], np.cumsum(n)])
            out = flat[np.repeat(first_of[mine] - ends[:-1], n) + np.arange(ends[-1])]
            cuts = ends[word_ends[at:at + n_texts + 1] - word_ends[at]].tolist()
            found += [out[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])]
        if odd:  # special tokens are matched in the text as it stands
            for d in np.unique(np.searchsorted(word_ends, np.flatnonzero(np.isin(codes, odd)), "right") - 1).tolist():
                found[d] = self._plain(self.tok.encode(texts[d].as_py(), add_special_tokens=False).ids)
        return found


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# -- minimal perfect hash ---------------------------------------------------

def _mix(keys: np.ndarray, salt: int, more: np.ndarray | None = None) -> np.ndarray:
    """Hash of 64-bit keys, or of pairs; every salt hashes anew."""
    if more is not None:
        keys = keys.astype(np.uint64) ^ _mix(more, salt ^ 0x5BD1E995)
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FINGER = 1 << 20  # a salt no level uses


def mph_build(keys: np.ndarray, more: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """(level sizes, bits) of a minimal perfect hash of different 64-bit keys
    (or pairs of ``keys`` and ``more``); both empty for no keys."""
    more = np.zeros(len(keys), np.uint64) if more is None else more
    sizes, maps, left, level = [], [], np.arange(len(keys)), 0
    while len(left):
        m = max(8, -(-2 * len(left) // 8) * 8)
        at = (_mix(keys[left], level, more[left]) % np.uint64(m)).astype(np.int64)
        alone = np.bincount(at, minlength=m) == 1
        sizes.append(m)
        maps.append(np.packbits(alone, bitorder="little"))
        left, level = left[~alone[at]], level + 1
    return np.array(sizes, "<u4").tobytes(), b"".join(x.tobytes() for x in maps)


def mph_slots(keys: np.ndarray, sizes: bytes, bits: bytes, more: np.ndarray | None = None) -> np.ndarray:
    """The slot of each key, 0 .. n - 1 without gaps for the built keys; -1
    for a key that no level holds (never a built one)."""
    more = np.zeros(len(keys), np.uint64) if more is None else more
    out = np.full(len(keys), -1, np.int64)
    left = np.arange(len(keys))
    below = at_byte = 0
    for level, m in enumerate(np.frombuffer(sizes, "<u4").tolist()):
        if not len(left):
            break
        flags = np.unpackbits(np.frombuffer(bits, np.uint8, m // 8, at_byte), bitorder="little")
        rank = np.cumsum(flags, dtype=np.int64)
        at = (_mix(keys[left], level, more[left]) % np.uint64(m)).astype(np.int64)
        here = flags[at] == 1
        out[left[here]] = below + rank[at[here]] - 1
        left = left[~here]
        below += int(rank[-1])
        at_byte += m // 8
    return out


def finger(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Stored 32-bit fingerprints."""
    return (_mix(keys, _FINGER, more) >> np.uint64(32)).astype("<u4")


# -- writing ----------------------------------------------------------------

_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()),
                     ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                     ("lengths", pa.list_(pa.int64()))])
_SHARDS_SQL = ("part int, shard long, before long, n_ids long, width int, payload binary, doc_ids array<long>, "
               "offsets array<long>, lengths array<long>")


@dataclass(frozen=True)
class Store:
    """The tables of a written folder."""

    root: str
    payload: DataFrame
    directory: DataFrame
    index: DataFrame


def open_store(spark: SparkSession, root: str) -> Store:
    """Open what ``write`` left in ``root``."""
    read = spark.read.schema
    return Store(root, read("shard long, width int, payload binary").parquet(f"{root}/payload"),
                 read("shard long, start long, n_ids long").parquet(f"{root}/directory"),
                 read("bucket long, buckets long, sizes binary, bits binary, fingers binary, shards binary, offsets binary, "
                      "lengths binary").parquet(f"{root}/index"))


def write(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
          order_by: list[str] | None = None, root: str | None = None) -> Store:
    """Encode every whole text, append ``end_id``, and write payload shards
    in ascending order of ``order_by`` (default: the id), the directory and
    the key index.

    NULL and empty texts are the end id alone. Rows with a NULL id are written
    first in id order. Of rows with the same id, or without one, all are
    written and have a key: the id and their occurrence in the write order
    (rows with equal order columns go by text). An empty table gives empty
    tables. Only the id, the text and the order columns are read.
    """
    spark = docs.sparkSession
    root = root or shared_path(spark, "token-ids")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [docs[c].alias(f"o{i}") for i, c in enumerate(order_by or [id_col])]
    names = [f"o{i}" for i in range(len(keys))]
    src = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"), *keys)
    ordered = src.repartitionByRange(n_parts, *names, "id").sortWithinPartitions(*names, "id", "text").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        shard, before = part << 32, 0
        ids, offsets, lengths, blobs, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            rows = [[part], [shard], [before], [size], [enc.width], [b"".join(blobs)], [ids], [offsets], [lengths]]
            return pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _SHARDS)], schema=_SHARDS)

        for b in batches:
            for key, ids_of in zip(b.column(0).to_pylist(), enc.encode_batch(b.column(1))):
                blob = ids_of + end
                n = len(blob) // enc.width
                if ids and size + n > SHARD_IDS:
                    yield flush()
                    shard, before = shard + 1, before + size
                    ids, offsets, lengths, blobs, size = [], [], [], [], 0
                ids.append(key)
                offsets.append(size)
                lengths.append(n)
                blobs.append(blob)
                size += n
        if ids:
            yield flush()

    shards = ordered.mapInArrow(frees_memory(run), _SHARDS_SQL)
    shards.write.option("compression", "zstd").parquet(f"{root}/payload")
    written = spark.read.schema(_SHARDS_SQL).parquet(f"{root}/payload")

    # starts: one total a partition (a parameter, not the data), then inside it
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (written.groupBy("part").agg(F.sum("n_ids").alias("total"))
             .select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base")))
    (written.select("part", "shard", "before", "n_ids").join(F.broadcast(parts), "part")
     .select("shard", (F.col("base") + F.col("before")).alias("start"), "n_ids").write.parquet(f"{root}/directory"))

    n_docs = written.agg(F.sum(F.size("doc_ids"))).head()[0] or 0
    buckets = max(1, -(-n_docs // BUCKET_KEYS))
    entries = _occurrences(written.select("shard", F.inline(F.arrays_zip("doc_ids", "offsets", "lengths"))).withColumnRenamed("doc_ids", "id"))
    entries = entries.select(*_key("id", "occurrence", buckets), "shard", "offsets", "lengths")
    schema = "bucket long, buckets long, sizes binary, bits binary, fingers binary, shards binary, offsets binary, lengths binary"

    def build(t: pa.Table) -> pa.Table:
        key, more = (t[c].to_numpy().view(np.uint64) for c in ("key", "more"))
        sizes, bits = mph_build(key, more)
        place = np.argsort(mph_slots(key, sizes, bits, more))
        cols = [finger(key, more)[place].tobytes()] + [t[c].to_numpy()[place].astype("<i8").tobytes() for c in ("shard", "offsets", "lengths")]
        values = [t["bucket"][0].as_py(), buckets, sizes, bits, *cols]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds)],
                        names=["bucket", "buckets", "sizes", "bits", "fingers", "shards", "offsets", "lengths"])

    entries.groupBy("bucket").applyInArrow(frees_after(build), schema).write.parquet(f"{root}/index")
    return open_store(spark, root)


def _occurrences(entries: DataFrame) -> DataFrame:
    """``entries`` (id, shard, offsets, ...) with the occurrence of their id.
    Repeated ids (NULL among them) are numbered inside each shard and then
    moved on by the counts of the shards before, so a hot one is spread."""
    repeated = cut(entries.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"))
    if repeated.isEmpty():
        return entries.withColumn("occurrence", F.lit(0).cast("long"))
    ids = repeated.select(F.col("id").alias("again"))
    same = F.col("id").eqNullSafe(F.col("again"))
    once = entries.join(ids, same, "left_anti").withColumn("occurrence", F.lit(0).cast("long"))
    many = cut(entries.join(ids, same, "left_semi"))
    earlier = Window.partitionBy("id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard = many.groupBy("id", "shard").agg(F.count(F.lit(1)).alias("n"))
    per_shard = per_shard.select(F.col("id").alias("again"), F.col("shard").alias("in_shard"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    local = F.row_number().over(Window.partitionBy("id", "shard").orderBy("offsets")) - 1
    many = many.withColumn("local", local).join(per_shard, same & (F.col("shard") == F.col("in_shard")))
    return once.unionByName(many.withColumn("occurrence", (F.col("base") + F.col("local")).cast("long")).select(*once.columns))


def _key(id_col: str, occurrence: str, buckets: int) -> list[Column]:
    """(bucket, key, more): a pair of longs tells id and occurrence; a NULL
    id takes the negative numbers."""
    key = F.coalesce(id_col, F.lit(0).cast("long"))
    more = F.when(F.col(id_col).isNull(), -1 - F.col(occurrence)).otherwise(F.col(occurrence))
    return [F.pmod(F.xxhash64(key, more), F.lit(buckets)).alias("bucket"), key.alias("key"), more.alias("more")]


# -- reading ----------------------------------------------------------------

def all_keys(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, occurrence): one key for every row of ``docs``. Long runs of
    a repeated id are counted out in pieces."""
    piece = 1 << 16
    counts = docs.groupBy(docs[id_col].cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(piece))).alias("at"))
    return starts.select("doc_id", F.explode(F.sequence("at", F.least(F.col("at") + piece, "n") - 1)).alias("occurrence"))


def locate(store: Store, keys: DataFrame, key_col: str = "doc_id", occurrence_col: str | None = None) -> DataFrame:
    """(doc_id, occurrence, copies, shard, offset, length) of the keys that
    the index holds; ``copies`` tells how often a key was asked for. Unknown
    keys give no row. Without ``occurrence_col`` the first document of each
    id is meant, and NULL keys give no row."""
    buckets = (store.index.agg(F.max("buckets")).head() or [None])[0] or 1
    occurrence = F.lit(0).cast("long") if occurrence_col is None else keys[occurrence_col].cast("long")
    wanted = keys.select(keys[key_col].cast("long").alias("id"), occurrence.alias("occurrence"))
    if occurrence_col is None:
        wanted = wanted.where("id IS NOT NULL")
    wanted = wanted.groupBy("id", "occurrence").agg(F.count(F.lit(1)).alias("copies"))
    wanted = wanted.select("id", "occurrence", "copies", *_key("id", "occurrence", buckets))
    names = ["doc_id", "occurrence", "copies", "shard", "offset", "length"]

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 6, names=names)
        key, more = (left[c].to_numpy().view(np.uint64) for c in ("key", "more"))
        row = {c: right[c][0].as_py() for c in ("sizes", "bits", "fingers", "shards", "offsets", "lengths")}
        slot = mph_slots(key, row["sizes"], row["bits"], more)
        known = (slot >= 0) & (np.frombuffer(row["fingers"], "<u4")[slot] == finger(key, more))
        at = slot[known]
        asked = left.filter(pa.array(known))
        return pa.table([*[asked[c].combine_chunks() for c in ("id", "occurrence", "copies")],
                         *[pa.array(np.frombuffer(row[c], "<i8")[at]) for c in ("shards", "offsets", "lengths")]], names=names)

    return wanted.groupBy("bucket").cogroup(store.index.groupBy("bucket")).applyInArrow(
        frees_after(find), ", ".join(f"{c} long" for c in names))


def fetch(store: Store, keys: DataFrame, key_col: str = "doc_id", occurrence_col: str | None = None) -> DataFrame:
    """(doc_id, occurrence, start, n_tokens, ids) for the keys that the index
    holds, a key asked for twice twice: ids are little-endian unsigned 32-bit
    integers, read from the payload shards; start counts the ids of all
    documents before."""
    places = locate(store, keys, key_col, occurrence_col).join(
        store.directory.select("shard", "start"), "shard").select("doc_id", "occurrence", "copies", "shard", "offset", "length", "start")
    names = ["doc_id", "occurrence", "copies", "start", "n_tokens", "ids"]

    def cut_out(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            payload = np.frombuffer(right["payload"][0].as_buffer(), f"<u{right['width'][0].as_py()}")
            off, n = left["offset"].to_numpy(), left["length"].to_numpy()
            ids = pa.array([payload[o:o + k].astype("<u4").tobytes() for o, k in zip(off.tolist(), n.tolist())], pa.binary())
            return pa.table([left["doc_id"], left["occurrence"], left["copies"], pa.array(left["start"].to_numpy() + off), left["length"], ids], names=names)
        return pa.table([pa.array([], pa.int64())] * 5 + [pa.array([], pa.binary())], names=names)

    found = places.groupBy("shard").cogroup(store.payload.groupBy("shard")).applyInArrow(
        frees_after(cut_out), "doc_id long, occurrence long, copies long, start long, n_tokens long, ids binary")
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")
