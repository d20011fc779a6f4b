"""LM scoring with a hierarchical Pitman-Yor model.

Restaurants: one for each previous word (the begin of a text counts as one),
all sharing the root. A restaurant's dishes are the words that followed; the
customers of the root are the tables of all restaurants. The root has discount
zero over the V training words and one unknown word, so that its predictive
probabilities depend on its customers alone and its own tables need no
sampling. In a Gibbs sweep all customers of every dish are taken out and seated
again given all other dishes (``table_counts.draw``, whatever the dish's size),
in ``Settings.moves`` turns that see the turns before. The seatings of the
sampled sweeps are averaged, and with them the predictive probabilities, which
are linear in a dish's and a restaurant's number of tables and in the
probability of the root.

How it is spread: a block of documents is reduced inside one task to its
different (word, previous word) entries, dealt to buckets by word. A bucket
holds all dishes of its words, so a word's customers at the root are local. What
a restaurant's dishes in other buckets must know is its number of tables: rows
(bucket, context, tables) are added up by context and go back to the buckets
that asked. This happens once a round of ``passes`` sweeps, in which a bucket
sees its own changes to a dish at once and those of other dishes after the
round. Dishes with one customer have one table whatever is drawn; they are
counted once and only the others travel. The seating is stored after each
round and seeded by bucket and round, so a lost executor changes nothing.

Scoring: log p(w | u) is log p(w) at the root, plus log(1 + bonus) if the pair
was seen, plus the log of the share that restaurant u leaves to the root. The
last term belongs to the word u and is added at u's own bucket. Blocks of a
bucket are dealt to as many groups as its tokens ask for, so the
occurrences of a hot word are spread; scores flow back as sparse partial sums.

The table of restaurants grows with the corpus: it is only ever merge-joined.

Words are identified by 64-bit hashes (XXH64), as contexts by 40 bits of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import table_counts
from strata.llm.common import SPACE_WORD, batch_words, bounded_runs, cut, discard, frees_after, frees_memory, materialize

END = np.uint64(xxhash.xxh64_intdigest(b" end "))  # no word holds white space
BEGIN = np.uint64(0)
CONTEXT_BYTES = 5
BLOCK_BYTES = 12 << 20  # above the batch size: a batch is a block, unless one text is longer
BLOCK_DOCS = 60_000
GROUP_BYTES = 32 << 20  # block entries scored together
TASK_BYTES = 16 << 20  # of a stored step's shuffles: large blobs take several times their size in a task
TOKEN_BYTES = 10  # of an entry with its occurrences
_CODEC = pa.Codec("zstd", compression_level=3)


@dataclass(frozen=True)
class Settings:
    """Discount (between 0 and 1) and strength of the context restaurants,
    what the root adds to each word's customers, rounds (an exchange of table
    totals each), sweeps a round, turns a sweep (each dish is seated again in
    one of them)."""

    discount: float = 0.7
    strength: float = 0.5
    root: float = 2.0
    burn_in: int = 1
    samples: int = 2
    passes: int = 2
    moves: int = 4
    seed: int = 11

    @property
    def rounds(self) -> int:
        return self.burn_in + self.samples


def _u(blob, kind: str) -> np.ndarray:
    return np.frombuffer(blob, kind)


def context_id(hashes: np.ndarray) -> np.ndarray:
    """The context that a word is to its successor."""
    return hashes & np.uint64((1 << 8 * CONTEXT_BYTES) - 1)


def squeeze(blob: bytes) -> bytes:
    """Compressed bytes, behind their length."""
    return len(blob).to_bytes(4, "little") + _CODEC.compress(blob, asbytes=True) if blob else b""


def spread(blob: bytes) -> bytes:
    return _CODEC.decompress(blob[4:], int.from_bytes(blob[:4], "little"), asbytes=True) if blob else b""


def pack(ids: np.ndarray) -> bytes:
    return np.ascontiguousarray(ids, "<u8").view(np.uint8).reshape(-1, 8)[:, :CONTEXT_BYTES].tobytes()


def unpack(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // CONTEXT_BYTES, 8), np.uint8)
    out[:, :CONTEXT_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, CONTEXT_BYTES)
    return out.view("<u8")[:, 0]


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))


# -- counting ---------------------------------------------------------------

_ENTRY_COLS = ["words", "n_ctx", "ctx", "n_occ", "occ"]
_ENTRIES = ("block long, bucket int, words binary, n_ctx binary, ctx binary, n_occ binary, occ binary, "
            "ids array<long>, held array<boolean>, n_tokens array<long>")
_LIST_KINDS = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
_LIST_COLS = ["ids", "held", "n_tokens"]


def _block(block: int, ids: pa.Array, held: pa.Array, texts: pa.Array, buckets: int) -> pa.RecordBatch:
    """One row a bucket, its arrays compressed; the first one carries the
    block's document list."""
    per_doc, words = batch_words(texts, SPACE_WORD)
    n_docs = len(per_doc)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words.dictionary.to_numpy(zero_copy_only=False).tolist()), np.uint64, len(words.dictionary))
    hashes = np.concatenate([hashes, [END]])
    doc = np.repeat(np.arange(n_docs, dtype="<u2"), per_doc + 1)
    ends = np.cumsum(per_doc + 1) - 1
    tokens = np.full(len(doc), len(hashes) - 1, np.int32)
    is_word = np.ones(len(doc), bool)
    is_word[ends] = False
    tokens[is_word] = words.indices.to_numpy(zero_copy_only=False)
    before = np.concatenate([np.zeros(1, np.int32), tokens[:-1]])
    before[np.concatenate([[0], ends[:-1] + 1])] = len(hashes)

    home = context_id(hashes) % np.uint64(buckets)
    order_w = np.lexsort((hashes, home))
    rank = np.empty(len(order_w), np.int64)
    rank[order_w] = np.arange(len(order_w))
    key = rank[tokens]
    key *= len(hashes) + 1
    key += before
    del tokens, before, is_word, words
    order = np.argsort(key, kind="stable")
    key, occ = key[order], doc[order]
    del order, doc
    first = _firsts(key)
    n_occ = np.diff(np.append(first, len(key)))
    entry_word, entry_before = np.divmod(key[first], len(hashes) + 1)
    del key
    entry_ctx = context_id(np.append(hashes, BEGIN))[entry_before]
    del entry_before
    word_first = _firsts(entry_word)
    n_ctx = np.diff(np.append(word_first, len(entry_word)))
    word = hashes[order_w][entry_word[word_first]]
    word_home = home[order_w][entry_word[word_first]].astype(np.int64)

    cut_w = _firsts(word_home)
    rows = []
    for lo, hi in zip(cut_w, np.append(cut_w[1:], len(word_home))):
        e0 = word_first[lo]
        e1 = word_first[hi] if hi < len(word_first) else len(first)
        o0, o1 = first[e0], first[e1] if e1 < len(first) else len(occ)
        blobs = (word[lo:hi].astype("<u8").tobytes(), n_ctx[lo:hi].astype("<u4").tobytes(), pack(entry_ctx[e0:e1]),
                 n_occ[e0:e1].astype("<u4").tobytes(), occ[o0:o1].tobytes())
        rows.append((int(word_home[lo]), *map(squeeze, blobs)))
    cols = list(zip(*rows))
    rest = [None] * (len(rows) - 1)
    lists = [[ids.to_pylist(), *rest], [held.to_pylist(), *rest], [(per_doc + 1).tolist(), *rest]]
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(rows), pa.int64()), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]],
         *[pa.array(v, k) for v, k in zip(lists, _LIST_KINDS)]], names=["block", "bucket", *_ENTRY_COLS, *_LIST_COLS])


def count_entries(docs: DataFrame, held: str, id_col: str, text_col: str, buckets: int, training: bool = False) -> DataFrame:
    """Block entries of all documents, or (what ``train`` takes) of the
    training documents alone."""
    src = docs.select(docs[id_col].cast("long").alias("id"), F.expr(held).alias("held"), docs[text_col].cast("string").alias("text"))
    if training:
        src = src.where("not held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for b in batches:
            sizes = pa.compute.binary_length(b.column(2)).fill_null(0).to_numpy(zero_copy_only=False)
            for at, n in bounded_runs(sizes, BLOCK_BYTES, BLOCK_DOCS):
                part = b.slice(at, n)
                yield _block(block, part.column(0), part.column(1), part.column(2), buckets)
                block += 1

    return src.mapInArrow(frees_memory(run), _ENTRIES)


# -- seating ----------------------------------------------------------------

_COUNTS = "bucket int, words binary, n_ctx binary, ctx binary, count binary, tokens long"


def _row(schema: str, values: list) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array([v], kinds[k]) for v, (_, k) in zip(values, fields)], names=[n for n, _ in fields])


def _gather(t: pa.Table) -> pa.Table:
    """All entries of a bucket's training documents -> one row: its words, and their
    contexts with counts."""
    words, ctx, counts = [], [], []
    for row in zip(*(t[name] for name in ("words", "n_ctx", "ctx", "n_occ"))):
        w, n, c, k = (spread(x.as_py()) for x in row)
        words.append(np.repeat(_u(w, "<u8"), _u(n, "<u4")))
        ctx.append(unpack(c))
        counts.append(_u(k, "<u4"))
    word, ctx, count = np.concatenate(words), np.concatenate(ctx), np.concatenate(counts)
    del words, counts
    order = np.lexsort((ctx, word))
    word = word[order]
    ctx = ctx[order]
    count = count[order]
    del order
    first = _firsts(word, ctx)
    word, ctx, count = word[first], ctx[first], np.add.reduceat(count, first, dtype=np.int64)
    at = _firsts(word)
    n_ctx = np.diff(np.append(at, len(word)))
    return _row(_COUNTS, [t["bucket"][0].as_py(), word[at].astype("<u8").tobytes(), n_ctx.astype("<u4").tobytes(), pack(ctx),
                          count.astype("<i8").tobytes(), int(count.sum())])


class Dishes:
    """The dishes of a bucket with two customers or more, and the number of
    tables of each: no probability depends on more of the seating."""

    def __init__(self, word_of: np.ndarray, ctx: np.ndarray, count: np.ndarray, single: np.ndarray, settings: Settings,
                 tables: np.ndarray | None = None):
        self.word_of, self.ctx, self.count, self.single, self.s = word_of, ctx, count, single, settings
        self.tables = np.ones(len(count), np.int64) if tables is None else tables.astype(np.int64)

    @property
    def start(self) -> np.ndarray:
        """Where the tables of each dish begin in ``sizes``."""
        return np.cumsum(self.tables) - self.tables

    @property
    def sizes(self) -> np.ndarray:
        """Customers of each table in one of the seatings with these tables:
        all but the first have one."""
        out = np.ones(int(self.tables.sum()), np.int64)
        out[self.start] += self.count - self.tables
        return out

    def customers(self) -> np.ndarray:
        """Of each word at the root."""
        return self.single + np.bincount(self.word_of, weights=self.tables, minlength=len(self.single)).astype(np.int64)

    def sweep(self, others: np.ndarray, n_root: float, n_words: int, rng: np.random.Generator) -> None:
        """All customers of every dish leave and are seated again. ``others``:
        tables of the other dishes of each dish's restaurant; ``n_root``:
        customers of the root."""
        s = self.s
        root = n_root - self.tables + s.root * (n_words + 1)
        strength = s.strength + s.discount * others
        for turn in range(s.moves):
            at = slice(turn, None, s.moves)
            rest = self.customers()[self.word_of[at]] - self.tables[at]  # the word's customers at the root from other restaurants
            self.tables[at] = table_counts.draw(self.count[at], strength[at], rest + s.root, root[at], s.discount, rng)


_STATE = "bucket int, n_rep binary, ctx binary, count binary, single binary, seats binary, sum binary, tables long"
_SEATS = "bucket int, seats binary, sum binary, tables long"  # what a round changes


def _begin(row: dict, settings: Settings) -> pa.RecordBatch:
    """The first seating: one table for every dish."""
    n_ctx = _u(row["n_ctx"], "<u4").astype(np.int64)
    word_of = np.repeat(np.arange(len(n_ctx)), n_ctx)
    count = _u(row["count"], "<i8")
    many = count > 1
    single = np.bincount(word_of[~many], minlength=len(n_ctx))
    dishes = Dishes(word_of[many], unpack(row["ctx"])[many], count[many], single, settings)
    return _state(row["bucket"], dishes, np.zeros(int(many.sum())))


def _state(bucket: int, dishes: Dishes, total: np.ndarray) -> pa.RecordBatch:
    n_rep = np.bincount(dishes.word_of, minlength=len(dishes.single))
    return _row(_STATE, [bucket, n_rep.astype("<u4").tobytes(), pack(dishes.ctx), dishes.count.astype("<i8").tobytes(),
                         dishes.single.astype("<u4").tobytes(), *_seats(dishes, total)]).to_batches()[0]


def _seats(dishes: Dishes, total: np.ndarray) -> list:
    return [dishes.tables.astype("<i8").tobytes(), total.astype("<f8").tobytes(), int(dishes.tables.sum())]


def _dishes(row: dict, settings: Settings) -> Dishes:
    n_rep = _u(row["n_rep"], "<u4").astype(np.int64)
    return Dishes(np.repeat(np.arange(len(n_rep)), n_rep), unpack(row["ctx"]), _u(row["count"], "<i8"),
                  _u(row["single"], "<u4").astype(np.int64), settings, _u(row["seats"], "<i8"))


def run_round(row: dict, ctx: np.ndarray, tables: np.ndarray, n_root: float, n_words: int, round_no: int, settings: Settings) -> pa.Table:
    """The seats after the sweeps of one round in one bucket. ``ctx``
    (sorted), ``tables``: tables per restaurant at the start."""
    dishes = _dishes(row, settings)
    others = tables[np.searchsorted(ctx, dishes.ctx)] - dishes.tables if len(dishes.count) else np.zeros(0)
    rng = np.random.default_rng([settings.seed, round_no, row["bucket"]])
    total, c0 = _u(row["sum"], "<f8").copy(), int(dishes.customers().sum())
    for _ in range(settings.passes):
        dishes.sweep(others, n_root + int(dishes.customers().sum()) - c0, n_words, rng)
        if round_no >= settings.burn_in:
            total += dishes.tables
    return _row(_SEATS, [row["bucket"], *_seats(dishes, total)])


def _step(n_root: float, n_words: int, round_no: int, settings: Settings):
    """A round as a function of a bucket's seating and the tables of its restaurants."""

    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _NO_SEATS
        right = right.sort_by("ctx")
        ctx, tables = right["ctx"].to_numpy().astype(np.uint64), right["tables"].to_numpy()
        return run_round(left.to_pylist()[0], ctx, tables, n_root, n_words, round_no, settings)

    return frees_after(step)


@dataclass(frozen=True)
class Model:
    """Stored counts, the last seating with its sums, and (ctx, tables,
    customers) of all restaurants under the averaged seating; ``stored``: the
    tables that these read."""

    counts: DataFrame
    state: DataFrame
    contexts: DataFrame
    n_tokens: int
    n_words: int
    n_root: float
    begin: tuple[float, int]
    settings: Settings
    stored: tuple[DataFrame, ...] = ()


def _flat(df: DataFrame, rows, schema: str) -> DataFrame:
    """Rows of numpy columns from each bucket's row."""
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    kinds = [{"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}[k] for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(rows(row), kinds)], names=list(names))

    return df.mapInArrow(frees_memory(run), schema)


def _by_context(bucket: int, ctx: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    ids, at = np.unique(ctx, return_inverse=True)
    sums = [np.bincount(at, weights=v, minlength=len(ids)) for v in values]
    return [np.full(len(ids), bucket, np.int32), ids.astype(np.int64), *sums]


def train(entries: DataFrame, settings: Settings | None = None) -> Model:
    """Counts over all training documents, then the rounds."""
    s = settings or Settings()
    counts = materialize(entries.select("bucket", "words", "n_ctx", "ctx", "n_occ").groupBy("bucket").applyInArrow(frees_after(_gather), _COUNTS),
                         "lm-counts", release=True, task_bytes=TASK_BYTES)
    n_words, n_tokens = counts.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).head()
    n_words = int(n_words) // 8

    def all_dishes(row: dict) -> list:
        count = _u(row["count"], "<i8")
        return _by_context(row["bucket"], unpack(row["ctx"]), (count == 1).astype(float), count.astype(float))

    contexts = materialize(_flat(counts, all_dishes, "bucket int, ctx long, single double, customers double")
                           .groupBy("ctx").agg(F.sum("single").alias("single"), F.sum("customers").alias("customers")), "lm-contexts", release=True, task_bytes=TASK_BYTES)
    n_single = contexts.agg(F.coalesce(F.sum("single"), F.lit(0.0))).head()[0]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                yield _begin(row, s)

    begun = state = seats = materialize(counts.mapInArrow(frees_memory(first), _STATE), "lm-seats")
    dishes = begun.drop("seats", "sum", "tables")

    def tables(row: dict) -> list:
        dishes = _dishes(row, s)
        return _by_context(row["bucket"], dishes.ctx, dishes.tables)

    for r in range(s.rounds):
        own = _flat(state, tables, "bucket int, ctx long, tables double")
        n_root = n_single + (seats.agg(F.sum("tables")).head()[0] or 0)
        known = own.select("bucket", "ctx", F.sum("tables").over(Window.partitionBy("ctx")).alias("own"))  # at most a row a bucket
        known = known.join(contexts.select("ctx", "single").hint("merge"), "ctx").select("bucket", "ctx", (F.col("own") + F.col("single")).alias("tables"))

        left, seats = seats, materialize(state.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_step(n_root, n_words, r, s), _SEATS),
                                         "lm-seats", release=True, task_bytes=TASK_BYTES)
        state = dishes.join(seats.hint("merge"), "bucket")  # a row a bucket
        if r:
            discard(left)

    def mean(row: dict) -> list:
        return _by_context(row["bucket"], unpack(row["ctx"]), _u(row["sum"], "<f8") / (s.samples * s.passes))

    averaged = _flat(state, mean, "bucket int, ctx long, tables double").groupBy("ctx").agg(F.sum("tables").alias("own"))
    single, contexts = contexts, materialize(contexts.join(averaged.hint("merge"), "ctx", "left").select(
        "ctx", (F.col("single") + F.coalesce("own", F.lit(0.0))).alias("tables"), "customers"), "lm-contexts", release=True, task_bytes=TASK_BYTES)
    discard(single)
    n_root = contexts.agg(F.coalesce(F.sum("tables"), F.lit(0.0))).head()[0]
    begin = contexts.where(F.col("ctx") == int(BEGIN)).agg(F.sum("tables"), F.sum("customers")).head()
    return Model(counts, state, contexts, int(n_tokens), n_words, n_root, (begin[0] or 0.0, int(begin[1] or 0)), s, (counts, begun, seats, contexts))


_NO_SEATS = pa.table([pa.array([], pa.int32()), *[pa.array([], pa.binary())] * 2, pa.array([], pa.int64())], names=[f.split()[0] for f in _SEATS.split(", ")])


# -- scoring ----------------------------------------------------------------

_READY = "bucket int, words binary, n_ctx binary, ctx binary, bonus binary, root binary, share binary, unigram binary, tokens long"


def _ready(left: pa.Table, right: pa.Table, n_root: float, n_words: int, s: Settings) -> pa.Table:
    """A bucket's counts with its seating and the restaurants they meet ->
    per pair its bonus over the root, per word its probability at the root
    and the log share its own restaurant leaves to the root."""
    if not left.num_rows:
        return pa.table([pa.array([], k) for k in (pa.int32(), *[pa.binary()] * 7, pa.int64())], names=[f.split()[0] for f in _READY.split(", ")])
    row = left.to_pylist()[0]
    seats = right.filter(pa.compute.is_valid(right["sum"]))
    known = right.select(["ctx", "tables", "customers"]).filter(pa.compute.is_valid(right["ctx"])).sort_by("ctx")
    ids = known["ctx"].to_numpy().astype(np.uint64)
    words, n_ctx = _u(row["words"], "<u8"), _u(row["n_ctx"], "<u4").astype(np.int64)
    word_of, ctx, count = np.repeat(np.arange(len(words)), n_ctx), unpack(row["ctx"]), _u(row["count"], "<i8")
    tables = np.ones(len(ctx))
    tables[count > 1] = _u(seats["sum"][0].as_py(), "<f8") / (s.samples * s.passes)
    root = (np.bincount(word_of, weights=tables, minlength=len(words)) + s.root) / (n_root + s.root * (n_words + 1))
    left_over = s.strength + s.discount * known["tables"].to_numpy()
    bonus = (count - s.discount * tables) / (left_over[_find(ids, ctx)] * root[word_of])
    own = _find(ids, context_id(words))
    share = np.where(own >= 0, np.log10(left_over[own] / (s.strength + known["customers"].to_numpy()[own])), 0.0)
    share[words == END] = 0.0
    unigram = np.bincount(word_of, weights=count, minlength=len(words))
    return _row(_READY, [row["bucket"], row["words"], row["n_ctx"], row["ctx"], bonus.astype("<f4").tobytes(), root.astype("<f8").tobytes(),
                         share.astype("<f8").tobytes(), unigram.astype("<i8").tobytes(), row["tokens"]])


def ready(model: Model) -> DataFrame:
    """The scoring tables of all buckets."""
    s, n_root, n_words = model.settings, model.n_root, model.n_words

    def asked(row: dict) -> list:
        return _by_context(row["bucket"], np.concatenate([unpack(row["ctx"]), context_id(_u(row["words"], "<u8"))]))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        return _ready(left, right, n_root, n_words, s)

    known = _flat(model.counts, asked, "bucket int, ctx long").join(model.contexts.hint("merge"), "ctx")
    right = known.select("bucket", "ctx", "tables", "customers", F.lit(None).cast("binary").alias("sum")).unionByName(
        model.state.select("bucket", "sum"), allowMissingColumns=True)
    return model.counts.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(frees_after(finish), _READY)


_PART = "block long, bucket int, doc binary, score binary, base binary, known binary, ids array<long>, held array<boolean>, n_tokens array<long>"


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Position of each key, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == keys, at, -1)


def _or(values: np.ndarray, at: np.ndarray, default: float) -> np.ndarray:
    return np.where(at >= 0, values[at], default) if len(values) else np.full(len(at), default)


def _score_bucket(left: pa.Table, right: pa.Table, n_root: float, n_words: int, n_tokens: int, s: Settings) -> pa.Table:
    """Per block: log probabilities of the bucket's entries, summed by
    document. ``left``: block entries, ``right``: the bucket's scoring row."""
    kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 4, *_LIST_KINDS)
    rows = []
    if left.num_rows:
        blobs = right.to_pylist()[0] if right.num_rows else {}
        words, ctx = _u(blobs.get("words", b""), "<u8"), unpack(blobs.get("ctx", b""))
        root, share, unigram = _u(blobs.get("root", b""), "<f8"), _u(blobs.get("share", b""), "<f8"), _u(blobs.get("unigram", b""), "<i8")
        bonus, n_ctx = _u(blobs.get("bonus", b""), "<f4"), _u(blobs.get("n_ctx", b""), "<u4").astype(np.int64)
        starts = np.append(0, np.cumsum(n_ctx))
        unknown = s.root / (n_root + s.root * (n_words + 1))
        denominator = n_tokens + 0.5 * (n_words + 1)
        for i in range(left.num_rows):
            r = {c: left[c][i].as_py() for c in ("block", "bucket", *_LIST_COLS)}
            r |= {c: spread(left[c][i].as_py()) for c in _ENTRY_COLS}
            n_each = _u(r["n_ctx"], "<u4").astype(np.int64)
            word = np.repeat(_find(words, _u(r["words"], "<u8")), n_each)
            at = _pair(starts, ctx, word, unpack(r["ctx"]))
            lp = np.log10(_or(root, word, unknown)) + np.log10(1 + _or(bonus, at, 0.0).astype(np.float64)) + _or(share, word, 0.0)
            n_occ = _u(r["n_occ"], "<u4").astype(np.int64)
            occ = _u(r["occ"], "<u2")
            score = np.bincount(occ, weights=np.repeat(lp, n_occ))
            base = np.bincount(occ, weights=np.repeat(np.log10((_or(unigram, word, 0) + 0.5) / denominator), n_occ))
            seen = np.bincount(occ, weights=np.repeat(word >= 0, n_occ))
            doc = np.flatnonzero(np.bincount(occ))
            sums = (doc.astype("<u2"), score[doc].astype("<f8"), base[doc].astype("<f8"), seen[doc].astype("<u4"))
            rows.append((r["block"], r["bucket"], *(squeeze(x.tobytes()) for x in sums), *(r[c] for c in _LIST_COLS)))
    cols = list(zip(*rows)) or [[]] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in _PART.split(", ")])


def _pair(starts: np.ndarray, ctx: np.ndarray, word: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each (word, context) among the words' sorted contexts, or -1:
    a binary search in all words' ranges at once."""
    lo = np.where(word >= 0, starts[word], 0)
    end = np.where(word >= 0, starts[np.maximum(word, 0) + 1] if len(starts) > 1 else 0, 0)
    hi = end.copy()
    while len(ctx) and (lo < hi).any():
        mid = (lo + hi) // 2
        less = (lo < hi) & (ctx[np.minimum(mid, len(ctx) - 1)] < asked)
        hi = np.where(less | (lo >= hi), hi, mid)
        lo = np.where(less, mid + 1, lo)
    found = lo < end
    return np.where(found & (ctx[np.where(found, lo, 0)] == asked), lo, -1) if len(ctx) else np.full(len(word), -1)


def _scoring_groups(entries: DataFrame, tables: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Block entries with the salt of their group in the bucket, and the
    scoring rows once for each group. A bucket has one group per
    ``GROUP_BYTES`` of entries, estimated from its training tokens."""
    groups = cut(counts.select("bucket", F.ceil(F.col("tokens") * TOKEN_BYTES / GROUP_BYTES).cast("int").alias("groups")))
    salt = F.pmod(F.xxhash64("block"), F.coalesce("groups", F.lit(1))).cast("int").alias("salt")
    asked = entries.join(F.broadcast(groups), "bucket", "left").select("block", "bucket", *_ENTRY_COLS, *_LIST_COLS, salt)  # one row a bucket
    tables = tables.join(F.broadcast(groups), "bucket").select(*tables.columns, F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"))
    return asked, tables


def _collect_block(t: pa.Table, begin: float) -> pa.Table:
    """Add a block's partial sums (in bucket order) per document; ``begin``:
    the log share that the begin's restaurant leaves to the root."""
    t = t.sort_by("bucket")
    lists = {c: next(v for v in t[c].to_pylist() if v is not None) for c in _LIST_COLS}
    n = len(lists["ids"])
    score, base, known = np.full(n, begin), np.zeros(n), np.zeros(n, np.int64)
    for docs, *parts in zip(*(t[c] for c in ("doc", "score", "base", "known"))):
        doc = _u(spread(docs.as_py()), "<u2")
        for total, blob, kind in zip((score, base, known), parts, ("<f8", "<f8", "<u4")):
            total[doc] += _u(spread(blob.as_py()), kind)
    return pa.table([pa.array(lists["ids"], pa.int64()), pa.array(lists["held"], pa.bool_()),
                     pa.array(lists["n_tokens"], pa.int64()), pa.array(known), pa.array(base), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: str | None = None,
                    settings: Settings | None = None) -> DataFrame:
    """Train on the documents for which the SQL expression ``held`` is not
    true and score all of them: doc_id, held_out, n_tokens (with the end),
    n_known (tokens seen in training), train_tokens, base_score (unigram,
    half a count added), score (log10 probability under the averaged
    predictive distribution), perplexity (10 ^ -(score / n_tokens)).

    Default split: crc32 of the id as text, remainder 1 of 5 is held out; a
    NULL id is a training document. NULL and empty texts are the end token
    alone. Repeated rows count and score each; an empty table gives no rows;
    other columns are not read. Without training documents every word is
    unknown.
    """
    s = settings or Settings()
    held = held or f"coalesce(crc32(cast(`{id_col}` as string)) % 5 = 1, false)"
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    model = train(count_entries(docs, held, id_col, text_col, buckets, training=True), s)
    n_root, n_words, n_tokens = model.n_root, model.n_words, model.n_tokens
    begin = float(np.log10((s.strength + s.discount * model.begin[0]) / (s.strength + model.begin[1])))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score_bucket(left, right, n_root, n_words, n_tokens, s)

    def collect(t: pa.Table) -> pa.Table:
        return _collect_block(t, begin)

    scoring = materialize(ready(model), "lm-scoring", release=True, task_bytes=TASK_BYTES)
    asked, tables = _scoring_groups(count_entries(docs, held, id_col, text_col, buckets), scoring, model.counts)
    discard(*model.stored)  # before the entries travel, the largest shuffle
    # so many partitions are not put together again: a task keeps few groups
    asked, tables = (df.repartition(buckets, "bucket", "salt") for df in (asked, tables))
    parts = asked.groupBy("bucket", "salt").cogroup(tables.groupBy("bucket", "salt")).applyInArrow(frees_after(score), _PART)
    out = parts.groupBy("block").applyInArrow(
        frees_after(collect), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"),
                      "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
