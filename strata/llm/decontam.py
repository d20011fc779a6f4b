"""Benchmark decontamination over a distributed positional inverted index.

The index is document-partitioned: every segment (a bounded run of documents
inside one task) stores, for each of its terms, the posting list of token
positions, plus one directory row with its documents. Hot terms are therefore
split over all segments and building needs no shuffle. Benchmark windows are
looked up by their rarest terms, one more than a proximity match may miss;
their postings, moved back by the term's offset and by up to the allowed
displacement, are the candidate starts, and inside each segment they are
intersected with the postings of the other terms. Exact phrases and proximity
matches (most terms within a few positions of their place) come out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import batch_words, bounded_runs, broadcast_within, cut, frees_after, frees_memory, materialize, row_keys

# Word bytes: digits, letters and all of non-ASCII UTF-8.
_IN_WORD = np.array([chr(b).isalnum() if b < 0x80 else True for b in range(256)])

SEGMENT_BYTES = 12 << 20  # above the batch size: a batch is a segment, unless one text is longer
MAX_BROADCAST_BYTES = 32 << 20
CANDIDATES = 1 << 18  # looked at together
# ids: of the documents of a segment, by column
_KEYS = "ids array<array<long>>"
INDEX = f"seg long, term string, tf int, postings binary, {_KEYS}, n_words array<int>"
_INDEX_ARROW = pa.schema([("seg", pa.int64()), ("term", pa.string()), ("tf", pa.int32()), ("postings", pa.binary()),
                          ("ids", pa.list_(pa.list_(pa.int64()))), ("n_words", pa.list_(pa.int32()))])


def _segment(seg: int, ids: list[pa.Array], texts: pa.Array, gap: int) -> Iterator[pa.RecordBatch]:
    per_text, words = batch_words(texts, _IN_WORD)
    yield pa.RecordBatch.from_arrays(
        [pa.array([seg], pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
         pa.array([[c.to_pylist() for c in ids]], _INDEX_ARROW.field("ids").type), pa.array([per_text.tolist()], pa.list_(pa.int32()))],
        schema=_INDEX_ARROW)
    codes = words.indices.to_numpy(zero_copy_only=False)
    if not len(codes):
        return
    pos = np.arange(len(codes), dtype=np.int32) + np.repeat(np.arange(1, len(per_text) + 1, dtype=np.int32) * gap, per_text)
    tf = np.bincount(codes, minlength=len(words.dictionary))
    blob = pos[np.argsort(codes, kind="stable")]
    at = np.concatenate([[0], np.cumsum(tf) * 4]).astype(np.int32)
    postings = pa.Array.from_buffers(pa.binary(), len(tf), [None, pa.py_buffer(at), pa.py_buffer(blob)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(tf), seg)), words.dictionary.cast(pa.string()), pa.array(tf, pa.int32()), postings,
         pa.nulls(len(tf), _INDEX_ARROW.field("ids").type), pa.nulls(len(tf), pa.list_(pa.int32()))], schema=_INDEX_ARROW)


def build_index(docs: DataFrame, keys: list[str], text_col: str = "text", gap: int = 16) -> DataFrame:
    """The stored positional index of ``docs`` (``INDEX`` columns). A row
    with a NULL term is a segment's directory: its documents in order with
    the columns ``keys`` (longs) and their word counts. Document k of a segment (from 0) starts at position
    (words of the documents before it) + (k + 1) * gap, so no window crosses
    documents or begins before position 0."""
    src = docs.select(*[docs[k].cast("long").alias(f"k{i}") for i, k in enumerate(keys)], docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seg = TaskContext.get().partitionId() << 32
        for b in batches:
            sizes = pa.compute.binary_length(b.columns[-1]).fill_null(0).to_numpy(zero_copy_only=False)
            for first, n in bounded_runs(sizes, SEGMENT_BYTES, 1 << 16):
                part = b.slice(first, n)
                yield from _segment(seg, part.columns[:-1], part.columns[-1], gap)
                seg += 1

    return materialize(src.mapInArrow(frees_memory(run), INDEX), "postings")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 10) -> DataFrame:
    """(item_id string, terms array): every run of ``window`` words of each
    item; an item of fewer words, but not none, is one window. Items with a
    NULL id or no words have none."""
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, terms = [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = [w.decode() for w in word.findall((text or "").encode().lower())]
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    ids.append(item)
                    terms.append(words[i:i + window])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])

    src = items.where(items[id_col].isNotNull()).select(
        items[id_col].cast("string").alias("id"), items[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, "item_id string, terms array<string>").distinct()


MATCHES = "seg long, ord int, n_hit int, wids array<long>, near array<long>"
_MATCH_NAMES = ["seg", "ord", "n_hit", "wids", "near"]


def _intersect(left: pa.Table, right: pa.Table, window: int, gap: int, slop: int, near_share: float) -> pa.Table:
    """One segment: candidate starts (left) against the postings and the
    directory (right)."""
    empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.int32()),
                      pa.array([], pa.list_(pa.int64())), pa.array([], pa.list_(pa.int64()))], names=_MATCH_NAMES)
    if not left.num_rows:
        return empty
    is_dir = pa.compute.is_null(right["term"])
    directory = right.filter(is_dir)
    n_words = np.array(directory["n_words"][0].as_py(), np.int64)
    base = np.concatenate([[0], np.cumsum(n_words)[:-1]]) + np.arange(1, len(n_words) + 1) * gap
    size = int(n_words.sum()) + (len(n_words) + 2) * gap
    lists = right.filter(pa.compute.invert(is_dir)).combine_chunks()
    vocab = {t: i for i, t in enumerate(lists["term"].to_pylist())}
    places = [np.frombuffer(p.as_buffer(), "<i4") for p in lists["postings"]]
    term_at = np.full(size, -1, np.int32)  # the postings, addressed by position
    for i, p in enumerate(places):
        term_at[p] = i

    left = left.sort_by("wid")
    wid_of, first, w_of = np.unique(left["wid"].to_numpy(), return_index=True, return_inverse=True)
    terms = np.full((len(wid_of), window), -3, np.int32)
    for i, row in enumerate(left["terms"].take(pa.array(first)).to_pylist()):
        terms[i, :len(row)] = [vocab.get(t, -2) for t in row]
    lens = (terms != -3).sum(axis=1)
    need = np.ceil(near_share * lens).astype(np.int64)
    shifts = np.arange(-slop, slop + 1)
    offsets = left["off"].to_numpy()
    looked_up = terms[w_of, offsets]
    n_found = np.array([len(p) for p in places])[looked_up] * len(shifts)
    ok_w, ok_start, near_w, near_doc = [], [], [], []
    # the probes of a window stay together, so every start of it is looked at once
    per_window = np.add.reduceat(n_found, first)
    last = np.append(first[1:], left.num_rows)
    for w0, n in bounded_runs(per_window, CANDIDATES, len(wid_of)):
        lo, hi = first[w0], last[w0 + n - 1]
        part = [places[t] for t in looked_up[lo:hi]]
        probe = np.repeat(np.arange(lo, hi), [len(p) for p in part])
        at = np.concatenate(part).astype(np.int64)
        key = (w_of[probe] * size + at - offsets[probe])[:, None] + shifts
        key, where = np.unique(key, return_index=True)
        at = at[where // len(shifts)]  # a probe's place: always inside the document
        w, start = key // size, key % size
        exact, close = np.ones(len(key), bool), np.zeros(len(key), np.int64)
        for k in range(window):
            want = terms[w, k]
            used = want != -3
            here = term_at[start + k] == want
            exact &= here | ~used
            for d in shifts[shifts != 0]:
                here |= term_at[start + k + d] == want
            close += here & used
            alive = close + np.maximum(lens[w] - k - 1, 0) >= need[w]
            alive |= exact
            if not alive.all():
                w, start, at, exact, close = w[alive], start[alive], at[alive], exact[alive], close[alive]
        ok_w.append(w[exact])
        ok_start.append(start[exact])
        near_w.append(w[~exact])
        near_doc.append(np.searchsorted(base, at[~exact], "right") - 1)
    ok_w, ok_start, near_w, near_doc = map(np.concatenate, (ok_w, ok_start, near_w, near_doc))
    ok_doc = np.searchsorted(base, ok_start, "right") - 1

    cover = np.zeros(size + 1, np.int32)
    np.add.at(cover, ok_start, 1)
    np.subtract.at(cover, ok_start + lens[ok_w], 1)
    hit = np.flatnonzero(np.cumsum(cover) > 0)
    n_hit = np.bincount(np.searchsorted(base, hit, "right") - 1, minlength=len(base))

    def by_doc(doc: np.ndarray, w: np.ndarray) -> dict[int, list[int]]:
        out: dict[int, list[int]] = {}
        for d, i in np.unique(np.stack([doc, wid_of[w]], axis=1), axis=0).tolist():
            out.setdefault(d, []).append(i)
        return out

    exact, around = by_doc(ok_doc, ok_w), by_doc(near_doc, near_w)
    docs = sorted({*exact, *around})
    if not docs:
        return empty
    return pa.table([pa.array([directory["seg"][0].as_py()] * len(docs), pa.int64()), pa.array(docs, pa.int32()),
                     pa.array([int(n_hit[d]) for d in docs], pa.int32()),
                     pa.array([exact.get(d, []) for d in docs], pa.list_(pa.int64())),
                     pa.array([around.get(d, []) for d in docs], pa.list_(pa.int64()))], names=_MATCH_NAMES)


def search(index: DataFrame, windows: DataFrame, window: int = 10, gap: int = 16, slop: int = 2,
           near_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(matches, window_items). ``matches``: per document with a match its
    segment, ordinal, number of hit words, ids of the windows found as exact
    phrases and of those found in proximity (at least ``near_share`` of the
    terms within ``slop`` positions of their place, for some start; any of
    the others may be missing). ``window_items``: (wid, item_id)."""
    if gap < window + 2 * slop:
        raise ValueError("gap must be at least window + 2 * slop")
    window_items = cut(windows.select(F.xxhash64(F.concat_ws(" ", "terms")).alias("wid"), "terms", "item_id"))
    distinct = window_items.select("wid", "terms").distinct()
    terms = cut(distinct.select(F.explode("terms").alias("term")).distinct())
    terms = broadcast_within(terms, MAX_BROADCAST_BYTES)
    postings = index.where("term IS NOT NULL").join(terms, "term", "left_semi")
    stats = postings.groupBy("term").agg(F.sum(F.col("tf").cast("long")).alias("total"))
    # absent terms are the rarest: they use up a probe and find nothing
    counted = F.struct(F.coalesce("total", F.lit(0)).alias("total"), "off", "term")
    probes = F.size("terms") - F.ceil(F.lit(near_share) * F.size("terms")).cast("int") + 1
    rarest = (distinct.select("wid", "terms", F.posexplode("terms").alias("off", "term")).join(stats, "term", "left")
              .groupBy("wid").agg(F.array_sort(F.collect_list(counted)).alias("r"), F.first("terms").alias("terms"))
              .select("wid", "terms", F.inline(F.slice("r", F.lit(1), probes))).where("total > 0").drop("total"))
    rarest = cut(rarest)
    by_term = broadcast_within(rarest, MAX_BROADCAST_BYTES)
    # the postings of every benchmark term reach the segment once, in lists
    candidates = index.where("term IS NOT NULL").select("seg", "term").join(by_term, "term").select("seg", "wid", "terms", "off")
    directory = index.where("term IS NULL").select("seg", "term", "postings", "n_words")
    lists = postings.select("seg", "term", "postings", F.lit(None).cast("array<int>").alias("n_words"))

    def per_segment(left: pa.Table, right: pa.Table) -> pa.Table:
        return _intersect(left, right, window, gap, slop, near_share)

    right = directory.unionAll(lists).toDF("seg", "term", "postings", "n_words")
    matches = candidates.groupBy("seg").cogroup(right.groupBy("seg")).applyInArrow(frees_after(per_segment), MATCHES)
    return cut(matches), window_items.select("wid", "item_id")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside any
    occurrence of a benchmark window), n_items and items_sha256 (of the
    sorted, comma-joined ids of items with an occurring window), contaminated
    (n_hit > 0), n_near_items (items found in proximity only).

    NULL and empty texts have no words and no hits; NULL document ids are
    kept as they are; an item with NULL id or text has no window; repeated
    rows give repeated results; an empty benchmark leaves every document
    clean; an empty table gives no rows; other columns are not read.
    """
    index = build_index(docs, [id_col], text_col)
    matches, window_items = search(index, item_windows(items, item_col, item_text_col, window), window)

    def items_of(col: str, out: str) -> DataFrame:
        return (matches.select("seg", "ord", F.explode(col).alias("wid")).join(window_items, "wid")
                .groupBy("seg", "ord").agg(F.sort_array(F.collect_set("item_id")).alias(out)))

    hits = (matches.select("seg", "ord", "n_hit").join(items_of("wids", "items"), ["seg", "ord"], "left")
            .join(items_of("near", "near_items"), ["seg", "ord"], "left"))
    everyone = index.where("term IS NULL").select("seg", F.posexplode(F.arrays_zip(F.col("ids")[0].alias("id"), "n_words")).alias("ord", "d"))
    none = F.array().cast("array<string>")
    items_col, near_col = F.coalesce("items", none), F.coalesce("near_items", none)
    return everyone.join(hits, ["seg", "ord"], "left").select(
        F.col("d.id").alias("doc_id"), F.col("d.n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items_col).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_col, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.size(F.array_except(near_col, items_col)).cast("long").alias("n_near_items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = 10) -> DataFrame:
    """The rows of ``docs`` without a benchmark window.

    The decision is taken by row, whatever its id: contaminated rows go also
    when their id is NULL, and clean rows stay also when another row of their
    id goes. NULL and empty texts stay; all copies of a contaminated text go;
    other columns may have any name; an empty table stays empty, an empty
    benchmark keeps all.
    """
    docs, keys = row_keys(docs)
    index = build_index(docs, keys, text_col)
    matches, _ = search(index, item_windows(items, item_col, item_text_col, window), window, slop=0, near_share=1.0)
    hit = matches.where("n_hit > 0").select("seg", "ord")
    everyone = index.where("term IS NULL").select("seg", F.posexplode(F.arrays_zip(F.col("ids")[0].alias("f"), F.col("ids")[1].alias("r"))).alias("ord", "d"))
    bad = everyone.join(hit, ["seg", "ord"], "left_semi").select(F.col("d.f").alias(keys[0]), F.col("d.r").alias(keys[1]))
    return docs.join(materialize(bad, "contaminated"), keys, "left_anti").drop(*keys)
