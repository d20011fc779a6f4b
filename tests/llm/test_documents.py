"""Operators on documents against brute force, on edge rows and on the
given tables."""

import collections
import math
import os
import random
import zlib

import brute_llm as bf
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import decontam, licenses, mixing, pitman_yor, quality, simhash, table_counts, tokenids
from strata.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.001"


def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def given_docs(spark, ready):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# -- quality ----------------------------------------------------------------

@pytest.mark.parametrize("which", ["edge", "given_docs"])
def test_quality_measures(which, request):
    df = request.getfixturevalue(which)
    got = rows(quality.measure(df), ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"])
    assert got == sorted(((i, *bf.quality(t)) for i, t in pairs(df)), key=repr)


def test_quality_verdict_and_filter(edge):
    limits = quality.RepetitionRules().max_coverage
    for _, t in bf.edge_texts():
        m = quality.measure_text(t, quality.RepetitionRules())
        if m[0]:
            assert m[9] == pytest.approx(max(bf.coverage(t, n) for n in limits))
    kept = quality.keep_good(edge)
    assert kept.columns == edge.columns
    want = [i for i, t in bf.edge_texts() if bf.keeps(t)]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert 17 not in want and 5 in want


def test_quality_verdict_on_repeats(frame, given_docs):
    heading = bf.prose(8, 50)
    page = "\n".join([heading, bf.prose(50, 2), heading, bf.prose(30, 33)])  # one short heading twice: stays
    long = "\n".join([bf.prose(25, 60), bf.prose(60, 2), bf.prose(25, 60), bf.prose(60, 33)])  # a passage of 25 words twice: goes
    docs = frame([(1, page), (2, long), (3, bf.prose(90, 5))]).select("doc_id", "text").union(given_docs.select("doc_id", "text"))
    got = sorted((r["doc_id"], r["kept"]) for r in quality.measure(docs).collect())
    assert got == sorted((i, bf.keeps(t)) for i, t in pairs(docs))
    assert {(1, True), (2, False), (3, True)} <= set(got)


# -- simhash ----------------------------------------------------------------

@given(st.integers(0, 2 ** 64 - 1), st.sets(st.integers(0, 63), max_size=2))
@settings(max_examples=300, deadline=None)
def test_masks_cover_every_pair_in_the_radius(fp, flips):
    other = fp ^ sum(1 << f for f in flips)
    assert any((fp ^ other) & m == 0 for m in simhash.covering_masks(2))


def test_masks_are_structured():
    masks = [m & (2 ** 64 - 1) for m in simhash.covering_masks(2)]
    assert len(masks) == 7 and all(36 <= bin(m).count("1") <= 37 for m in masks)
    assert len(simhash.covering_masks(1)) == 3


@pytest.mark.parametrize("limit", [2, 32])
@pytest.mark.parametrize("radius", [1, 2])
def test_components_of_close_fingerprints(spark, ready, limit, radius):
    rng = random.Random(limit + radius)
    fps = []
    for _ in range(12):  # clouds of close fingerprints, chains between some
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 40])):
            fps.append(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))))
    fps = list(dict.fromkeys(f % 2 ** 64 for f in fps))
    nodes = spark.createDataFrame([(i, f - 2 ** 64 if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long").repartition(4)
    found = {r["node"]: r["component"] for r in simhash.connected_components(simhash.links(nodes, radius, limit)).collect()}
    want = bf.components([(i, f"{f:016x}") for i, f in enumerate(fps)], radius)
    assert {i: found.get(i, i) for i in want} == want


@pytest.mark.parametrize("which", ["edge", "given_docs"])
def test_near_duplicates(which, request):
    df = request.getfixturevalue(which)
    docs = pairs(df)
    want = bf.components([(i, bf.fingerprint(t)) for i, t in docs if i is not None])
    assert rows(simhash.near_duplicates(df), ["doc_id", "fingerprint", "component_id"]) == sorted(
        ((i, bf.fingerprint(t), want.get(i)) for i, t in docs), key=repr)


def test_keep_one(edge):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    docs = pairs(edge)
    last = 10 ** 6  # NULL ids are grouped like any other, after all of them
    groups = bf.components([(last if i is None else i, bf.fingerprint(t)) for i, t in docs])
    want = [None if i == last else i for i in groups if groups[i] == i]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_rows_that_share_an_id_are_judged_apart(spark, ready, frame):
    one, two, three = bf.prose(60, 1), bf.prose(60, 30), bf.ITEM + " " + bf.prose(40, 60)
    docs = frame([(1, one), (1, two), (1, one), (None, two), (None, three), (None, bf.prose(50, 80)), (2, three), (2, one)])
    kept = rows(simhash.keep_one(docs), ["doc_id", "text"])
    assert kept == sorted([(1, one), (1, two), (2, three), (None, bf.prose(50, 80))], key=repr)
    clean = rows(decontam.drop_contaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string")), ["doc_id", "text"])
    assert clean == sorted(((i, t) for i, t in pairs(docs) if t != three), key=repr)


# -- decontamination --------------------------------------------------------

ITEMS = [(1, bf.ITEM), (2, "short item here"), (2, bf.ITEM), (3, ""), (4, None), (None, bf.ITEM), (5, "!!"), (10, bf.ITEM + " omega " + bf.prose(12, 8))]


def test_contamination(spark, ready, edge):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows(decontam.contamination(edge, items).drop("n_near_items"), ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    assert got == sorted(((i, *bf.contamination(t, ITEMS)) for i, t in pairs(edge)), key=repr)
    assert sum(r[-1] for r in got) >= 3
    kept = decontam.drop_contaminated(edge, items)
    assert kept.columns == edge.columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({12, 13, 14})


def test_contamination_over_broadcast_bounds(spark, ready, edge, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = rows(decontam.contamination(edge, items), ["doc_id", "n_hit", "items_sha256", "n_near_items"])
    monkeypatch.setattr(decontam, "MAX_BROADCAST_BYTES", 0)
    assert rows(decontam.contamination(edge, items), ["doc_id", "n_hit", "items_sha256", "n_near_items"]) == want


def test_proximity(spark, ready, frame):
    words = bf.ITEM.split()
    moved = " ".join(words[:5] + ["inserted"] + words[5:])
    got = {r["doc_id"]: r for r in decontam.contamination(frame([(1, moved), (2, bf.ITEM), (3, "alpha beta " + bf.prose(30))]),
                                                          spark.createDataFrame([(1, " ".join(words[:10]))], "item_id long, text string")).collect()}
    assert (got[1]["contaminated"], got[1]["n_near_items"]) == (False, 1)
    assert (got[2]["contaminated"], got[2]["n_near_items"]) == (True, 0)
    assert (got[3]["contaminated"], got[3]["n_near_items"]) == (False, 0)


def test_proximity_with_the_rarest_words_changed(spark, ready, frame):
    words = bf.ITEM.split()[:10]
    items = [(1, " ".join(words))]
    texts = [(100 + i, " ".join(words[j] for j in range(10) if j not in (3, 7))) for i in range(5)]  # words 3 and 7 are the rarest
    for n, gone in enumerate([(3,), (7,), (3, 7), (2, 3, 7)]):
        texts.append((n, " ".join("edited" if j in gone else w for j, w in enumerate(words))))
    texts += [(10, " ".join(words[3:4] + ["seldom"] + words[7:8]))]
    got = {r["doc_id"]: r for r in decontam.contamination(frame(texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [got[n]["n_near_items"] for n in range(4)] == [1, 1, 1, 0] and got[10]["n_near_items"] == 0
    assert not any(r["contaminated"] for r in got.values())


@pytest.mark.parametrize("seed", range(3))
def test_proximity_against_every_start(spark, ready, frame, seed):
    rng = np.random.default_rng(seed)
    draw = lambda n: [f"w{i}" for i in rng.integers(0, 14, n)]
    items = [(i, draw(int(rng.integers(1, 14)))) for i in range(12)]
    texts = [(i, draw(int(rng.integers(0, 40)))) for i in range(25)]
    want = {}
    for t, w in texts:
        near, exact = set(), set()
        for i, v in items:
            n = min(10, len(v))
            for g in (v[j:j + n] for j in range(len(v) - n + 1)):
                for s in range(-14, len(w) + 3):
                    close = sum(any(0 <= s + k + d < len(w) and w[s + k + d] == x for d in range(-2, 3)) for k, x in enumerate(g))
                    near |= {i} if close >= math.ceil(0.8 * n) else set()
                    exact |= {i} if s >= 0 and w[s:s + n] == g else set()
        want[t] = (len(exact), len(near - exact))
    got = decontam.contamination(frame([(t, " ".join(w)) for t, w in texts]),
                                 spark.createDataFrame([(i, " ".join(v)) for i, v in items], "item_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_items"], r["n_near_items"]) for r in got} == want
    assert any(n for _, n in want.values())


def test_doubled_first_word_is_no_match_before_the_segment(spark, ready, frame):
    words = bf.ITEM.split()[:9]
    item = " ".join([words[0], *words])
    text = " ".join([*words, words[0], *[w + "x" for w in words], "other"])  # begins at the second of the doubled words
    other = " ".join([w + "x" for w in words] + ["other"])
    docs, items = frame([(1, text)]).coalesce(1), [(1, item), (2, other)]
    got = rows(decontam.contamination(docs, spark.createDataFrame(items, "item_id long, text string")),
               ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    assert got == [(1, *bf.contamination(text, items))]


# -- licences ---------------------------------------------------------------

def test_licences_on_edge_rows(edge):
    got = {r["doc_id"]: r for r in licenses.scan(edge).collect()}
    for i, t in bf.edge_texts():
        assert got[i]["n_words"] == len(bf.piece_words(t))
    r = got[15]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == (3, 3, 7, "mit", "mit", 1.0)
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["labels"], got[0]["score"]) == (0, None, "", 0.0)


def test_licence_notices_and_key_phrases(frame):
    texts = [t for forms in licenses.TEMPLATES.values() for t, _ in forms]
    labels = [x for x, forms in licenses.TEMPLATES.items() for _ in forms]
    broken = "Licensed under CC and BY NC 4.0."  # the words, not the phrase
    docs = [(k, f"{bf.prose(30, k)} {t} {bf.prose(9, k)}") for k, t in enumerate(texts)] + [(99, broken), (100, "K mit licensK license mit")]
    got = {r["doc_id"]: r for r in licenses.scan(frame(docs)).collect()}
    for k, label in enumerate(labels):
        assert label in got[k]["labels"].split(","), texts[k]
    assert got[99]["labels"] == "" and got[100]["n_base"] == 0


# -- mixing -----------------------------------------------------------------

@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_schedule_stays_within_one_block(shares):
    total, out = sum(shares), mixing.period_schedule(shares)
    assert sorted(s for *_, s in out) == list(range(total))
    done = [0] * len(shares)
    for c, k, release, due, slot in out:
        assert done[c] == k and release <= slot < due
        done[c] += 1
        assert all(abs(d * total - a * (slot + 1)) < total for d, a in zip(done, shares))


def test_schedule_of_documents(edge):
    shares, other, size = {"a": 3, "b": 1}, 2, 64
    got = mixing.schedule(edge, shares, other, size).collect()
    data = [(r["doc_id"], r["source"], len(r["text"] or "")) for r in edge.collect()]
    assert sorted(((r["doc_id"], r["source"], r["size"]) for r in got), key=repr) == sorted(data, key=repr)
    table = {(c, k): (r, d, s) for c, k, r, d, s in mixing.period_schedule([3, 1, 2])}
    for c, name in enumerate(("a", "b", None)):
        own = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r) for r in got if r["source"] == name), key=lambda x: x[:3])
        before = 0
        for _, _, n, r in own:
            assert r["before"] == before and r["block"] == before // size
            a, k = (3, 1, 2)[c], r["block"]
            want = tuple(x + (k // a) * 6 for x in table[(c, k % a)])
            assert (r["release"], r["deadline"], r["slot"]) == want
            before += n


def test_mixed_keeps_rows_in_order(edge):
    clash = edge.withColumnsRenamed({"slot": "mix_slot", "block": "row_index", "before": "__mix_slot"})
    out = mixing.mixed(clash, {"a": 1}, 1, 64)
    assert out.columns == clash.columns
    got = [(r["doc_id"], r["source"], r["text"]) for r in out.collect()]  # partitions in order
    assert sorted(got, key=repr) == rows(edge, ["doc_id", "source", "text"])
    slot = {(c, k): s for c, k, _, _, s in mixing.period_schedule([1, 1])}
    before, places = [0, 0], []
    for i, s, t in sorted(got, key=lambda r: (r[1] != "a", r[0] is not None, r[0] or 0, len(r[2] or ""))):
        c = int(s != "a")
        places.append((slot[(c, 0)] + before[c] // 64 * 2, before[c], i, len(t or "")))
        before[c] += len(t or "")
    want = [(i, n) for _, _, i, n in sorted(places, key=lambda p: (p[0], p[1], p[2] is not None, p[2] or 0))]
    assert sorted(want[:5], key=repr) == sorted(((i, len(t or "")) for i, _, t in got[:5]), key=repr)
    assert [i for i, n in want if n] == [i for i, _, t in got if t]


# -- token ids --------------------------------------------------------------

def encode(text):
    from tokenizers import Tokenizer

    tok = encode.__dict__.setdefault("tok", Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")))
    return tok.encode(text or "", add_special_tokens=False).ids + [1]


@given(st.text(max_size=40) | st.text(st.sampled_from("aB's 1!é́İßK漢\x85\x1c\n\t’ﬁ٣ſ<|endoftext|>"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_word_memory_encodes_like_the_library(text):
    enc = tokenids.encoder(tokenizer_file("word_bpe_49k.json"))
    assert enc.by_word
    for raw in enc.encode_batch(pa.array([text, "and " + text])):
        assert np.frombuffer(raw, enc.dtype).tolist() + [1] == encode(text)
        text = "and " + text


@given(st.sets(st.integers(-2 ** 63, 2 ** 63 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_perfect_hash_is_minimal(keys):
    k = np.array(sorted(keys), np.int64).view(np.uint64)
    slots = tokenids.mph_slots(k, *tokenids.mph_build(k))
    assert sorted(slots.tolist()) == list(range(len(k)))


@pytest.mark.parametrize("shard", [1 << 20, 100])
def test_token_store_round_trip(spark, edge, monkeypatch, shard):
    monkeypatch.setattr(tokenids, "SHARD_IDS", shard)
    store = tokenids.write(edge, tokenizer_file("word_bpe_49k.json"))
    data = sorted(bf.edge_texts(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, {}
    for i, t in data:
        ids = encode(t)
        if i is not None and i not in want:
            want[i] = (start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
    everyone = tokenids.fetch(store, tokenids.all_keys(edge), occurrence_col="occurrence").collect()
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in everyone), key=repr) == sorted(((i, np.array(encode(t), "<u4").tobytes()) for i, t in data), key=repr)
    assert sorted(r["start"] for r in everyone) == np.cumsum([0] + [len(encode(t)) for _, t in data])[:-1].tolist()
    keys = spark.createDataFrame([(i,) for i in [*want, 777, None, 5]], "doc_id long")
    got = tokenids.fetch(store, keys).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], bytes(r["ids"])) for r in got} == want
    assert len(got) == len(want) + 1  # the repeated key twice, the unknown and NULL keys not
    raw = b"".join(bytes(r["payload"]) for r in store.payload.orderBy("shard").collect())
    assert np.frombuffer(raw, "<u2").tolist() == [x for _, t in data for x in encode(t)]


# -- language model ---------------------------------------------------------

def test_unigram_base(edge):
    got = rows(pitman_yor.score_documents(edge), ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"])
    texts = pairs(edge)
    want = sorted(((i, *r) for (i, _), r in zip(texts, bf.unigram(texts))), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_held_out_perplexity_beats_the_base(spark, ready):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = pitman_yor.score_documents(docs).toPandas()
    held = out[out.held_out]
    assert held.score.sum() > held.base_score.sum() + 0.6 * held.n_tokens.sum()
    assert 10 ** -(held.score.sum() / held.n_tokens.sum()) < 3_000
    again = pitman_yor.score_documents(docs.repartition(3)).toPandas()  # other blocks, same counts
    both = out.merge(again, on="doc_id")
    assert np.allclose(both.score_x, both.score_y, rtol=1e-9)


def test_occurrences_of_a_hot_word_are_spread(spark, ready, frame, monkeypatch):
    docs = frame([(i, "the " * 40 + bf.prose(6, i)) for i in range(60)]).repartition(12)
    want = pitman_yor.score_documents(docs).toPandas()
    monkeypatch.setattr(pitman_yor, "GROUP_BYTES", 500)
    entries = pitman_yor.count_entries(docs, "false", "doc_id", "text", 4)
    model = pitman_yor.train(entries)
    asked, tables = pitman_yor._scoring_groups(entries, pitman_yor.ready(model), model.counts)
    sizes = asked.groupBy("bucket", "salt").count().toPandas()
    hot = (lm_hash("the") & ((1 << 40) - 1)) % 4
    assert asked.count() == entries.count()
    assert sizes[sizes.bucket == hot]["count"].max() <= 0.6 * sizes[sizes.bucket == hot]["count"].sum()
    assert tables.groupBy("bucket", "salt").count().where("count > 1").count() == 0
    got = pitman_yor.score_documents(docs).toPandas()
    both = want.merge(got, on="doc_id")
    assert len(both) == 60 and np.allclose(both.score_x, both.score_y, rtol=1e-9) and (both.n_known_x == both.n_known_y).all()


def bigrams(texts):
    for text in texts:
        words = (text or "").lower().split()
        yield from zip(["", *words], [*words, " end "])


def lm_hash(word):
    return xxhash.xxh64_intdigest(word.encode()) if word else 0


def test_restaurants_are_the_real_words_before(spark, ready, frame):
    texts = [bf.prose(30 + i, i) for i in range(40)] + [None, "", "lone", "Lone lone lone"]
    entries = pitman_yor.count_entries(frame(list(enumerate(texts))), "false", "doc_id", "text", 3)
    model = pitman_yor.train(entries)
    want = collections.Counter(bigrams(texts))
    cut = (1 << 40) - 1
    got = {}
    for row in model.counts.collect():
        n_ctx = np.frombuffer(row["n_ctx"], "<u4")
        for w, u, c in zip(np.repeat(np.frombuffer(row["words"], "<u8"), n_ctx), pitman_yor.unpack(row["ctx"]), np.frombuffer(row["count"], "<i8")):
            got[int(u), int(w)] = int(c)
    assert got == {(lm_hash(u) & cut, lm_hash(w)): c for (u, w), c in want.items()}
    seated = collections.Counter()
    for row in model.state.collect():
        dishes = pitman_yor._dishes(row.asDict(), model.settings)
        ends = np.append(dishes.start[1:], len(dishes.sizes))
        for i, (a, b) in enumerate(zip(dishes.start, ends)):  # the tables seat all customers, empty ones last
            sizes, t = dishes.sizes[a:b], dishes.tables[i]
            assert sizes.sum() == dishes.count[i] and (sizes[:t] > 0).all() and (sizes[t:] == 0).all()
        mean = np.frombuffer(row["sum"], "<f8") / (model.settings.samples * model.settings.passes)
        assert (mean >= 1).all() and (mean <= dishes.count).all()
        for u, t in zip(dishes.ctx.tolist(), mean):
            seated[u] += t
    for (u, _), c in want.items():
        seated[lm_hash(u) & cut] += c == 1
    contexts = {r["ctx"]: (r["tables"], r["customers"]) for r in model.contexts.collect()}
    assert len(contexts) == len({u for u, _ in want})
    for u, (tables, customers) in contexts.items():
        assert tables == pytest.approx(seated[u])
        assert customers == sum(c for (x, _), c in want.items() if lm_hash(x) & cut == u)


def test_probabilities_add_up_and_give_the_scores(spark, ready, frame):
    texts = [bf.prose(30 + i, i) for i in range(40)] + [None, "lone", "Lone lone lone unheard-of"]
    docs = frame([(i, t) for i, t in enumerate(texts)])
    s = pitman_yor.Settings(burn_in=1, samples=1)
    held = "doc_id = 42"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # seeds go by bucket
    model = pitman_yor.train(pitman_yor.count_entries(docs, held, "doc_id", "text", buckets, training=True), s)
    contexts = {r["ctx"]: (r["tables"], r["customers"]) for r in model.contexts.collect()}
    root, bonus = {}, {}
    for row in pitman_yor.ready(model).collect():
        words, n_ctx = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["n_ctx"], "<u4")
        root |= dict(zip(words.tolist(), np.frombuffer(row["root"], "<f8")))
        bonus |= dict(zip(zip(np.repeat(words, n_ctx).tolist(), pitman_yor.unpack(row["ctx"]).tolist()), np.frombuffer(row["bonus"], "<f4").astype(float)))
    unknown = s.root / (model.n_root + s.root * (model.n_words + 1))
    assert sum(root.values()) + unknown == pytest.approx(1)

    def p(u, w):
        tables, customers = contexts.get(u, (0, 0))
        return root.get(w, unknown) * (1 + bonus.get((w, u), 0.0)) * (s.strength + s.discount * tables) / (s.strength + customers)

    for u in contexts:
        assert sum(p(u, w) for w in [*root, -1]) == pytest.approx(1, rel=1e-5)
    got = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(docs, held=held, settings=s).collect()}
    for i, text in enumerate(texts):
        want = sum(math.log10(p(lm_hash(u) & ((1 << 40) - 1), lm_hash(w))) for u, w in bigrams([text]))
        assert got[i] == pytest.approx(want, rel=1e-5)


def test_sampler_draws_the_exact_posterior():
    """Tables of one dish given all others: generalised Stirling numbers times
    the seating weights of the restaurant and the root."""
    s = pitman_yor.Settings(discount=0.6, strength=0.8, root=0.5, moves=6, passes=20)
    c, others, rest, n_root, n_words, n = 6, 3.0, 2, 6, 3, 20_000
    stirling = np.zeros((c + 1, c + 2))
    stirling[0, 0] = 1
    for m in range(c):
        for t in range(1, m + 2):
            stirling[m + 1, t] = stirling[m, t - 1] + (m - s.discount * t) * stirling[m, t]
    want = np.array([stirling[c, t] * np.prod([(s.strength + s.discount * (others + i)) * (rest + i + s.root) / (n_root + i + s.root * (n_words + 1))
                                               for i in range(t)]) for t in range(1, c + 1)])
    dishes = pitman_yor.Dishes(np.arange(n), np.zeros(n, np.uint64), np.full(n, c), np.full(n, rest), s)
    rng = np.random.default_rng(5)
    for _ in range(s.passes):
        dishes.sweep(np.full(n, others), n_root + dishes.tables, n_words, rng)
    got = np.bincount(dishes.tables, minlength=c + 1)[1:] / n
    assert np.abs(got - want / want.sum()).max() < 0.015


@pytest.mark.parametrize("c, others, rest, n_root", [(40, 30, 50, 400), (1000, 300, 40, 3000), (1500, 200, 60, 2000), (1500, 90_000, 3_000, 90_000)])
def test_one_sweep_seats_all_customers_of_a_large_dish(c, others, rest, n_root):
    """From one table, a single sweep draws from the exact posterior."""
    s, n, n_words = pitman_yor.Settings(), 2_000, 9
    log_s = np.full(c + 1, -np.inf)  # generalised Stirling numbers
    log_s[0] = 0
    for m in range(c):
        log_s[1:m + 2] = np.logaddexp(log_s[:m + 1], np.log(np.maximum(m - s.discount * np.arange(1, m + 2), 1e-300)) + log_s[1:m + 2])
        log_s[0] = -np.inf
    i = np.arange(c)
    weight = log_s[1:] + np.cumsum(np.log((s.strength + s.discount * (others + i)) * (rest + i + s.root) / (n_root + i + s.root * (n_words + 1))))
    want = np.exp(weight - weight.max()) / np.exp(weight - weight.max()).sum()
    mean, var = want @ (i + 1), want @ (i + 1) ** 2 - (want @ (i + 1)) ** 2
    dishes = pitman_yor.Dishes(np.arange(n), np.zeros(n, np.uint64), np.full(n, c), np.full(n, rest), s)
    dishes.sweep(np.full(n, float(others)), n_root + dishes.tables, n_words, np.random.default_rng(7))
    assert mean > 5.5 and abs(dishes.tables.mean() - mean) < 4 * math.sqrt(var / n)
    assert abs(dishes.tables.var() / var - 1) < 0.2
    got = np.cumsum(np.bincount(dishes.tables, minlength=c + 1)[1:]) / n
    assert np.abs(got - np.cumsum(want)).max() < 1.95 / math.sqrt(n)  # Kolmogorov-Smirnov, 0.1 %


def test_chances_above_the_recursion():
    for d in (0.3, 0.7, 0.9):
        t = np.arange(1, 1025)
        sums = table_counts.log_stirling(d)[1024, 1:] - math.lgamma(1025) + [math.lgamma(x + 1) for x in t] + t * math.log(d)
        assert np.abs(table_counts.log_chance(np.full(1024, 1024), t, d) - sums).max() < 1e-4
    one = math.lgamma(10**6 - 0.7) - math.lgamma(10**6 + 1) + math.log(0.7) - math.lgamma(0.3)  # of one variable
    assert table_counts.log_chance(np.array([10**6]), np.array([1]), 0.7)[0] == pytest.approx(one, abs=1e-6)


def test_model_tables_are_gone_before_the_entries_travel(spark, ready, frame, monkeypatch):
    stored = []

    def spy(df, name, **options):
        stored.append((name, materialize(df, name, **options)))
        files[name] = files.get(name, []) + stored[-1][1].inputFiles()
        return stored[-1][1]

    files, materialize = {}, pitman_yor.materialize
    monkeypatch.setattr(pitman_yor, "materialize", spy)
    out = pitman_yor.score_documents(frame([(i, bf.prose(20, i)) for i in range(30)]))
    left = {name for name, paths in files.items() if any(os.path.exists(p.removeprefix("file:")) for p in paths)}
    assert len(stored) >= 6 and left == {"lm-scoring"}
    assert out.count() == 30 and out.where("score < 0").count() == 30  # also when read twice


# -- empty tables -----------------------------------------------------------

def test_empty_tables(spark, ready, frame):
    none = frame([]).limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    assert quality.measure(none).count() == 0 and quality.keep_good(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    assert decontam.contamination(none, items).count() == 0
    assert decontam.contamination(frame([(1, bf.ITEM)]), items).collect()[0]["contaminated"] is False
    assert licenses.scan(none).count() == 0
    assert mixing.schedule(none, {"a": 1}, 1, 8).count() == 0 and mixing.mixed(none, {"a": 1}, 1, 8).count() == 0
    assert tokenids.fetch(tokenids.write(none, tokenizer_file("word_bpe_49k.json")), none.select("doc_id")).count() == 0
    assert pitman_yor.score_documents(none).count() == 0
    held = pitman_yor.score_documents(frame([(1, "a b")]), held="true").collect()[0]  # nothing to train on
    assert held["n_known"] == 0 and held["train_tokens"] == 0


def test_pipeline_against_brute_force(spark, ready):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    items = [tuple(r) for r in pd.read_parquet(f"{SF}/benchmark.parquet")[["item_id", "text"]].values]
    docs = docs[[bf.keeps(t) for t in docs.text]]
    group = bf.components([(i, bf.fingerprint(t)) for i, t in zip(docs.doc_id, docs.text)])
    docs = docs[[group[i] == i for i in docs.doc_id]]
    docs = docs[[not bf.contamination(t, items)[-1] for t in docs.text]]
    from strata.llm.queries import MIX_BLOCK, MIX_OTHER, MIX_SHARES

    names = sorted(MIX_SHARES)
    weights = [MIX_SHARES[n] for n in names] + [MIX_OTHER]
    slot = {(c, k): s for c, k, _, _, s in mixing.period_schedule(weights)}
    before, place = [0] * len(weights), {}
    for i, t, s in zip(docs.doc_id, docs.text, docs.source):
        c = names.index(s) if s in MIX_SHARES else len(names)
        block = before[c] // MIX_BLOCK
        place[i] = (slot[(c, block % weights[c])] + block // weights[c] * sum(weights), before[c], i)
        before[c] += len(t)
    text, start, want = dict(zip(docs.doc_id, docs.text)), 0, []
    for i in sorted(place, key=place.get):
        ids = encode(text[i])
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got.values.tolist()] == sorted(want)
