"""URL filters, filter interaction audit and embedding whitening against
brute force, on edge rows and on the given tables."""

import itertools
import math
import random

import brute_llm as bf
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import audit, urlfilter, whitening

SF = "/root/testdata/sf0.001"


def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# -- Bloom cascade ----------------------------------------------------------

@pytest.mark.parametrize("n_listed, n_others", [(0, 50), (1, 0), (1, 3000), (400, 20), (2000, 2000), (30, 30000)])
def test_cascade_is_exact_over_its_universe(n_listed, n_others):
    listed = [f"k{i}".encode() for i in range(n_listed)]
    others = [f"o{i}".encode() for i in range(n_others)]
    cascade = urlfilter.Cascade(*urlfilter.build_levels(listed, others))
    assert all(k in cascade for k in listed)
    assert not any(k in cascade for k in others)


def test_cascade_is_small():
    sizes, _, bits = urlfilter.build_levels([b"k%d" % i for i in range(3000)], [b"o%d" % i for i in range(30000)])
    assert len(sizes) > 2 and sum(sizes) == 8 * len(bits) < 3000 * 14


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.org", "/x", "block"), ("org", "/fr/x", "block"), ("tie.com", "/", "allow"), ("tie.com", "/", "block"), ("com", "/abcd", "allow"),
         ("b.com", "/ab", "block"), ("all.de", "", "block"), ("odd.de", "/", "maybe"), (None, None, "odd")]
URLS = [None, "", "no mark/x", "http://", "http:///p", "https://EXAMPLE.net/en/1?x=/de/", "http://www.example.net/enx", "ftp://net", "http://net/",
        "http://xnet/", "http://a.org/fr/x/y", "http://b.a.org/x#f", "http://tie.com/q", "http://b.com/abcd", "http://sub.ALL.de?x", "http://odd.de/",
        "x://y://z.net/p", "http://example.com/de/" + "é" * 5000, "http://www.spam.io/p", "http://spam.io", "http://thin.io/p?q", "http://thin.io/p/",
        "http://www.example.com.", "http://u@h.net:80/en/"]


def brute_url(url, hosts, pages):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].encode().lower().decode(), rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [(len((h or "") + (p or "")), len(h or ""), v == "block", h or "", p or "", v) for h, p, v in RULES if v in ("block", "allow")
           and (host == (h or "") or host.endswith("." + (h or ""))) and path.startswith(p or "")]
    if fit:
        _, _, _, h, p, v = max(fit)
        return host, path, h + p, v, "rule"
    if any(host == h or host.endswith("." + h) for h in hosts):
        return host, path, None, "block", "host"
    return (host, path, None, "block", "page") if (host, path) in pages else (host, path, None, "allow", "none")


@pytest.mark.parametrize("max_bytes", [urlfilter.MAX_BYTES, 0])
def test_url_verdicts(spark, ready, max_bytes):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           *[T.StructField(c, T.StringType()) for c in ("host", "path", "id", "key", "shard", "rule")]])
    urls = [(i if i % 5 else None, u) for i, u in enumerate(URLS)] + [(7, URLS[5])] * 40
    pages = spark.createDataFrame([(i, u, *["x"] * 6) for i, u in urls], schema).repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    hosts = spark.createDataFrame([("spam.io",), ("spam.io",), (None,)], "host string")
    thin = spark.createDataFrame([("thin.io", "/p"), ("thin.io", None)], "host string, path string")
    got = rows(urlfilter.filter_urls(pages, rules, hosts, thin, max_bytes=max_bytes), ["page_id", "host", "path", "rule", "verdict", "reason"])
    assert got == sorted(((i, *brute_url(u, {"spam.io"}, {("thin.io", "/p")})) for i, u in urls), key=repr)
    assert urlfilter.filter_urls(pages.limit(0), rules, max_bytes=max_bytes).count() == 0


def test_url_filter_sends_no_join_below_the_bound(spark, ready):
    pages = spark.createDataFrame([(1, URLS[5])], "page_id long, url string")
    plan = urlfilter.filter_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan


# -- audit ------------------------------------------------------------------

def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    rows_ = []
    for i, t, lang in docs:
        t = t or ""
        w = bf.space_words(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and first[t] < i}
        rows_.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows_}:
        mine = [r for r in rows_ if r[0] == part]
        removed = {}
        cells = []
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                here = [r for r in mine if f in r[1] and not r[1] & set(order[:step - 1])]
                removed[f] = removed.get(f, 0) + len(here)
                cells.append((part, order, step, sum(not r[1] & set(order[:step]) for r in mine), len(here),
                              sum(f in r[1] and bool(r[1] & set(order[:step - 1])) for r in mine), sum(r[1] == {f} for r in mine),
                              sum(r[2] for r in here), sum(r[3] for r in here), f))
        out += [(*c[:-1], removed[c[-1]]) for c in cells]
    return sorted(out, key=repr)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_on_edge_rows(spark, ready, edge, monkeypatch):
    docs = edge.withColumn("lang", F.when(F.pmod(F.hash("doc_id"), F.lit(3)) > 0, "en"))
    labels = [(5, 1, 0), (6, 1, 1), (6, 0, None), (9, None, 1), (None, 1, 1), (77, 1, 1), (7, 1, 0)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = brute_audit([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], [x for x in labels if x[0] is not None])
    assert rows(audit.audit(docs, frame), AUDIT) == want
    monkeypatch.setattr(audit, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(audit, "TASK_HASHES", 2)
    assert rows(audit.audit(docs, frame), AUDIT) == want
    assert audit.audit(docs.limit(0), frame).count() == 0


def test_sketch_clears_only_unique_texts(spark, ready, monkeypatch):
    monkeypatch.setattr(audit, "SLICE_DOCS", (64, 512))
    rng = random.Random(3)
    hashes = [rng.getrandbits(64) - 2 ** 63 for _ in range(5000)]
    twice = hashes[:40]
    found = {r["h"] for r in audit.possible_repeats(spark.createDataFrame([(h,) for h in hashes + twice + [hashes[0]] * 3000], "h long").repartition(7)).collect()}
    assert set(twice) <= found and len(found) < 40 + 0.03 * 5000


# -- whitening --------------------------------------------------------------

def brute_whiten(vectors):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    n, sums = len(x), [sum(int(v) for v in c) for c in x.T]
    y = x - x.mean(axis=0)
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    keep = min(32, int((e > max(e[0], 0) * x.shape[1] * np.finfo(float).eps).sum()))
    dev = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return n, dev, y @ u[:, :keep] / np.sqrt(e[:keep]), e[:keep] / e.sum()


def check_whitened(frame, usable):
    n, dev, z, share = brute_whiten([v for _, v in usable])
    got = whitening.by_component(whitening.whiten(frame)).collect()
    assert len(got) == len(usable) * z.shape[1]
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
        assert r["n"] == n and r["identity_error"] < 1e-4
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-6)
    sign = np.zeros(z.shape[1])
    for (i, _), d, w in zip(usable, dev, z):
        for k in range(z.shape[1]):
            mine = by[i][k + 1]
            assert any(r["deviation"] == d for r in mine)
            if sum(j == i for j, _ in usable) == 1 and abs(w[k]) > 1e-6:
                sign[k] = sign[k] or math.copysign(1, w[k] * mine[0]["whitened"])
                assert mine[0]["whitened"] * sign[k] == pytest.approx(w[k], abs=1e-6)


def test_whitening_of_the_given_table(spark, ready):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    check_whitened(df, [(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_whitening_on_edge_rows(spark, ready):
    rng = np.random.default_rng(1)
    good = [(i, [float(v) for v in rng.normal(size=5) * [3, 2, 1, 1, 0]]) for i in range(60)]  # the last dimension is constant
    same = [(100 + i, good[0][1]) for i in range(300)]
    bad = [(None, None), (1000, []), (1001, [1.0, None, 1.0, 1.0, 1.0]), (1002, [float("nan")] * 5), (1003, [float("inf")] + [0.0] * 4),
           (1004, [1.0] * 4), (1005, [1e300] * 5)]
    usable = good + same + [(5, good[7][1])] + [(None, good[3][1])]
    data = [(i, v, "c", "c", "c") for i, v in usable + bad]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, x string, ids string, z string").repartition(6)
    check_whitened(frame, usable)
    one = whitening.whiten(frame, weighting="one").head()
    assert one["n"] == 60
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.by_component(whitening.whiten(frame.where("vec_id = 3"))).count() == 0  # no variance
    assert whitening.whiten(frame.where("vec_id = 3")).count() == 1


def test_sums_stay_exact_for_large_entries(spark, ready):
    data = [(i, [float(2 ** 52 + i), float(-i)]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    x = [[int(math.floor(64 * c)) + 1_000_000 for c in v] for _, v in data]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((9 * a - s) ** 2 for a, s in zip(row, sums)) for (i, _), row in zip(data, x)}
    assert {r["vec_id"]: r["deviation"] for r in got.collect()} == want
