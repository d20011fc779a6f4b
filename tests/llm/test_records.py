"""Rollups, revisits and tool calls against brute force, and every query of
the subpackage against its SQL."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import chat, queries, rollup, warc
from strata.sources.pointer import list_names, publish_once, read_text
from strata.tables import TABLES

SF = "/root/testdata/sf0.001"


# -- rollups ----------------------------------------------------------------

CHANGE = ("kind string, source string, lang string, tokenizer string, n_tokens long, old_source string, old_lang string, "
          "old_tokenizer string, old_n_tokens long, d_docs string")


def feed(seed, n):
    rng = random.Random(seed)
    key = lambda: (rng.choice(["a", "a", "a", "b", None]), rng.choice(["en", None]), rng.choice(["t1", "t2"]))
    count = lambda: rng.choice([None, 0, 5, 10 ** 12])
    return [(rng.choice(["insert", "Delete ", "revise", "other", None]), *key(), count(), *key(), count(), "x") for _ in range(n)]


def brute(batches):
    out = defaultdict(lambda: [0, 0])
    for rows in batches:
        for kind, s, la, t, n, os_, ol, ot, on, _ in rows:
            kind = (kind or "").strip().lower()
            for sign, key, value in ((1, (s, la, t), n), (-1, (os_, ol, ot), on)):
                if kind == "revise" or (sign == 1 and kind in ("insert", "delete")):
                    f = -1 if kind == "delete" else sign
                    out[key][0] += f
                    out[key][1] += f * (value or 0)
    return {k: tuple(v) for k, v in out.items() if tuple(v) != (0, 0)}


def test_rollup(spark, ready, tmp):
    r = rollup.Rollup(spark, tmp + "/rollup")
    assert r.totals().count() == 0
    done = []

    def check():
        assert {(x["source"], x["lang"], x["tokenizer"]): (x["n_docs"], x["n_tokens"]) for x in r.totals().collect()} == brute(done)

    for k, n in enumerate((40, 0, 60)):
        rows = feed(k, n)
        df = spark.createDataFrame(rows, CHANGE)
        assert r.apply(f"b{k}", df)
        done.append(rows)
        check()
        assert not r.apply(f"b{k}", spark.createDataFrame(feed(99, 5), CHANGE))  # the id counts, not the rows
        check()
    assert r.compact()
    check()
    # a crash before the commit file: the deltas of the try stay unnamed
    rollup._sum(rollup.signed(spark.createDataFrame(feed(7, 9), CHANGE))).write.parquet(f"{r.root}/deltas/half-done")
    check()
    rows = feed(8, 30)
    assert r.apply("b8", spark.createDataFrame(rows, CHANGE))
    done.append(rows)
    check()
    with pytest.raises(ValueError):
        r.apply("a/b", spark.createDataFrame([], CHANGE))


def test_publish_once(spark, tmp):
    assert publish_once(spark, f"{tmp}/c/x", "one") and not publish_once(spark, f"{tmp}/c/x", "two")
    assert read_text(spark, f"{tmp}/c/x") == "one" and read_text(spark, f"{tmp}/c/y") is None
    assert list_names(spark, f"{tmp}/c") == ["x"]


# -- revisits ---------------------------------------------------------------

@pytest.mark.parametrize("url,want", [
    ("HTTP://User@WWW.Example.COM:80/A/b/?utm_source=x&b=2&a=1#frag", "example.com/A/b?a=1&b=2"),
    ("https://www2.example.com:443/?ref=1", "example.com?ref=1"), ("http://e.org:443/", "e.org:443"), ("https://e.org:80", "e.org:80"), ("example.com", "example.com"),
    ("http://e.org/%7eme/a%2fb/%zz/./c/../d/../../x%", "e.org/~me/a%2Fb/x%"), ("http://e.org/../a/..", "e.org"), ("http://e.org/a?q=%41%26", "e.org/a?q=A%26"), (None, None), ("  ", None), ("#x", None),
    ("https://m.example.org/p.html?page=2&REF=x", "m.example.org/p.html?REF=x&page=2"), ("http://e.org/a?b=1&&b=1", "e.org/a?b=1&b=1"),
])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u")).alias("c"))
    assert df.head()["c"] == want


def test_header_names_that_differ_in_case(spark):
    h = F.map_from_arrays(F.array(F.lit("ETag"), F.lit("X"), F.lit("etag ")), F.array(F.lit("1"), F.lit(None), F.lit("2")))
    assert spark.range(1).select(warc.plain_headers(h).alias("h")).head()["h"] == {"etag": "2", "x": None}


RECORD = "record_id long, kind string, url string, ts timestamp, headers map<string,string>, digest string, status string, before long"


def test_revisits_of_hot_urls(spark, ready):
    rng = random.Random(3)
    day = datetime(2024, 1, 1)
    rows = []
    for i in range(600):  # half of all records on one URL, many equal times
        url = "http://hot.org/x" if i % 2 else rng.choice(["http://a.org/", "https://www.a.org", "http://b.org/p?z=1&y=2", None])
        kind = rng.choice(["response", "revisit", "revisit", "warcinfo", None])
        headers = rng.choice([None, {"ETag": '"1"'}, {"etag": 'W/"1"', "Date": f"d{i}", "Content-Type": "x"}, {"ETAG ": '"2"'},
                              {"Last-Modified": "m1"}, {"Last-Modified": "m2", "Expires": None}])
        rows.append((rng.choice([i, i, i, None]) if i > 20 else i, kind, url, rng.choice([day + timedelta(hours=rng.randrange(40)), day, None]),
                     headers, rng.choice([None, "d1", "d2"]), "x", 1))
    rows += rows[30:60]  # repeated rows
    canon = {"http://hot.org/x": "hot.org/x", "http://a.org/": "a.org", "https://www.a.org": "a.org", "http://b.org/p?z=1&y=2": "b.org/p?y=2&z=1", None: None}

    def plain(h):
        out = {}
        for k, v in (h or {}).items():
            out[k.strip().lower()] = v
        return out

    full = {}
    for r in rows:
        if r[1] == "response" and r[0] is not None and r[3] is not None and r[2]:
            full.setdefault(canon[r[2]], set()).add((r[3], r[0]))
    stored = {r[0]: r for r in rows if r[1] == "response" and r[0] is not None}
    want = []
    for r in rows:
        if r[1] != "revisit" or r[0] is None:
            continue
        url, mine = canon[r[2]], plain(r[4])
        found = max((x for x in full.get(url, ()) if r[3] is not None and x[0] < r[3]), default=None)
        if url is None or found is None:
            want.append((r[0], url, "no_url" if url is None else "no_response", None, None, None))
            continue
        theirs, tag = plain(stored[found[1]][4]), lambda h: (h.get("etag") or "").removeprefix("W/") or None
        checks = []
        if tag(mine) and tag(theirs):
            checks.append(tag(mine) == tag(theirs))
        elif mine.get("last-modified") and theirs.get("last-modified"):
            checks.append(mine["last-modified"] == theirs["last-modified"])
        if r[5] and stored[found[1]][5]:
            checks.append(r[5] == stored[found[1]][5])
        status = "unverified" if not checks else "resolved" if all(checks) else "mismatch"
        ok = status == "resolved"
        merged = {**theirs, **{k: v for k, v in mine.items() if k in warc.PERMITTED and v is not None}}
        want.append((r[0], url, status, found[1], merged if ok else None, stored[found[1]][5] if ok else None))
    got = warc.resolve_revisits(spark.createDataFrame(rows, RECORD).repartition(6)).collect()
    assert sorted(map(repr, ((g["record_id"], g["url"], g["status"], g["refers_to"], g["headers"] and dict(sorted(g["headers"].items())), g["digest"]) for g in got))) \
        == sorted(map(repr, ((*w[:4], w[4] and dict(sorted(w[4].items())), w[5]) for w in want)))
    assert {w[2] for w in want} == {"no_url", "no_response", "resolved", "mismatch", "unverified"}
    assert warc.resolve_revisits(spark.createDataFrame([], RECORD)).count() == 0


# -- tool calls -------------------------------------------------------------

TOOLS = {"add": [chat.Argument("a", "integer", minimum=0), chat.Argument("b", "number", required=False, maximum=10)],
         "say": [chat.Argument("text", "string", choices=("hi", "ho")), chat.Argument("loud", "boolean", required=False)]}
CALL = "conv_id long, turn long, call_id string, name string, arguments string, after string, level string, n long"
RESULT = "conv_id long, turn long, call_id string, content string, status string"


def call(conv, turn, cid, name="add", args='{"a": 1}', after=None):
    return (conv, turn, cid, name, args, after, "x", 0)


def test_tool_calls(spark, ready):
    calls = [
        call(1, 1, "x", args='{ "b" : 2.50, "a" : 1 }'), call(1, 3, "y", after="x"), call(1, 2, "z", after="y"), call(2, 1, "x", after="gone"),
        call(3, 1, "p", after="q"), call(3, 2, "q", after="p"), call(3, 3, "r", after="p"), call(4, 1, "e"), call(4, 1, "e"),
        call(5, 1, None), call(None, 1, "x"), call(6, 1, "j", args="{broken"), call(6, 2, "k", args=None), call(6, 3, "l", args="[1]"),
        call(6, 4, "m", name="none"), call(6, 5, "n", name=None), call(6, 6, "o", args='{"a": -1, "b": 11, "c": 0}'), call(6, 7, "s", args='{"a": "1"}'),
        call(6, 8, "t", name="say", args='{"text": "hey", "loud": 1}'), call(6, 9, "u", name="say", args='{"text": null}'), call(6, 10, "v", name="say", args="{}"),
        call(7, 5, "late"),
    ]
    results = [(1, 2, "x", "b"), (1, 2, "x", "a"), (1, 9, "y", 'q"\n'), (4, 2, "e", None), (7, 5, "late", "x"), (8, 1, "orphan", "x"), (None, 1, "x", "x"), (1, 1, None, "x")]
    cdf = spark.createDataFrame(calls, CALL).repartition(4)
    rdf = spark.createDataFrame([(*r, "x") for r in results], RESULT).repartition(3)
    out = chat.link_calls(cdf, rdf, TOOLS).collect()
    got = {(r["conv_id"], r["turn"], r["call_id"]): r for r in out}
    assert len(out) == len(calls)
    level = {k: r["level"] for k, r in got.items()}
    assert [level[k] for k in ((1, 1, "x"), (1, 3, "y"), (1, 2, "z"), (2, 1, "x"), (5, 1, None), (None, 1, "x"))] == [0, 1, 2, 0, 0, 0]
    assert [got[k]["status"] for k in ((3, 1, "p"), (3, 2, "q"), (3, 3, "r"))] == ["cycle"] * 3
    assert (got[(1, 1, "x")]["n_results"], got[(1, 1, "x")]["status"]) == (2, "linked")
    assert got[(1, 1, "x")]["json"] == '{"arguments":{"a":1,"b":2.5},"call_id":"x","conv_id":1,"level":0,"name":"add","result":"a","status":"linked"}'
    assert json.loads(got[(1, 3, "y")]["json"])["result"] == 'q"\n'
    assert [got[k]["status"] for k in ((1, 2, "z"), (4, 1, "e"), (7, 5, "late"), (5, 1, None))] == ["unanswered", "linked", "early", "unanswered"]
    problems = {k[2]: r["problems"] for k, r in got.items() if k[0] == 6}
    assert problems == {"j": "json", "k": "json", "l": "json", "m": "tool", "n": "tool", "o": "maximum:b,minimum:a,unknown:c", "s": "type:a",
                        "t": "choice:text,type:loud", "u": "missing:text", "v": "missing:text"}
    assert sorted((r["conv_id"], r["call_id"]) for r in chat.orphan_results(cdf, rdf).where("conv_id is not null and call_id is not null").collect()) == [(8, "orphan")]
    none = spark.createDataFrame([], CALL)
    assert chat.link_calls(none, rdf, TOOLS).count() == 0
    assert {r["status"] for r in chat.link_calls(cdf, spark.createDataFrame([], RESULT), TOOLS).collect()} == {"invalid", "cycle", "unanswered"}


def test_long_chain_needs_few_rounds(spark, ready):
    n = 300
    calls = spark.createDataFrame([call(1, i, f"c{i}", after=f"c{i - 1}" if i else None) for i in range(n)], CALL)
    got = {r["call_id"]: r["level"] for r in chat.levels(calls, max_rounds=10).collect()}
    assert got == {f"c{i}": i for i in range(n)}


def test_native_plans_have_no_python(spark, ready):
    docs = spark.read.parquet(f"{SF}/conversations.parquet")
    plan = chat.link_calls(*queries.tool_turns(docs), queries.CHAT_TOOLS)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


# -- SQL --------------------------------------------------------------------

def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, ready, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries.ORACLE[name])
    names = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(n) for n in names]
    want = sorted((tuple(norm(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == names
    got = sorted((tuple(norm(x) for x in r) for r in df.select(*names).collect()), key=repr)
    assert got == want and got


def test_null_texts_are_copies_of_one_another(spark, ready, frame):
    docs = frame([(1, None), (4, ""), (2, "a b"), (7, None), (5, ""), (3, "a b"), (9, None)])
    got = queries.op1(lambda name: docs).select("source", "tokenizer", "n_docs", "n_tokens").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, "words-1", 1, 0), ("a", "words-1", 1, 0), ("b", "words-1", 1, 2)], key=repr)
