"""Registered queries opN_<name> of the training-data operators, with their
DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import audit, chat, decontam, licenses, mixing, pitman_yor, quality, rollup, simhash, tokenids, urlfilter, warc, whitening
from strata.llm.common import cut, materialize, prepare, shared_path

# DuckDB: lower-case A-Z only, and the word pattern of digits, letters, non-ASCII
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file on this machine (a parameter of the
    operators; the files are installed on every node, never in this repo)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    """Register ``fn(table) -> DataFrame``; ``table(name)`` reads one of the
    given tables through Spark."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet"))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@query("op6_quality_rules")
def op6(table) -> DataFrame:
    """Repetition measures and verdict of every document."""
    return quality.measure(table("documents"))


@query("op4_simhash")
def op4(table) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(table("documents"))


@query("op5_benchmark_decontamination", f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, CASE WHEN len(w) < 10 THEN w ELSE list_slice(w, i, i + 9) END AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("text")} AS w FROM documents),
dw AS (SELECT rid, i, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT len(g) AS n FROM bw) WHERE len(w) >= n)),
m AS (SELECT DISTINCT rid, i, n, item_id FROM dw JOIN bw USING (g)),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM m) GROUP BY rid),
v AS (SELECT DISTINCT unnest(g) AS word FROM bw),
p AS MATERIALIZED (SELECT rid, pos, word FROM (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d) SEMI JOIN v USING (word)),
tf AS (SELECT word, count(*) AS n FROM p GROUP BY word),
gs AS MATERIALIZED (SELECT row_number() OVER () AS gid, g, len(g) - CAST(ceil(0.8 * len(g)) AS INTEGER) + 1 AS probes FROM (SELECT DISTINCT g FROM bw)),
gw AS MATERIALIZED (SELECT gid, probes, unnest(g) AS word, generate_subscripts(g, 1) AS k, len(g) AS n FROM gs),
pr AS (SELECT gid, word, k FROM (SELECT gid, word, k, probes, row_number() OVER (PARTITION BY gid ORDER BY coalesce(tf.n, 0), k, word) AS r
  FROM gw LEFT JOIN tf USING (word)) WHERE r <= probes),
cand AS (SELECT DISTINCT rid, gid, pos - k + s AS beg FROM pr JOIN p USING (word), range(-2, 3) x(s)),
near AS (SELECT DISTINCT rid, gid FROM (SELECT rid, gid FROM cand JOIN gw USING (gid) JOIN p USING (rid, word)
  WHERE pos BETWEEN beg + k - 2 AND beg + k + 2 GROUP BY rid, gid, beg, n HAVING count(DISTINCT k) >= ceil(0.8 * n))),
around AS (SELECT rid, count(*) AS n_near FROM (SELECT rid, item_id FROM near JOIN gs USING (gid) JOIN bw USING (g)
  EXCEPT SELECT rid, item_id FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN hits USING (rid) LEFT JOIN found USING (rid) LEFT JOIN around USING (rid)""")
def op5(table) -> DataFrame:
    """Benchmark words and items in every document, and items in proximity."""
    return decontam.contamination(table("documents"), table("benchmark"))


@query("op5_benchmark_proximity")
def op5_near(table) -> DataFrame:
    """Benchmark items in proximity only, in every document."""
    return decontam.contamination(table("documents"), table("benchmark")).select("doc_id", "contaminated", "n_near_items")


# Production shares of the mix: the large source is held back, the others and
# whatever is not named get one share each.
MIX_SHARES = {"src0": 5, **{f"src{i}": 1 for i in range(1, 20)}}
MIX_OTHER = 1
MIX_BLOCK = 1 << 16  # characters


@query("op8_mix_sources")
def op8(table) -> DataFrame:
    """Block, release, deadline and slot of every document."""
    return mixing.schedule(table("documents"), MIX_SHARES, MIX_OTHER, MIX_BLOCK)


def token_digest(store: tokenids.Store, docs: DataFrame) -> DataFrame:
    """Start, length and CRC-32 of the ids read back for every row of ``docs``."""
    return tokenids.fetch(store, tokenids.all_keys(docs), occurrence_col="occurrence").select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op10_token_ids")
def op10(table) -> DataFrame:
    """Every document's ids, written and read back through the index."""
    docs = table("documents")
    return token_digest(tokenids.write(docs, tokenizer_file("word_bpe_49k.json")), docs)


def _license_sql() -> str:
    """The scan in DuckDB: postings from corpus IDFs, hits grouped by the
    place where the template would begin, key phrases at their places."""
    forms = licenses.templates(licenses.TEMPLATES)
    rows = lambda x: ", ".join(str(r).replace(",)", ")") for r in x)
    words = rows([(t, i, w) for t, f in enumerate(forms) for i, w in enumerate(f.words)])
    labels = rows([(t, f.label) for t, f in enumerate(forms)])
    keys = rows([(t, k, at + j, w) for t, f in enumerate(forms) for k, (at, ws) in enumerate(f.keys) for j, w in enumerate(ws)])
    phrases = rows([(label, j, w) for p, label in licenses.PHRASES.items() for j, w in enumerate(licenses.words_of(p))])
    return f"""
WITH f(t, pos, w) AS (VALUES {words}), l(t, label) AS (VALUES {labels}), k(t, k, pos, w) AS (VALUES {keys}),
p(label, j, w) AS (VALUES {phrases}),
vocab AS (SELECT w FROM f UNION SELECT w FROM p),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("text")} AS ws FROM documents),
m AS (SELECT rid, i, ws[i + 1] AS w FROM (SELECT rid, ws, unnest(range(len(ws))) AS i FROM d) WHERE ws[i + 1] IN (SELECT w FROM vocab)),
idf AS (SELECT w, ln(((SELECT count(*) FROM d) + 1) / (count(DISTINCT rid) + 1)) + 1 AS v FROM vocab LEFT JOIN m USING (w) GROUP BY w),
rare AS (SELECT t, w, v FROM (SELECT t, w, v, row_number() OVER (PARTITION BY t ORDER BY v DESC, w) AS n
  FROM (SELECT DISTINCT t, w, v FROM f JOIN idf USING (w))) WHERE n <= 6),
post AS (SELECT t, pos, w, v / sum(v) OVER (PARTITION BY t) AS v FROM f JOIN rare USING (t, w)),
place AS (SELECT rid, t, i - pos AS off, sum(v) AS s FROM m JOIN post USING (w) GROUP BY ALL),
ok AS (SELECT DISTINCT rid, label FROM place JOIN l USING (t)
  WHERE s >= 0.75 - 1e-9 AND NOT EXISTS (SELECT 1 FROM k WHERE k.t = place.t
    AND NOT EXISTS (SELECT 1 FROM m WHERE m.rid = place.rid AND m.i = place.off + k.pos AND m.w = k.w))),
base AS (SELECT rid, i, label FROM (SELECT rid, m.i - p.j AS i, label, count(DISTINCT p.j) AS n FROM m JOIN p USING (w) GROUP BY ALL) x
  WHERE n = (SELECT count(*) FROM p WHERE p.label = x.label)),
bs AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY rid),
ls AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels
  FROM (SELECT rid, label FROM ok UNION SELECT rid, label FROM base) GROUP BY rid),
sc AS (SELECT rid, least(round(max(s), 6), 1.0) AS score FROM place GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN bs USING (rid) LEFT JOIN ls USING (rid) LEFT JOIN sc USING (rid)"""


@query("op2_license_scan", _license_sql())
def op2(table) -> DataFrame:
    """Licence phrases and notices in every document."""
    return licenses.scan(table("documents"))


@query("op9_lm_scores")
def op9(table) -> DataFrame:
    """Base and hierarchical Pitman-Yor scores of every document."""
    return pitman_yor.score_documents(table("documents"))


_SPACE_WORD = r"[^\x20\x09-\x0D]+"
_PIECE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def token_feed(docs: DataFrame) -> list[tuple[str, DataFrame]]:
    """The change feed of a corpus: every document is counted, recounted by
    the next tokenizer version where that differs, and exact copies of an
    earlier document are taken down."""
    counts = materialize(docs.select(
        "doc_id", "source", "lang", F.coalesce(F.md5("text"), F.lit("")).alias("h"),  # NULL texts are copies of one another
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_SPACE_WORD)).cast("long").alias("v1"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_PIECE_WORD)).cast("long").alias("v2")), "token-counts")
    keys = [F.col("source"), F.col("lang")]
    load = counts.select(F.lit("insert").alias("kind"), *keys, F.lit("words-1").alias("tokenizer"), F.col("v1").alias("n_tokens"))
    recount = counts.where("v1 <> v2").select(
        F.lit("revise").alias("kind"), *keys, F.lit("pieces-2").alias("tokenizer"), F.col("v2").alias("n_tokens"),
        F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), F.lit("words-1").alias("old_tokenizer"), F.col("v1").alias("old_n_tokens"))
    first = cut(counts.groupBy("h").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "first"))
    copies = counts.join(first, "h").where("doc_id <> first")
    same = F.col("v1") == F.col("v2")
    take_down = copies.select(F.lit("delete").alias("kind"), *keys, F.when(same, "words-1").otherwise("pieces-2").alias("tokenizer"),
                              F.when(same, F.col("v1")).otherwise(F.col("v2")).alias("n_tokens"))
    return [("001-load", load), ("002-recount", recount), ("003-take-down", take_down)]


_COUNT = "CAST(len(regexp_extract_all(coalesce(text, ''), '{}')) AS BIGINT)"


@query("op1_token_rollup", f"""
WITH c AS (SELECT doc_id, source, lang, {_COUNT.format(_SPACE_WORD)} AS v1, {_COUNT.format(_PIECE_WORD)} AS v2,
  doc_id <> min(doc_id) OVER (PARTITION BY text) AS copy FROM documents)
SELECT source, lang, CASE WHEN v1 = v2 THEN 'words-1' ELSE 'pieces-2' END AS tokenizer, count(*) AS n_docs,
  CAST(sum(v2) AS BIGINT) AS n_tokens FROM c WHERE NOT copy GROUP BY ALL""")
def op1(table) -> DataFrame:
    """Totals by source, language and tokenizer after three batches, one of
    them sent twice, and a compaction."""
    docs = table("documents")
    totals = rollup.Rollup(docs.sparkSession, shared_path(docs.sparkSession, "token-rollup"))
    feed = token_feed(docs)
    for batch, changes in [*feed[:2], feed[1]]:
        totals.apply(batch, changes)
    totals.compact()
    totals.apply(*feed[2])
    return totals.totals()


def captures(pages: DataFrame) -> DataFrame:
    """WARC records of a crawl table: each page is a full response, and is
    asked for again 3,000 minutes later under its URL with a fragment. The
    server sends strong tags, weak tags, or only a date, by length of page."""
    kind = F.length("html") % 3
    tag, date = F.md5("html"), F.concat(F.lit("day "), F.floor(F.col("page_id") / 2))

    def headers(weak: str, at: Column) -> Column:
        etag = F.concat(F.lit(weak), F.lit('"'), tag, F.lit('"'))
        return F.when(kind < 2, F.create_map(F.lit("ETag"), etag, F.lit("Date"), at, F.lit("Content-Type"), F.lit("text/html"))).otherwise(
            F.create_map(F.lit("Last-Modified"), date, F.lit("Date"), at, F.lit("Content-Type"), F.lit("text/html")))

    when = lambda minutes: F.timestamp_seconds((F.col("page_id") + minutes) * 60)
    full = pages.select((F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", when(0).alias("ts"),
                        headers("", F.concat(F.lit("t"), F.col("page_id"))).alias("headers"), tag.alias("digest"))
    again = pages.select((F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"),
                         F.concat("url", F.lit("#again")).alias("url"), when(3000).alias("ts"),
                         F.when(kind == 1, headers("W/", F.concat(F.lit("t"), F.col("page_id") + 3000)))
                         .otherwise(headers("", F.concat(F.lit("t"), F.col("page_id") + 3000))).alias("headers"),
                         F.lit(None).cast("string").alias("digest"))
    return full.unionByName(again)


_CANON = """
WITH raw AS (SELECT page_id, length(html) % 3 AS k, md5(html) AS tag, 'day ' || CAST(page_id // 2 AS VARCHAR) AS day,
  regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u,
  CASE lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) WHEN 'http' THEN ':80$' WHEN 'https' THEN ':443$' ELSE '^$' END AS port FROM pages),
cut AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^.*@', ''), '^www[0-9]*\\.', ''), port, '')
  || regexp_replace(regexp_extract(regexp_extract(u, '^[^/?]*(.*)$', 1), '^[^?]*'), '/+$', '') AS hp,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\\?(.*)$', 1), '&'),
    lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|fbclid|gclid|sessionid|jsessionid|phpsessid)(=|$)'))), '&') AS q FROM raw),
p AS (SELECT page_id, k, tag, day, hp || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url FROM cut)"""


@query("op3_warc_revisits", _CANON + """,
j AS (SELECT a.page_id, a.url, a.k, a.tag, a.day, max(b.page_id) AS m FROM p a LEFT JOIN p b ON a.url = b.url AND b.page_id < a.page_id + 3000 GROUP BY ALL),
r AS (SELECT j.*, b.k AS bk, b.tag AS btag, b.day AS bday FROM j LEFT JOIN p b ON b.page_id = j.m),
s AS (SELECT *, CASE WHEN m IS NULL THEN 'no_response' WHEN k < 2 AND bk < 2 THEN CASE WHEN tag = btag THEN 'resolved' ELSE 'mismatch' END
  WHEN k = 2 AND bk = 2 THEN CASE WHEN day = bday THEN 'resolved' ELSE 'mismatch' END ELSE 'unverified' END AS status FROM r)
SELECT page_id * 2 + 1 AS record_id, url, status, m * 2 AS refers_to,
  CASE WHEN status = 'resolved' THEN 'content-type: text/html; date: t' || CAST(page_id + 3000 AS VARCHAR) || CASE
    WHEN k = 0 THEN '; etag: "' || tag || '"' WHEN k = 1 THEN '; etag: W/"' || tag || '"' ELSE '; last-modified: ' || day END END AS headers,
  CASE WHEN status = 'resolved' THEN btag END AS digest FROM s""")
def op3(table) -> DataFrame:
    """Every page's revisit: what it refers to, and its merged headers."""
    found = warc.resolve_revisits(captures(table("pages")))
    listed = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return found.withColumn("headers", F.array_join(listed, "; "))


CHAT_TOOLS = {
    "search": [chat.Argument("limit", "integer", minimum=1, maximum=4), chat.Argument("text", "string")],
    "convert": [chat.Argument("unit", "string", choices=("chars", "words", "lines")), chat.Argument("value", "integer", maximum=900),
                chat.Argument("scale", "number", required=False)],
    "note": [chat.Argument("body", "string"), chat.Argument("title", "string")],
}


def tool_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a conversation table: every assistant turn is a
    call (tool by turn, arguments from its whole text, following the
    assistant turn before last), every other turn the result of the call one
    turn before."""
    ident = lambda back: F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn") - back)
    lines = F.size(F.split("text", "\n")).cast("long")
    unit = F.element_at(F.array(*map(F.lit, ("chars", "words", "lines", "pages"))), (F.length("text") % 4 + 1).cast("int"))
    tool = F.col("turn") % 3
    arguments = (F.when(tool == 0, F.to_json(F.struct(F.col("text"), lines.alias("limit"))))
                 .when(tool == 1, F.to_json(F.struct(F.length("text").alias("value"), unit.alias("unit"))))
                 .otherwise(F.to_json(F.struct(F.when(lines > 1, F.col("turn").cast("string")).alias("title"), F.col("text").alias("body")))))
    name = F.element_at(F.array(*map(F.lit, CHAT_TOOLS)), (tool + 1).cast("int"))
    calls = turns.where("role = 'assistant'").select("conv_id", "turn", ident(0).alias("call_id"), name.alias("name"),
                                                     arguments.alias("arguments"), ident(2).alias("after"))
    results = turns.where("role <> 'assistant'").select("conv_id", "turn", ident(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


@query("op7_chat_tool_calls", """
WITH RECURSIVE a AS (SELECT *, 'c' || conv_id || '-' || turn AS call_id, len(string_split(text, chr(10))) AS lines, turn % 3 AS t
  FROM conversations WHERE role = 'assistant'),
lv(conv_id, turn, level) AS (SELECT conv_id, turn, 0 FROM a WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.conv_id = a.conv_id AND b.turn = a.turn - 2)
  UNION ALL SELECT a.conv_id, a.turn, level + 1 FROM lv JOIN a ON a.conv_id = lv.conv_id AND a.turn = lv.turn + 2),
r AS (SELECT conv_id, turn - 1 AS turn, count(*) AS n, min(text) AS content FROM conversations WHERE role <> 'assistant' GROUP BY ALL),
x AS (SELECT a.conv_id, a.turn, call_id, CAST(level AS BIGINT) AS level, CAST(coalesce(n, 0) AS BIGINT) AS n_results, content,
  CASE t WHEN 0 THEN 'search' WHEN 1 THEN 'convert' ELSE 'note' END AS name,
  CASE t WHEN 0 THEN CASE WHEN lines > 4 THEN 'maximum:limit' ELSE '' END
    WHEN 1 THEN concat_ws(',', CASE WHEN length(text) % 4 = 3 THEN 'choice:unit' END, CASE WHEN length(text) > 900 THEN 'maximum:value' END)
    ELSE CASE WHEN lines > 1 THEN '' ELSE 'missing:title' END END AS problems,
  CASE t WHEN 0 THEN '{"limit":' || lines || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}'
    WHEN 1 THEN '{"unit":"' || (['chars', 'words', 'lines', 'pages'])[length(text) % 4 + 1] || '","value":' || length(text) || '}'
    ELSE '{"body":' || CAST(to_json(text) AS VARCHAR) || CASE WHEN lines > 1 THEN ',"title":"' || a.turn || '"' ELSE '' END || '}' END AS args
  FROM a JOIN lv USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn)),
s AS (SELECT *, CASE WHEN problems <> '' THEN 'invalid' WHEN n_results = 0 THEN 'unanswered' ELSE 'linked' END AS status FROM x)
SELECT conv_id, turn, call_id, level, n_results, status, problems, '{"arguments":' || args || ',"call_id":"' || call_id || '","conv_id":' || conv_id
  || ',"level":' || level || ',"name":"' || name || '","result":' || CASE WHEN status = 'linked' THEN CAST(to_json(content) AS VARCHAR) ELSE 'null' END
  || ',"status":"' || status || '"}' AS json FROM s""")
def op7(table) -> DataFrame:
    """Every tool call of the conversations, linked, ordered, validated and
    written as canonical JSON."""
    return chat.link_calls(*tool_turns(table("conversations")), CHAT_TOOLS)


# Production rules (host, path, verdict), and the words that list a host.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
SPAM_WORDS = ("pills", "casino", "viagra", "poker", "loans")
THIN_HTML = 700  # characters


@query("op11_url_filters", f"""
WITH u AS (SELECT page_id, length(coalesce(html, '')) AS n, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
a AS (SELECT page_id, n, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(h, p, v) AS (VALUES {", ".join(map(str, URL_RULES))}),
fit AS (SELECT host, path, arg_max(h || p, length(h || p) * 1000 + length(h)) AS rule, arg_max(v, length(h || p) * 1000 + length(h)) AS v
  FROM (SELECT DISTINCT host, path FROM a) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL),
thin AS (SELECT host, path, max(n) < {THIN_HTML} AS thin FROM a GROUP BY ALL)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN v WHEN spam OR thin THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN spam THEN 'host' WHEN thin THEN 'page' ELSE 'none' END AS reason
FROM (SELECT a.*, rule, v, thin, regexp_matches(host, '{"|".join(SPAM_WORDS)}') AS spam FROM a JOIN thin USING (host, path) LEFT JOIN fit USING (host, path))""")
def op11(table) -> DataFrame:
    """Verdict on every page's URL: rules, then hosts with a spam word in
    their name, then addresses that only ever served a thin page."""
    pages = table("pages")
    rules = pages.sparkSession.createDataFrame(URL_RULES, "host string, path string, verdict string")
    sized = urlfilter.addresses(pages.select("page_id", "url", F.length(F.coalesce("html", F.lit(""))).alias("n_html")), "page_id", "url", "n_html")
    sized = cut(sized.groupBy("host", "path").agg(F.max("n_html").alias("n_html")))
    hosts = sized.where(F.col("host").rlike("|".join(SPAM_WORDS))).select("host").distinct()
    return urlfilter.filter_urls(pages, rules, hosts, sized.where(F.col("n_html") < THIN_HTML).select("host", "path"))


@query("op12_filter_audit", r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^ 	-
]+') AS ws FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
  || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 'E' ELSE '' END AS fails FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
c(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c a, c b, c, c d, c e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, i AS step, substr(filter_order, i, 1) AS filter, substr(filter_order, 1, i - 1) AS prior FROM o, range(1, 6) r(i)),
x AS (SELECT m.*, s.*, contains(fails, filter) AS it, translate(fails, prior, '') <> fails AS gone FROM m, s),
g AS (SELECT part, filter_order, step, filter, CAST(sum(CASE WHEN NOT it AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN it AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN it AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails = filter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN it AND NOT gone AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN it AND NOT gone AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM g""")
def op12(table) -> DataFrame:
    """What each of five filters does at each step of each order, by language."""
    return audit.audit(table("documents"), table("labels"))


@query("op13_embedding_whitening")
def op13(table) -> DataFrame:
    """Whitened components of every embedding."""
    return whitening.by_component(whitening.whiten(table("embeddings")))
