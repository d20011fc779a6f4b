"""Quality rules: repetition coverage.

Rolling hashes of several n-gram lengths (numpy, whole texts) find the word
n-grams and the lines that a text repeats; the rules bound the share of
characters that lie inside repeated material. One pass over the documents,
no shuffle: every document is judged alone inside its Arrow batch, so skewed
sources or copies do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import WHITESPACE, frees_memory, text_bytes

# Multiplier of the rolling polynomial hash (odd, 64 bits).
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the verdict. Coverage counts the characters of words inside
    the second and later occurrences of an n-gram, each word once. Repeats of
    fewer than ``min_repeat_chars`` characters in all do not count: one
    repeated heading says nothing about a short page."""

    min_words: int = 20
    max_repeat_percent: int = 30  # words in 8-word windows found twice or more
    max_dup_line_share: float = 0.30  # of lines with a word
    max_dup_line_chars: float = 0.20  # of the bytes of lines with a word
    max_coverage: dict[int, float] = field(
        default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    min_repeat_chars: int = 100


BASE_WINDOW = 8

MEASURES = T.StructType(
    [T.StructField(n, T.LongType(), False) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType(), False), T.StructField("kept", T.BooleanType(), False),
       T.StructField("dup_line_share", T.DoubleType(), False), T.StructField("dup_line_chars", T.DoubleType(), False),
       T.StructField("max_coverage", T.DoubleType(), False)])


def _repeats(h: np.ndarray) -> np.ndarray | None:
    """For each position: 0 unique, 1 first of several, 2 a later one; None
    when all values differ."""
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return None
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    kind = np.zeros(len(h), np.int8)
    kind[order[:-1][same]] = 1
    kind[order[1:][same]] = 2
    return kind


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int32)
    edge[starts] += 1
    np.subtract.at(edge, starts + length, 1)
    return np.cumsum(edge[:n]) > 0


def measure_text(text: str | None, rules: RepetitionRules) -> tuple:
    """The measures of one text (NULL: no words), as in ``MEASURES``."""
    raw = text_bytes(text)
    words = raw.split()
    n = len(words)
    n_symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    if n == 0:
        return 0, 0, n_symbols, 0, 0, True, False, 0.0, 0.0, 0.0
    dense = raw.translate(None, WHITESPACE)
    word_chars = len(dense) if dense.isascii() else len(dense.decode("utf-8", "surrogatepass"))

    seen: set[bytes] = set()
    n_lines = n_dup_lines = dup_line_bytes = line_bytes = 0
    if b"\n" in raw:
        for line in raw.split(b"\n"):
            if line.strip(WHITESPACE):
                n_lines += 1
                line_bytes += len(line)
                if line in seen:
                    n_dup_lines += 1
                    dup_line_bytes += len(line)
                else:
                    seen.add(line)
    dup_line_share = n_dup_lines / n_lines if n_lines else 0.0
    dup_line_chars = dup_line_bytes / line_bytes if line_bytes else 0.0

    n_repeat = 0
    worst = 0.0
    over = False
    lens = None
    lengths = sorted({*rules.max_coverage, BASE_WINDOW})
    h1 = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    h, at = h1, 1
    for length in lengths:
        if n < length:
            break
        while at < length:
            at += 1
            h = h[:-1] * _BASE + h1[at - 1:]
        kind = _repeats(h)
        if kind is None:  # no longer n-gram can repeat either
            break
        if length == BASE_WINDOW:
            n_repeat = int(_covered(np.flatnonzero(kind), length, n).sum())
        if length in rules.max_coverage:
            if lens is None:
                lens = np.fromiter((len(w) if w.isascii() else len(w.decode("utf-8", "surrogatepass")) for w in words), np.int64, n)
            repeated = int(lens[_covered(np.flatnonzero(kind == 2), length, n)].sum())
            share = repeated / word_chars
            worst = max(worst, share)
            over |= share > rules.max_coverage[length] and repeated >= rules.min_repeat_chars
    base_failed = n < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n
    lines_over = dup_line_share > rules.max_dup_line_share or dup_line_chars > rules.max_dup_line_chars
    bad = over or (lines_over and dup_line_bytes >= rules.min_repeat_chars)
    return (n, word_chars, n_symbols, n_dup_lines, n_repeat, base_failed, not (base_failed or bad),
            dup_line_share, dup_line_chars, worst)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rules: RepetitionRules | None = None) -> DataFrame:
    """One row per input row: the id and the columns of ``MEASURES``.

    Words are runs of bytes other than space and \\x09-\\x0D. NULL and empty
    texts have no words and fail the base rule (fewer than 20 words); NULL
    ids stay NULL; repeated rows give repeated results; an empty table gives
    an empty result; other columns of ``docs`` are not read.
    """
    rules = rules or RepetitionRules()
    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *MEASURES.fields])
    names = [f.name for f in MEASURES.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rows = [measure_text(t.as_py(), rules) for t in b.column(1)]
            cols = [pa.array(c) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], [id_col, *names])

    return src.mapInArrow(frees_memory(run), schema)


def keep_good(docs: DataFrame, text_col: str = "text", rules: RepetitionRules | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged. Only
    the text goes to Python and only the verdict comes back.

    NULL, empty and short texts go (fewer than 20 words); each row is judged
    alone, so ties, repeated rows and NULL ids play no part; any other columns
    may have any name; an empty table stays empty.
    """
    rules = rules or RepetitionRules()

    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def verdicts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for b in batches:
                yield pa.array([measure_text(t.as_py(), rules)[6] for t in b], pa.bool_())

        return frees_memory(verdicts)(texts)

    return docs.where(F.arrow_udf(judge, "boolean")(docs[text_col].cast("string")))
