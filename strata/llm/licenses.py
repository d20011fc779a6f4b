"""Licence scans: a positional rare-token index over notice templates.

Only DataFrame functions. Each text is cut into words once; the words that
occur in a template are stored with their positions (the table ``marks``).
Document frequencies over the whole corpus give every template word an IDF;
the words with the highest ones in a template are its postings (word ->
template, position). A file's occurrences of these words are looked up, each
hit says where the template would begin, and hits that agree on the place add
up. A template is found where enough of its rare-word weight agrees and its
mandatory key phrases stand at their relative positions.

Everything after the tokeniser works inside one row, so nothing is shuffled
but the word counts of the template vocabulary, and repeated ids, hot sources
or long texts cannot skew a task.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize

# Wording of public licence notices, and the phrases that have
# to be there. Words are digits, letters and non-ASCII characters.
TEMPLATES: dict[str, list[tuple[str, tuple[str, ...]]]] = {
    "mit": [
        ("Released under the MIT License.", ("mit license",)),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         "documentation files (the \"Software\"), to deal in the Software without restriction", ("permission is hereby granted",)),
    ],
    "apache": [
        ("Licensed under the Apache License, Version 2.0.", ("apache license",)),
        ("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
         "http://www.apache.org/licenses/LICENSE-2.0", ("in compliance with the license", "apache org licenses")),
    ],
    "gpl": [
        ("This work is licensed under the GNU General Public License, version 3.", ("gnu general public license",)),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
         "Public License as published by the Free Software Foundation", ("gnu general public license", "free software foundation")),
    ],
    "cc-by-nc": [("Licensed under CC BY-NC 4.0.", ("cc by nc",))],
    "bsd": [("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met", ("redistribution and use", "source and binary forms"))],
    "mpl": [("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license",))],
}
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_MARK = "array<struct<i:int,w:string>>"


def words_of(text: str) -> list[str]:
    """Words of a notice or phrase (ASCII, lower case)."""
    return re.findall(r"[0-9a-z]+", text.lower())


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]  # (place, words) of each key phrase


def templates(spec: dict[str, list[tuple[str, tuple[str, ...]]]]) -> list[Template]:
    """Parse the notices and place their key phrases."""
    out = []
    for label, notices in spec.items():
        for text, phrases in notices:
            w = words_of(text)
            keys = []
            for p in map(words_of, phrases):
                at = next((i for i in range(len(w)) if w[i:i + len(p)] == p), None)
                if at is None:
                    raise ValueError(f"key phrase {' '.join(p)!r} is not in the notice of {label}")
                keys.append((at, tuple(p)))
            out.append(Template(label, tuple(w), tuple(keys)))
    return out


def text_words(text: Column) -> Column:
    """Words of the whole text, lower-cased; NULL: none. Of the characters
    outside ASCII only the Kelvin sign has an ASCII lower case: it is put out
    of the way, so ASCII words are exactly those with A-Z lower-cased."""
    plain = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("K"), F.lit("é"))
    return F.regexp_extract_all(F.lower(plain), F.lit(_WORD), F.lit(0))


def marks(docs: DataFrame, vocabulary: set[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, m): the places of the vocabulary words in each text,
    stored once in the shared folder."""
    words = docs.select(docs[id_col].alias("doc_id"), text_words(docs[text_col]).alias("words"))
    placed = F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    known = F.filter(placed, lambda x: x["w"].isin(*sorted(vocabulary)))
    return materialize(words.select("doc_id", F.size("words").cast("long").alias("n_words"), known.cast(_MARK).alias("m")), "licence-words")


def _starts(phrase: list[str] | tuple[str, ...]) -> Column:
    """Places in ``m`` where the words of the phrase stand consecutively."""

    def here(x: Column, j: Column) -> Column:
        ok = x["w"] == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            y = F.get(F.col("m"), j + k)
            ok = ok & (y["w"] == word) & (y["i"] == x["i"] + k)
        return F.coalesce(ok, F.lit(False))

    return F.transform(F.filter("m", here), lambda x: x["i"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: dict | None = None,
         phrases: dict[str, str] | None = None, rare_words: int = 6, min_score: float = 0.75) -> DataFrame:
    """Per row: doc_id, n_words, n_base (places of the base phrases),
    first_word, last_word (their smallest and largest start, else NULL),
    base_labels, labels (with the templates found; distinct, sorted,
    comma-joined), score (largest share, 0 to 1, of a template's rare-word
    weight that agrees on one place; rounded to 6 decimals).

    NULL and empty texts have no words, no labels and score 0; NULL ids stay;
    repeated rows give repeated results; an empty table gives no rows; other
    columns are not read.
    """
    forms = templates(spec or TEMPLATES)
    phrases = phrases or PHRASES
    base = {p: words_of(p) for p in phrases}
    vocabulary = {w for t in forms for w in t.words} | {w for p in base.values() for w in p}
    table = marks(docs, vocabulary, id_col, text_col)

    # one count a vocabulary word (a parameter's size), over all documents
    seen = table.select(F.explode(F.array_distinct(F.transform("m", lambda x: x["w"]))).alias("w"))
    df = {r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_docs = table.count()
    idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}

    postings: dict[str, list[tuple[int, int, float]]] = {}
    for t, form in enumerate(forms):
        rare = sorted(set(form.words), key=lambda w: (-idf[w], w))[:rare_words]
        total = sum(idf[w] for w in form.words if w in rare)
        for at, w in enumerate(form.words):
            if w in rare:
                postings.setdefault(w, []).append((t, at, idf[w] / total))
    index = F.create_map(*[c for w, rows in sorted(postings.items()) for c in (
        F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(at).alias("at"), F.lit(v).alias("v")) for t, at, v in rows]))])

    rare_only = F.filter("m", lambda x: x["w"].isin(*sorted(postings)))
    hits = F.array_sort(F.flatten(F.transform(rare_only, lambda x: F.transform(
        F.element_at(index, x["w"]), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["at"]).alias("off"), p["v"].alias("v"))))))
    start = F.struct(F.lit(-1).alias("t"), F.lit(0).alias("off"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"),
                     F.array().cast("array<struct<t:int,off:int>>").alias("found"))

    def add(acc: Column, x: Column) -> Column:
        same = (acc["t"] == x["t"]) & (acc["off"] == x["off"])
        before = F.when(same, acc["sum"]).otherwise(F.lit(0.0))
        now = before + x["v"]
        reached = (now >= min_score - 1e-9) & (before < min_score - 1e-9)
        place = F.struct(x["t"].alias("t"), x["off"].alias("off"))
        return F.struct(x["t"].alias("t"), x["off"].alias("off"), now.alias("sum"), F.greatest(acc["best"], now).alias("best"),
                        F.when(reached, F.concat(acc["found"], F.array(place))).otherwise(acc["found"]).alias("found"))

    starts = {p: _starts(w) for p, w in base.items()}
    table = table.select("doc_id", "n_words", "m", F.aggregate(hits, start, add).alias("r"),
                         F.concat(*starts.values()).alias("base"),
                         F.filter(F.array(*[F.when(F.size(s) > 0, F.lit(phrases[p])) for p, s in starts.items()]),
                                  lambda x: x.isNotNull()).alias("base_labels"))

    def shift(at: int):
        return lambda i: i - at

    def verified(t: int) -> Column:
        """Label of template ``t`` if it begins somewhere in ``r.found`` with
        every key phrase at its place."""
        ok = F.transform(F.filter("r.found", lambda x: x["t"] == t), lambda x: x["off"])
        for at, words in forms[t].keys:
            ok = F.array_intersect(ok, F.transform(_starts(words), shift(at)))
        return F.when(F.size(ok) > 0, F.lit(forms[t].label))

    none = F.array().cast("array<string>")
    found = F.when(F.size("r.found") > 0, F.filter(F.array(*[verified(t) for t in range(len(forms))]), lambda x: x.isNotNull())).otherwise(none)
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return table.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"), joined(F.col("base_labels")).alias("base_labels"),
        joined(F.concat("base_labels", found)).alias("labels"), F.least(F.round("r.best", 6), F.lit(1.0)).alias("score"))
