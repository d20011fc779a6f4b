"""Plain Python versions of the operators' definitions, and edge-case rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

SPACE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
PIECE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

PROSE = ("the quick brown fox jumps over a lazy dog while seven wise owls watch from old oak trees near the quiet river bank "
         "and children sing about summer rain falling on warm stone roofs").split()
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"


def prose(n: int, start: int = 0) -> str:
    return " ".join(f"{PROSE[(start + i * 7) % len(PROSE)]}{(start * 31 + i) % 97}" for i in range(n))


def edge_texts() -> list[tuple[int | None, str | None]]:
    base = prose(60, 3)
    near = base.split()
    return [
        (0, None), (1, ""), (2, " \n\t \x0b\x0c\r"), (3, "one two"), (4, "word"), (5, base), (6, base), (6, base), (7, base + "!"),
        (8, " ".join(near[:-1])), (None, prose(40, 9)), (None, prose(40, 9)), (9, prose(20000, 5)), (10, "same line here\n" * 40 + prose(30)),
        (11, "É Ünïcode TEXT  K Kelvin İ ß 漢字 \x00 \x85 a b " + prose(25, 2)),
        (12, f"{prose(15, 1)} {ITEM} {prose(15, 8)}"), (13, ITEM.upper().replace(" ", ", ")), (14, f"{prose(5)}. short item here. {ITEM[:30]}"),
        (15, "Released under the MIT License. mit license MIT-license " + prose(22, 4)),
        (16, "x " * 19), (17, "x " * 500), (18, f"{prose(12, 6)}\n{prose(12, 6)}\n\n{prose(30, 2)}"), (-5, "negative id " + prose(21, 7)),
        (2 ** 40, "<|endoftext|> It's 1234 #*$%&|<> don't " + prose(21, 11)),
    ]


def lower(text: str | None) -> bytes:
    return (text or "").encode().lower()


def space_words(text: str | None) -> list[bytes]:
    return SPACE_WORD.findall((text or "").encode())


def piece_words(text: str | None) -> list[str]:
    return PIECE_WORD.findall(lower(text).decode())


def fingerprint(text: str | None) -> str:
    w = SPACE_WORD.findall(lower(text))
    if not w:
        return "0" * 16
    sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return f"{sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)):016x}"


def components(rows: list[tuple[int, str]], radius: int = 2) -> dict[int, int]:
    """Smallest id reachable over links of at most ``radius`` bits."""
    fps: dict[int, int] = {}
    for i, f in rows:
        fps[int(f, 16)] = min(i, fps.get(int(f, 16), i))
    keys = list(fps)
    up = {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(a ^ b).count("1") <= radius:
                up[root(a)] = root(b)
    best: dict[int, int] = {}
    for k in keys:
        best[root(k)] = min(fps[k], best.get(root(k), fps[k]))
    return {i: best[root(int(f, 16))] for i, f in rows}


def quality(text: str | None) -> tuple:
    t = text or ""
    w = space_words(t)
    lines = [x for x in t.split("\n") if space_words(x)]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(8)}
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return (len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed)


def coverage(text: str | None, n: int) -> float:
    """Share of word characters in the second and later occurrences of n-grams."""
    w = space_words(text)
    seen, hit = set(), set()
    for i in range(len(w) - n + 1):
        g = tuple(w[i:i + n])
        if g in seen:
            hit |= set(range(i, i + n))
        seen.add(g)
    return sum(len(w[i].decode()) for i in hit) / max(1, sum(len(x.decode()) for x in w))


def keeps(text: str | None) -> bool:
    """Verdict of the repetition rules with their default limits."""
    t = text or ""
    n, chars, _, dup, _, failed = quality(t)
    if failed:
        return False
    lines = [x for x in t.split("\n") if space_words(x)]
    again = sum(len(x.encode()) for k, x in enumerate(lines) if x in lines[:k])
    whole = sum(len(x.encode()) for x in lines)
    if "\n" in t and again >= 100 and (dup > 0.30 * len(lines) or again > 0.20 * whole):
        return False
    return not any(round(coverage(t, k) * chars) >= 100 and coverage(t, k) > limit for k, limit in
                   {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items())


def contamination(text: str | None, items: list[tuple]) -> tuple:
    w = piece_words(text)
    hit, found = set(), set()
    for item, body in items:
        v = piece_words(body)
        if item is None or not v:
            continue
        n = min(10, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def unigram(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(held_out, n_tokens, n_known, train_tokens, base_score) per row."""
    docs = [(i is not None and zlib.crc32(str(i).encode()) % 5 == 1, [*SPACE_WORD.findall(lower(t)), None]) for i, t in rows]
    c = Counter(t for held, ts in docs if not held for t in ts)
    n, v = sum(c.values()), len(c)
    return [(held, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)) for held, ts in docs]
