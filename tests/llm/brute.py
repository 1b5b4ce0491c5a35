"""Plain versions of the operators, one row or one pair at a time."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
from tokenizers import Tokenizer

from rollbook.llm import decontaminate as D
from rollbook.llm import license_scan as L
from rollbook.llm.pieces import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_tokenizer = None


def ids(text: str | None) -> list[int]:
    global _tokenizer
    if _tokenizer is None:
        _tokenizer = Tokenizer.from_file(tokenizer_path())
    return _tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(some: list[int]) -> int:
    return zlib.crc32(np.array(some, "<u4").tobytes())


def repeated_runs(texts: list[str | None], window: int = 35) -> list[tuple[int, int, str]]:
    """n_words, n_removed and the kept words of each text."""
    words = [WORD.findall(t or "") for t in texts]
    often = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if often[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def shingles(text: str | None, n: int) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_components(rows: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, int]:
    """The smallest id reachable from each id over all pairs of rows."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)) and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def overlaps(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> set[tuple[int, int]]:
    """Pairs with an alignment that the rule accepts, over all alignments."""
    number: dict[str, int] = defaultdict(lambda: len(number))
    cut = lambda t: np.array([number[w] for w in re.findall(r"[^\W_]+", (t or "").lower())], np.int64)
    found = set()
    cut_items = [(k, cut(t)) for k, t in items]
    for i, text in docs:
        d = cut(text)
        for k, g in cut_items:
            if not len(d) or not len(g):
                continue
            run = min(D.OVERLAP, len(g))
            need = run - D.SUBSTITUTED * run // D.OVERLAP
            wide = np.concatenate((np.full(len(g), -1), d, np.full(len(g), -1)))
            same = np.stack([wide[x : x + len(d) + len(g)] == g[x] for x in range(len(g))])
            sums = np.concatenate((np.zeros((1, same.shape[1]), int), np.cumsum(same, 0)))
            if (sums[run:] - sums[:-run]).max() >= need:
                found.add((i, k))
    return found


def scanned(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, base = [], set()
    for phrase, label in L.BASE:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    norm, hits = f" {' '.join(w)} ", []
    if any(g in norm for g in L.GATE):
        for r in L.signature_rules():
            if r.keyword in norm:
                hits += [(m.start(), m.end(), r.priority, r.label) for m in re.finditer(f" {r.pattern}(?= )", norm)]
    hits.sort(key=lambda h: (h[0], -h[1], -h[2], h[3]))
    kept = [h for k, h in enumerate(hits) if not any(g[1] >= h[1] and g[2] >= h[2] for g in hits[:k])]
    labels = base | {h[3] for h in kept}
    score = max([L.WEIGHT[h[2]] for h in kept] + [0.5 * bool(base)])
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), float(score), len(kept)


def ftrl(rows: list[tuple[list[int], int]], passes: int, alpha: float, beta: float, l1: float, l2: float) -> dict[int, float]:
    """Weights of a logistic regression, one row and one feature at a time."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(k: int) -> float:
        return 0.0 if abs(z[k]) <= l1 else -(z[k] - (l1 if z[k] > 0 else -l1)) / ((beta + n[k] ** 0.5) / alpha + l2)

    for _ in range(passes):
        for on, label in rows:
            w, x = {k: weight(k) for k in on}, len(on) ** -0.5
            g = (1 / (1 + np.exp(-sum(w.values()) * x)) - label) * x
            for k in on:
                z[k] += g - ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / alpha * w[k]
                n[k] += g * g
    return {k: weight(k) for k in z}
