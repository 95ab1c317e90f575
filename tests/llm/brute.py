"""Plain restatements of the operators' contracts for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np

DOCS = "doc_id long, text string, source string, score string, piece string"


def roots(n: int, pairs) -> list[int]:
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    return [root(i) for i in range(n)]


def components(ids: list, pairs) -> list:
    of = roots(len(ids), pairs)
    least: dict[int, int] = {}
    for i, r in enumerate(of):
        if ids[i] is not None:
            least[r] = min(least.get(r, ids[i]), ids[i])
    return [least.get(r) for r in of]


def shingles(text: str | None, n: int) -> set:
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def jaccard_links(texts: list, n: int, percent: int) -> list[tuple[int, int]]:
    sets, holders, links = [shingles(t, n) for t in texts], defaultdict(list), []
    for i, s in enumerate(sets):
        shared: Counter = Counter()
        for g in s:
            shared.update(holders[g])
            holders[g].append(i)
        links += [(i, j) for j, o in shared.items() if 100 * o >= percent * (len(s) + len(sets[j]) - o)]
    return links


def cosine_links(vectors: list, least: float) -> list[tuple[int, int]]:
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [np.array(v, dtype=float) / np.linalg.norm(v) if usable(v) else None for v in vectors]
    return [
        (i, j)
        for i, a in enumerate(units)
        for j, b in enumerate(units[:i])
        if a is not None and b is not None and len(a) == len(b) and a @ b >= least
    ]


def base_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def license_counts(text: str | None, phrases) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    hits = [
        (i, label)
        for phrase, label in phrases
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))
