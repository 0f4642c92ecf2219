"""Small fixtures and plain-Python counterparts of the operators."""

from __future__ import annotations

import random
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{int(rng.paretovariate(0.25)) % vocabulary}x" for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    out = words(rng, n)
    return " ".join(w + ("." if rng.random() < 0.1 else "") for w in out)


def docs(spark, rows):
    """Rows (doc_id, text[, source]) as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(rows) -> list:
    """Component id of each (doc_id, text), by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    ids: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return [ids.get(find(i)) for i in range(len(rows))]
