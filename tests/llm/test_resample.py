"""Importance resampling against a plain-Python version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from depot.llm import resample
from tests.llm.helpers import LOWER, docs, prose

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n, buckets):
    w = LETTERS.findall((text or "").translate(LOWER))
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)], len(w)


def expected(rows, target, n, buckets, percent, min_words, seed):
    s, t = Counter(), Counter()
    for r in rows:
        s.update(grams(r[1], n, buckets)[0])
    for x in target:
        t.update(grams(x, n, buckets)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for r in rows:
        g, words = grams(r[1], n, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        out.append([r[0], len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words >= min_words])
    fit = sorted((x for x in out if x[5]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[2], x[1]))
    for place, x in enumerate(fit[:percent * len(fit) // 100], 1):
        x[4] = place
    return sorted((tuple(x[:5]) for x in out), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(i, "\n".join(prose(rng, rng.randrange(1, 30)) for _ in range(rng.randrange(1, 5)))) for i in range(120)]
    out += [(500, None), (501, ""), (502, "\n \n"), (None, prose(rng, 40)), (503, "É" * 300_000 + " 7 " + "w" * 70), (504, prose(rng, 60_000)),
            (505, "one\ntwo\n\nthree four"), (3, out[3][1]), (3, out[3][1])]
    same = "the same line in many documents\nand another one\n"
    return out + [(1000 + i, same * 6) for i in range(60)]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_resample_is_the_plain_version(spark, rows, n):
    rng = random.Random(8)
    target = [prose(rng, 30) for _ in range(20)] + [None, ""]
    got = resample.resample(docs(spark, rows).repartition(5), spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string"),
                            percent=25, n=n, buckets=1000, min_words=15, seed=7)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, target, n, 1000, 25, 15, 7)


def test_empty_tables_and_clashing_names(spark):
    none = docs(spark, [(1, "x")]).filter("false")
    one = spark.createDataFrame([(1, "a b", 5, 6, 7)], "doc_id long, text string, id long, weight long, place long")
    assert resample.resample(none, none).collect() == []
    got = resample.resample(one, none, min_words=1, percent=100).collect()
    assert [(r["doc_id"], r["n_features"], r["rank"]) for r in got] == [(1, 2, 1)]


def test_a_distinct_line_is_shuffled_and_hashed_once(spark, monkeypatch):
    """The distinct lines, not the lines, reach the workers."""
    plans = []
    inner = resample.map_arrow
    monkeypatch.setattr(resample, "map_arrow", lambda df, run, schema: plans.append(df) or inner(df, run, schema))
    resample.feature_counts(docs(spark, [(i, "same line\nsame line") for i in range(50)]), "text", 100, 1)
    assert [tuple(r) for r in plans[0].collect()] == [("same line", 100)]
