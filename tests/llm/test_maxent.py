import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from depot.llm import maxent
from depot.llm.common import scan_words
from tests.llm.helpers import LOWER, WORD, docs


def two_languages(n, rng):
    """Texts of two word stocks: the context tells which."""
    stock = [[f"a{i}" for i in range(300)] + ["the"] * 60, [f"b{i}" for i in range(300)] + ["der"] * 60]
    out = []
    for i in range(n):
        own = stock[i % 2]
        out.append(" ".join(rng.choice(own) for _ in range(rng.randint(5, 80))))
    return out


def test_base_score_equals_brute_force_and_model_gains(spark):
    rng = random.Random(2)
    texts = two_languages(400, rng) + [None, "", "Never Seen Words", "THE the", "x" * 300_000, "the " * 20_000]
    rows = list(enumerate(texts)) + [(None, "the a1"), (7, texts[7])]
    df = docs(spark, rows).selectExpr("*", "1 AS block", "2 AS words")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    got = maxent.score(df, held).collect()
    assert len(got) == len(rows)
    tokens = lambda t: [*WORD.findall((t or "").translate(LOWER)), None]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter(x for i, t in rows if not out(i) for x in tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), out(i), len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens(t)), 4)) for i, t in rows)
    assert want == sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got)
    assert {r.train_tokens for r in got} == {n}
    own = [r for r in got if r.held_out and r.n_tokens > 5 and r.doc_id < 400]
    assert sum(r.score for r in own) > sum(r.base_score for r in own) + 0.1 * sum(r.n_tokens for r in own)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)


def test_empty_and_without_training(spark):
    df = docs(spark, [(1, "a b"), (2, None)])
    assert maxent.score(df.limit(0), F.lit(False)).count() == 0
    got = {r.doc_id: r for r in maxent.score(df, F.lit(True)).collect()}
    assert got[1].n_known == 0 and got[1].train_tokens == 0 and got[2].n_tokens == 1 and math.isfinite(got[1].score)


def test_class_softmax_is_a_distribution():
    rng = np.random.default_rng(0)
    w = maxent.Weights(rng.normal(size=maxent.CLASSES).astype(np.float32), rng.normal(size=(3 * maxent.BUCKETS, maxent.CLASSES)).astype(np.float32))
    p = maxent._softmax(rng.integers(0, maxent.BUCKETS, (3, 100)) + np.arange(3)[:, None] * maxent.BUCKETS, w)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_every_round_reads_all_training_tokens(spark, monkeypatch):
    """Also those of documents that are alone in their block."""
    seen, add = [], maxent._add_tables

    def spy(parts, rows, width):
        out = add(parts, rows, width)
        if (rows, width) == (3 * maxent.BUCKETS + 1, maxent.CLASSES + 1):
            seen.append(int(out[-1, -1]))
        return out

    monkeypatch.setattr(maxent, "_add_tables", spy)
    monkeypatch.setattr(maxent, "BLOCK_BYTES", 64)
    texts = ["the a b " * 100, *["the a c"] * 9, "b " * 500]
    got = maxent.score(docs(spark, list(enumerate(texts))).coalesce(1), F.col("doc_id") == 3).collect()
    assert seen == [got[0].train_tokens] * maxent.ROUNDS


def test_word_factor_equals_brute_force(spark, monkeypatch):
    """With an even class softmax: counts of pairs over many blocks and ranges, and the strength."""
    seen, find = [], maxent.dictionary
    monkeypatch.setattr(maxent, "dictionary", lambda *a: seen.append(find(*a)) or seen[-1])
    monkeypatch.setattr(maxent, "_softmax", lambda f, w: np.full((f.shape[1], len(w.bias)), 1 / len(w.bias), np.float32))
    monkeypatch.setattr(maxent, "DICTIONARY", 200)
    monkeypatch.setattr(maxent, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(maxent, "RANGE_TOKENS", 500)
    rng = random.Random(5)
    rows = list(enumerate(two_languages(60, rng) + ["new a1 new a2 the", None, "the " * 3000, "a1 a2 a3 " * 40, "a1 a2 a3 " * 40]))
    held = F.col("doc_id") % 7 == 4
    got = {r.doc_id: r.score for r in maxent.score(docs(spark, rows).repartition(3), held).collect()}
    words = seen[0]
    code = lambda w: maxent.END if w is None else scan_words(pa.array([w]), lower=True)[0][0]
    tokens = {i: [*WORD.findall(t or ""), None] for i, t in rows}
    known = dict(zip(words.hashes.tolist(), words.classes.tolist()))
    kind = {w: known.get(int(code(w)), maxent.RARE) for t in tokens.values() for w in t}
    train = [t for i, t in tokens.items() if i % 7 != 4]
    count = Counter(w for t in train for w in t)
    assert 0 < sum(kind[w] == maxent.RARE for w in count) < len(count)
    before = lambda t: ["(begin)", *t]
    pair = Counter((h, w) for t in train for h, w in zip(before(t), t))
    total = Counter((h, kind[w]) for t in train for h, w in zip(before(t), t))
    mass, kinds = Counter(), Counter(kind[w] for w in count)
    for w, c in count.items():
        mass[kind[w]] += c

    def logs(t, k, out):
        for h, w in zip(before(t), t):
            p = (count[w] - out + 0.5) / (mass[kind[w]] + 0.5 * (kinds[kind[w]] + (kind[w] == maxent.RARE)))
            yield math.log10((pair[h, w] - out + k * p) / (total[h, kind[w]] - out + k))

    best = max(maxent.STRENGTHS, key=lambda k: sum(x for t in train for x in logs(t, k, 1)))
    for i, t in tokens.items():
        assert math.isclose(got[i], sum(logs(t, best, 0)) - len(t) * math.log10(maxent.CLASSES), rel_tol=1e-5), i


def test_pairs_learnt_grow_with_the_input():
    """Ranges follow the tokens, each of a bounded size."""
    assert [maxent._range_bits(n) for n in (0, 1, maxent.RANGE_TOKENS, maxent.RANGE_TOKENS + 1, 100 * maxent.RANGE_TOKENS)] == [0, 0, 0, 1, 7]
    x = np.random.default_rng(1).integers(0, 1 << 39, 1000)
    assert (maxent._unpack(maxent._pack(x, 5), 5) == x).all()
