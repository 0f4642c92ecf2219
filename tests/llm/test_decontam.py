import random

import numpy as np

from depot.llm import decontam
from tests.llm.helpers import docs, prose


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence_equals_table():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 8, rng.integers(1, 30)).astype(np.uint64), rng.integers(0, 8, rng.integers(0, 40)).astype(np.uint64)
        assert decontam.common_subsequence(a, b) == lcs(a.tolist(), b.tolist())


def fixture(spark):
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randint(18, 60)).replace("1", "é")) for i in range(40)]
    rows, planted = [], set()
    for d in range(300):
        text = prose(rng, rng.randint(30, 400))
        if d % 3 == 0:
            i = rng.randrange(40)
            w = items[i][1].split()
            if d % 6 == 0:                              # a paraphrase: words dropped and put in, other case and punctuation
                w = [x.upper() + "," for k, x in enumerate(w) if k % 9 != 4]
                w.insert(len(w) // 2, "indeed")
            at = rng.randint(0, len(text.split()))
            own = text.split()
            text = " ".join(own[:at] + w + own[at:])
            planted.add((d, i))
        rows.append((d, text))
    return rows, items, planted


def test_recall_and_precision(spark):
    rows, items, planted = fixture(spark)
    bench = spark.createDataFrame([*items, (98, None), (99, "..."), (None, "")], "item_id long, text string")
    df = docs(spark, [*rows, (1000, None), (1001, ""), (None, items[0][1])]).selectExpr("*", "1 AS item_id", "2 AS place")
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench).collect()}
    assert (None, 0) in found
    found.discard((None, 0))
    assert len(found & planted) >= 0.97 * len(planted)
    assert not found - planted
    blocks = {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench, block_items=30).collect()} - {(None, 0)}
    assert len(blocks & planted) >= 0.97 * len(planted) and not blocks - planted
    kept = {r.doc_id for r in decontam.keep_clean(df, bench).collect()}
    assert kept == {r[0] for r in rows} - {d for d, _ in found} | {1000, 1001}


def test_empty(spark):
    rows, items, _ = fixture(spark)
    bench = spark.createDataFrame(items[:3], "item_id long, text string")
    df = docs(spark, rows[:3])
    assert decontam.leaks(df.limit(0), bench).count() == 0
    assert decontam.leaks(df, bench.limit(0)).count() == 0
    assert decontam.keep_clean(df, bench.limit(0)).count() == 3


def test_candidate_recall_against_brute_force():
    """Latent candidates against all windows' full cosines: at least 0.9 of those above 0.5."""
    import pyarrow as pa
    from depot.llm.common import scan_words
    rng = random.Random(5)
    items = decontam.make_items([(i, prose(rng, 30)) for i in range(60)])
    texts = [prose(rng, 200) for _ in range(50)] + [prose(rng, 40) + " " + prose(random.Random(5), 60) for _ in range(20)]
    vocabulary = np.unique(np.concatenate([i.words for i in items]))
    idf = np.ones(len(vocabulary)) * 3.0
    dense = np.zeros((len(items), len(vocabulary)))
    for r, i in enumerate(items):
        np.add.at(dense[r], np.searchsorted(vocabulary, i.words), 3.0)
    u, s, v = np.linalg.svd(dense, full_matrices=False)
    basis = v[:50].T.astype(np.float32)
    latent = dense @ basis
    latent /= np.linalg.norm(latent, axis=1, keepdims=True)
    index = decontam.Index(vocabulary, idf, basis, items, np.ascontiguousarray(latent.T.astype(np.float32)), 32)
    words, _, _, at = scan_words(pa.array(texts), lower=True, letters_only=True)
    where = decontam._places(vocabulary)(words)
    got = {(t, s, i) for t, s, i, _ in decontam.candidates(where, at, index, 0.3)}
    want = set()
    for t in range(len(texts)):
        for s in range(at[t], at[t + 1], 32):
            own = where[s:min(s + 64, at[t + 1])]
            x = np.bincount(own[own >= 0], minlength=len(vocabulary)) * 3.0
            c = dense @ x / np.maximum(np.linalg.norm(dense, axis=1) * np.linalg.norm(x), 1e-9)
            want |= {(t, s, int(i)) for i in np.flatnonzero(c >= 0.5)}
    assert len(want & got) >= 0.9 * len(want)


def test_short_items_beside_a_long_one(spark):
    """Exact copies and paraphrases of 15-word items, with and without a 1,000-word item in their block."""
    rng = random.Random(3)
    even = lambda n: " ".join(f"w{rng.randrange(4000)}x" for _ in range(n))
    short = [(i, even(15)) for i in range(40)]
    long = (40, even(1000))
    rows, planted = [], set()
    for d in range(240):
        own = prose(rng, rng.randint(300, 3000)).split()
        w = short[d % 40][1].split()
        if d % 3 == 1:                                  # a paraphrase
            w = [x.upper() for k, x in enumerate(w) if k % 9 != 4]
            w.insert(7, "indeed")
        if d % 3 < 2:
            at = rng.randint(0, len(own))
            own[at:at] = w
            planted.add((d, d % 40))
        rows.append((d, " ".join(own)))
    rows.append((240, prose(rng, 700) + " " + long[1] + " " + prose(rng, 700)))
    df = docs(spark, rows)
    for items in (short, [*short, long]):
        bench = spark.createDataFrame(items, "item_id long, text string")
        found = {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench).collect()}
        assert planted <= found and not found - planted - {(240, 40)}
    assert (240, 40) in found


def test_cut_texts_give_the_same_candidates(monkeypatch):
    """A text held in many pieces has the candidates of one held whole."""
    rng = np.random.default_rng(4)
    items = [decontam.Item(i, rng.integers(0, 300, n).astype(np.uint64), np.zeros(0), np.zeros(0)) for i, n in enumerate((1, 3, 5, 15, 16, 17, 60, 130))]
    latent = np.zeros((300, len(items)), np.float32)
    for i, x in enumerate(items):
        np.add.at(latent[:, i], x.words.astype(int), 1)
    latent /= np.linalg.norm(latent, axis=0)
    index = decontam.Index(np.arange(300, dtype=np.uint64), np.ones(300), np.eye(300, dtype=np.float32), items, latent, 32)
    at = np.array([0, 7, 7, 3000, 3001, 3500])
    where = rng.integers(-1, 300, 3500).astype(np.int32)
    for k, x in enumerate(items):
        where[200 + 300 * k:200 + 300 * k + len(x.words)] = x.words
    whole = decontam.candidates(where, at, index, 0.3)
    monkeypatch.setattr(decontam, "_CELLS", 1)
    cut = decontam.candidates(where, at, index, 0.3)
    assert sorted(c[:3] for c in whole) == sorted(c[:3] for c in cut) and {c[2] for c in whole} == set(range(len(items)))
    assert all(at[t] <= s < at[t + 1] and (s - at[t]) % decontam._spans(items)[i] == 0 for t, s, i, _ in whole)


def test_the_space_is_fitted_on_every_document(spark):
    """All passages of more documents than a sample would hold enter A'A."""
    rng = random.Random(5)
    items = decontam.make_items([(i, prose(rng, 40)) for i in range(20)])
    vocabulary = np.unique(np.concatenate([i.words for i in items]))
    rows = [(d, items_text) for d in range(5000) for items_text in [" ".join(f"w{(d + k) % 60}x" for k in range(8))]]
    counted = decontam._count(docs(spark, rows), vocabulary, 32)
    passages = [np.frombuffer(r.passage, np.int32).astype(np.int64) for r in counted.where("place < 0").collect()]
    known = set(vocabulary.tolist())
    assert len(passages) == sum(any(h in known for h in decontam._hashes(t).tolist()) for _, t in rows) > 2048
    idf = np.linspace(1, 2, len(vocabulary))
    r, c, v = decontam._tfidf(passages, idf)
    a = np.zeros((len(passages), len(idf)))
    a[r, c] = v
    q = np.random.default_rng(1).standard_normal((len(idf), 9))
    square = decontam._square(counted.where("place < 0").select("passage"), idf)
    assert np.allclose(decontam._times(square, q), a.T @ (a @ q), rtol=1e-3, atol=1e-2)


def test_a_wide_vocabulary_gives_the_same_space(spark, monkeypatch):
    rows, items, _ = fixture(spark)
    own = decontam.make_items(items)
    small = decontam.build_index(docs(spark, rows), own, len(rows), rank=16)
    monkeypatch.setattr(decontam, "_SQUARE", 0)
    wide = decontam.build_index(docs(spark, rows), own, len(rows), rank=16)
    assert np.allclose(small.latent.T @ small.latent, wide.latent.T @ wide.latent, atol=1e-2)


def test_blocks_of_the_square_are_small(spark):
    """A task holds half of A'A, and no block of it fills half a region of a JVM's heap."""
    rng = np.random.default_rng(6)
    passages = [rng.integers(0, 900, 40) for _ in range(300)]
    idf = rng.uniform(1, 2, 900)
    df = spark.createDataFrame([(bytearray(p.astype(np.int32).tobytes()),) for p in passages], "passage binary").repartition(3)
    square = decontam._square(df, idf)
    assert max(len(r.part) for r in square.select("part").collect()) < 1 << 19
    r, c, v = decontam._tfidf(passages, idf)
    a = np.zeros((len(passages), len(idf)))
    a[r, c] = v
    assert np.allclose(decontam._times(square, np.eye(900)), a.T @ a, rtol=1e-4, atol=1e-4)
    half, corners = np.zeros(900 * 901 // 2, np.float32), decontam._corners(900)
    decontam._add_products(r, c, v, len(passages), corners, half)
    assert np.allclose(decontam._unpacked(half, corners, 0, 900), a.T @ a, rtol=1e-4, atol=1e-4)
