import random

import numpy as np
import pyarrow as pa

from depot.llm import common, toxicity
from tests.llm.helpers import docs, prose

BAD = ["vile", "scummy", "wretch", "lowly"]


def fixture(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for d in range(n):
        w = prose(rng, rng.randint(20, 300)).split()
        toxic = d % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 9)):
                w.insert(rng.randrange(len(w)), rng.choice([*BAD, "nasti" + rng.choice(["er", "est", "ly", "fy"])]))
        rows.append((d, " ".join(w)))
        labels.append((d, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_defined_cases(spark):
    rows, labels = fixture(600, 1)
    lab = spark.createDataFrame([*labels[:400], (None, 1, 1), (5, 1, None), (7, 1, labels[7][2])], "doc_id long, quality int, toxic int")
    df = docs(spark, rows).selectExpr("*", "9 AS toxic", "1 AS severity")
    model = toxicity.train(df, lab)
    assert np.all(np.diff(model.theta) > 0) and np.all(model.weights >= 0)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    held = [d for d, _, _ in labels[400:]]
    assert sum(got[d].toxic == bool(labels[d][2]) for d in held) >= 0.97 * len(held)
    assert all(0 <= r.severity <= 3 and r.grade <= 3 for r in got.values())
    few, many = docs(spark, [(1, "so vile")]), docs(spark, [(1, "vile wretch scummy lowly vile wretch nastily nastiest")])
    assert toxicity.score(few, model).first().severity < toxicity.score(many, model).first().severity
    kept = toxicity.keep_clean(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if not r.toxic}
    odd = toxicity.score(docs(spark, [(None, None), (1, ""), (1, ""), (2, "VILE!! scummy### " * 50_000)]), model).collect()
    assert len(odd) == 4 and sorted(r.toxic for r in odd) == [False, False, False, True]
    assert toxicity.score(df.limit(0), model).count() == 0


def test_without_labels_nothing_is_toxic(spark):
    rows, labels = fixture(30, 2)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for own in (lab.limit(0), lab.where("toxic = 0"), lab.where("toxic = 1")):
        assert toxicity.keep_clean(docs(spark, rows), toxicity.train(docs(spark, rows), own)).count() == 30


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(3)
    n, x = 900, rng.random(900) * 4
    grade = np.minimum(3, np.searchsorted([1, 2, 3], x + rng.normal(0, 0.2, n)))
    w, theta = toxicity.fit_ordinal(np.arange(n), np.zeros(n, int), x, grade, 1)
    p = toxicity._sigmoid(w[0] * x[:, None] - theta)
    assert np.corrcoef(p.sum(axis=1), grade)[0, 1] > 0.9 and np.all(np.diff(theta) > 0)


def test_a_batch_is_scored_in_bounded_memory():
    """What a worker holds beside a batch of 4 MB is a small part of what all its words would take."""
    import tracemalloc
    rng = random.Random(2)
    words = [f"w{rng.randrange(9000)}x" for _ in range(3000)]
    text = " ".join(words)
    texts = pa.array([text] * (4_000_000 // len(text)))
    model = toxicity.Model(np.sort(common.scan_words(pa.array(words), lower=True, letters_only=True)[0]), np.full(3000, 1e-3), np.array([1.0, 2.0, 3.0]))
    whole = toxicity.severity(texts, model)
    tracemalloc.start()
    got = [toxicity.severity(b.column("text"), model) for b in common.byte_slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", common.SLICE)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(np.concatenate(got), whole) and peak < 48 << 20


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array([" ".join(f"word{k * k}" for k in range(n)) for n in (0, 1, 900, 5000)])
    whole = common.scan_words(texts, lower=True)
    monkeypatch.setattr(common, "_PIECE", 1 << 10)
    common._powers.cache_clear()
    try:
        assert all(np.array_equal(a, b) for a, b in zip(common.scan_words(texts, lower=True), whole))
    finally:
        common._powers.cache_clear()
