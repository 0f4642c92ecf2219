import random

import numpy as np
import pyarrow as pa
import pytest

from depot.llm import minmax
from tests.llm.helpers import components, docs, prose, shingles


def edited(rng, text, share):
    w = text.split()
    for _ in range(max(1, int(share * len(w)))):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def fixture():
    rng = random.Random(4)
    rows = []
    for g in range(25):
        base = prose(rng, rng.randint(12, 200))
        rows += [(len(rows) + k, t) for k, t in enumerate([base, base.upper().lower(), *(edited(rng, base, s) for s in (0.01, 0.02, 0.04, 0.05, 0.2))])]
    crowd = prose(rng, 150)
    rows += [(len(rows) + k, edited(rng, crowd, 0.02)) for k in range(60)]        # near copies of one text
    rows += [(len(rows) + k, crowd) for k in range(40)]                            # exact copies
    licence = prose(rng, 60)
    rows += [(len(rows) + k, prose(rng, 60) + " " + licence) for k in range(40)]   # a shared passage, no link
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "a b"), (5004, "A  b"), (5005, "b a"), (None, "a b"), (None, "only here it has no id at all"), (5006, crowd), (5006, "quite another text with this id")]
    rng.shuffle(rows)
    return rows


def test_equals_all_pairs(spark):
    rows = fixture()
    want = components(rows)
    got = minmax.near_duplicates(docs(spark, rows).selectExpr("*", "1 AS node", "2 AS kept", "3 AS label")).collect()
    assert sorted((str(r[0]), len(shingles(r[1])), str(c if shingles(r[1]) else r[0])) for r, c in zip(rows, want)) == sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_keep_one_leaves_one_of_each(spark):
    rows = fixture()
    df = docs(spark, rows).selectExpr("*", "1 AS _node", "2 AS _marked", "3 AS _label", "4 AS row")
    kept = minmax.keep_one(df)
    assert kept.columns == df.columns
    kept = kept.collect()
    want = components(rows)
    full = [(r, c) for r, c in zip(rows, want) if shingles(r[1])]
    alone = sum(1 for r in rows if not shingles(r[1]))
    groups = {str(c) for _, c in full}
    assert len([k for k in kept if shingles(k.text)]) >= len(groups)
    assert len(kept) == alone + len({(str(c)) if str(c) != "5006" else r[1] for r, c in full})


def test_empty_and_alone(spark):
    df = docs(spark, [(1, "a b c d e f"), (2, "g h i j k l")])
    assert minmax.near_duplicates(df.limit(0)).count() == 0 and minmax.keep_one(df.limit(0)).count() == 0
    assert all(r.kept for r in minmax.near_duplicates(df).collect()) and minmax.keep_one(df).count() == 2


@pytest.mark.parametrize("share", [0.5, 0.75, 0.9])
def test_estimate_is_unbiased(share):
    rng = np.random.default_rng(8)
    found = []
    for _ in range(40):
        both, own = int(300 * share), 300 - int(300 * share)
        pool = rng.integers(0, 2**63, both + own, dtype=np.uint64)
        a, b = np.sort(pool[:both + own // 2]), np.sort(np.concatenate([pool[:both], pool[both + own // 2:]]))
        sig = minmax.min_max(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        found.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(found) - share) < 0.02


def test_sets_do_not_depend_on_the_batch():
    texts = ["a b c d e f a b c d e", None, "", "x y", "X  y"]
    hashes, at = minmax._sets(pa.array(texts))
    keys = minmax.set_keys(hashes, at)
    assert at.tolist() == [0, len(shingles(texts[0])), 6, 6, 7, 8] and keys[3] == keys[4]
    for i, t in enumerate(texts):
        assert minmax.set_keys(*minmax._sets(pa.array([t], pa.string())))[0] == keys[i]
