import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from depot.llm import cube, rendezvous
from tests.llm.helpers import WORD, docs, prose


def fill(sizes, weights, total, cap):
    """Targets by capping and sharing again until nothing is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    wanted, full = total * sum(sizes.values()), set()
    while True:
        rest = wanted - sum(cap * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        level = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if level[s] >= cap * sizes[s]]
        if not over:
            return {s: cap * sizes[s] if s in full else level[s] for s in names}
        full |= set(over)


def fixture():
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(1, 120)), rng.choice(["a", "a", "a", "b", "Z", "ä", None])) for i in range(3000)]
    return rows + [(9000, None, "b"), (9001, "", "b"), (None, "x y", "a"), (None, "x y", "a")] + [(9002, "r s t", "Z")] * 700 + [(9003, prose(rng, 20_000), "c")]


def test_mix_hits_targets(spark):
    rows = fixture()
    df = docs(spark, rows).selectExpr("*", "1 AS size", "2 AS prob", "3 AS copies")
    got = cube.mix(df, block=128).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len(WORD.findall(r[1] or ""))
    want = fill(sizes, (5.0, 2.0, 1.0), 1.5, 2.0)
    taken, n, copies = Counter(), Counter(), Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        n[r.source] += 1
        copies[r.source] += r.copies
    for s in sizes:
        largest = max(len(WORD.findall(r[1] or "")) for r in rows if r[2] == s)
        assert abs(taken[s] - want[s]) <= max(2 * 120, largest if s == "c" else 0)
        assert abs(copies[s] - n[s] * want[s] / sizes[s]) <= 3            # documents are balanced too
    again = cube.mix(df.repartition(5), block=128).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert cube.mix(df.limit(0)).count() == 0


def test_draw_rows(spark):
    rows = fixture()
    df = docs(spark, rows).selectExpr("*", "1 AS _k", "2 AS k2", "3 AS _times")
    mixed = Counter()
    for r in cube.mix(df, block=128).collect():
        mixed[r.doc_id, r.source, r.size] += r.copies
    drawn = cube.draw_rows(df, block=128)
    assert drawn.columns == df.columns
    got = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in drawn.collect())
    assert got == +mixed
    assert cube.draw_rows(df.limit(0)).count() == 0


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(2)
    p, size = rng.random(500), rng.integers(1, 1000, 500).astype(float)
    q = cube.flight(p, size, None)
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * size).sum() - (p * size).sum()) < 1e-3
    assert ((q > 0) & (q < 1)).sum() <= 2
    mean = np.mean([cube.flight(np.full(9, 0.3), size[:9] + k, None) for k in range(400)], axis=0)
    assert np.abs(mean - 0.3).max() < 0.12


def test_shards(spark):
    rows = [(i, f"text {i % 50}") for i in range(2000)] + [(None, None), (None, ""), (5, "text 5"), (5, "other")] + [(7777, "hot")] * 500
    df = docs(spark, rows).selectExpr("*", "1 AS shard", "2 AS _n")
    got = rendezvous.shard(df, [1.0] * 24, rows_a_part=10).collect()
    assert len(got) == len(rows)
    slots = {}
    owner = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert owner.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())

    def best(key, n):
        u = [(int(hashlib.md5(f"shard/{j}/{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for j in range(n)]
        return min(range(n), key=lambda j: (-math.log(u[j]), j))

    for d, (s, g) in owner.items():
        if d is not None:
            assert (s, g) == (best(d, 24), best(d, 25))
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert want == Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    moved = sum(g == 24 for s, g in owner.values())
    assert 0.01 < moved / len(owner) < 0.08
    assert rendezvous.shard(df.limit(0), [1.0] * 3).count() == 0


def test_weighted_shards(spark):
    df = docs(spark, [(i, "x") for i in range(6000)])
    n = Counter(r.shard for r in rendezvous.shard(df, [1.0, 3.0]).collect())
    assert abs(n[1] / 6000 - 0.75) < 0.03
    one, two = ({r.doc_id: r.shard for r in rendezvous.shard(df, w).collect()} for w in ([1.0, 3.0], [2.0, 3.0]))
    assert all(two[d] in (one[d], 0) for d in one)      # a heavier shard only takes
