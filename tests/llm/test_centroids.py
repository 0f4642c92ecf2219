"""Centroid clustering against exact integers in plain Python."""

import hashlib
import math
import random

from depot.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, k, rounds, seed, scale, dims):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-centroids.LARGEST, min(centroids.LARGEST, x)) for x in v]) for i, v in kept]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cs = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cs))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for c in range(len(cs)):
            mine = [v for (_, v), x in zip(kept, of) if x == c]
            if mine:
                cs[c] = [sum(x) // len(mine) for x in zip(*mine)]
    at = [near(v) for _, v in kept]
    out = []
    for (i, _), (d, c) in zip(kept, at):
        out.append((i, c, d, sum(x for x, y in at if y == c), sum(x for x, _ in at), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **args):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, centroids.cluster(df, dims=4, **args).collect()), key=str)


def test_clusters_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-64, 64) / 32 for _ in range(4)]) for i in range(80)]
    rows += [(200 + i, [0.5, 0.5, -0.5, 0.25]) for i in range(40)]          # one vector a third of the time
    rows += [(7, rows[7][1]), (None, rows[8][1]), (300, None), (301, []), (302, [1.0] * 5), (303, [1.0, None, 0.0, 0.0]),
             (304, [1.0, float("nan"), 0.0, 0.0]), (305, [1.0, float("inf"), 0.0, 0.0])]
    for k, rounds in ((5, 3), (5, 0), (1, 2)):
        assert run(spark, rows, k=k, rounds=rounds) == expected(rows, k, rounds, 1, 64, 4)


def test_few_vectors_ties_and_large_components(spark):
    rows = [(1, [1.0, 1.0, 1.0, 1.0]), (2, [1.0, 1.0, 1.0, 1.0])]           # equal centroids: the smaller number wins
    got = run(spark, rows)
    assert got == expected(rows, 16, 3, 1, 64, 4) and {r[1] for r in got} == {0}
    rows = [(1, [3e38, -3e38, 0.0, 0.0]), (2, [0.0, 0.0, 0.0, 0.0])]
    assert run(spark, rows, k=1, rounds=0) == expected(rows, 1, 0, 1, 64, 4)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []
    df = spark.createDataFrame([(1, [1.0, 2.0], 3, 4)], "vec_id long, embedding array<float>, id int, cluster int")
    got = centroids.cluster(df, dims=2)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert [tuple(r)[:5] for r in got.collect()] == [(1, 0, 0, 0, 0)]


def test_passes_stay_in_the_jvm(spark):
    data = centroids.quantised(spark.createDataFrame([(1, [0.5] * 4, 0)], SCHEMA), dims=4)
    plan = data.select(centroids.nearest(data["v"], [[1, 2, 3, 4], [5, 6, 7, 8]])["cluster"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
