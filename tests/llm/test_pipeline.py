"""The pipeline on a fixture whose outcome plain Python can tell."""

import random
from collections import Counter

import corpus_pipeline as P
from tests.llm.helpers import WORD, components, docs, prose
from tests.llm.test_mixing_sharding import fill

BAD = ["vile", "scummy", "wretch"]


def fixture(spark, folder):
    rng = random.Random(21)
    items = [(i, prose(rng, 30)) for i in range(8)]
    rows, toxic, leaky = [], set(), set()
    for d in range(260):
        w = prose(rng, rng.randint(20, 150)).split()
        if d % 5 == 0:
            toxic.add(d)
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        elif d % 7 == 0:
            leaky.add(d)
            w += items[d % 8][1].split()
        rows.append((d, " ".join(w), f"src{d % 3}"))
    for d in range(260, 300):                           # copies and near copies
        text = rows[d - 259][1] + (" end" if d % 2 else "")
        rows.append((d, text, f"src{d % 3}"))
        for group in (toxic, leaky):
            if d - 259 in group:
                group.add(d)
    rows += [(300, None, None), (301, "", "src1")]
    docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(d, 1, int(d in toxic)) for d in range(260)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, toxic, leaky


def test_stages_and_run(spark, tmp_path):
    folder = str(tmp_path)
    rows, toxic, leaky = fixture(spark, folder)
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"] and P.ORACLE_SQL is None
    text = {r[0]: r for r in rows}
    docs_ = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs_.columns
    want = [r for r in rows if r[0] not in toxic]
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs_, folder)
        out.write.parquet(f"{folder}/stage{k}")
        docs_ = spark.read.parquet(f"{folder}/stage{k}")
        ids = [r.doc_id for r in docs_.collect()]
        if k < 4:
            assert docs_.columns == columns
        if k == 1:
            want = [r for r, c in zip(want, components(want)) if c == r[0] or not WORD.search(r[1] or "")]
        if k == 2:
            want = [r for r in want if r[0] not in leaky]
        if k < 3:
            assert sorted(ids) == sorted(r[0] for r in want), name
    sizes = Counter()
    for r in want:
        sizes[r[2]] += len(WORD.findall(r[1] or ""))
    goal, taken = fill(sizes, (5.0, 2.0, 1.0), 1.5, 2.0), Counter()
    for d in ids:
        taken[text[d][2]] += len(WORD.findall(text[d][1] or ""))
    assert all(abs(taken[s] - goal[s]) <= 300 for s in sizes)
    assert max(Counter(ids).values()) <= 2
    full = P.run(spark, folder)
    assert sorted(map(str, full.collect())) == sorted(map(str, docs_.select(*full.columns).collect()))


def test_stages_take_odd_tables(spark, tmp_path):
    folder = str(tmp_path)
    fixture(spark, folder)
    odd = docs(spark, [(None, None), (None, "x y"), (1, ""), (1, "a b c d e f"), (1, "a b c d e f")]).selectExpr("*", "1 AS toxic", "2 AS node", "3 AS size", "4 AS shard")
    for table in (odd, odd.limit(0)):
        for name, stage in P.STAGES:
            out = stage(spark, table, folder)
            n = out.count()
            assert n <= 2 * table.count()
            if name != "sharding":
                assert out.columns == table.columns


def test_a_run_leaves_no_helpers(spark, tmp_path):
    """What the stages stored on their way is gone; their results and short lists of digests stay."""
    import os

    from depot.session import shared_dir
    folder, top = str(tmp_path), shared_dir(spark).removeprefix("file:")
    fixture(spark, folder)
    before = set(os.listdir(top))
    P.run(spark, folder).collect()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(top)) - before}
    assert left <= {"pipeline-mixing", "minmax-dropped", "minmax-repeated", "false-alarms", "mix-times"}
