"""Personal data: base spans against the plain patterns, learned spans and edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from depot.llm import pii
from tests.llm.helpers import docs, prose

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 12 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def test_base_spans_are_those_of_the_plain_patterns():
    rng = random.Random(2)
    kept = 0
    for _ in range(6000):
        pieces = rng.choices(["1", "4", "42", "255", "999", ".", "..", "-", " ", "  ", "(", ")", "+", "@", "a", "b.c", "%", "é", "\n", "_", "4111111111111111", "4111 1111-11111111",
                              "+1 (017) 555-7713", "10.0.0.1", "x@y.z", "/", "00"], k=rng.randrange(1, 25))
        text = "".join(pieces)
        got = [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)]
        assert got == plain(text), text
        kept += len(got)
    assert kept > 1000


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1" * 1_000_000, "1.1" * 400_000, "+1" + "-(" * 500_000, "@a" * 400_000, "a.b@" * 300_000, "1 2-" * 300_000,
                                  "(at)" * 300_000, ":" * 500_000 + "1.2.3.4", " at a.b" * 100_000])
def test_long_runs_take_linear_time(text):
    pii.candidates(text)


MORE = ["reach anna.lee (at) mail dot org for more", "call me at (212) 555-0187 today", "phone 030 1234 5678 please", "my ssn is 123-45-6789 there",
        "my name is Maria Keller and", "signed by Dr. Peter Baum yesterday"]
CLEAN = ["version 10.300.2.1 of page 4444 5555 6666 7778", "chapter 12-34 and 1999-2004 at noon dot", "item 1234567890123456 sold at 5 30", "He was at Home with Others"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(300):
        d = "".join(rng.choices("123456789", k=10))
        rows.append((i, f"{prose(rng, 8)} mail user.{i}@mail{i % 9}.example.com or tel +1 ({d[:3]}) 555-{d[3:7]} from host 10.{i % 250}.2.{i % 99} {prose(rng, 8)}"))
    return rows + [(1000 + i, f"{prose(rng, 6)} {x} {prose(rng, 6)}") for i, x in enumerate(MORE)] + [(2000 + i, f"{prose(rng, 6)} {x}") for i, x in enumerate(CLEAN)]


def test_votes_add_spans_and_leave_clean_texts_alone(spark, corpus):
    out = {r["doc_id"]: r for r in pii.detect(docs(spark, corpus).repartition(4)).collect()}
    text = dict(corpus)
    for i in range(300):
        assert [(x["kind"], x["start"], x["end"]) for x in out[i]["spans"] if x["base"]] == plain(text[i])
    hits = {i: [(x["kind"], text[1000 + i][x["start"]:x["end"]]) for x in out[1000 + i]["spans"] if not x["base"]] for i in range(len(MORE))}
    assert hits[0] == [("email", "anna.lee (at) mail dot org")] and hits[1] == [("phone", "(212) 555-0187")] and hits[2] == [("phone", "030 1234 5678")]
    assert hits[3] == [("id", "123-45-6789")] and hits[4] == [("name", "Maria Keller")] and hits[5] == [("name", "Peter Baum")]
    assert all(out[2000 + i]["spans"] == [] for i in range(len(CLEAN)))


def test_edges_repeats_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (3, "x@y.zz 10.1.1.1"), (3, "x@y.zz 10.1.1.1"), (None, "é +49 30 123456 é"), (4, "q" * 500_000 + " a@b.cc")]
    df = docs(spark, rows).withColumns({"found": F.lit(1), "id": F.lit(2), "n_email": F.lit(3), "spans": F.lit("s")})
    got = pii.detect(df)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = got.withColumn("spans", pii.joined())
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(1, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, ""), *[(3, 1, 1, 0, 0, "email:0:6,ip:7:15")] * 2, (None, 0, 0, 0, 1, "phone:2:15"), (4, 1, 0, 0, 0, "email:500001:507")]
    want[-1] = (4, 1, 0, 0, 0, "email:500001:500007")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(*w[:5], digest(w[5]), w[5]) for w in want], key=str)
    assert pii.detect(df.filter("false")).collect() == []


def test_reliabilities_follow_the_counts():
    """A labeler that agrees with the others gains; one that votes at random does not."""
    rng, n = np.random.default_rng(1), len(pii.LABELERS)
    truth = rng.random(20_000) < 0.6
    right = [0.95, 0.9, 0.5, 0.85, 0.7, 0.8, 0.8]
    counts = {}
    for y in truth:
        code = sum((2 if (rng.random() < right[i]) == y else 0) * 3 ** i for i in range(n))
        counts[code] = counts.get(code, 0) + 1
    got, post = pii.reliabilities([(0, c, k) for c, k in counts.items()])
    assert np.allclose(got, [right, right], atol=0.03)
    assert post[0, -1] > 0.999 and post[0, 0] < 0.001


def test_mask_replaces_spans(spark, corpus):
    df = docs(spark, [*corpus, (9000, None)])
    model = pii.train(pii.stored(pii.scan(df, "doc_id", "text"), "test-pii"))
    out = {r["doc_id"]: r["text"] for r in pii.mask(df, model).collect()}
    assert out[9000] is None and out[2000] == dict(corpus)[2000]
    assert "[EMAIL]" in out[5] and "[PHONE]" in out[5] and "[IP]" in out[5] and "@" not in out[5] and "[NAME]" in out[1004]
