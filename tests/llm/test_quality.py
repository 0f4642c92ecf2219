import random

from depot.llm import quality
from tests.llm.helpers import WORD, docs, prose


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen: dict = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def cases():
    rng = random.Random(3)
    return [None, "", " \n\t ", "one", "a b c d e a b c d e", "é ü " * 30, "The " * 40, "x\nx\nx\n \n" * 5 + prose(rng, 30), "A&& b## " * 20, "LOUD WORDS! " * 20,
            "- a b\n* c d\n- e f\n" + "- " + prose(rng, 20), "so...\n" * 3 + prose(rng, 9) + "...", "1 2 3 4 5 6 7 8 9 10 11 12", "a" * 3_000_000, prose(rng, 3000), prose(rng, 60),
            "\x1c\x85\u00a0 not white space \u2003 here it is but words are many enough for it"]


def test_numbers_equal_brute_force(spark):
    texts = cases()
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[15]), (3, texts[15])]
    out = quality.judge(docs(spark, rows).selectExpr("*", "1 AS kept", "2 AS n_words")).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out if r.doc_id is not None and r.doc_id != 3}
    for i, t in enumerate(texts):
        if i != 3:
            assert (by[i].n_words, by[i].word_chars, by[i].n_symbols, by[i].n_dup_lines, by[i].n_repeat_words) == brute(t), repr(t)[:80]
            n, _, _, _, k = brute(t)
            assert by[i].base_failed == (n < 10 or 100 * k > 20 * n)
            assert not (by[i].base_failed and by[i].kept)
    assert by[14].kept and by[15].kept
    assert not any(by[i].kept for i in (0, 1, 2, 4, 6, 8, 9, 10, 12))


def test_order_changes_no_verdict(spark):
    df = docs(spark, list(enumerate(cases())))
    names = list(quality.RULES)
    one = {r.doc_id: r.kept for r in quality.judge(df, order=names).collect()}
    two = {r.doc_id: r.kept for r in quality.judge(df, order=names[::-1]).collect()}
    assert one == two
    assert sorted(quality.rule_order(df, sample_rows=10)) == sorted(names)
    assert quality.judge(df.limit(0)).count() == 0
