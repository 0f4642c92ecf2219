r"""Document quality: base numbers and a short-circuit cascade of rules.

The cascade measures, on a bounded sample, how long each rule takes and how
many documents it rejects, and orders the rules by rejections per second.  A
document that one rule rejects is not shown to the rules after it.  A verdict
is the AND of all rules, so the order (and with it the measured times) never
changes a result, only the work.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.llm.common import _MULT, byte_slices, ints, map_arrow, mix64, scan_words, text_buffer

WINDOW = 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


class Base(NamedTuple):
    """Numbers of a run of documents, an array each."""
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    n_lines: np.ndarray                     # lines with a word


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[off])


def repeated_words(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of WINDOW words found twice or more in it."""
    out = np.zeros(len(offsets) - 1, np.int64)
    value = np.zeros(len(words), np.uint64)
    padded = np.concatenate([words, np.zeros(WINDOW, np.uint64)])
    for j in range(WINDOW):
        value = value * np.uint64(_MULT) + padded[j:j + len(words)]
    value = mix64(value)
    for i in np.flatnonzero(np.diff(offsets) > WINDOW):
        a, n = int(offsets[i]), int(offsets[i + 1] - offsets[i])
        own = value[a:a + n - WINDOW + 1]
        ordered = np.sort(own)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            hit = np.flatnonzero(np.isin(own, twice))
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + WINDOW, -1)
            out[i] = np.count_nonzero(np.cumsum(edge))
    return out


def base_numbers(texts: pa.Array) -> Base:
    buf, off = text_buffer(texts)
    words, starts, ends, at = scan_words(texts, lower=False)
    inside = np.zeros(len(buf) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    chars = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((buf & 0xC0) != 0x80)
    n = len(off) - 1
    lines, dup = np.zeros(n, np.int64), np.zeros(n, np.int64)
    raw = buf.tobytes()
    for i in range(n):
        own = [x for x in raw[off[i]:off[i + 1]].split(b"\n") if x and not x.isspace()]
        lines[i] = len(own)
        dup[i] = len(own) - len(set(own)) if len(own) > 1 else 0
    return Base(np.diff(at), _per_text(chars, off), _per_text(_SYMBOLS[buf], off), dup, repeated_words(words, at), lines)


# -- rules: (texts as bytes, base numbers, rows) -> rejected, all by whole numbers --

_UPPER, _LETTER = re.compile(rb"[A-Z]"), re.compile(rb"[A-Za-z]")
_WORDY = re.compile(rb"[^\x20\x09-\x0D]*[A-Za-z\x80-\xff][^\x20\x09-\x0D]*")
_BULLET, _OPEN_END = re.compile(rb"[\x20\x09\x0B-\x0D]*[-*]"), re.compile(rb"\.\.\.[\x20\x09\x0B-\x0D]*$")


def _lines(text: bytes) -> list[bytes]:
    return [x for x in text.split(b"\n") if x and not x.isspace()]


def _each(test: Callable[[bytes, int, int], bool]):
    def rule(texts: list[bytes], b: Base, rows: np.ndarray) -> np.ndarray:
        return np.fromiter((test(texts[i], int(b.n_words[i]), int(b.n_lines[i])) for i in rows), bool, len(rows))
    return rule


RULES: dict[str, Callable[[list[bytes], Base, np.ndarray], np.ndarray]] = {
    # more than one symbol in ten words
    "symbols": lambda t, b, r: 10 * b.n_symbols[r] > b.n_words[r],
    # mean word length below 2 or above 15
    "word_length": lambda t, b, r: (b.word_chars[r] < 2 * b.n_words[r]) | (b.word_chars[r] > 15 * b.n_words[r]),
    # over 30 % of the lines repeat an earlier one
    "repeated_lines": lambda t, b, r: 10 * b.n_dup_lines[r] > 3 * b.n_lines[r],
    # over half of at least 20 ASCII letters are capitals
    "capitals": _each(lambda t, w, n: len(_LETTER.findall(t)) >= 20 and 2 * len(_UPPER.findall(t)) > len(_LETTER.findall(t))),
    # more than one exclamation mark in ten words
    "exclamation": _each(lambda t, w, n: 10 * t.count(b"!") > w),
    # fewer than 60 % of the words have a letter
    "letters": _each(lambda t, w, n: 10 * len(_WORDY.findall(t)) < 6 * w),
    # over 90 % of the lines begin with a bullet
    "bullets": _each(lambda t, w, n: 10 * sum(_BULLET.match(x) is not None for x in _lines(t)) > 9 * n),
    # over 30 % of the lines break off with three dots
    "open_ends": _each(lambda t, w, n: 10 * sum(_OPEN_END.search(x) is not None for x in _lines(t)) > 3 * n),
}


def base_failed(b: Base) -> np.ndarray:
    return (b.n_words < 10) | (100 * b.n_repeat_words > 20 * b.n_words)


def cascade(texts: list[bytes], b: Base, order: list[str], measured: dict[str, list[float]] | None = None) -> np.ndarray:
    """Which documents pass all rules; each rule sees only what the ones before left."""
    rows = np.flatnonzero(~base_failed(b))
    for name in order:
        began = time.perf_counter()
        out = RULES[name](texts, b, rows)
        if measured is not None:                # the sample: every rule sees every row
            entry = measured.setdefault(name, [0.0, 0, 0])
            entry[0], entry[1], entry[2] = entry[0] + time.perf_counter() - began, entry[1] + len(rows), entry[2] + int(out.sum())
        else:
            rows = rows[~out]
    kept = np.zeros(len(texts), bool)
    kept[rows] = True
    return kept


def _bytes(texts: pa.Array) -> list[bytes]:
    buf, off = text_buffer(texts)
    raw = buf.tobytes()
    return [raw[off[i]:off[i + 1]] for i in range(len(off) - 1)]


def rule_order(docs: DataFrame, text: str = "text", sample_rows: int = 1000) -> list[str]:
    """Rules by rejections per second on about ``sample_rows`` documents, drawn
    from all partitions.

    Only the order comes from the sample; any order gives the same verdicts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[float]] = {}
        for batch in batches:
            for b in byte_slices(batch, text, 4 << 20):
                cascade(_bytes(b.column(text)), base_numbers(b.column(text)), list(RULES), seen)
        yield pa.RecordBatch.from_pydict({"rule": list(seen), "seconds": [float(v[0]) for v in seen.values()],
                                          "seen": [int(v[1]) for v in seen.values()], "rejected": [int(v[2]) for v in seen.values()]})

    drawn = docs.select(text).where(F.rand(11) < sample_rows / max(1, docs.count()))
    rows = map_arrow(drawn, run, "rule string, seconds double, seen long, rejected long")
    total = rows.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()     # a row for each rule
    found = {r.rule: (r.seconds, r.rejected) for r in total}
    worth = lambda n: (found.get(n, (0.0, 0))[1] + 0.5) / (found.get(n, (0.0, 0))[0] + 1e-6)
    return sorted(RULES, key=lambda n: (-worth(n), n))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", order: list[str] | None = None) -> DataFrame:
    """Base numbers and verdict of every document: ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``.

    Null or empty text: all numbers 0, base_failed, not kept.  Keys are only
    carried along (null, repeated: a row each); whole texts are read in runs of
    4 MB; further columns are ignored; an empty table gives an empty result."""
    order = order if order is not None else rule_order(docs, text)
    schema = f"{key} long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, text, 4 << 20):
                n = base_numbers(b.column(text))
                kept = cascade(_bytes(b.column(text)), n, order)
                yield pa.RecordBatch.from_arrays([b.column(key).cast(pa.int64()), *map(ints, n[:5]), pa.array(base_failed(n)), pa.array(kept)], names)

    return map_arrow(docs.select(key, text), run, schema)
