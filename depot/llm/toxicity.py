"""Toxicity severity by cumulative-link ordinal regression.

Grades 0 (clean) to 3 come from binary labels: a toxic document's grade is
the tercile, among toxic labelled documents, of the amount (sum of log counts)
of terms that set these apart.
One weight vector is shared by all ordered thresholds,
P(grade >= j) = sigmoid(w.x - theta_j) with rising theta, fitted by maximum
likelihood with an L2 penalty; the severity is the expected grade, the sum of
these probabilities.  Features are log counts of selected words and word stems.

The model is fitted on at most about ``max_labelled`` labelled documents (a
hash sample of the labels); every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.llm.common import SLICE, byte_slices, folded, map_arrow, prefix_hashes, scan_words, stored
from depot.session import scratch_scope

GRADES = 4
PREFIXES = (4, 5, 6)
MIN_RATIO = 16.0                           # log-likelihood ratio of a selected term


class Model(NamedTuple):
    words: np.ndarray           # sorted hashes of the selected words
    weights: np.ndarray
    theta: np.ndarray           # GRADES - 1 rising thresholds


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term hashes, text of each term, words of each text): every word, and
    its first 4, 5 and 6 bytes, so that a stem counts whatever its ending."""
    texts = folded(texts)
    words, starts, ends, at = scan_words(texts, lower=True, letters_only=True)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    terms, owner = [words], [text]
    for size in PREFIXES:
        p = prefix_hashes(texts, starts, ends, size)
        terms.append(p[p != 0])
        owner.append(text[p != 0])
    return np.concatenate(terms), np.concatenate(owner), np.diff(at)


def _term_counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct terms, counts) of each text."""
    terms, owner, sizes = _terms(texts)
    order = np.argsort(owner, kind="stable")
    at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))])
    for i in range(len(sizes)):
        own, n = np.unique(terms[order[at[i]:at[i + 1]]], return_counts=True)
        yield own, n


def labelled_counts(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """``toxic`` and term counts of a bounded sample of labelled documents.

    Labels without id or verdict are left out; of repeated labels the highest counts."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if n > max_labelled:
        known = known.where(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(n)) < max_labelled)
    # broadcast of a proven size: about max_labelled rows of 12 bytes
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("toxic", "text")
    schema = "toxic int, words binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, "text", SLICE):
                got = list(_term_counts(b.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [b.column("toxic"), pa.array([g[0].tobytes() for g in got], pa.binary()),
                     pa.array([g[1].astype(np.int32).tobytes() for g in got], pa.binary())], ["toxic", "words", "counts"])

    return stored(map_arrow(rows, run, schema), "toxicity-labelled")


def _select(sample: DataFrame, features: int, min_docs: int) -> np.ndarray:
    """Sorted hashes of the terms that set toxic documents apart most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = b.column("toxic").to_numpy()
            own = [np.frombuffer(x, np.uint64) for x in b.column("words").to_pylist()]
            if not sum(map(len, own)):
                continue
            flags = np.repeat(toxic, [len(x) for x in own])
            words, inverse = np.unique(np.concatenate(own), return_inverse=True)
            bad = np.bincount(inverse, weights=flags, minlength=len(words)).astype(np.int64)
            every = np.bincount(inverse, minlength=len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(bad), pa.array(every - bad)], ["word", "bad", "good"])

    totals = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n_bad, n_good = float(totals[0] or 0), float(totals[1] - (totals[0] or 0))
    if not n_bad or not n_good:
        return np.zeros(0, np.uint64)
    # signed log-likelihood ratio of the term's documents being toxic more often than documents are
    every, share = F.col("bad") + F.col("good"), n_bad / (n_bad + n_good)
    part = lambda n, p: F.when(n > 0, n * F.log(n / (every * F.lit(p)))).otherwise(F.lit(0.0))
    ratio = 2 * (part(F.col("bad"), share) + part(F.col("good"), 1 - share))
    rows = (map_arrow(sample, run, "word long, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
            .where((F.col("bad") >= min_docs) & (F.col("bad") > every * F.lit(share)))
            .withColumn("ratio", ratio).where(F.col("ratio") >= MIN_RATIO).orderBy(F.desc("ratio"), "word").limit(features).select("word").collect())
    return np.sort(np.array([r.word for r in rows], np.int64).view(np.uint64))


def _lookup(words: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the sorted ``words``, which of ``own``) of the words that are there."""
    at = np.searchsorted(words, own)
    at[at == len(words)] = 0
    hit = np.flatnonzero(words[at] == own)
    return at[hit], hit


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, features: int,
                l2: float = 0.5, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights (none negative) and thresholds of the proportional-odds model on a
    sparse matrix (row, column, value), by Adam on the penalised log likelihood."""
    n, cuts = len(grade), GRADES - 1
    w = np.zeros(features)
    # start from the marginal shares; gaps are kept positive by a logarithm
    share = np.clip([(grade >= j).mean() for j in range(1, GRADES)], 1e-4, 1 - 1e-4)
    theta = -np.log(share / (1 - share))
    p = np.concatenate([w, theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        w, theta = p[:features], p[features] + np.concatenate([[0], np.cumsum(np.exp(p[features + 1:]))])
        eta = np.bincount(rows, weights=values * w[cols], minlength=n)
        above = np.concatenate([np.ones((n, 1)), _sigmoid(eta[:, None] - theta[None, :]), np.zeros((n, 1))], axis=1)
        slope = above * (1 - above)
        mine = np.maximum(above[np.arange(n), grade] - above[np.arange(n), grade + 1], 1e-12)
        d_eta = -(slope[np.arange(n), grade] - slope[np.arange(n), grade + 1]) / mine
        d_theta = np.zeros(cuts)
        for j in range(1, GRADES):
            d_theta[j - 1] = np.sum(slope[grade == j, j] / mine[grade == j]) - np.sum(slope[grade == j - 1, j] / mine[grade == j - 1])
        g = np.concatenate([np.bincount(cols, weights=values * d_eta[rows], minlength=features) + l2 * w,
                            [d_theta.sum()], np.exp(p[features + 1:]) * np.cumsum(d_theta[::-1])[::-1][1:]]) / n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        np.maximum(p[:features], 0, out=p[:features])       # a toxic term never lowers the severity
    return p[:features], p[features] + np.concatenate([[0], np.cumsum(np.exp(p[features + 1:]))])


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, features: int = 4096, min_docs: int = 4) -> Model:
    """Fit the model.  Without toxic or without clean labels nothing is toxic.
    The stored sample is freed; the model is all that stays."""
    with scratch_scope(docs.sparkSession):
        return _train(docs, labels, max_labelled, features, min_docs)


def _train(docs: DataFrame, labels: DataFrame, max_labelled: int, features: int, min_docs: int) -> Model:
    sample = labelled_counts(docs, labels, max_labelled)
    words = _select(sample, features, min_docs)
    if not len(words):
        return Model(np.zeros(1, np.uint64), np.zeros(1), np.full(GRADES - 1, 50.0))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x, c in zip(b.column("words").to_pylist(), b.column("counts").to_pylist()):
                at, hit = _lookup(words, np.frombuffer(x, np.uint64))
                out.append((at.astype(np.int32).tobytes(), np.frombuffer(c, np.int32)[hit].tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())],
                                             ["toxic", "at", "counts"])

    got = map_arrow(sample, sparse, "toxic int, at binary, counts binary").collect()      # about max_labelled rows
    at = [np.frombuffer(r["at"], np.int32) for r in got]
    rows, cols = np.repeat(np.arange(len(got)), [len(x) for x in at]), np.concatenate(at)
    counts = np.concatenate([np.frombuffer(r["counts"], np.int32) for r in got])
    toxic = np.array([r.toxic for r in got]) > 0
    amount = np.bincount(rows, weights=np.log1p(counts), minlength=len(got))
    cuts = np.quantile(amount[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + np.searchsorted(cuts, amount), 0)
    w, theta = fit_ordinal(rows, cols, np.log1p(counts), grade, len(words))
    return Model(words, w, theta)


def severity(texts: pa.Array, model: Model) -> np.ndarray:
    """P(grade >= 1), P(grade >= 2), ... of each text: an array of n x 3."""
    terms, owner, sizes = _terms(texts)
    near = np.zeros(1 << 16, bool)
    near[(model.words & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(near[(terms & np.uint64(0xFFFF)).astype(np.int64)])
    place, hit = _lookup(model.words, terms[maybe])
    cell, n = np.unique(owner[maybe[hit]] * len(model.words) + place, return_counts=True)
    eta = np.bincount(cell // len(model.words), weights=np.log1p(n) * model.weights[cell % len(model.words)], minlength=len(sizes))
    return _sigmoid(eta[:, None] - model.theta[None, :])


def score(docs: DataFrame, model: Model, limit: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``severity`` (expected grade, 0 to 3), ``p_toxic`` (of grade 1 or more),
    ``grade`` (the most grades whose probability reaches ``limit``) and
    ``toxic`` (grade > 0) of every document.

    Null or empty texts have no features and get the model's base rate; null
    or repeated keys are a row each; further columns are ignored; an empty
    table gives an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, text, SLICE):
                p = severity(b.column(text), model)
                grade = (p >= limit).sum(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(key).cast(pa.int64()), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(grade), pa.array(grade > 0)],
                                                 [key, "severity", "p_toxic", "grade", "toxic"])

    return map_arrow(docs.select(key, text), run, f"{key} long, severity double, p_toxic double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns.  Null or
    empty texts have the model's base rate; null and repeated keys are rows like
    any other; an empty table stays empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, text, SLICE):
                yield b.filter(pa.array(severity(b.column(text), model)[:, 0] < limit))

    return map_arrow(docs, run, docs.schema)
