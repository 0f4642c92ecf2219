"""Importance resampling towards a target distribution over hashed n-grams.

Segment deduplication: newlines cut the texts into lines.  Spark counts equal
lines first (combined before the shuffle, so a line that stands in every
document is one row a task); a distinct line's features are hashed once and
multiplied by its occurrences.  N-grams that run over a line end are not in any
line: a second scan adds just these.  A separator is never part of a word, so
both together are the features of the whole texts.

The bucket counts (as many rows as buckets, a parameter) go to the driver and
come back as one gain a bucket; documents are then weighed in place, from whole
texts, and only (id, score) rows are ordered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depot.llm.common import byte_slices, ints, map_arrow, scan_words, text_buffer
from depot.operators.keys import dense_keys

SLICE = 4 << 20
_LONG = 64                              # longer words go through zlib one by one
_FIRST = 0xFFFFFFFF


def _table() -> np.ndarray:
    """The byte table of CRC-32 (reversed polynomial 0xEDB88320), by its rule."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _table()


def _feed(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running CRC states after the bytes of one word each (buf is lower case)."""
    state = state.copy()
    sizes = ends - starts
    for i in np.flatnonzero(sizes > _LONG).tolist():
        state[i] = zlib.crc32(buf[starts[i]:ends[i]].tobytes(), int(state[i]) ^ _FIRST) ^ _FIRST
    live = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
    j = 0
    while len(live):
        now = state[live]
        state[live] = _CRC[(now ^ buf[starts[live] + j]) & np.uint32(255)] ^ (now >> np.uint32(8))
        j += 1
        live = live[sizes[live] > j]
    return state


def _lower(texts: pa.Array) -> np.ndarray:
    buf, _ = text_buffer(texts)
    return np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)


def features(texts: pa.Array, buckets: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(lower-case bytes, word starts, n+1 word offsets of the texts, for each
    width 1..n the (first word, bucket) of every run inside one text)."""
    _, starts, ends, off = scan_words(texts, True, letters_only=True)
    buf = _lower(texts)
    text_of = np.repeat(np.arange(len(off) - 1), np.diff(off))
    state = _feed(np.full(len(starts), _FIRST, np.uint32), buf, starts, ends)
    at = np.arange(len(starts))
    runs = []
    for width in range(1, n + 1):
        if width > 1:
            keep = at + width - 1 < len(starts)
            at, state = at[keep], state[keep]
            keep = text_of[at] == text_of[at + width - 1]
            at, state = at[keep], state[keep]
            state = _CRC[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))
            state = _feed(state, buf, starts[at + width - 1], ends[at + width - 1])
        runs.append((at, (state ^ np.uint32(_FIRST)).astype(np.int64) % buckets))
    return buf, starts, off, runs


def _counts(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    there = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([ints(there), ints(counts[there])], ["bucket", "n"])


def feature_counts(docs: DataFrame, text_col: str, buckets: int, n: int) -> np.ndarray:
    """Count of every bucket over all whole texts (null or empty: none)."""
    lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).filter(F.col("line") != "")
    distinct = lines.groupBy("line").agg(F.count(F.lit(1)).alias("times"))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "line", SLICE):
                times = part.column("times").to_numpy()
                _, _, off, runs = features(part.column("line"), buckets, n)
                of = np.repeat(np.arange(len(off) - 1), np.diff(off))
                for at, bucket in runs:
                    np.add.at(total, bucket, times[of[at]])
        yield from _counts(total)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                buf, starts, _, runs = features(part.column("text"), buckets, n)
                line = np.searchsorted(np.flatnonzero(buf == 10), starts)
                for width, (at, bucket) in enumerate(runs, 1):
                    total += np.bincount(bucket[line[at] != line[at + width - 1]], minlength=buckets)
        yield from _counts(total)

    parts = map_arrow(distinct, inside, "bucket long, n long")
    if n > 1:
        parts = parts.unionByName(map_arrow(docs.select(F.col(text_col).alias("text")), across, "bucket long, n long"))
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():       # as many rows as buckets at most
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of target to source, a bucket each."""
    k = float(len(source))
    ratio = (target + 1.0) * (float(source.sum()) + k) / ((source + 1.0) * (float(target.sum()) + k))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, n: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight) of every document, in place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                _, _, off, runs = features(part.column("text"), len(gain), n)
                of = np.repeat(np.arange(len(off) - 1), np.diff(off))
                size, weight = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                for at, bucket in runs:
                    size += np.bincount(of[at], minlength=part.num_rows)
                    np.add.at(weight, of[at], gain[bucket])
                yield pa.RecordBatch.from_arrays([part.column("id"), ints(np.diff(off)), ints(size), ints(weight)],
                                                 ["id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(seed: int, key: Column) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 8 hex digits of sha256 of ``seed:key``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, n: int = 1, buckets: int = 10_000, min_words: int = 20, seed: int = 2024,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its weight, score and rank: of the N documents with
    at least ``min_words`` words, the floor(percent * N / 100) highest scores
    are drawn, ranked 1, 2, ... with ties to the smaller id; undrawn rows have a
    null rank.  Returns (id_col, n_features, weight, score, rank).

    A null or empty text has no words, no features and weight 0.  A null id is
    hashed as empty and stands last among ties; repeated rows are each scored and
    ranked.  An empty target leaves the smoothed source alone; an empty table
    gives no rows.  Other columns do not matter.
    """
    gain = gains(feature_counts(docs, text_col, buckets, n), feature_counts(target, text_col, buckets, n))
    scored = weigh(docs, gain, n, id_col, text_col).withColumn("score", F.col("weight") + gumbel(seed, F.col("id")))
    scored = scored.select("id", "n_features", "weight", "score", (F.col("n_words") >= min_words).alias("fit"))
    order = [F.col("fit").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    ranked = dense_keys(scored, order, "place")
    drawn = ranked.agg(F.count_if("fit").alias("n")).first()["n"] * percent // 100
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
