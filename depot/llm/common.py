"""Shared helpers: table access, stored intermediates, batch slicing and a
vectorised word scanner over Arrow string buffers.

The scanner works on the raw UTF-8 bytes of a whole Arrow batch with numpy:
no per-word Python objects, bounded temporaries (1 MB pieces that end at a
separator), and 64-bit word hashes that do not depend on batch boundaries.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depot.session import scratch_path

#: Java regex of a word: everything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = 8 << 20
#: Bytes of text whose words a worker holds at once: some 30 times that in numbers.
SLICE = 1 << 20
_PIECE = 1 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_MULT = 0x9E3779B97F4A7C15 | 5          # odd; -1 of it is divisible by 4 only
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the folder that all executors share and read it
    back: cuts the lineage, and a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application
    (as spark-submit --py-files would): the functions of the operators live in it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parents[1]
        archive = os.path.join(tempfile.mkdtemp(prefix="depot-py-"), "depot.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    # batches that JVM and worker can both hold: a batch of texts ends at 8 MB
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(limit, str(BATCH_BYTES))


def release() -> None:
    """Give freed memory back to the system, so that a worker's size follows its batch."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _tidy(run: Callable) -> Callable:
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            release()
    return tidy


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(_tidy(run), schema)


def map_groups(df: DataFrame, keys: list[str], run: Callable, schema) -> DataFrame:
    """``applyInArrow`` with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(run, schema)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal (integer) keys in batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            key = tuple(cols[:, lo].tolist())
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# ---- rows by digest: which rows of a wide table are in a narrow list
_PROBES, _PAGE = 4, 1 << 16
_LEAST_BITS, _MOST_BITS = 1 << 19, 1 << 27


def digests(docs: DataFrame, first: str, second: str, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with two 64-bit digests of its columns (or of those named)."""
    names = [F.col(f"`{c}`") for c in columns or docs.columns]
    return docs.withColumns({first: F.xxhash64(*names), second: F.xxhash64(F.lit(2), *names)})


def _probe(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in range(1, _PROBES + 1):
        yield mix64(keys.astype(np.int64).view(np.uint64) + np.uint64((k * 0x9E3779B97F4A7C15) & _MASK)) & np.uint64(bits - 1)


def bloom(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of a column of longs: 16 bits a key up to 16 MB, a bound
    beyond which it only lets more rows through.  Tasks make pages of it, which
    are added before they reach the driver."""
    column = keys.columns[0]
    bits = min(_MOST_BITS, max(_LEAST_BITS, 1 << (16 * keys.count()).bit_length()))
    pages = bits // 8 // _PAGE

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 8, np.uint8)
        for b in batches:
            for at in _probe(b.column(column).to_numpy(), bits):
                np.bitwise_or.at(held, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        yield from _paged({k: x for k, x in enumerate(held.reshape(pages, _PAGE)) if x.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("page").to_pylist(), b.column("bits").to_pylist()):
                x = np.frombuffer(x, np.uint8)
                sums[k] = sums[k] | x if k in sums else x
        yield from _paged(sums)

    out = np.zeros((pages, _PAGE), np.uint8)
    schema = "page int, bits binary"
    for r in map_arrow(map_arrow(keys, part, schema).repartition(min(pages, 32), "page"), add, schema).collect():
        out[r.page] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def _paged(pages: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for k, x in pages.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["page", "bits"])


def maybe_in(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Is a key in the filter's list?  No is certain."""
    out = np.ones(len(keys), bool)
    for at in _probe(keys, 8 * len(bits)):
        out &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def passed(df: DataFrame, bits: np.ndarray, key: str, inside: bool) -> DataFrame:
    """The rows whose ``key`` may be in the filter (``inside``), or certainly is not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(maybe_in(bits, b.column(key).to_numpy()) == inside))

    return map_arrow(df, run, df.schema)


#: False alarms that tasks hold in memory (32 MB); beyond that they are joined.
_FEW = 1 << 18


def split(docs: DataFrame, listed: DataFrame, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """(rows in ``listed``, rows not in it) of a wide table with digests, by a
    stored list (first, second) of digests.  Most rows outside the list are told
    by a Bloom filter where they lie; the few others are found among the digests
    alone and stored, so that wide rows meet a short list at most: in the same
    pass while it is short, by a join of the rows that the filter lets through
    beyond that."""
    bits = bloom(listed.select(first))
    wrong = passed(docs.select(first, second), bits, first, True).join(listed, [first, second], "left_anti").distinct()
    wrong = stored(wrong, "false-alarms")
    if wrong.count() <= _FEW:
        alarms = set(zip(*(c.to_pylist() for c in wrong.select(first, second).toArrow().columns)))

        def side(inside: bool) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    found = maybe_in(bits, b.column(first).to_numpy())
                    at = np.flatnonzero(found)
                    ones, twos = (b.column(c).take(pa.array(at)).to_pylist() for c in (first, second))
                    found[at] = [x not in alarms for x in zip(ones, twos)]
                    yield b.filter(pa.array(found == inside))

            return map_arrow(docs, run, docs.schema)

        return side(True), side(False)
    near = passed(docs, bits, first, True)
    out = passed(docs, bits, first, False).unionByName(near.join(wrong, [first, second], "left_semi").select(docs.columns))
    return near.join(wrong, [first, second], "left_anti").select(docs.columns), out


def repeated(df: DataFrame, times: str, number: str, run: int = 10_000) -> DataFrame:
    """Each row as often as ``times`` says, numbered 0, 1, ...: in runs, so that
    no array is as long as the count of a very common row."""
    runs = F.sequence(F.lit(0).cast("long"), (F.col(times) - 1).cast("long"), F.lit(run).cast("long"))
    last = F.least(F.col(number) + run, F.col(times)) - 1
    return df.where(F.col(times) > 0).withColumn(number, F.explode(runs)).withColumn(number, F.explode(F.sequence(F.col(number), last.cast("long"))))


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with at most ``limit`` bytes of ``column`` each
    (one row may be larger: it is then alone)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and total + n > limit:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    yield batch.slice(at)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(_PIECE + 1, _MULT & _MASK, np.uint64), np.full(_PIECE + 1, pow(_MULT, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@cache
def _alphabet(lower: bool, letters_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is word byte, random code of each byte); A-Z share the codes of a-z if lowered."""
    code = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT)) | np.uint64(1)
    if lower:
        code[65:91] = code[97:123]
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    if letters_only:
        word[:128] = False
        word[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    return word, code


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, n+1 offsets); null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and len(off) else np.zeros(0, np.uint8)
    return buf, off - off[0]


def folded(texts: pa.Array) -> pa.Array:
    """Lower case of all scripts."""
    return pc.utf8_lower(texts)


def scan_words(texts: pa.Array, lower: bool, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text: (hash, start byte, end byte) per word and n+1
    offsets of the texts' words.  A word is a run without ASCII white space,
    or (``letters_only``) of ASCII letters, digits and non-ASCII bytes."""
    buf, off = text_buffer(texts)
    word, code = _alphabet(lower, letters_only)
    up, down = _powers()
    hashes, starts, ends = [], [], []
    at = 0
    while at < len(buf):
        to = min(at + _PIECE, len(buf))
        if to < len(buf):                               # end the piece at a separator or a text's end
            gap = np.flatnonzero(~word[buf[at:to]])
            edge = off[np.searchsorted(off, to, side="right") - 1]
            cut = max(at + int(gap[-1]) + 1 if len(gap) else 0, int(edge))
            to = cut if cut > at else to
            while cut <= at and to < len(buf) and word[buf[to]]:   # one word longer than a piece
                to += 1
        raw = buf[at:to]
        inside = np.zeros(to - at + 2, bool)
        inside[1:-1] = word[raw]
        first = np.zeros(to - at + 1, bool)             # a text begins here
        lo, hi = np.searchsorted(off, (at, to))
        first[off[lo:hi] - at] = True
        first[-1] = True
        now, before = inside[1:], inside[:-1]           # now[i]: byte i is in a word (i = len: no)
        begin = np.flatnonzero(now & (~before | first))
        end = np.flatnonzero(before & (~now | first))
        if to - at > _PIECE:                            # the one very long word: in steps
            value = np.zeros(1, np.uint64)
            for k in range(0, to - at, _PIECE):
                part = code[raw[k:k + _PIECE]] * up[:len(raw[k:k + _PIECE])]
                value = mix64(value ^ np.add.reduce(part))
            hashes.append(np.resize(value, len(begin)))
        else:
            total = np.zeros(to - at + 1, np.uint64)
            np.cumsum(code[raw] * up[:to - at], out=total[1:])
            hashes.append(mix64((total[end] - total[begin]) * down[begin]))
        starts.append(begin + at)
        ends.append(end + at)
        at = to
    cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start = cat(starts, np.int64)
    return cat(hashes, np.uint64), start, cat(ends, np.int64), np.searchsorted(start, off)


def prefix_hashes(texts: pa.Array, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Hash of the first ``size`` bytes of each word (A-Z as a-z); 0 for shorter words."""
    buf, _ = text_buffer(texts)
    _, code = _alphabet(True, False)
    long = np.flatnonzero(ends - starts >= size)
    value = np.full(len(long), size, np.uint64)
    for j in range(size):
        value *= np.uint64(_MULT)
        value += code[buf[starts[long] + j]]
    out = np.zeros(len(starts), np.uint64)
    out[long] = mix64(value)
    return out


def shingle_sets(words: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each text as 64-bit hashes: (hashes,
    sorted within each text; n+1 offsets).  A text with fewer words has its
    whole sequence as one shingle; one without words has none."""
    n = len(offsets) - 1
    counts = np.diff(offsets)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    whole = np.zeros(len(words), np.uint64)
    for j in range(width):
        whole = whole * np.uint64(_MULT) + padded[j:j + len(words)]
    whole = mix64(whole)
    out, sizes = [], np.zeros(n, np.int64)
    for i in range(n):
        k = int(counts[i])
        if not k:
            continue
        a = int(offsets[i])
        if k < width:
            value = np.uint64(k)
            with np.errstate(over="ignore"):
                for j in range(k):
                    value = value * np.uint64(_MULT) + words[a + j]
            piece = mix64(np.array([value], np.uint64))
        else:
            piece = np.sort(whole[a:a + k - width + 1])
            if len(piece) > 1:
                keep = np.empty(len(piece), bool)
                keep[0] = True
                np.not_equal(piece[1:], piece[:-1], out=keep[1:])
                piece = piece[keep]
        out.append(piece)
        sizes[i] = len(piece)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def ints(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).astype(np.int64, copy=False))
