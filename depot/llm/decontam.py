"""Benchmark decontamination by latent semantic retrieval.

1. Vocabulary: the words of the benchmark items.  One pass counts in how many
   documents each occurs and keeps, of every passage of every document, the
   places of its words in the vocabulary.
2. Randomised SVD of the TF-IDF matrix A of items and all passages: Spark tasks
   sum the products of the words that share a passage, which are added by
   blocks of rows to A'A.  A random test matrix is multiplied by it,
   orthonormalised, multiplied again, and a small eigenproblem gives the latent
   basis.  For a vocabulary too wide for A'A the passages are multiplied with
   the test matrix each time instead.
3. Search: every window of every whole document is projected and compared with
   the items of its length class in blocks; windows above a cosine limit are
   candidates.  Items are classed by powers of two of their words and each class
   has windows and a stride of its own, so a long item widens no window of a
   short one.  Vectors of wide spans are sums of those of the narrowest.
4. A candidate is a leak if the longest common subsequence of words covers
   enough of the item and of the rarer half of its words, or covers less but
   the item's answer (its last sentence) stands in the window: a paraphrase.

Items are taken in blocks of at most ``block_items``, each a pass of its own,
so what tasks hold is bounded for a benchmark of any size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.llm.common import SLICE, byte_slices, folded, map_arrow, release, scan_words, stored
from depot.session import scratch_scope


class Item(NamedTuple):
    item_id: int
    words: np.ndarray           # hashes in order
    answer: np.ndarray          # hashes of the last sentence
    rare: np.ndarray            # hashes of the rarer half of the words, in order


class Index(NamedTuple):
    vocabulary: np.ndarray      # sorted word hashes
    idf: np.ndarray
    basis: np.ndarray           # vocabulary x rank, float32
    items: list[Item]
    latent: np.ndarray          # rank x items, unit columns
    span: int                   # words in half a passage


_CHUNK = 1 << 12                            # tokens whose latent rows are held at once
_GATHER = 1 << 9                            # the same where they are only summed: a processor's cache holds them
_CELLS = 1 << 13                            # narrowest spans whose vectors are held at once
_LEAST = 4                                  # words in the narrowest span
_SQUARE = 4096                              # words up to which a task holds half of A'A (32 MB)
_PAIRS = 1 << 16                            # pairs of words that are summed at once
_ROWS = 1 << 10                             # passages whose products are made at once
_PART = 1 << 19                             # bytes of a block of rows of A'A: less than half a region of a JVM's heap
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def _hashes(text: str) -> np.ndarray:
    return scan_words(folded(pa.array([text or ""])), lower=True, letters_only=True)[0]


def make_items(rows: list[tuple[int, str]]) -> list[Item]:
    """Items with a word; the answer is the last sentence with three words or more, else the whole."""
    out = []
    for item_id, text in rows:
        words = _hashes(text)
        if len(words):
            ends = [h for h in map(_hashes, _SENTENCE.split(text)) if len(h) >= 3]
            out.append(Item(item_id, words, ends[-1] if ends else words, words))
    return out


def _with_rare(item: Item, idf: np.ndarray) -> Item:
    return item._replace(rare=item.words[idf >= np.median(idf)])


def _places(vocabulary: np.ndarray):
    """A function: places in the vocabulary (-1: none) of word hashes."""
    near = np.zeros(1 << 20, bool)
    near[(vocabulary & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def places(words: np.ndarray) -> np.ndarray:
        out = np.full(len(words), -1, np.int32)
        maybe = np.flatnonzero(near[(words & np.uint64(0xFFFFF)).astype(np.int64)])
        at = np.searchsorted(vocabulary, words[maybe])
        at[at == len(vocabulary)] = 0
        good = vocabulary[at] == words[maybe]
        out[maybe[good]] = at[good]
        return out
    return places


def _count(docs: DataFrame, vocabulary: np.ndarray, span: int) -> DataFrame:
    """Rows of two kinds: (place, documents) partial counts, and (-1, places of
    the words of a passage), of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _places(vocabulary)
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            out = []
            for b in byte_slices(batch, "text", SLICE):
                words, _, _, at = scan_words(folded(b.column("text")), lower=True, letters_only=True)
                where = places(words)
                hit = np.flatnonzero(where >= 0)
                doc = np.searchsorted(at, hit, side="right") - 1
                cells = np.unique(doc * len(vocabulary) + where[hit])
                total += np.bincount(cells % len(vocabulary), minlength=len(vocabulary))
                for i in range(b.num_rows):
                    for k in range(at[i], at[i + 1], 2 * span):
                        own = where[k:min(k + 2 * span, at[i + 1])]
                        own = own[own >= 0]
                        if len(own):
                            out.append(own.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([-1] * len(out), pa.int32()), pa.array([0] * len(out), pa.int64()), pa.array(out, pa.binary())],
                                             ["place", "docs", "passage"])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at]), pa.nulls(len(at), pa.binary())], ["place", "docs", "passage"])

    return stored(map_arrow(docs.select("text"), run, "place int, docs long, passage binary"), "decontam-counts")


def _tfidf(passages: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse unit rows: (row, column, value) of passages given as places."""
    rows = np.repeat(np.arange(len(passages)), [len(p) for p in passages])
    cols = np.concatenate(passages) if passages else np.zeros(0, np.int64)
    cell, n = np.unique(rows * len(idf) + cols, return_counts=True)
    rows, cols = cell // len(idf), cell % len(idf)
    values = n * idf[cols]
    norm = np.sqrt(np.bincount(rows, weights=values ** 2, minlength=len(passages)))
    return rows, cols, values / np.maximum(norm[rows], 1e-12)


def _gram(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n: int, q: np.ndarray) -> np.ndarray:
    """A'(A q) of sparse rows."""
    y = np.zeros((n, q.shape[1]))
    order = np.argsort(rows, kind="stable")
    rows, cols, values = rows[order], cols[order], values[order]
    for at in range(0, len(rows), _CHUNK):             # bounded temporaries
        r, c, v = rows[at:at + _CHUNK], cols[at:at + _CHUNK], values[at:at + _CHUNK]
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        y[r[first]] += np.add.reduceat(q[c] * v[:, None], first, axis=0)
    z = np.zeros_like(q)
    order = np.argsort(cols, kind="stable")
    rows, cols, values = rows[order], cols[order], values[order]
    for at in range(0, len(rows), _CHUNK):
        r, c, v = rows[at:at + _CHUNK], cols[at:at + _CHUNK], values[at:at + _CHUNK]
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        z[c[first]] += np.add.reduceat(y[r] * v[:, None], first, axis=0)
    return z


def _passages(batch: pa.RecordBatch, size: int) -> Iterator[list[np.ndarray]]:
    column = batch.column("passage")
    for at in range(0, len(column), size):
        yield [np.frombuffer(x, np.int32).astype(np.int64) for x in column.slice(at, size).to_pylist()]


def _corners(n: int) -> np.ndarray:
    """Where the rows of a packed upper triangle would begin: cell (i, j) stands at ``corners[i] + j``."""
    i = np.arange(n, dtype=np.int64)
    return i * n - i * (i + 1) // 2


def _add_products(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n: int, corners: np.ndarray, out: np.ndarray) -> None:
    """Add A'A of sparse rows (columns in order) to ``out``, a packed upper triangle."""
    end = np.cumsum(np.bincount(rows, minlength=n))
    partners = end[rows] - np.arange(len(rows))        # a cell meets itself and those behind it in its row
    done = np.concatenate([[0], np.cumsum(partners)])
    values, wide = values.astype(out.dtype), corners[cols]
    lo = 0
    while lo < len(rows):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + _PAIRS, side="right")) - 1)
        k = partners[lo:hi]
        right = np.arange(int(done[hi] - done[lo])) + np.repeat(np.arange(lo, hi) - (done[lo:hi] - done[lo]), k)
        np.add.at(out, np.repeat(wide[lo:hi], k) + cols[right], np.repeat(values[lo:hi], k) * values[right])
        lo = hi


def _unpacked(half: np.ndarray, corners: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Whole rows ``lo`` to ``hi`` of the symmetric matrix of a packed upper triangle."""
    own, every = np.arange(lo, hi)[:, None], np.arange(len(corners))[None, :]
    return half[corners[np.minimum(own, every)] + np.maximum(own, every)]


def _add_blocks(parts: DataFrame, blocks: int) -> DataFrame:
    """Sums of the (block, part) rows of equal block."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("block").to_pylist(), b.column("part")):
                x = np.frombuffer(x.as_buffer(), np.float32)
                if k in sums:
                    sums[k] += x
                else:
                    sums[k] = x.astype(np.float64)
        for k in list(sums):                            # one at a time
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sums.pop(k).tobytes()], pa.binary())], ["block", "part"])

    return map_arrow(parts.repartition(min(blocks, 8), "block"), add, "block int, part binary")


def _by_blocks(z: np.ndarray, block: int, first: int = 0) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, numbered from ``first``, one at a time."""
    for k in range(0, len(z), block):
        part = np.ascontiguousarray(z[k:k + block], np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([first + k // block], pa.int32()), pa.array([part], pa.binary())], ["block", "part"])


def _block(n: int) -> int:
    """Rows of A'A in a block: as doubles they stay under ``_PART``, since the
    JVMs copy every block some times and set arrays of half a region or more
    apart, each in regions of its own."""
    return max(1, (_PART - 4096) // (8 * n))


def _square(passages: DataFrame, idf: np.ndarray) -> DataFrame:
    """A'A of all passages by blocks of rows, stored: a partial sum per task, added in Spark."""
    n, block = len(idf), _block(len(idf))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corners = _corners(n)
        half = np.zeros(n * (n + 1) // 2, np.float32)
        for b in batches:
            for own in _passages(b, _ROWS):
                _add_products(*_tfidf(own, idf), len(own), corners, half)
            release()
        for k in range(0, n, block):                                    # what stands above the diagonal, below it too
            yield from _by_blocks(_unpacked(half, corners, k, min(k + block, n)), block, k // block)

    # half a square for each task: so many tasks that all cores work, not one for each file
    few = passages.coalesce(2 * passages.sparkSession.sparkContext.defaultParallelism)
    return stored(_add_blocks(map_arrow(few, part, "block int, part binary"), -(-n // block)), "decontam-square")


def _times(square: DataFrame, q: np.ndarray) -> np.ndarray:
    """(A'A) q, a block of rows at a time in Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, x in zip(b.column("block"), b.column("part")):
                out = (np.frombuffer(x.as_buffer(), np.float64).reshape(-1, len(q)) @ q).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k.as_py()], pa.int32()), pa.array([out], pa.binary())], ["block", "part"])

    return _collected(map_arrow(square, run, "block int, part binary"), q, _block(len(q)))


def _collected(blocks: DataFrame, q: np.ndarray, block: int) -> np.ndarray:
    z = np.zeros_like(q)
    for r in blocks.collect():                          # vocabulary x rank numbers in all
        z[r.block * block:(r.block + 1) * block] = np.frombuffer(r.part, np.float64).reshape(-1, q.shape[1])
    return z


def _spark_gram(passages: DataFrame, idf: np.ndarray, q: np.ndarray, block: int = 512) -> np.ndarray:
    """A'(A q) over all passages: a partial product per task, added by blocks of rows."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.zeros_like(q)
        for b in batches:
            for own in _passages(b, 4096):
                z += _gram(*_tfidf(own, idf), len(own), q)
        yield from _by_blocks(z, block)

    return _collected(_add_blocks(map_arrow(passages, part, "block int, part binary"), -(-len(q) // block)), q, block)


def build_index(docs: DataFrame, items: list[Item], n_docs: int, rank: int = 256, seed: int = 7) -> Index:
    """Fit the latent space on the items and on all passages of all documents
    (items weigh as much as the passages).  Word statistics are of all documents."""
    vocabulary = np.unique(np.concatenate([i.words for i in items]))
    span = max(32, int(np.sort(_spans(items))[len(items) // 2]))
    rows = _count(docs, vocabulary, span)
    df = np.zeros(len(vocabulary))
    for r in rows.where("place >= 0").groupBy("place").agg(F.sum("docs").alias("docs")).collect():     # a row per benchmark word
        df[r.place] = r.docs
    idf = np.log((n_docs + 1.0) / (df + 1.0)) + 1e-3
    items = [_with_rare(i, idf[np.searchsorted(vocabulary, i.words)]) for i in items]
    passages = rows.where("place < 0").select("passage")
    n_passages = passages.count()
    own = _tfidf([np.searchsorted(vocabulary, i.words) for i in items], idf)
    weight = max(1.0, n_passages / len(items))
    width = min(len(vocabulary), rank + 16)
    q = np.random.default_rng(seed).standard_normal((len(vocabulary), width))

    square = _square(passages, idf) if n_passages and len(vocabulary) <= _SQUARE else None

    def gram(q: np.ndarray) -> np.ndarray:
        z = weight * _gram(*own, len(items), q)
        if n_passages:
            z += _spark_gram(passages, idf, q) if square is None else _times(square, q)
        return z

    for _ in range(2):
        q = np.linalg.qr(gram(q))[0]
    t = q.T @ gram(q)
    _, u = np.linalg.eigh((t + t.T) / 2)
    basis = (q @ u[:, ::-1][:, :rank]).astype(np.float32)
    latent = np.zeros((len(items), basis.shape[1]), np.float32)
    np.add.at(latent, own[0], basis[own[1]] * own[2][:, None].astype(np.float32))
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return Index(vocabulary, idf, basis, items, np.ascontiguousarray(latent.T), span)


def _spans(items: list[Item]) -> np.ndarray:
    """Words in half a window of each item: its length up to the next power of two."""
    return np.array([max(_LEAST, 1 << (len(i.words) - 1).bit_length()) for i in items], np.int64)


def _pieces(at: np.ndarray, step: int, over: int) -> Iterator[list[tuple[int, int, int, int]]]:
    """Runs of pieces (text, first word, end, end of the words that begin
    windows) of about ``step`` words; a longer text is cut, its pieces reach
    ``over`` words into the next."""
    run, total = [], 0
    for t in range(len(at) - 1):
        lo, end = int(at[t]), int(at[t + 1])
        while lo < end:
            own = end if end - lo <= step + over else lo + step
            to = min(own + over, end)
            if run and total + to - lo > step + over:
                yield run
                run, total = [], 0
            run.append((t, lo, to, own))
            total += to - lo
            lo = own
    if run:
        yield run


def candidates(where: np.ndarray, at: np.ndarray, index: Index, limit: float) -> list[tuple[int, int, int, float]]:
    """(text, first word, item, cosine) of the windows whose latent cosine
    with an item reaches ``limit``.  A window is two neighbouring spans of the
    item's length class, so an item lies whole in some window and fills a
    quarter of it or more; a window's vector is the sum of its spans' vectors."""
    own = _spans(index.items)
    least, most = int(own.min()), int(own.max())
    classes = {int(s): np.flatnonzero(own == s) for s in np.unique(own)}
    latent = {s: np.ascontiguousarray(index.latent[:, members]) for s, members in classes.items()}
    weighted = index.basis * index.idf.astype(np.float32)[:, None]
    rows_of = np.empty((_GATHER, weighted.shape[1]), np.float32)
    step = max(1, _CELLS * least // most) * most
    out = []
    for run in _pieces(at, step, most):
        text, first, end, owned = (np.array(x, np.int64) for x in zip(*run))
        count = -(-(end - first) // least)
        base = np.concatenate([[0], np.cumsum(count)])
        vectors = np.zeros((int(base[-1]), index.basis.shape[1]), np.float32)
        hits = [f + np.flatnonzero(where[f:e] >= 0) for f, e in zip(first.tolist(), end.tolist())]       # pieces of a text overlap
        hit, piece = np.concatenate(hits), np.repeat(np.arange(len(run)), [len(h) for h in hits])
        cell = base[piece] + (hit - first[piece]) // least
        for k in range(0, len(hit), _GATHER):
            c, w = cell[k:k + _GATHER], where[hit[k:k + _GATHER]]
            begin = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            vectors[c[begin]] += np.add.reduceat(np.take(weighted, w, axis=0, out=rows_of[:len(w)], mode="clip"), begin, axis=0)
        span = least
        while True:
            owner = np.repeat(np.arange(len(run)), count)
            place = np.arange(len(owner)) - base[owner]
            if span in classes:
                start = first[owner] + place * span
                for k in range(0, len(vectors), 4096):
                    rows = np.arange(k, min(k + 4096, len(vectors)))
                    block = vectors[k:k + 4096].copy()
                    more = rows[rows + 1 < len(vectors)]
                    np.add(block[:len(more)], vectors[k + 1:k + 1 + len(more)], out=block[:len(more)], where=(owner[more] == owner[more + 1])[:, None])
                    norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", block, block)), 1e-9)
                    cos = block @ latent[span] / norm[:, None]
                    for r, i in zip(*np.nonzero(cos >= limit)):
                        if start[k + r] < owned[owner[k + r]]:
                            out.append((int(text[owner[k + r]]), int(start[k + r]), int(classes[span][i]), float(cos[r, i])))
            if span == most:
                break
            vectors = np.add.reduceat(vectors, np.flatnonzero(place % 2 == 0), axis=0)     # two spans are one of the next width
            count = -(-count // 2)
            base = np.concatenate([[0], np.cumsum(count)])
            span *= 2
    return out


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one integer."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        m = masks.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _matches(texts: pa.Array, places, index: Index, limit: float, strong: float = 0.75, weak: float = 0.55) -> dict[tuple[int, int], tuple[int, bool]]:
    """(text, item): common words in the best window and whether the answer stands there."""
    words, _, _, at = scan_words(folded(texts), lower=True, letters_only=True)
    where = places(words)
    best: dict[tuple[int, int], tuple[int, bool]] = {}
    spans = _spans(index.items).tolist()
    for t, start, i, _ in candidates(where, at, index, limit):
        item, more = index.items[i], spans[i] // 4                      # put-in words may reach beyond the window
        begin, end = max(start - more, at[t]), min(start + 2 * spans[i] + more, at[t + 1])
        own = words[begin:end]
        n = common_subsequence(item.words, own[where[begin:end] >= 0])
        if n < weak * len(item.words):
            continue
        rare = common_subsequence(item.rare, own) / len(item.rare)      # frequent words alone prove nothing
        answer = common_subsequence(item.answer, own) >= 0.8 * len(item.answer)
        if n >= strong * len(item.words) and rare >= strong or answer and rare >= weak:
            best[t, i] = max(best.get((t, i), (0, False)), (n, answer))
    return best


def find(docs: DataFrame, index: Index, limit: float) -> DataFrame:
    """``doc_id``, ``item_id``, ``item_words``, ``common_words`` (of the best
    window) and ``answer_found`` of every leak: at least three quarters of the
    item's words in order, or 55 % and four fifths of the answer's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _places(index.vocabulary)
        for batch in batches:
            out = []
            for b in byte_slices(batch, "text", SLICE):
                ids = b.column("doc_id").to_pylist()
                out += [(ids[t], index.items[i].item_id, len(index.items[i].words), n, a)
                        for (t, i), (n, a) in _matches(b.column("text"), places, index, limit).items()]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], [c.split()[0] for c in _LEAK.split(", ")])

    return map_arrow(docs.select("doc_id", "text"), run, _LEAK)


_LEAK = "doc_id long, item_id long, item_words int, common_words int, answer_found boolean"


def _indexes(docs: DataFrame, benchmark: DataFrame, block_items: int, rank: int) -> Iterator[Index]:
    """An index for each block of items (hash blocks of about half ``block_items``, or one block)."""
    n_items, n_docs = benchmark.count(), docs.count()
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    n_blocks = -(-2 * n_items // block_items) if n_items > block_items else 1
    for k in range(n_blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()
        items = make_items(sorted((tuple(r) for r in own), key=lambda r: (r[0] is None, r)))
        if items and n_docs:
            with scratch_scope(docs.sparkSession):      # the index itself is in the driver, of a size bounded by the block
                index = build_index(docs, items, n_docs, rank)
            yield index


def leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = 512, rank: int = 256, limit: float = 0.3) -> DataFrame:
    """Leaks of every benchmark item in every whole document, a row per
    document and item.

    Null or wordless items match nothing and null texts are empty; documents
    are told apart by doc_id (rows of a repeated doc_id: a row each; a null
    doc_id is reported as null); an empty table on either side gives an empty
    result; further columns are ignored."""
    out = docs.sparkSession.createDataFrame([], _LEAK)
    for index in _indexes(docs, benchmark, block_items, rank):
        out = out.unionByName(find(docs, index, limit))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, block_items: int = 512, rank: int = 256, limit: float = 0.3) -> DataFrame:
    """The rows of ``docs`` in which no item of ``benchmark`` is found, with all
    their columns: a narrow pass for each block of items.  Null texts hold
    nothing and stay; repeated rows and null ids are rows like any other; an
    empty table on either side leaves ``docs`` as it is."""
    for index in _indexes(docs, benchmark, block_items, rank):
        docs = _drop(docs, index, limit)
    return docs


def _drop(docs: DataFrame, index: Index, limit: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _places(index.vocabulary)
        for batch in batches:
            for b in byte_slices(batch, "text", SLICE):
                clean = np.ones(b.num_rows, bool)
                clean[[t for t, _ in _matches(b.column("text"), places, index, limit)]] = False
                yield b.filter(pa.array(clean))

    return map_arrow(docs, run, docs.schema)
