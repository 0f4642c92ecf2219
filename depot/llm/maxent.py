"""Language-model scores from a hashed maximum-entropy model.

P(word | history) = P(class | history) * P(word | class, previous word).

The class softmax has hashed features of the history: the previous word, the
previous two, and the word before the previous one (a skip).

The word softmax of a class has a bias per word (the log of its smoothed share
p of the class) and a weight for each pair of neighbouring words of the
training documents.  With a prior of strength k the best weight of a pair seen
n times is log(1 + n / (k p)), and its normaliser 1 + N / k, where N is how
often the class follows the previous word.  So these weights need counts of
pairs only, and as many pairs are learnt as the training documents hold: the
counts stay in Spark, dealt over tasks by their hashes, and never meet in one
place.  k is the value of ``STRENGTHS`` that gives all training tokens the
highest likelihood when each is left out of its own counts.

The 2**17 most frequent training words are the dictionary (a bound on what
tasks hold); a dictionary word's class is its context cluster (which frequent
words stand around it) with a frequency band.  All other words, and the one
unknown word, are the class of rare words.

1. Whole texts become blocks of word numbers (about 4 MB of text each), kept
   in the shared folder.
2. Every training word is counted over all blocks (a row per distinct word of
   a block goes through the shuffle).
3. The most frequent words are clustered by whom they stand next to; each
   dictionary word's neighbours are counted in tables of dictionary x clusters.
4. Class weights: a start from feature counts, then synchronous gradient
   rounds; each round is a Spark job over all training documents, gradients
   are added by blocks of rows, and the driver holds the bounded weight tables
   only.
5. Each block asks for the counts of its pairs and rare words: it deals their
   hashes over ranges of the hash space, as many as the tokens need; a task adds
   up what the blocks counted in a range, and answers each block.
6. Scores in numpy batches, blocks beside their answers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depot.llm.common import _MULT, byte_slices, ints, map_arrow, map_groups, mix64, release, scan_words, stored
from depot.session import scratch_path, scratch_scope

BLOCK_BYTES = 4 << 20
END = np.uint64(0x2545F4914F6CDD1D)         # the end token's hash
DICTIONARY, SEEDS, CLUSTERS, BANDS = 1 << 17, 512, 8, (3e-5,)
RARE = CLUSTERS * (len(BANDS) + 1)          # the class of the words beyond the dictionary
CLASSES = RARE + 1
BUCKETS, ROUNDS = 1 << 13, 4
STRENGTHS = (0.5, 2.0, 8.0, 32.0, 128.0)
RANGE_TOKENS = 1 << 20                      # tokens to a range of the hash space
_STEP = 1 << 16                             # tokens in a numpy batch
_CODE = 40                                  # bits of a pair's hash within its range


# -- blocks ------------------------------------------------------------------

_BLOCK = "block long, size long, doc_ids array<long>, held binary, tokens binary, numbers binary, words binary"


def _pack(numbers: np.ndarray, width: int = 4) -> bytes:
    """Numbers below 256**width as byte planes, compressed: the high ones are nearly all zero."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return len(numbers).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes.T), "zstd", asbytes=True)


def _unpack(data: bytes, width: int = 4) -> np.ndarray:
    data = memoryview(data)
    n = int.from_bytes(data[:8], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(data[8:], n * width, "zstd"), np.uint8).reshape(width, n).T
    return out.view("<i8").reshape(-1)


def encode(docs: DataFrame, held_out: Column, key: str, text: str) -> DataFrame:
    """Blocks of documents: ids, held-out flags, tokens per document, the
    number of each token among the block's distinct words (most frequent
    first), and these words' hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in byte_slices(batch, text, BLOCK_BYTES):
                words, _, _, at = scan_words(b.column(text), lower=True)
                n = b.num_rows
                sizes = np.diff(at) + 1
                every = np.insert(words, at[1:], END)
                del words
                own, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
                del every
                rank = np.argsort(-count, kind="stable")
                place = np.empty(len(own), np.int64)
                place[rank] = np.arange(len(own))
                held = b.column("_held").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 16) + k]), pa.array([len(inverse)]), pa.array([b.column(key).cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
                     pa.array([held.tobytes()], pa.binary()), pa.array([sizes.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([_pack(place[inverse])], pa.binary()), pa.array([own[rank].tobytes()], pa.binary())],
                    [c.split()[0] for c in _BLOCK.split(", ")])
                k += 1

    return stored(map_arrow(docs.select(key, text, held_out.alias("_held")), run, _BLOCK), "maxent-blocks")


class Block(NamedTuple):
    held: np.ndarray            # per document
    tokens: np.ndarray          # per document
    numbers: np.ndarray         # per token
    words: np.ndarray           # per distinct word
    doc: np.ndarray             # per token
    train: np.ndarray           # per token


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            b = batch.slice(i, 1)
            get = lambda c: b.column(c)[0].as_py()  # noqa: B023,E731
            held, tokens = np.frombuffer(get("held"), bool), np.frombuffer(get("tokens"), np.int32).astype(np.int64)
            doc = np.repeat(np.arange(len(tokens), dtype=np.int32), tokens)
            yield b, Block(held, tokens, _unpack(get("numbers")), np.frombuffer(get("words"), np.uint64), doc, ~held[doc])
            release()


def _add_tables(parts: DataFrame, rows: int, width: int) -> np.ndarray:
    """Sum of tables sent as (block of rows, float64 numbers), added in Spark;
    the driver gets one table of rows x width."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("rows").to_pylist(), b.column("part")):
                x = np.frombuffer(x.as_buffer(), np.float32).astype(np.float64)
                sums[k] = sums[k] + x if k in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["rows", "part"])

    out, step = np.zeros((rows, width)), _rows_a_part(rows)
    for r in map_arrow(parts.repartition(-(-rows // step), "rows"), add, "rows int, part binary").collect():
        out[r.rows * step:(r.rows + 1) * step] += np.frombuffer(r.part, np.float64).reshape(-1, width)
    return out


def _rows_a_part(rows: int) -> int:
    return max(1, -(-rows // 24))


def _parts(total: np.ndarray) -> pa.RecordBatch:
    step = _rows_a_part(len(total))
    at = range(0, len(total), step)
    return pa.RecordBatch.from_arrays([pa.array([k // step for k in at], pa.int32()), pa.array([total[k:k + step].astype(np.float32).tobytes() for k in at], pa.binary())], ["rows", "part"])


# -- word classes --------------------------------------------------------------

def _pairs(b: Block, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of training tokens and of the tokens ``at`` before them in the same document."""
    later = np.arange(at, len(b.numbers))
    later = later[(b.doc[later] == b.doc[later - at]) & b.train[later]]
    return later, later - at


def count_words(blocks: DataFrame) -> DataFrame:
    """``word`` and ``c`` (training tokens) of every training word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, b in _blocks(batches):
            n = np.bincount(b.numbers[b.train], minlength=len(b.words))
            rows = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(b.words[rows].view(np.int64)), ints(n[rows])], ["word", "c"])

    return stored(map_arrow(blocks, run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "maxent-counts")


class Words(NamedTuple):
    """The dictionary: sorted hashes, counts, classes."""
    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray


def _seed_of(seeds: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Place among the seeds of each word, or -1."""
    if not len(seeds):
        return np.full(len(words), -1)
    at = np.searchsorted(seeds, words)
    at[at == len(seeds)] = 0
    return np.where(seeds[at] == words, at, -1)


def cluster_seeds(blocks: DataFrame, seeds: np.ndarray) -> np.ndarray:
    """Context cluster of each frequent word: k-means on the leading
    eigenvectors of their positive pointwise mutual information."""
    n = len(seeds)
    if n <= CLUSTERS:
        return np.arange(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n)
        for _, b in _blocks(batches):
            own = _seed_of(seeds, b.words)[b.numbers]
            for at in (1, 2):
                x, y = _pairs(b, at)
                good = (own[x] >= 0) & (own[y] >= 0)
                total += np.bincount(own[x[good]] * n + own[y[good]], minlength=n * n)
        yield _parts(total.reshape(n, n))

    met = _add_tables(map_arrow(blocks, run, "rows int, part binary"), n, n)
    met = met + met.T
    share = met.sum(axis=1) / max(met.sum(), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        pmi = np.log(met / max(met.sum(), 1) / np.outer(share, share))
    pmi = np.where(np.isfinite(pmi), np.maximum(pmi, 0), 0)
    value, vector = np.linalg.eigh(pmi)
    point = vector[:, -CLUSTERS:] * np.sqrt(np.maximum(value[-CLUSTERS:], 0))
    point /= np.maximum(np.linalg.norm(point, axis=1, keepdims=True), 1e-9)
    centre = [point[int(np.argmax(share))]]
    while len(centre) < CLUSTERS:           # farthest point next: deterministic
        centre.append(point[int(np.argmin(np.max(point @ np.array(centre).T, axis=1)))])
    centre = np.array(centre)
    for _ in range(50):
        label = np.argmax(point @ centre.T, axis=1)
        for k in range(CLUSTERS):
            if (label == k).any():
                mean = point[label == k].mean(axis=0)
                centre[k] = mean / max(np.linalg.norm(mean), 1e-9)
    return label


def dictionary(blocks: DataFrame, counts: DataFrame, train_tokens: int) -> Words:
    """The most frequent words with their classes: at most DICTIONARY rows on the driver."""
    # the lowest count that keeps the words within the bound, by a histogram of log counts
    grade = F.floor(F.log2("c") * 64)
    total, least = 0, None
    for r in counts.groupBy(grade.alias("grade")).count().orderBy(F.desc("grade")).collect():      # some hundred rows
        total += r["count"]
        if total > DICTIONARY:
            break
        least = r["grade"]
    rows = counts.where(grade >= least).toPandas() if least is not None else counts.limit(0).toPandas()
    rows = rows.sort_values(["c", "word"], ascending=[False, True])
    hashes, c = rows["word"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64)
    seeds = np.sort(hashes[:SEEDS])
    order = np.argsort(hashes)
    hashes, c = hashes[order], c[order]
    n = len(hashes)
    if not n:
        return Words(hashes, c, np.zeros(0, np.int64))
    cluster = cluster_seeds(blocks, seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(n * CLUSTERS, np.int64)
        for _, b in _blocks(batches):
            seed, place = _seed_of(seeds, b.words), _seed_of(hashes, b.words)
            own, place = np.where(seed >= 0, cluster[seed], -1)[b.numbers], place[b.numbers]
            for at in (1, 2):
                later, sooner = _pairs(b, at)
                for x, y in ((later, sooner), (sooner, later)):
                    good = (own[y] >= 0) & (place[x] >= 0)
                    met += np.bincount(place[x[good]] * CLUSTERS + own[y[good]], minlength=len(met))
        yield _parts(met.reshape(n, CLUSTERS))

    met = _add_tables(map_arrow(blocks, run, "rows int, part binary"), n, CLUSTERS)
    lift = met / np.maximum(met.sum(axis=0), 1)
    band = sum((c < share * train_tokens).astype(np.int64) for share in BANDS)
    return Words(hashes, c, np.argmax(lift, axis=1) * (len(BANDS) + 1) + band)


def _known(b: Block, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Class of each distinct word of a block, and its count if it is in the dictionary (else 0)."""
    at = _seed_of(words.hashes, b.words)
    if not len(words.hashes):
        return np.full(len(at), RARE), np.zeros(len(at), np.int64)
    return np.where(at >= 0, words.classes[at], RARE), np.where(at >= 0, words.counts[at], 0)


# -- the class softmax -----------------------------------------------------------

class Weights(NamedTuple):
    bias: np.ndarray            # classes
    table: np.ndarray           # (3 * BUCKETS) x classes, float32


def features(b: Block, use: np.ndarray) -> np.ndarray:
    """Three feature numbers of the tokens ``use``: previous word, previous two, skip."""
    first = np.cumsum(b.tokens) - b.tokens
    at = use - first[b.doc[use]]
    code = mix64(b.words * np.uint64(_MULT))
    none, mask = np.uint64(1), np.uint64(BUCKETS - 1)
    one = np.where(at >= 1, code[b.numbers[np.maximum(use - 1, 0)]], none)
    two = np.where(at >= 2, code[b.numbers[np.maximum(use - 2, 0)]], none)
    out = np.empty((3, len(use)), np.int32)
    out[0] = one & mask
    out[1] = (mix64(one * np.uint64(3) + two) & mask).astype(np.int32) + BUCKETS
    out[2] = ((two >> np.uint64(20)) & mask).astype(np.int32) + 2 * BUCKETS
    return out


def _softmax(f: np.ndarray, w: Weights) -> np.ndarray:
    x = w.table.take(f[0], axis=0)
    x += w.table.take(f[1], axis=0)
    x += w.table.take(f[2], axis=0)
    x += w.bias
    np.clip(x, -60, 60, out=x)
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], np.float32))[:, None]
    return x


def start_weights(blocks: DataFrame, words: Words, prior: np.ndarray) -> Weights:
    """Log ratios of class shares given a feature, from the counts of all training tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 * BUCKETS * CLASSES)
        for _, b in _blocks(batches):
            kind = _known(b, words)[0][b.numbers]
            use = np.flatnonzero(b.train)
            for at in range(0, len(use), _STEP):
                own = use[at:at + _STEP]
                for f in features(b, own):
                    total += np.bincount(f.astype(np.int64) * CLASSES + kind[own], minlength=len(total))
        yield _parts(total.reshape(-1, CLASSES))

    n = _add_tables(map_arrow(blocks, run, "rows int, part binary"), 3 * BUCKETS, CLASSES)
    smooth = 20.0
    ratio = np.log((n + smooth * prior) / (n.sum(axis=1, keepdims=True) + smooth) / prior)
    return Weights(np.log(prior).astype(np.float32), (0.5 * ratio).astype(np.float32))


def gradient_round(blocks: DataFrame, words: Words, w: Weights, rate: float) -> Weights:
    """One synchronous step on all training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES + 1, 3 * BUCKETS + 1))        # a row per class, the last: tokens
        for _, b in _blocks(batches):
            kind = _known(b, words)[0]
            use = np.flatnonzero(b.train)
            for at in range(0, len(use), _STEP):
                own = use[at:at + _STEP]
                f = features(b, own)
                g = _softmax(f, w)
                g[np.arange(len(own)), kind[b.numbers[own]]] -= 1
                g = np.ascontiguousarray(g.T)
                total[:CLASSES, -1] += g.sum(axis=1)
                total[-1, -1] += len(own)
                for j in range(3):
                    part, rows = f[j] - j * BUCKETS, slice(j * BUCKETS, (j + 1) * BUCKETS)
                    for c in range(CLASSES):
                        total[c, rows] += np.bincount(part, weights=g[c], minlength=BUCKETS)
                    total[-1, rows] += np.bincount(part, minlength=BUCKETS)
        total = np.ascontiguousarray(total.T)
        yield _parts(total)

    g = _add_tables(map_arrow(blocks, run, "rows int, part binary"), 3 * BUCKETS + 1, CLASSES + 1)
    # a damped diagonal step: the curvature of a class weight is at most a quarter of its feature's tokens
    step = rate * g[:, :-1] / (0.25 * g[:, -1:] + 20.0)
    return Weights((w.bias - step[-1]).astype(np.float32), (w.table - step[:-1]).astype(np.float32))


# -- counts of pairs ---------------------------------------------------------------

_ASK = "part int, block long, codes binary, counts binary, words binary, more binary"
_ANSWER = "block long, part int, counts binary, more binary"


class Keys(NamedTuple):
    """What a block asks for, in order of the hash space."""
    codes: np.ndarray           # distinct hashes of (previous word, word) and (previous word, class): range and _CODE bits
    counts: np.ndarray          # of the block's training tokens
    pair: np.ndarray            # per token: the place of its pair
    total: np.ndarray           # per token: the place of its previous word and class
    rare: np.ndarray            # the block's numbers of the words beyond the dictionary


def keys_of(b: Block, kind: np.ndarray, bits: int) -> Keys:
    """``bits``: log2 of the ranges that the hash space is cut into."""
    code = mix64(b.words * np.uint64(_MULT))
    before = np.empty(len(b.numbers), np.uint64)
    before[1:] = code[b.numbers[:-1]]
    before[np.cumsum(b.tokens) - b.tokens] = 1                      # a text begins
    before *= np.uint64(5)
    every = np.concatenate([before + code[b.numbers], before + (kind[b.numbers].astype(np.uint64) + np.uint64(1)) * np.uint64(_MULT)])
    del before
    every = mix64(every) >> np.uint64(64 - _CODE - bits)
    codes, place = np.unique(every, return_inverse=True)
    del every
    n = len(b.numbers)
    counts = np.bincount(place[:n][b.train], minlength=len(codes)) + np.bincount(place[n:][b.train], minlength=len(codes))
    rare = np.flatnonzero(kind == RARE)
    return Keys(codes, counts, place[:n], place[n:], rare[np.argsort(b.words[rare])])


def _range_bits(tokens: int) -> int:
    return min(64 - _CODE, max(0, -(-tokens // RANGE_TOKENS) - 1).bit_length())


def _ranges(hashes: np.ndarray, shift: int) -> dict[int, slice]:
    """Slice of each range that sorted hashes hold something of."""
    if not len(hashes):
        return {}
    own = (hashes >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(hashes), np.int64)
    at = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    return {int(own[i]): slice(i, j) for i, j in zip(at, [*at[1:], len(own)])}


def answers(blocks: DataFrame, words: Words, bits: int) -> DataFrame:
    """A row for each block and range: the counts over all training documents
    of what the block asks for there, in the order of ``keys_of``."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, none = np.uint64((1 << _CODE) - 1), slice(0, 0)
        for row, b in _blocks(batches):
            k = keys_of(b, _known(b, words)[0], bits)
            own = b.words[k.rare]
            more = np.bincount(b.numbers[b.train], minlength=len(b.words))[k.rare]
            first, second = _ranges(k.codes, _CODE), _ranges(own, 64 - bits)
            parts = sorted(first.keys() | second.keys())
            x, y = [first.get(p, none) for p in parts], [second.get(p, none) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array([row.column("block")[0].as_py()] * len(parts), pa.int64()),
                 pa.array([_pack(np.diff(k.codes[i] & low, prepend=np.uint64(0)), _CODE // 8) for i in x], pa.binary()),
                 pa.array([_pack(k.counts[i]) for i in x], pa.binary()),
                 pa.array([_pack(own[i], 8) for i in y], pa.binary()), pa.array([_pack(more[i]) for i in y], pa.binary())],
                [c.split()[0] for c in _ASK.split(", ")])

    def add(own: pa.Table) -> pa.Table:
        def totals(hashes: list[np.ndarray], counts: list[np.ndarray]) -> list[bytes]:
            _, place = np.unique(np.concatenate(hashes), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)[place]      # exact below 2**53
            return [_pack(x, 8) for x in np.split(n, np.cumsum([len(x) for x in hashes])[:-1])]

        get = lambda c, width: [_unpack(x.as_buffer(), width) for x in own.column(c)]
        found = totals([np.cumsum(x) for x in get("codes", _CODE // 8)], get("counts", 4)), totals(get("words", 8), get("more", 4))
        return pa.table([own.column("block"), own.column("part"), pa.array(found[0], pa.binary()), pa.array(found[1], pa.binary())],
                        names=[c.split()[0] for c in _ANSWER.split(", ")])

    return map_groups(map_arrow(blocks, ask, _ASK), ["part"], add, _ANSWER)


# -- the operator ------------------------------------------------------------------

_SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "model array<double>, left_out array<double>")


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every document by a model of the documents that are not ``held_out``.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score``
    (smoothed unigram log10 probability) and ``score`` (the model's).  Null or
    empty texts are one end token; null or repeated keys are a row each; with
    no training documents every token is unknown; further columns are ignored;
    an empty table gives an empty result.  The model's events are the training
    words and one unknown word, as for the base score.  A pair's hash has 40
    bits and those of its range, so about one pair in a million shares its
    counts with another; those of words have 64."""
    spark = docs.sparkSession
    path = scratch_path(spark, "maxent-scored")
    with scratch_scope(spark):
        _scored(docs, held_out, key, text).write.parquet(path)
    scored = spark.read.schema(_SCORED).parquet(path)
    best = scored.select(*[F.sum(F.col("left_out")[k]).alias(str(k)) for k in range(len(STRENGTHS))]).first()
    k = int(np.argmax([x or 0.0 for x in best]))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", F.col("model")[k].alias("score"))


def _scored(docs: DataFrame, held_out: Column, key: str, text: str) -> DataFrame:
    """``score`` under each of ``STRENGTHS`` (``model``), and what training tokens
    left out of their own counts add to it (``left_out``)."""
    blocks = encode(docs, held_out, key, text)
    counts = count_words(blocks)
    n, distinct = (int(x or 0) for x in counts.agg(F.sum("c"), F.count(F.lit(1))).first())
    words = dictionary(blocks, counts, n)
    mass = np.bincount(words.classes, weights=words.counts, minlength=CLASSES)
    kinds = np.bincount(words.classes, minlength=CLASSES)
    mass[RARE], kinds[RARE] = n - words.counts.sum(), distinct - len(words.hashes)
    below = np.maximum(mass + 0.5 * (kinds + (np.arange(CLASSES) == RARE)), 1e-300)     # the unknown word is a rare word
    base_below = np.log10(n + 0.5 * (distinct + 1))
    prior = (mass + 0.5) / (mass + 0.5).sum()
    w = start_weights(blocks, words, prior)
    for k in range(ROUNDS if n else 0):
        w = gradient_round(blocks, words, w, 0.8 / (1 + 0.5 * k))
    bits = _range_bits(blocks.agg(F.sum("size")).first()[0] or 0)

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        (row, b), = _blocks(block.to_batches())
        kind, count = _known(b, words)
        k = keys_of(b, kind, bits)
        found = found.sort_by("part")
        seen = np.concatenate([_unpack(x.as_buffer(), 8) for x in found.column("counts")])
        count[k.rare] = np.concatenate([_unpack(x.as_buffer(), 8) for x in found.column("more")])
        unit = np.log10(count + 0.5)
        model, left = np.zeros((len(STRENGTHS), len(b.tokens))), np.zeros((len(STRENGTHS), len(b.tokens)))
        for at in range(0, len(b.numbers), _STEP):
            use = slice(at, at + _STEP)
            word, doc = b.numbers[use], b.doc[use]
            own = kind[word]
            p = _softmax(features(b, np.arange(at, at + len(own))), w)
            chosen = np.log10(np.maximum(p[np.arange(len(own)), own], 1e-30))
            low, pair, total = int(doc[0]), seen[k.pair[use]], seen[k.total[use]]
            share, out = (count[word] + 0.5) / below[own], b.train[use].astype(np.int64)
            less = (count[word] - out + 0.5) / below[own]
            for j, strength in enumerate(STRENGTHS):
                x = np.bincount(doc - low, weights=chosen + np.log10((pair + strength * share) / (total + strength)))
                y = np.bincount(doc - low, weights=out * np.log10((pair - out + strength * less) / (total - out + strength)))
                model[j, low:low + len(x)] += x
                left[j, low:low + len(y)] += y
        add = lambda x: np.bincount(b.doc, weights=x, minlength=len(b.tokens))
        nested = lambda x: pa.array(list(x.T), pa.list_(pa.float64()))
        return pa.table([row.column("doc_ids")[0].values, pa.array(b.held), pa.array(b.tokens), pa.array(add(count[b.numbers] > 0).astype(np.int64)),
                         pa.array(np.full(len(b.tokens), n)), pa.array(add(unit[b.numbers]) - b.tokens * base_below), nested(model), nested(left)],
                        names=[c.split()[0] for c in _SCORED.split(", ")])

    return blocks.groupBy("block").cogroup(answers(blocks, words, bits).groupBy("block")).applyInArrow(run, _SCORED)
