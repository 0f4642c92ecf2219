"""Near-duplicate documents by min-max hashing.

Every permutation gives two signature values, the smallest and the largest
hash of a set's shingles, so 64 hash evaluations a shingle give 128 values:
the share of equal values estimates the Jaccard similarity without bias and
with less variance than as many independent minima.

1. Documents with the same shingle set form a class (64-bit key of the set);
   everything below works on classes, so copies cost one row each.
2. 32 bands of four values give bucket keys.  A pair of similarity 0.75 or
   more misses all bands with a probability under 6e-6.
3. Members of a bucket are compared with its smallest class only (two such
   partners per class), confirmed on full sets, and joined into components.
4. What is still apart within a bucket is compared by signature inside tasks,
   a large bucket in chunks, a pair in the first band that it shares.  Members
   of the label that most of a bucket has are not compared among themselves, so
   its chunks meet the chunks of the others only.  Members with an estimate of
   at least 0.5 to another (six standard deviations below 0.75: a pair there
   falls under it with a probability under 1e-9) come with their full sets to a
   second task, which confirms pairs in falling order of the estimate and skips
   those that its own links already join.  So every candidate pair is in one component or has been refuted, and
   what leaves a task is linear in the members of a bucket.
5. Components by minimum labels with pointer jumping, each round stored.

Links, components and fingerprints stay distributed.  A broadcast bitmap of
fixed size keeps classes without candidates from being shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from depot.llm.common import (SLICE, bloom, byte_slices, digests, fresh, grouped, map_arrow, maybe_in, mix64, scan_words,
                              shingle_sets, split, stored)
from depot.session import discard, scratch_path, scratch_scope

PERMUTATIONS, BANDS, WIDTH = 64, 32, 5
SIMILAR = 75                                # percent
ESTIMATE = 0.5
_SALTS, _CHUNK, _BITS = 16, 512, 1 << 22


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:PERMUTATIONS] | np.uint64(1), seeds[PERMUTATIONS:]


def min_max(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Signatures (sets x 128: minimum and maximum of each permutation); empty sets: zeros."""
    mult, add = _parameters()
    full = np.flatnonzero(np.diff(offsets) > 0)
    out = np.zeros((len(offsets) - 1, 2 * PERMUTATIONS), np.uint64)
    at = 0
    while at < len(full):                   # runs of sets of about 64 K shingles: temporaries stay in cache
        to = max(at + 1, int(np.searchsorted(offsets[full], offsets[full[at]] + (1 << 16))))
        rows = full[at:to]
        lo, hi = int(offsets[rows[0]]), int(offsets[rows[-1] + 1])
        part, first = hashes[lo:hi], offsets[rows] - lo
        work = np.empty_like(part)
        for p in range(PERMUTATIONS):
            np.multiply(part, mult[p], out=work)
            work += add[p]
            out[rows, 2 * p] = np.minimum.reduceat(work, first)
            out[rows, 2 * p + 1] = np.maximum.reduceat(work, first)
        at = to
    return out


def set_keys(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set (order does not matter); empty sets: 0."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes.copy()), dtype=np.uint64)])
    return mix64((total[offsets[1:]] - total[offsets[:-1]]) + np.diff(offsets).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """Bucket keys (sets x bands) of signatures."""
    rows = signatures.reshape(len(signatures), BANDS, -1)
    value = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signatures), 1))
    for j in range(rows.shape[2]):
        value = mix64(value ^ rows[:, :, j])
    return value


def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words, _, _, at = scan_words(texts, lower=True)
    return shingle_sets(words, at, WIDTH)


def signatures(docs: DataFrame, key: str, text: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``n_shingles``, ``node`` (class key), ``bands`` and ``sig`` (16 bits of each value) of every row,
    and the long columns ``carried``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, text, SLICE):
                hashes, at = _sets(b.column(text))
                sig = min_max(hashes, at)
                bands, short = band_keys(sig), (sig >> np.uint64(17)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [b.column(key).cast(pa.int64()), pa.array(np.diff(at).astype(np.int64)), pa.array(set_keys(hashes, at).view(np.int64)),
                     pa.array([x.tobytes() for x in bands], pa.binary()), pa.array([x.tobytes() for x in short], pa.binary()), *(b.column(c) for c in carried)],
                    ["doc_id", "n_shingles", "node", "bands", "sig", *carried])

    schema = ", ".join(["doc_id long, n_shingles long, node long, bands binary, sig binary", *(f"{c} long" for c in carried)])
    return map_arrow(docs.select(key, text, *carried), run, schema)


def _buckets(classes: DataFrame) -> DataFrame:
    """(bucket, band, node, leader) of all members of buckets with two classes or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.frombuffer(b"".join(b.column("bands").to_pylist()), np.int64)
            band = np.tile(np.arange(BANDS, dtype=np.int32), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(band), pa.array(np.repeat(b.column("node").to_numpy(), BANDS))], ["bucket", "band", "node"])

    rows = map_arrow(classes.select("node", "bands"), run, "bucket long, band int, node long")
    crowded = stored(rows.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "minmax-crowded")
    bits = bloom(crowded.select("bucket"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(batches):                          # most buckets have one class: their rows stay here
            yield b.filter(pa.array(maybe_in(bits, b.column("bucket").to_numpy())))

    rows = map_arrow(classes.select("node", "bands"), near, "bucket long, band int, node long")
    return stored(_salted(rows, crowded, "bucket", "inner"), "minmax-buckets")


def _salted(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join with a right side of one row a key, a hot key of the left side
    dealt over _SALTS parts."""
    salt = F.pmod(F.xxhash64(*[c for c in ("node", "doc_id") if c in left.columns]), F.lit(_SALTS)).cast("int")
    # a merge join: the size by which Spark would broadcast this side leaves the salts out
    many = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))).hint("merge")
    return left.withColumn("_salt", salt).join(many, [key, "_salt"], how).drop("_salt")


def bitmap(nodes: DataFrame) -> np.ndarray:
    """Bits of the nodes' hashes: half a megabyte, whatever the number of nodes."""
    bit = F.pmod(F.col("node"), F.lit(_BITS))
    rows = (nodes.select(bit.alias("bit")).select(F.expr("bit div 32").alias("word"), F.expr("shiftleft(1L, cast(bit % 32 as int))").alias("flag"))
            .groupBy("word").agg(F.bit_or("flag").alias("flags")).collect())
    out = np.zeros(_BITS // 32, np.uint32)
    for r in rows:
        out[r.word] = r.flags
    return out


def _marked(bits: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    at = np.mod(nodes, _BITS)
    return (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


def _full_sets(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the given classes, read from the texts again."""
    bits = bitmap(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, text, 4 << 20):
                hashes, at = _sets(b.column(text))
                keys = set_keys(hashes, at).view(np.int64)
                rows = np.flatnonzero(_marked(bits, keys) & (np.diff(at) > 0))
                _, first = np.unique(keys[rows], return_index=True)
                rows = rows[first]
                yield pa.RecordBatch.from_arrays([pa.array(keys[rows]), pa.array([hashes[at[i]:at[i + 1]].tobytes() for i in rows], pa.binary())], ["node", "shingles"])

    found = map_arrow(docs.select(text), run, "node long, shingles binary").join(nodes, "node", "left_semi")
    return stored(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "minmax-sets")


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures agree enough."""
    sig = classes.select("node", "sig")
    joined = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
              .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1) for c in ("sig_a", "sig_b"))
            yield b.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= ESTIMATE))

    return map_arrow(joined.select("a", "b", "sig_a", "sig_b"), run, "a long, b long")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= SIMILAR * union of two sorted sets."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < SIMILAR * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int(np.count_nonzero(large[at] == small))
    return 100 * common >= SIMILAR * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar."""
    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                    for x, y in zip(b.column("set_a"), b.column("set_b"))]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(joined.select("a", "b", "set_a", "set_b"), run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component, of all nodes with an
    edge.  Each round takes the smallest label around and jumps to the label
    of that label; labels are stored every round."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "minmax-edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "minmax-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        own = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = stored(own.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "minmax-labels")
        changed = new.where("label < old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


_MEMBER = "bucket long, band int, i int, j int, own int, node long, label long, bands binary, sig binary"


def _candidates(group: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, later rows, estimates) of the pairs of a chunk pair that have
    different labels, similar signatures, and share no earlier band."""
    node, label, own = (group.column(c).to_numpy() for c in ("node", "label", "own"))
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint16).reshape(len(node), -1)
    bands = np.frombuffer(b"".join(group.column("bands").to_pylist()), np.int64).reshape(len(node), -1)
    i, j, band = (group.column(c)[0].as_py() for c in ("i", "j", "band"))
    left, right = (np.arange(len(node)),) * 2 if i == j else (np.flatnonzero(own == i), np.flatnonzero(own == j))
    for k in left:
        far = right[(label[right] != label[k]) & ((right > k) if i == j else True)]
        if len(far):
            estimate = (sig[far] == sig[k]).mean(axis=1)
            keep = (estimate >= ESTIMATE) & ~(bands[far, :band] == bands[k, :band]).any(axis=1)
            if keep.any():
                yield int(k), far[keep], estimate[keep]


def _apart(members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of a bucket that have a candidate with another label in it."""
    rows = (members.select("bucket", "band", "node").join(labels, "node", "left").select("bucket", "band", "node", F.coalesce("label", "node").alias("label")))
    mixed = (rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("_m"))
             .groupBy("bucket").agg(F.max(F.struct("_m", "label")).alias("_top"), F.sum("_m").alias("_n"), F.count(F.lit(1)).alias("_labels")).where("_labels > 1"))
    chunks = lambda n: F.ceil(n / F.lit(_CHUNK)).cast("int")
    rows = _salted(rows, mixed.select("bucket", F.col("_top.label").alias("top"), chunks(F.col("_n") - F.col("_top._m")).alias("few"),
                                      chunks(F.col("_top._m")).alias("many")), "bucket", "inner")
    # a large bucket: chunk i meets chunk j in the group (i, j), i <= j.  The members of its
    # commonest label are chunks from ``few`` on and meet only the chunks before these
    most = F.col("label") == F.col("top")
    place = F.xxhash64("node")
    own = F.when(most, F.col("few") + F.pmod(place, F.col("many"))).otherwise(F.pmod(place, F.col("few"))).cast("int")
    others = F.sequence(F.lit(0), F.col("few") + F.when(most, 0).otherwise(F.col("many")) - 1)
    rows = (rows.withColumn("own", own).withColumn("other", F.explode(others))
            .select("bucket", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label"))
    rows = rows.join(classes.select("node", "bands", "sig"), "node").select([c.split()[0] for c in _MEMBER.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for group in grouped(batches, ["bucket", "i", "j"]):
            found = [np.r_[k, far] for k, far, _ in _candidates(group)]
            if found:
                held += group.take(pa.array(np.unique(np.concatenate(found)))).to_batches()
                n += held[-1].num_rows
                if n >= 10_000:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    ordered = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return map_arrow(ordered, run, _MEMBER)


def _links_apart(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join the labels met in a bucket, confirmed on full sets."""
    def links(group: pa.Table) -> Iterator[tuple[int, int]]:
        node, label = group.column("node").to_numpy(), group.column("label").to_numpy()
        full = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        parent = {int(x): int(x) for x in label}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        pairs = [(np.full(len(far), k), far, e) for k, far, e in _candidates(group)]
        if not pairs:
            return
        one, two, estimate = (np.concatenate(c) for c in zip(*pairs))
        for p in np.argsort(-estimate, kind="stable"):
            k, m = int(one[p]), int(two[p])
            x, y = find(int(label[k])), find(int(label[m]))
            if x != y and similar(full[k], full[m]):
                parent[x] = y
                yield int(node[k]), int(node[m])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["bucket", "i", "j"]):
            found = list(links(group))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

    ordered = apart.join(sets, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return map_arrow(ordered, run, "a long, b long")


class Found(NamedTuple):
    rows: DataFrame             # doc_id, n_shingles, node of every input row, and what is carried
    nodes: DataFrame            # node, component_id, label of classes with copies or links


def analyse(docs: DataFrame, key: str = "doc_id", text: str = "text", carried: tuple[str, ...] = ()) -> Found:
    """Rows with their classes, and the components; whatever else is stored on the way is freed."""
    spark = docs.sparkSession
    kept = [scratch_path(spark, name) for name in ("minmax-rows", "minmax-components")]
    with scratch_scope(spark):
        rows, nodes = _analyse(docs, key, text, carried, kept[0])
        nodes.write.parquet(kept[1])
    return Found(rows, spark.read.schema(nodes.schema).parquet(kept[1]))


def _analyse(docs: DataFrame, key: str, text: str, carried: tuple[str, ...], path: str) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    wide = scratch_path(spark, "minmax-signatures")
    signed = signatures(docs, key, text, carried)
    signed.write.parquet(wide)
    signed = spark.read.schema(signed.schema).parquet(wide)
    narrow = signed.drop("bands", "sig")
    narrow.write.parquet(path)
    rows = spark.read.schema(narrow.schema).parquet(path)
    classes = stored(signed.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("min_id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "minmax-classes")
    discard(spark, wide)
    members = _buckets(classes)
    # partners: the leader met in most buckets and the smallest leader
    met = members.where("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n"))
    partner = met.groupBy("node").agg(F.array_distinct(F.array(F.max_by("leader", F.struct("n", -F.col("leader"))), F.min("leader"))).alias("to"))
    star = partner.select(F.explode("to").alias("a"), F.col("node").alias("b"))
    first = stored(_estimated(star, classes), "minmax-star")
    nodes = stored(first.select(F.col("a").alias("node")).unionByName(first.select(F.col("b").alias("node"))).distinct(), "minmax-nodes")
    sets = _full_sets(docs, text, nodes)
    edges = stored(_confirmed(first, sets), "minmax-links")
    labels = components(edges)
    # the rest of the candidates: apart in spite of a common bucket
    rest = stored(_apart(members, labels, classes), "minmax-apart")
    if rest.limit(1).count():
        more = rest.select("node").distinct().join(nodes, "node", "left_anti")
        sets = sets.unionByName(_full_sets(docs, text, stored(more, "minmax-nodes")))
        found = stored(_links_apart(rest, sets), "minmax-links")
        if found.limit(1).count():
            labels = components(edges.unionByName(found))
    linked = classes.join(labels, "node", "left").where("copies > 1 or label is not null").select("node", "min_id", F.coalesce("label", "node").alias("label"))
    least = linked.groupBy("label").agg(F.min("min_id").alias("component_id"))
    return rows, linked.join(least, "label").select("node", "component_id", "label")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id of all that
    links reach) and ``kept`` (doc_id = component_id) of every row.

    Null, empty or wordless texts: no shingles, linked with nothing, kept; with
    fewer than five words the whole sequence is the one shingle.  A null doc_id
    counts only where no document of its component has an id.  Repeated rows
    are copies (rows with the component's smallest id are all kept here;
    ``keep_one`` leaves one).  Further columns are ignored; an empty table
    gives an empty result."""
    found = analyse(docs, key, text)
    rows = _salted(found.rows, found.nodes.select("node", "component_id", F.lit(True).alias("_in")), "node", "left")
    component = F.when(F.col("_in") & (F.col("n_shingles") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are alone, and one row (smallest id, then
    smallest class) of every component, with all their columns.  Nulls, empty
    texts and repeated rows as in ``near_duplicates``; an empty table stays one.

    Which rows go is settled on digests of the rows; texts stay where they are
    (``common.split``)."""
    spark = docs.sparkSession
    one, two = fresh(docs, "_digest", "_digest2")
    marked = digests(docs, one, two)
    paths = [scratch_path(spark, name) for name in ("minmax-dropped", "minmax-repeated")]
    with scratch_scope(spark):
        found = analyse(marked, key, text, (one, two))
        members = _salted(found.rows.where("n_shingles > 0"), found.nodes, "node", "inner").select("doc_id", "node", "component_id", "label", one, two)
        first = members.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("label").agg(F.min(F.struct("node", one, two)).alias("k"))
        first = first.select(f"k.{one}", f"k.{two}")
        every = stored(members.groupBy(one, two).agg(F.count(F.lit(1)).alias("n")), "minmax-members")
        every.join(first, [one, two], "left_anti").select(one, two).write.parquet(paths[0])
        every.where("n > 1").join(first, [one, two], "left_semi").select(one, two).write.parquet(paths[1])
    dropped, repeated = (spark.read.schema(f"{one} long, {two} long").parquet(p) for p in paths)
    _, left = split(marked, dropped, one, two)
    if repeated.limit(1).count():                       # the row that stays stands there several times
        several, left = split(left, repeated, one, two)
        left = left.unionByName(several.dropDuplicates([one, two]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
