"""Near-duplicate components by a multi-index Hamming join (operator 9).

A document's set is its distinct shingles of ``words`` consecutive words. A
signature of ``SYMBOLS`` MinHash values, ``BITS`` bits each, stands for it; two
sets of likeness J differ in about ``SYMBOLS * (1 - J)`` symbols. Signatures
are split into ``CHUNKS`` chunks. Two signatures that differ in at most
``DISTANCE`` symbols have, by the pigeonhole principle, a chunk with at most
one error (``DISTANCE < 2 * CHUNKS``), so they share one of the chunk's keys
with one symbol left out. A pair of sets with J = 0.8 differs in more symbols
with probability under 1e-6. Every candidate link is confirmed on the full sets.

How groups stay small in every task:

1. Documents with equal sets are one class; only classes go on.
2. In each bucket of equal keys every class is paired with one pivot (the
   smallest id, then the largest, then one by hash) if they share several
   buckets, and components are taken from the confirmed links. That finds a group of near copies in as many
   pairs as it has members.
3. What is left are buckets that hold several components. Their pairs across
   components are compared in blocks of at most ``BLOCK`` rows a side.
   A pair is given by its first shared key only, and only if it is within
   ``DISTANCE`` and its parity sketches allow a link: each element that just
   one of two sets has flips one of ``PARITY`` bits, so the sketches of a
   linked pair never differ in more bits than the sets may in elements. What
   is left is confirmed on the sets. So no link is lost, pairs inside a
   component are never formed, and near misses do not leave their task.

Components come from hooking every root to its smallest neighbour and pointer
jumping, on written tables; nothing is collected but row counts.

Defined results: a text without words has an empty set, ``n_shingles`` 0 and
is linked with nothing; with fewer words than a shingle the whole sequence is
the only shingle. Rows with one ``doc_id`` count as one document. A null
``doc_id`` is linked with nothing, has a null component and is kept. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracery.llm.common import partitions, pieces, utf8
from tracery.llm.ppm import chunks, mix, words as word_keys
from tracery.session import scratch_path

SYMBOLS, CHUNKS, DISTANCE = 64, 16, 29
BITS = 16
PARITY = 2048
BLOCK = 2048
#: Further pivots tried in buckets that hold several components.
PIVOTS = 3
#: Buckets in common from which a pivot is tried; missing one only leaves work for step 3.
SHARED_BUCKETS = 4
#: Pairs that meet one copy of a pivot's row, and pivots with several copies, at most.
PIVOT_ROWS, HOT_PIVOTS = 4096, 50_000
_RNG = np.random.default_rng(20240229)
_XOR = _RNG.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """Shingle hashes of each text, in order, with repeats."""
    for _, streams in chunks(texts):
        keys, n = word_keys(streams)
        ends = np.cumsum(n)
        total = np.zeros(len(keys), np.uint64)
        for j in range(words):
            total[:len(keys) - j] += keys[j:] * _STEP[j]
        total = mix(total)
        for end, count in zip(ends.tolist(), n.tolist()):
            count -= 1  # the end sign
            start = end - 1 - count
            if count >= words:
                yield total[start:start + count - words + 1]
            elif count:
                short = (keys[start:start + count] * _STEP[8:8 + count]).sum(dtype=np.uint64, keepdims=True)
                yield mix(short + np.uint64(count))
            else:
                yield keys[:0]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of symbols per non-empty set."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for i in range(SYMBOLS):
        least = np.minimum.reduceat((flat ^ _XOR[i]) * _MUL[i], first)
        out[:, i] = mix(least) & np.uint64((1 << BITS) - 1)
    return out


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """Keys of each signature: every chunk with each one of its symbols left out."""
    width = SYMBOLS // CHUNKS
    parts = sig.reshape(len(sig), CHUNKS, width).astype(np.uint64) + np.uint64(1)
    place = (np.arange(CHUNKS * width, dtype=np.uint64) + np.uint64(1)).reshape(CHUNKS, width)
    weighted = parts * _STEP[:width]
    keys = weighted.sum(2, keepdims=True, dtype=np.uint64) - weighted
    return mix(keys + place * _MUL[0]).reshape(len(sig), -1)


def described(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n, digest, sig`` of every document (digest and signature of its set)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            sets = list(shingle_sets(utf8(b.column("text")), words))
            distinct = [np.unique(s) for s in sets]
            some = [i for i, s in enumerate(sets) if len(s)]
            sig: list = [None] * len(sets)
            if some:
                for i, row in zip(some, signatures([distinct[i] for i in some])):
                    sig[i] = row.astype("<u2").tobytes()
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(s) for s in distinct], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in distinct], pa.binary()),
                pa.array(sig, pa.binary())], names=["doc_id", "n", "digest", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, digest binary, sig binary")


def parity_sketch(items: np.ndarray) -> bytes:
    """One bit per residue of the items' hashes: whether an odd number have it."""
    return np.packbits(np.bincount(items % np.uint64(PARITY), minlength=PARITY).astype(np.uint8) & 1).tobytes()


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``id, items, sketch``: distinct shingle hashes of each document and
    their parity sketch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            found = [np.unique(s) for s in shingle_sets(utf8(b.column("text")), words)]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())),
                pa.array([parity_sketch(s) for s in found], pa.binary())], names=["id", "items", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "id long, items array<long>, sketch binary")


class _Tables:
    """Steps written to the shared folder: each is computed once."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n = spark, scratch_path(spark, "near-dup"), 0

    def cut(self, frame: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)


def bucketed(classes: DataFrame) -> DataFrame:
    """``key, place, id``: one row per key of each class; ``place`` numbers
    the key's chunk and left-out symbol."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u2").reshape(-1, SYMBOLS)
            keys = chunk_keys(sig).view(np.int64)
            ids = np.repeat(np.asarray(b.column("id")), keys.shape[1])
            place = np.tile(np.arange(keys.shape[1], dtype=np.int16), len(sig))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(place), pa.array(ids)],
                                             names=["key", "place", "id"])

    return classes.select("id", "sig").mapInArrow(run, "key long, place short, id long")


def first_place(differs: np.ndarray) -> np.ndarray:
    """The first key that two signatures share, from their unequal symbols."""
    width = SYMBOLS // CHUNKS
    chunks_ = differs.reshape(len(differs), CHUNKS, width)
    errors = chunks_.sum(2)
    chunk = np.argmax(errors <= 1, 1)
    return chunk * width + np.argmax(chunks_[np.arange(len(differs)), chunk], 1)


def with_pivot(pairs: DataFrame, left: DataFrame, side: DataFrame, rows: int = PIVOT_ROWS) -> DataFrame:
    """``left``, rows of ``pairs`` with more columns, joined with ``side`` on
    ``b``. A pivot of more than ``rows`` pairs has its row of ``side`` in as many
    copies as it needs, and its pairs are dealt over them by ``a``."""
    per = max(rows, -(-pairs.count() // HOT_PIVOTS))  # so at most HOT_PIVOTS of them
    hot = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > per).select(
        "b", F.ceil(F.col("_n") / per).cast("int").alias("_copies"))
    if hot.isEmpty():
        return left.join(side, "b")
    few = F.broadcast(hot)
    salt = F.coalesce(F.pmod(F.xxhash64("a"), F.col("_copies")), F.lit(0)).cast("int").alias("_salt")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)).alias("_salt")
    return left.join(few, "b", "left").select(*left.columns, salt).join(
        side.join(few, "b", "left").select(*side.columns, copies), ["b", "_salt"]).drop("_salt")


def within_distance(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs whose signatures and set sizes allow a link."""
    side = classes.select("id", "n", "sig")
    joined = with_pivot(pairs, pairs.join(side.toDF("a", "n_a", "sig_a"), "a"), side.toDF("b", "n_b", "sig_b")).filter(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(-1, SYMBOLS) for c in ("sig_a", "sig_b"))
            near = pa.array((x != y).sum(1) <= DISTANCE)
            yield b.select(["a", "b"]).filter(near)

    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets have ``100 * common >= percent * all``."""
    items = sets.select("id", "items")
    joined = with_pivot(pairs, pairs.join(items.toDF("a", "items_a"), "a"), items.toDF("b", "items_b"))
    common = F.size(F.array_intersect("items_a", "items_b"))
    return joined.select("a", "b", common.alias("common"), (F.size("items_a") + F.size("items_b")).alias("both")).filter(
        100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b")


def components(links: DataFrame, tables: _Tables) -> DataFrame:
    """``id, root`` for every id in a link that is not its component's smallest."""
    edges = tables.cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    roots = None
    while not edges.isEmpty():
        up = tables.cut(edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "id"))
        while True:  # pointer jumping: every id points at its root in the end
            over = up.select(F.col("id").alias("root"), F.col("root").alias("next"))
            jumped = tables.cut(up.join(over, "root", "left").select(
                "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
            up = jumped.select("id", "root")
            if jumped.filter("moved").isEmpty():
                break
        if roots is None:
            roots = up
        else:
            step = up.select(F.col("id").alias("root"), F.col("root").alias("next"))
            roots = tables.cut(roots.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
                               .unionByName(up.join(roots.select("id"), "id", "left_anti")))
        edges = tables.cut(relabelled(relabelled(edges, up, "a"), up, "b").filter("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    return roots if roots is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("root"))


def relabelled(rows: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """``column`` replaced by its root, where it has another one."""
    side = roots.select(F.col("id").alias(column), F.col("root").alias("_root"))
    return rows.join(side, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


def stars(rows: DataFrame, pivot: str) -> DataFrame:
    """``a, b``: each id with a pivot that it shares several buckets with, as
    near copies do. Other pairs are left to ``across_components``."""
    return rows.select(F.greatest("id", pivot).alias("a"), F.least("id", pivot).alias("b")).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= SHARED_BUCKETS).select("a", "b")


def across_components(rows: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """``a, b``: pairs of different components in one bucket, near by signature.

    ``rows``: ``key, place, id, comp`` of buckets with several components. A
    bucket of more than ``block`` rows is cut into parts by hash, and each two
    parts meet in a task of their own. A pair that shares several keys is given
    by the first of them only.
    """
    sized = rows.join(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")), "key")
    parts = F.ceil(F.col("rows") / block).cast("int")
    part = F.pmod(F.xxhash64("id", F.lit(1)), parts).cast("int")
    dealt = sized.select("key", "place", "id", "comp", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = dealt.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("group"),
                         "place", "part", "id", "comp", (F.col("part") == F.col("other")).alias("same"))
    dealt = dealt.join(classes.select("id", "n", "sig").join(sets.select("id", "sketch"), "id"), "id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def near(table: pa.Table) -> pa.RecordBatch:
            group, ids, comp, part, n, place = (
                np.asarray(table.column(c)) for c in ("group", "id", "comp", "part", "n", "place"))
            same = np.asarray(table.column("same"))
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, SYMBOLS)
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(-1, PARITY // 64)
            found = []
            left = np.arange(len(group))
            step = 1
            while len(left):
                left = left[left + step < len(group)]
                left = left[group[left] == group[left + step]]
                for s in range(0, len(left), 1 << 16):
                    i = left[s:s + (1 << 16)]
                    j = i + step
                    # Two parts meet here only across; within, each part has a group of its own.
                    ok = (comp[i] != comp[j]) & ((part[i] != part[j]) | same[i])
                    ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                    i, j = i[ok], j[ok]
                    differs = sig[i] != sig[j]
                    close = np.flatnonzero(differs.sum(1) <= DISTANCE)
                    at = first_place(differs[close])
                    close = close[(place[i[close]] == at) & (place[j[close]] == at)]
                    i, j = i[close], j[close]
                    # Sets with ``100 * common >= percent * all`` differ in at most this many elements.
                    apart = np.bitwise_count(sketch[i] ^ sketch[j]).sum(1, dtype=np.int64)
                    ok = (100 + percent) * apart <= (100 - percent) * (n[i] + n[j])
                    i, j = ids[i[ok]], ids[j[ok]]
                    found.append(np.unique(np.stack([np.maximum(i, j), np.minimum(i, j)], 1), axis=0))
                step += 1
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())],
                                              names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            group = np.asarray(b.column("group"))
            if held and held[-1].column("group")[-1].as_py() != group[0]:
                yield near(pa.Table.from_batches(held))
                held = []
            # The batch's last group may go on in the next batch.
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield near(pa.Table.from_batches([*held, b.slice(0, cut)]))
                held = []
            held.append(b.slice(cut))
        if held:
            yield near(pa.Table.from_batches(held))

    n = partitions(rows.sparkSession)
    return (dealt.repartition(n, "group").sortWithinPartitions("group", "part", "id")
            .mapInArrow(run, "a long, b long").distinct())


def same_document(every: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of one document id that has several texts."""
    of_class = every.filter("n > 0").select("doc_id", "digest").join(classes.select("digest", "id"), "digest")
    low = of_class.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("high")).filter("b < high")
    return of_class.join(low, "doc_id").select(F.col("id").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    spark = docs.sparkSession
    tables = _Tables(spark)
    every = tables.cut(described(docs, words))
    least = F.min(F.struct("doc_id", "n", "sig")).alias("x")
    classes = tables.cut(every.filter("doc_id is not null and n > 0").groupBy("digest").agg(least).select(
        "digest", F.col("x.doc_id").alias("id"), F.col("x.n").alias("n"), F.col("x.sig").alias("sig")))
    keys = bucketed(classes)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first"), F.max("id").alias("last"))
    buckets = tables.cut(keys.join(shared.filter("rows > 1 and first < last").hint("shuffle_hash"), "key"))
    wanted = buckets.select("id").distinct()
    sets = tables.cut(full_sets(docs.join(wanted.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), words))
    roots = tables.cut(sets.select("id", F.col("id").alias("root")).limit(0))

    def grow(links: DataFrame) -> None:
        """Take further links into the components."""
        nonlocal roots
        new = components(relabelled(relabelled(links, roots, "a"), roots, "b"), tables)
        roots = tables.cut(relabelled(roots, new, "root").unionByName(new))

    def check(near: DataFrame) -> None:
        grow(tables.cut(confirmed(tables.cut(near), sets, percent)))

    def unfinished(rows: DataFrame) -> DataFrame:
        """``key, place, id, comp`` of the buckets that hold several components."""
        labelled = relabelled(rows.select("key", "place", "id", F.col("id").alias("comp")), roots, "comp")
        spread = labelled.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
        return tables.cut(labelled.join(spread.select("key"), "key", "left_semi"))

    grow(same_document(every, classes))
    check(within_distance(tables.cut(stars(buckets.filter("id <> first"), "first")), classes, percent))
    rest = unfinished(buckets)
    for salt in range(PIVOTS):
        if rest.isEmpty():
            break
        order = F.struct("id", "comp") if not salt else F.struct(F.xxhash64("id", F.lit(salt)), "id", "comp")
        pivot = rest.groupBy("key").agg(F.max(order).alias("p")).select(
            "key", F.col("p.id").alias("pivot"), F.col("p.comp").alias("pivot_comp"))
        check(within_distance(tables.cut(stars(rest.join(pivot, "key").filter("comp <> pivot_comp"), "pivot")), classes, percent))
        rest = unfinished(rest)
    if not rest.isEmpty():
        check(across_components(rest, classes, sets, percent))
    # Every document points at its class, every class at its component's root.
    of_class = relabelled(classes.select("digest", F.col("id").alias("root")), roots, "root")
    found = every.join(of_class, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("root"))).otherwise(F.col("doc_id")).alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest
    id. Of rows with one id the one with the smallest text stays; rows with a
    null id all stay."""
    found = near_duplicates(docs, words, percent)
    folder = scratch_path(docs.sparkSession, "near-dup-found")
    found.select("doc_id", "kept").write.parquet(folder)
    found = docs.sparkSession.read.schema("doc_id long, kept boolean").parquet(folder)
    kept = docs.join(found.filter("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    repeated = found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    single = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(F.struct("text", *others)).alias("_row")).select("doc_id", "_row.*").select(*docs.columns)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(single)
