"""Spelling variants by pivotal grams (operator 11).

Words are the distinct runs of letters of at least ``MIN_LENGTH`` code points
that occur ``MIN_COUNT`` times. Two words are near if one inserted, deleted or
replaced code point turns one into the other.

A word's bigrams are ordered from rare to frequent over all words; its gram
prefix is the three rarest, and all that tie with the third. Two bigrams of the
prefix that do not overlap are its pivots; dynamic programming over their
positions takes the two with the smallest summed frequency. One edit destroys
at most one of them, so of two near words the one whose prefix ends earlier in
the order has a pivot in the other's prefix. Position limits make that an
equality: a gram that survives an edit to its right has kept its position and
everything to its left, and one that survives an edit to its left has moved
with the length and kept everything to its right. So the index key is gram,
position, length, side and a hash of what that side holds; a pivot looks up the
positions and lengths that one edit allows. Candidates are verified on the
words, both words' pivots being looked up in both words' prefixes.

How it is spread: pieces of the corpus count their words before the shuffle.
The alphabet has 90 letters, so there are at most 8,100 bigrams, whose
frequencies reach every task. Index rows are dealt and sorted by the key's
hash; a task takes whole buckets and yields only verified pairs. Inside a
bucket, pairs to verify share half a word: one edit leaves the first or the
last half as it is. A bucket of more than ``BUCKET`` prefix rows is cut into
parts by hash, and each two parts meet in a group of their own. Only keys of
such buckets are broadcast, one for every ``BUCKET`` rows at most.

A word's form is its near word of largest count (ties: the smallest in code
point order) if that is at least ``RATIO`` times its own; counts grow by that
factor along forms, so roots take few rounds of pointer jumping.

Defined results: null texts have no words; a null ``doc_id`` is written as
empty text in the deletion rule; repeated rows count each; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.llm.common import partitions, pieces
from tracery.llm.ppm import mix
from tracery.llm.winnow import _POWERS
from tracery.session import scratch_path

MIN_LENGTH, MIN_COUNT, RATIO, DAMAGED_IN = 7, 2, 10, 31
#: Prefix rows of a bucket that meet in one group, and rows looked at together.
BUCKET, ROWS = 1 << 16, 1 << 16
#: Candidates verified at once; words up to ``WIDE`` bytes are compared as rows of a matrix.
CANDIDATES, WIDE = 1 << 18, 40
#: Words whose bigrams are held at once, in bytes.
WORD_BYTES = 1 << 20
#: Latin-1 holds exactly the letters of a run in one byte each; any other letter ends a run there too.
RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % MIN_LENGTH)
_WEIGHT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_FAR = 1 << 39


def damaged(doc_id: object, run: bytes) -> bytes:
    """The run after the deletion rule (``run`` in Latin-1, lower case)."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(),
                   zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if h % DAMAGED_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            total: Counter = Counter()
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if text:
                    for found, n in Counter(RUN.findall(text.encode("latin-1", "replace").lower())).items():
                        total[damaged(doc_id, found)] += n
            words = [w for w in total if len(w) >= MIN_LENGTH]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()),
                                              pa.array([total[w] for w in words], pa.int64())], names=["word", "n"])

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


class Grams:
    """The positional bigrams of some words, one after another."""

    def __init__(self, words: list[str]):
        raw = [w.encode("latin-1") for w in words]
        size = np.array([len(w) for w in raw], np.int64)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.size = size - 1  # bigrams per word
        self.word = np.repeat(np.arange(len(words)), self.size)
        begin = np.cumsum(size) - size
        self.first = np.cumsum(self.size) - self.size
        self.pos = np.arange(len(self.word)) - self.first[self.word]
        self.start, self.end = begin[self.word] + self.pos, (begin + size)[self.word]
        self.begin = begin[self.word]
        self.gram = self.bytes[self.start].astype(np.int64) << 8 | self.bytes[self.start + 1]
        self.length = self.end - self.begin


def gram_counts(words: DataFrame) -> DataFrame:
    """``gram, words``: in how many words each bigram occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "word", WORD_BYTES):
            g = Grams(b.column("word").to_pylist())
            gram, n = np.unique(distinct(g.word << 16 | g.gram) & 0xFFFF, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "words"])

    return words.select("word").mapInArrow(run, "gram long, words long").groupBy("gram").agg(F.sum("words").alias("words"))


def prefixes(g: Grams, rank: np.ndarray) -> np.ndarray:
    """Which bigrams are in their word's prefix: the three rarest and their ties."""
    order = rank[g.gram]
    by_rank = np.argsort(g.word << 16 | order, kind="stable")
    third = order[by_rank[g.first + np.minimum(2, g.size - 1)]]
    return order <= third[g.word]


def pivots(g: Grams, within: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Two bigrams per word, of those ``within``, that do not overlap and are
    rarest together. ``best[j]``, the least cost up to ``j``, is a running minimum;
    the pair that ends at ``j`` costs its own frequency and ``best[j - 2]``."""
    cost = np.where(within, np.minimum(frequency[g.gram], _FAR - 1), _FAR)
    # Each word's costs lie below those of all words before it, so the minimum starts anew.
    floor = g.word.astype(np.int64) << 40
    best = np.minimum.accumulate(cost - floor) + floor
    before = np.full(len(cost), _FAR)
    far = np.flatnonzero(g.pos >= 2)
    before[far] = best[far - 2]
    total = cost + before

    def first_where(hit: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(hit)
        return at[np.unique(g.word[at], return_index=True)[1]]

    second = first_where(total == np.minimum.reduceat(total, g.first)[g.word])
    return np.concatenate([first_where(cost == before[second][g.word]), second])


def keys(gram, pos, length, side, part) -> np.ndarray:
    out = np.zeros(len(gram), np.uint64)
    for weight, x in zip(_WEIGHT, (gram, pos, length, side)):
        out = mix(out + (np.asarray(x, np.int64).astype(np.uint64) + np.uint64(1)) * weight)
    return mix(out ^ part).view(np.int64)


def index_rows(words: list[str], rank: np.ndarray, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``key, is pivot, word number`` of every index row."""
    g = Grams(words)
    up, down = _POWERS.get(len(g.bytes) + 1)
    total = np.zeros(len(g.bytes) + 1, np.uint64)
    np.cumsum((g.bytes.astype(np.uint64) + np.uint64(1)) * up[:len(g.bytes)], out=total[1:])
    left = (total[g.start] - total[g.begin]) * down[g.begin]
    right = (total[g.end] - total[g.start + 2]) * down[g.start + 2]
    within = prefixes(g, rank)
    found = []

    def add(at: np.ndarray, pivot: bool, side: int, moved: int, longer: int) -> None:
        part = (left, right)[side][at]
        found.append((keys(g.gram[at], g.pos[at] + moved, g.length[at] + longer, np.full(len(at), side), part),
                      np.full(len(at), pivot), g.word[at]))

    for side in (0, 1):
        add(np.flatnonzero(within), False, side, 0, 0)
    two = pivots(g, within, frequency)
    for side in (0, 1):
        # An edit on the other side: replaced and deleted code points must be there.
        room = (g.length - g.pos - 2, g.pos)[side]
        for longer in (-1, 0, 1):
            add(two if longer == 1 else two[room[two] > 0], True, side, longer * side, longer)
    key, pivot, word = (np.concatenate(x) for x in zip(*found))
    return key, pivot, word


def split_keys(words: DataFrame, known, bucket: int) -> dict[int, int]:
    """Keys with more than ``bucket`` prefix rows, and the parts of each: at
    most one key per ``bucket`` rows of the index."""

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "word", WORD_BYTES):
            g = Grams(b.column("word").to_pylist())
            within = prefixes(g, known.value[0])
            place, n = np.unique(keys(g.gram, g.pos, g.length, 0 * g.pos, np.uint64(0))[within], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(n)], names=["key", "n"])

    # Buckets hold no more rows than words with that gram at that place in that length.
    crowded = words.select("word").mapInArrow(places, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(
        F.col("n") > bucket)
    if crowded.isEmpty():
        return {}

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "word", WORD_BYTES):
            key, pivot, _ = index_rows(b.column("word").to_pylist(), *known.value)
            key, n = np.unique(key[~pivot], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    found = words.select("word").mapInArrow(counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return {r.key: -(-r.n // bucket) for r in found.filter(F.col("n") > bucket).collect()}


def dealt(key: np.ndarray, pivot: np.ndarray, word: np.ndarray, words: list[str], parts: dict[int, int]):
    """``group, is pivot, word number``: rows of split buckets go to every group of their part."""
    if not parts:
        return key, pivot, word
    many = np.sort(np.array(list(parts), np.int64))
    split = np.flatnonzero(many[np.minimum(np.searchsorted(many, key), len(many) - 1)] == key)
    groups, flags, who = [np.delete(key, split)], [np.delete(pivot, split)], [np.delete(word, split)]
    for k, p, w in zip(key[split].tolist(), pivot[split].tolist(), word[split].tolist()):
        n = parts[k]
        mine, other = zlib.crc32(words[w].encode()) % n, np.arange(n, dtype=np.int64)
        pair = mine + n * other if p else mine * n + other
        groups.append(mix(np.uint64(k & (1 << 64) - 1) + (pair.astype(np.uint64) + np.uint64(1)) * _WEIGHT[0]).view(np.int64))
        flags.append(np.full(n, p))
        who.append(np.full(n, w))
    return np.concatenate(groups), np.concatenate(flags), np.concatenate(who)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one edit turns one word into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; ``np.unique`` hashes them, which takes many times longer."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


class Bucketed:
    """Verified pairs of some whole groups."""

    def __init__(self, words: list[str]):
        self.words = words
        raw = [w.encode("latin-1") for w in words]
        self.size = np.array([len(w) for w in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        self.begin = np.cumsum(self.size) - self.size
        up, self.down = _POWERS.get(len(flat) + 1)
        self.total = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:len(flat)], out=self.total[1:])
        short = [w if len(w) <= WIDE else b"" for w in raw]
        self.left = np.array(short, f"S{WIDE}").view(np.uint8).reshape(-1, WIDE)
        self.right = np.array([w[::-1] for w in short], f"S{WIDE}").view(np.uint8).reshape(-1, WIDE)

    def _part(self, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        s, e = self.begin[word] + start, self.begin[word] + end
        return (self.total[e] - self.total[s]) * self.down[s]

    def _halves(self, group: np.ndarray, longer: int, word: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Keys of both halves of each word as compared with a word of length
        ``other``; ``longer`` tells how much longer the pivot's word is."""
        size = self.size[word]
        least = np.minimum(size, other)
        half = least // 2
        base = mix(group.view(np.uint64) + _WEIGHT[1:2] * np.uint64(longer + 2)) + least.astype(np.uint64) * _WEIGHT[2]
        return np.concatenate([mix(base ^ mix(self._part(word, 0 * half, half) + _WEIGHT[0])),
                               mix(base ^ mix(self._part(word, size - (least - half), size) + _WEIGHT[3]))])

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        gap = np.abs(self.size[i] - self.size[j])
        same = (self.left[i] != self.left[j]).argmax(1) + (self.right[i] != self.right[j]).argmax(1)
        least = np.minimum(self.size[i], self.size[j])
        ok = (i != j) & (gap <= 1) & (same >= least - (gap == 0))
        for k in np.flatnonzero(np.maximum(self.size[i], self.size[j]) > WIDE):
            ok[k] = one_edit(self.words[i[k]], self.words[j[k]])
        return ok

    def _facing(self, group: np.ndarray, pivot: np.ndarray, size: np.ndarray):
        """Pivot and prefix rows of groups that hold both (rows come sorted by group),
        and the least and largest word size that each row faces in its group: the key
        holds the length, so most pivots face one size only."""
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
        rows = np.diff(np.append(start, len(group)))
        low, high, none = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64), 1 << 40
        for side in (pivot, ~pivot):
            facing = np.repeat(np.minimum.reduceat(np.where(side, none, size), start), rows) if len(start) else low
            low = np.where(side, facing, low)
            facing = np.repeat(np.maximum.reduceat(np.where(side, -1, size), start), rows) if len(start) else high
            high = np.where(side, facing, high)
        return np.flatnonzero(pivot & (high >= low)), np.flatnonzero(~pivot & (high >= low)), low, high

    def pairs(self, group: np.ndarray, pivot: np.ndarray, word: np.ndarray) -> np.ndarray:
        """``(n, 2)`` word numbers, each pair once, the smaller first."""
        x, y, low, high = self._facing(group, pivot, self.size[word])
        sub, who = [], []
        for longer in (-1, 0, 1):
            for at, gap, flag in ((y, longer, 0), (x, -longer, 1)):
                other = self.size[word[at]] + gap
                at = at[(low[at] <= other) & (other <= high[at])]
                # The lowest bit tells the pivots, which come last in their half's bucket.
                sub.append(self._halves(group[at], longer, word[at], self.size[word[at]] + gap) & ~np.uint64(1) | np.uint64(flag))
                who.append(np.tile(word[at], 2))
        sub, who = np.concatenate(sub), np.concatenate(who)
        order = np.argsort(sub)
        sub, who = sub[order], who[order]
        first, half = sub & np.uint64(1), sub >> np.uint64(1)
        start = np.flatnonzero(np.append(True, half[1:] != half[:-1])) if len(sub) else np.zeros(0, np.int64)
        rows = np.diff(np.append(start, len(sub)))
        right = np.add.reduceat(first.astype(np.int64), start) if len(start) else rows
        left = rows - right
        some = np.flatnonzero((left > 0) & (right > 0))
        start, left, right = start[some], left[some], right[some]
        # Row by row of the prefix side against all of its bucket's pivots, in slices of candidates.
        row = np.repeat(start, left) + (np.arange(left.sum()) - np.repeat(np.cumsum(left) - left, left))
        begin, width = np.repeat(start + left, left), np.repeat(right, left)
        upto = np.cumsum(width)
        found, at = [np.zeros((0, 2), np.int64)], 0
        while at < len(row):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CANDIDATES, side="right")))
            w = width[at:stop]
            i = np.repeat(row[at:stop], w)
            j = np.repeat(begin[at:stop], w) + (np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w))
            i, j = who[i], who[j]
            one = distinct(np.minimum(i, j) * len(self.words) + np.maximum(i, j))
            i, j = one // len(self.words), one % len(self.words)
            ok = self.near(i, j)
            found.append(np.stack([i[ok], j[ok]], 1))
            at = stop
        i, j = np.concatenate(found).T
        one = distinct(i * len(self.words) + j)
        return np.stack([one // len(self.words), one % len(self.words)], 1)


def near_pairs(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``a, b`` (words, ``a < b``): every pair one edit apart, once."""
    spark = words.sparkSession
    counted = gram_counts(words).collect()  # at most 90 * 90 rows
    frequency, rank = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for k, r in enumerate(sorted(counted, key=lambda r: (r.words, r.gram))):
        frequency[r.gram], rank[r.gram] = r.words, k
    known = spark.sparkContext.broadcast((rank, frequency))
    parts = spark.sparkContext.broadcast(split_keys(words, known, bucket))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "word", WORD_BYTES):
            mine = b.column("word").to_pylist()
            if mine:
                group, pivot, word = dealt(*index_rows(mine, *known.value), mine, parts.value)
                yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(pivot), b.column("word").take(pa.array(word))],
                                                 names=["group", "pivot", "word"])

    def verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def found() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            words = table.column("word").combine_chunks().dictionary_encode()
            names = words.dictionary.to_pylist()
            pairs = Bucketed(names).pairs(np.asarray(table.column("group")), np.asarray(table.column("pivot")),
                                          np.asarray(words.indices).astype(np.int64))
            a, b = ([names[k] for k in side] for side in pairs.T.tolist())
            low = [min(x) for x in zip(a, b)]
            return pa.RecordBatch.from_arrays([pa.array(low, pa.string()), pa.array([max(x) for x in zip(a, b)], pa.string())],
                                              names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            if n >= ROWS:
                # The last group held may go on in this batch.
                last = held[-1].column("group")[-1].as_py()
                cut = int(np.searchsorted(np.asarray(b.column("group")), last, side="right"))
                if cut < b.num_rows:
                    held.append(b.slice(0, cut))
                    yield found()
                    held, n, b = [], 0, b.slice(cut)
            held.append(b)
            n += b.num_rows
        if held:
            yield found()

    n = partitions(spark)
    index = words.select("word").mapInArrow(rows, "group long, pivot boolean, word string")
    return index.repartition(n, "group").sortWithinPartitions("group").mapInArrow(verified, "a string, b string").distinct()


def variants(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    spark, folder = words.sparkSession, scratch_path(words.sparkSession, "spelling")

    def cut(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    # Of equal counts the smallest word: the greatest count, then the least text.
    near = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("top"))
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.minus") >= ratio * F.col("n"), F.col("top")).alias("top"))
    found = cut(joined.select("word", "n", "n_near", F.col("top.other").alias("form"), (-F.col("top.minus")).alias("form_n")), "forms")
    # Pointer jumping: every word with a form points at the last one in the end.
    roots, step = found.filter("form is not null").select("word", F.col("form").alias("root")), 0
    while True:
        over = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step += 1
        jumped = cut(roots.join(over, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots{step}")
        roots = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Spelling variants of the words of ``docs``."""
    words = word_counts(docs)
    path = scratch_path(docs.sparkSession, "words")
    words.write.parquet(path)
    words = docs.sparkSession.read.schema(words.schema).parquet(path)
    return variants(words, near_pairs(words, bucket))
