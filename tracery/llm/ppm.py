"""Language-model scores by prediction by partial matching (operator 2).

A text is lower-cased (A-Z) and read as words, one space between them and an
end sign. The model is a trie of byte contexts up to ``ORDER`` bytes, learned
from the training documents. A byte's probability is its count at the longest
context that has seen it; each longer context that has not gives an escape with
probability ``q / (t + q)`` (``q`` distinct and ``t`` all bytes seen there).
Bytes seen at a longer context are excluded from the shorter ones. Below order
0 the bytes never seen are equally likely.

How it is spread: a trie node's context and byte are one gram of ``ORDER + 1``
bytes in a 64-bit key. Pieces of the corpus count their distinct grams and
words (64-bit hashes) in numpy; the counts are summed by ranges of the key's
hash. Escapes need a context together with its shorter forms, so grams are
regrouped by the context's last two bytes; the order-1 counts below that are at
most 65,536 numbers and are broadcast. Blocks of documents then ask for just
their own distinct grams and words by the same ranges, and are scored by
lookup. Nothing that grows with the corpus reaches the driver or a single
task: a key has one entry per block, however often it occurs.

Defined results: a null or empty text is only the end sign; a null ``doc_id``
hashes as empty text; without training documents every byte is equally likely
and the base score is 0; repeated rows are scored each; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.llm.common import pieces, utf8, with_fields
from tracery.llm.winnow import _POWERS
from tracery.session import scratch_path

ORDER = 5
#: Text per block and per piece of the corpus that is counted at once.
BLOCK_BYTES = 8 << 20
#: Text whose codes are held at once within a block.
CHUNK_BYTES = 1 << 20
BLOCKS_PER_RANGE = 4
GRAM, WORD = 0, 1
HELD_OUT_IN = 10
_MIX = np.uint64(0xD6E8FEB86659FD93)
_END_WORD = np.uint64(0x51ED270B0A1F39C1)
_B = np.uint64(8)


def mix(keys: np.ndarray) -> np.ndarray:
    h = keys ^ (keys >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def stream(text: bytes) -> bytes:
    return b" ".join(text.lower().split()) + b"\n"


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of streams of about ``size`` bytes: ``(first text, streams)``."""
    first, held, total = 0, [], 0
    for i, text in enumerate(texts):
        held.append(stream(text))
        total += len(held[-1])
        if total >= size:
            yield first, held
            first, held, total = i + 1, [], 0
    if held:
        yield first, held


def grams(streams: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """One key per byte, the byte and the ``order`` bytes before it in its
    stream (zero before the start), and the streams' lengths."""
    size = np.array([len(s) for s in streams], np.int64)
    raw = np.frombuffer(b"".join([b"\0" * order + s for s in streams]), np.uint8).astype(np.uint64)
    n = len(raw) - order
    code = np.zeros(n, np.uint64)
    for j in range(order + 1):
        code = (code << _B) | raw[j:n + j]
    begin = np.cumsum(size + order) - (size + order)
    keep = np.ones(n, bool)
    for j in range(1, order + 1):
        keep[begin[1:] - j] = False
    return code[keep], size


def words(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One key per token, end signs included, and tokens per stream."""
    raw = np.frombuffer(b"".join(streams), np.uint8)
    up, down = _POWERS.get(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    end = np.flatnonzero((raw == 32) | (raw == 10))
    start = np.append(0, end[:-1] + 1)
    length = end - start
    key = mix((total[end] - total[start]) * down[start] + length.astype(np.uint64) * _MIX)
    last = raw[end] == 10
    # A stream's end is a token of its own, after its last word (if it has one).
    repeat = np.where(last & (length > 0), 2, 1)
    out = np.repeat(key, repeat)
    at = np.cumsum(repeat) - 1
    out[at[last]] = _END_WORD
    return out, np.diff(np.append(0, at[last] + 1))


def counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their summed weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, weights.dtype)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.diff(np.append(first, len(keys)))


def by_range(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts keys by range, the ranges present, and their starts."""
    ranges = (mix(keys) >> np.uint64(16)) % np.uint64(n)
    order = np.argsort(ranges.astype(np.uint16 if n < 1 << 16 else np.uint64), kind="stable")
    present, start = np.unique(ranges[order], return_index=True)
    return order, present.astype(np.int64), np.append(start, len(keys))


# -- the model ---------------------------------------------------------------


def gram_scores(keys: np.ndarray, counts: np.ndarray, bigrams: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of each gram's last byte after its context.

    ``keys`` (ascending) hold every gram of the contexts' last-two-bytes group,
    ``counts`` their training counts (0 if only asked for), ``bigrams`` the
    256 x 256 order-1 counts.
    """
    score = np.zeros(len(keys))
    open_ = np.ones(len(keys), bool)
    seen = counts > 0
    level, count = keys[seen], counts[seen].astype(np.float64)
    above = None  # the next longer order's nodes
    for k in range(order, -1, -1):
        if k < order:
            if k >= 2:
                level, count = counted(level & np.uint64((1 << 8 * (k + 1)) - 1), count)
            else:
                dense = bigrams if k == 1 else bigrams.sum(0, keepdims=True)
                level = np.flatnonzero(dense.reshape(-1)).astype(np.uint64)
                count = dense.reshape(-1)[level.astype(np.int64)].astype(np.float64)
        mine = keys & np.uint64((1 << 8 * (k + 1)) - 1)
        total, kinds = _nodes(level, count, mine >> _B)
        if above is not None:
            # What the longer context has seen is excluded here.
            low = above & np.uint64((1 << 8 * (k + 1)) - 1)
            gone, gone_kinds = _nodes(above, _lookup(level, count, low), (keys & np.uint64((1 << 8 * (k + 2)) - 1)) >> _B)
            total, kinds = total - gone, kinds - gone_kinds
        here = _lookup(level, count, mine)
        hit = open_ & (here > 0)
        score[hit] += np.log10(here[hit] / (total[hit] + kinds[hit]))
        escape = open_ & ~hit & (kinds > 0)
        score[escape] += np.log10(kinds[escape] / (total[escape] + kinds[escape]))
        open_ &= ~hit
        above = level
    score[open_] -= np.log10(max(1, 256 - len(level)))
    return score


def _lookup(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def _nodes(keys: np.ndarray, counts: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of counts and number of bytes at each asked context."""
    if not len(keys):
        return np.zeros(len(contexts)), np.zeros(len(contexts))
    own = keys >> _B
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    return (_lookup(own[first], np.add.reduceat(counts, first), contexts),
            _lookup(own[first], np.diff(np.append(first, len(own))).astype(np.float64), contexts))


# -- Spark -------------------------------------------------------------------

_KEYS = "range long, kind int, keys binary, counts binary"


def _u64(blobs: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<u8")


def training_counts(docs: DataFrame, n_ranges: int, order: int = ORDER) -> DataFrame:
    """Counts of every distinct gram and word, summed by range. Held-out
    documents contribute their keys with count 0. ``docs``: ``text, held_out``."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", BLOCK_BYTES):
            held = b.column("held_out").to_pylist()
            texts = utf8(b.column("text"))
            found: dict[int, list] = {GRAM: [], WORD: []}
            for learn in (True, False):
                for _, streams in chunks([t for t, h in zip(texts, held) if h != learn]):
                    for kind, keys in ((GRAM, grams(streams, order)[0]), (WORD, words(streams)[0])):
                        one, n = distinct(keys)
                        found[kind].append((one, n if learn else np.zeros_like(n)))
            for kind, parts in found.items():
                keys, n = counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                place, ranges, start = by_range(keys, n_ranges)
                keys, n = keys[place].astype("<u8"), n[place].astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array(ranges), pa.array(np.full(len(ranges), kind, np.int32)),
                    pa.array([keys[s:e].tobytes() for s, e in zip(start, start[1:])], pa.binary()),
                    pa.array([n[s:e].tobytes() for s, e in zip(start, start[1:])], pa.binary()),
                ], names=["range", "kind", "keys", "counts"])

    def add(table: pa.Table) -> pa.Table:
        out = []
        kinds = np.asarray(table.column("kind"))
        all_keys, all_counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()
        for kind in (GRAM, WORD):
            rows = np.flatnonzero(kinds == kind)
            keys, n = counted(_u64(all_keys[i] for i in rows),
                              np.frombuffer(b"".join([all_counts[i] for i in rows]), "<u4").astype(np.uint64))
            out.append((table.column("range")[0].as_py(), kind, keys.astype("<u8").tobytes(), n.astype("<u8").tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                        names=["range", "kind", "keys", "counts"])

    return docs.mapInArrow(gather, _KEYS).groupBy("range").applyInArrow(add, _KEYS)


def corpus_totals(counts: DataFrame) -> tuple[int, int]:
    """Training tokens and distinct training tokens."""

    def run(batches):
        for b in batches:
            n = [np.frombuffer(x, "<u8") for x in b.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x.sum()) for x in n], pa.int64()),
                                              pa.array([int((x > 0).sum()) for x in n], pa.int64())], names=["n", "v"])

    row = counts.filter(F.col("kind") == WORD).mapInArrow(run, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return int(row[0] or 0), int(row[1] or 0)


def bigram_counts(counts: DataFrame) -> np.ndarray:
    """Order-1 counts, at most 256 x 256."""

    def run(batches):
        for b in batches:
            for keys, n in zip(b.column("keys").to_pylist(), b.column("counts").to_pylist()):
                code, total = counted(np.frombuffer(keys, "<u8") & np.uint64(0xFFFF),
                                      np.frombuffer(n, "<u8"))
                yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(total.astype(np.int64))],
                                                 names=["code", "n"])

    out = np.zeros(1 << 16)
    rows = counts.filter(F.col("kind") == GRAM).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    for r in rows.collect():
        out[r.code] = r.n
    return out.reshape(256, 256)


def gram_table(counts: DataFrame, bigrams: np.ndarray, n_ranges: int, order: int = ORDER) -> DataFrame:
    """``range, kind, keys, values``: log10 probability of every gram, by range again."""
    shared = counts.sparkSession.sparkContext.broadcast(bigrams)

    def split(batches):
        for b in batches:
            for keys, n in zip(b.column("keys").to_pylist(), b.column("counts").to_pylist()):
                keys, n = np.frombuffer(keys, "<u8"), np.frombuffer(n, "<u8")
                place, shards, start = by_range((keys >> _B) & np.uint64(0xFFFF), n_ranges)
                keys, n = keys[place], n[place]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shards), pa.array([keys[s:e].tobytes() for s, e in zip(start, start[1:])], pa.binary()),
                    pa.array([n[s:e].tobytes() for s, e in zip(start, start[1:])], pa.binary()),
                ], names=["shard", "keys", "counts"])

    def score(table: pa.Table) -> pa.Table:
        keys, n = counted(_u64(table.column("keys").to_pylist()), _u64(table.column("counts").to_pylist()))
        values = gram_scores(keys, n, shared.value, order).astype("<f4")
        place, ranges, start = by_range(keys, n_ranges)
        keys, values = keys[place].astype("<u8"), values[place]
        return pa.table([
            pa.array(ranges), pa.array(np.full(len(ranges), GRAM, np.int32)),
            pa.array([keys[s:e].tobytes() for s, e in zip(start, start[1:])], pa.binary()),
            pa.array([values[s:e].tobytes() for s, e in zip(start, start[1:])], pa.binary()),
        ], names=["range", "kind", "keys", "values"])

    return (counts.filter(F.col("kind") == GRAM).mapInArrow(split, "shard long, keys binary, counts binary")
            .groupBy("shard").applyInArrow(score, "range long, kind int, keys binary, values binary"))


def _asked(texts: list[bytes], order: int) -> dict[int, np.ndarray]:
    """Distinct grams and words of a block."""
    found: dict[int, list] = {GRAM: [], WORD: []}
    for _, streams in chunks(texts):
        found[GRAM].append(distinct(grams(streams, order)[0])[0])
        found[WORD].append(distinct(words(streams)[0])[0])
    return {kind: distinct(np.concatenate(parts))[0] for kind, parts in found.items()}


def score_documents(docs: DataFrame, counts: DataFrame, n_blocks: int, n_ranges: int, order: int = ORDER) -> DataFrame:
    """``doc_id, n_tokens, n_known, sum_log, score``: ``sum_log`` is the sum of
    log10(count + 0.1) over the tokens, ``score`` the model's log10 probability."""
    blocks = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block"))
    blocks = blocks.repartition(n_blocks, "block")

    def ask(table: pa.Table) -> pa.Table:
        block, out = table.column("block")[0].as_py(), []
        for kind, keys in _asked(utf8(table.column("text").combine_chunks()), order).items():
            place, ranges, start = by_range(keys, n_ranges)
            keys = keys[place].astype("<u8")
            out += [(block, r, kind, keys[s:e].tobytes()) for r, s, e in zip(ranges.tolist(), start, start[1:])]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                        names=["block", "range", "kind", "keys"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        kinds, known_kinds = np.asarray(asked.column("kind")), np.asarray(known.column("kind"))
        blobs = {c: known.column(c).to_pylist() for c in ("keys", "values")}
        block, key_blobs = asked.column("block").to_pylist(), asked.column("keys").to_pylist()
        for kind, dtype in ((GRAM, "<f4"), (WORD, "<u8")):
            rows = np.flatnonzero(known_kinds == kind)
            keys = _u64(blobs["keys"][i] for i in rows)
            values = np.frombuffer(b"".join([blobs["values"][i] for i in rows]), dtype)
            order_ = np.argsort(keys)
            keys, values = keys[order_], values[order_]
            for i in np.flatnonzero(kinds == kind):
                found = values[np.searchsorted(keys, np.frombuffer(key_blobs[i], "<u8"))]
                if kind == WORD and (not len(found) or found.max() < 1 << 32):
                    found = found.astype("<u4")
                out.append((block[i], asked.column("range")[0].as_py(), kind, found.tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))]
                        if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.binary())],
                        names=["block", "range", "kind", "values"])

    schema = with_fields(docs.select("doc_id").schema, "n_tokens long, n_known long, sum_log double, score double")

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts = utf8(table.column("text").combine_chunks())
        values = {}
        kinds, ranges = np.asarray(answers.column("kind")), np.asarray(answers.column("range"))
        blobs = answers.column("values").to_pylist()
        asked = _asked(texts, order)
        for kind, keys in asked.items():
            place, present, start = by_range(keys, n_ranges)
            size = dict(zip(present.tolist(), np.diff(start).tolist()))
            out = np.empty(len(keys), np.float64)
            rows = np.flatnonzero(kinds == kind)
            rows = rows[np.argsort(ranges[rows])]
            out[place] = np.concatenate([_values(blobs[i], kind, size[int(ranges[i])]) for i in rows])
            values[kind] = out
        log_count, known = np.log10(values[WORD] + 0.1), values[WORD] > 0
        n_tokens, n_known, sum_log, score = [], [], [], []
        for _, streams in chunks(texts):
            code, size = grams(streams, order)
            score.append(np.add.reduceat(values[GRAM][np.searchsorted(asked[GRAM], code)], np.cumsum(size) - size))
            token, n = words(streams)
            at = np.searchsorted(asked[WORD], token)
            first = np.cumsum(n) - n
            n_tokens.append(n)
            n_known.append(np.add.reduceat(known[at].astype(np.int64), first))
            sum_log.append(np.add.reduceat(log_count[at], first))
        return pa.table([table.column("doc_id"), *(pa.array(np.concatenate(x)) for x in (n_tokens, n_known, sum_log, score))],
                        names=["doc_id", "n_tokens", "n_known", "sum_log", "score"])

    asked = blocks.groupBy("block").applyInArrow(ask, "block long, range long, kind int, keys binary")
    known = gram_table(counts, bigram_counts(counts), n_ranges, order).unionByName(
        counts.filter(F.col("kind") == WORD).withColumnRenamed("counts", "values"))
    answers = asked.groupBy("range").cogroup(known.groupBy("range")).applyInArrow(
        answer, "block long, range long, kind int, values binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, schema)


def _values(blob: bytes, kind: int, n: int) -> np.ndarray:
    if kind == GRAM:
        return np.frombuffer(blob, "<f4").astype(np.float64)
    return np.frombuffer(blob, "<u4" if len(blob) == 4 * n else "<u8").astype(np.float64)


def score_corpus(docs: DataFrame, order: int = ORDER, held_out_in: int = HELD_OUT_IN) -> DataFrame:
    """Learn from the documents whose crc32 bucket is not 0 and score all."""
    spark = docs.sparkSession
    bucket = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(held_out_in))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    n_ranges = max(1, -(-n_blocks // BLOCKS_PER_RANGE))
    folder = scratch_path(spark, "ppm-counts")
    training_counts(docs.select("text", (bucket == 0).alias("held_out")), n_ranges, order).write.parquet(folder)
    counts = spark.read.schema(_KEYS).parquet(folder)
    total, distinct_words = corpus_totals(counts)
    scored = score_documents(docs, counts, n_blocks, n_ranges, order)
    per_token = float(np.log10(total + 0.1 * (distinct_words + 1)))
    return scored.select(
        "doc_id", (bucket == 0).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("sum_log") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), "score")
