"""Token ids in frequency-ranked, byte-aligned files (operator 10).

Documents are encoded with the tokenizers library, an end id is appended, and
the ids are written in ascending ``doc_id`` order as self-contained blocks.

A block holds, in this order (little endian): magic ``FRB1``; counts of
documents, ids and distinct ids (uint32 each); doc ids (int64, with a validity
byte each), ids per document (uint32); the ids by falling frequency in the
block (uint32); control bytes; data bytes. An id is stored as its frequency
rank in 1 to 4 bytes. Control bytes hold four 2-bit lengths each and stand
apart from the data, so a block is decoded by one table lookup per control
byte and one gather per byte position, without a branch per id.

Blocks are rows of a Parquet table, written and read by Spark only. A row also
holds its slice (ascending ranges of ``doc_id``) and the number of ids of the
slice before it, so a document's global position needs one small sum per slice.

Defined results: null text is empty (only the end id); rows with a null
``doc_id`` come first; rows with equal ``doc_id`` are ordered by their ids; an
empty table gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracery.llm.common import PIECE_BYTES, batch, partitions, pieces, slice_bounds, slice_of
from tracery.llm.pair_bpe import byte_letters
from tracery.session import scratch_path

MAGIC = b"FRB1"
BLOCK_IDS = 1 << 20
#: Entries of the per-worker caches of encoded words.
CACHE_ENTRIES = 400_000
#: Fixed value: the pre-token pattern of the byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


class Recent:
    """A bounded cache: entries not used while as many new ones came are dropped."""

    def __init__(self, size: int, make):
        self.size, self.make, self.young, self.old = size, make, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
            self.young[key] = found
        return found

    def all(self, keys: list) -> list:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, keys))
        for i, v in enumerate(found):
            if v is None:
                found[i] = self.get(keys[i])
        return found


class WordEncoder:
    """Encodes texts with a byte-level tokenizer file, each distinct word once.

    Pre-tokens never cross a single space between two non-space characters, so
    a text is the concatenation of its space-separated chunks. The distinct
    chunks of a piece of the column are cut into pre-tokens, these are encoded
    by the library's model and cached, and the texts are put together by
    index. Texts with other spacing are cut by the pre-token pattern; texts
    that hold an added token go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.letters = dict(enumerate(byte_letters()))
        self.pattern = regex.compile(PRE_TOKEN).findall
        self.chunks, self.words = Recent(CACHE_ENTRIES, self._chunk), Recent(CACHE_ENTRIES, self._word)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():  # only the space has another letter
            letters = word.replace(" ", self.letters[32])
        else:
            letters = word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def text(self, text: str) -> bytes:
        """Ids of a text on its own."""
        if any(a in text for a in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.width).tobytes()
        return b"".join(map(self.words.get, self.pattern(text)))

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk after a space."""
        if chunk.isalpha():
            return self._word(f" {chunk}")
        if chunk[-1] in ".,;:!?|" and chunk[:-1].isalpha():
            return self.chunks.get(chunk[:-1]) + self.words.get(chunk[-1])
        return self.text(f" {chunk}")

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column's texts, and ids per text."""
        split = pc.split_pattern(pc.fill_null(column.cast(pa.large_string()), ""), " ")
        first = np.asarray(split.offsets)[:-1] - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        codes = np.array(coded.indices, np.int32)
        distinct = coded.dictionary
        names = distinct.to_pylist()
        if not len(codes):
            return np.zeros(0, self.width), np.zeros(len(column), np.int64)
        inner = pc.utf8_trim_whitespace(distinct)
        odd = np.asarray(pc.or_(pc.not_equal(inner, distinct), pc.equal(inner, "")))[codes]
        # A text's first chunk follows no space: it may begin with one, but not end with one before the next.
        starts = [names[c] for c in codes[first].tolist()]
        size = np.diff(np.append(first, len(codes)))
        odd[first] = [n > 1 and (not c or c[-1].isspace()) for c, n in zip(starts, size.tolist())]
        whole = np.add.reduceat(odd, first) > 0
        for added in self.added:
            special = np.asarray(pc.match_substring(distinct, added))
            if special.any():
                whole |= np.add.reduceat(special[codes], first) > 0
        rest = codes.copy()
        rest[first] = -1
        used = np.zeros(len(names), bool)
        used[rest[(rest >= 0) & ~np.repeat(whole, size)]] = True
        texts = column.to_pylist() if whole.any() else []
        parts = self.chunks.all(names if used.all() else [c if u else "-" for c, u in zip(names, used.tolist())])
        parts += [self.text(texts[i] or "") if w else self.text(c) for i, (c, w) in enumerate(zip(starts, whole.tolist()))]
        pool = np.frombuffer(b"".join(parts), self.width)
        length = np.fromiter(map(len, parts), np.int32, len(parts)) // self.width.itemsize
        begin = np.cumsum(length, dtype=np.int32) - length
        codes[first] = len(names) + np.arange(len(first), dtype=np.int32)
        n = length[codes]
        n[np.repeat(whole, size) & (rest >= 0)] = 0
        at = np.repeat(begin[codes] - (np.cumsum(n, dtype=np.int32) - n), n)
        at += np.arange(len(at), dtype=np.int32)
        return pool[at], np.add.reduceat(n, first, dtype=np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, so its caches serve later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# -- block format ------------------------------------------------------------


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    raw = np.ascontiguousarray(values, "<u4")
    length = 1 + (raw > 0xFF).astype(np.uint8) + (raw > 0xFFFF) + (raw > 0xFFFFFF)
    most = int(length.max(initial=1))
    data = raw.view(np.uint8).reshape(-1, 4)[:, :most][np.arange(most) < length[:, None]]
    codes = np.zeros(-(-len(raw) // 4) * 4, np.uint8)
    codes[:len(raw)] = length - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    length = _LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(length, dtype=np.int64) - length
    value = data[at].astype(np.uint32)
    for k in range(1, int(length.max(initial=1))):
        more = np.flatnonzero(length > k)
        value[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return value


def write_block(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    often = np.bincount(ids)
    by_rank = np.argsort(-often, kind="stable")[:np.count_nonzero(often)]
    rank = np.zeros(len(often), np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    control, data = pack(rank[ids])
    return b"".join([
        MAGIC, struct.pack("<III", len(counts), len(ids), len(by_rank)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is not None for d in doc_ids),
        np.array(counts, "<u4").tobytes(), by_rank.astype("<u4").tobytes(), control, data,
    ])


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Doc ids, ids per document, and all ids of a block."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, n, distinct = struct.unpack_from("<III", block, 4)
    at = 16

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(block, dtype, count, at)
        at += out.nbytes
        return out

    doc_ids, valid = take("<i8", docs), take("u1", docs)
    counts, by_rank, control = take("<u4", docs), take("<u4", distinct), take("u1", -(-n // 4))
    ranks = unpack(control, np.frombuffer(block, np.uint8, -1, at), n) if n else np.zeros(0, np.uint32)
    return [int(d) if v else None for d, v in zip(doc_ids, valid)], counts, by_rank[ranks]


# -- Spark -------------------------------------------------------------------

_ENCODED = pa.schema([("doc_id", pa.int64()), ("slice", pa.int32()), ("ids", pa.binary())])
_BLOCK = pa.schema([("slice", pa.int32()), ("slice_offset", pa.int64()), ("n_ids", pa.int64()), ("block", pa.binary())])
_POSITION = pa.schema([("doc_id", pa.int64()), ("slice", pa.int32()), ("offset", pa.int64()),
                       ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def encode_documents(docs: DataFrame, path: str, end_id: int, n_slices: int) -> DataFrame:
    """``doc_id, slice, ids``: encoded texts, ids as fixed-width binary."""
    bounds = slice_bounds(docs, "doc_id", n_slices)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for b in pieces(batches, "text", 4 * PIECE_BYTES):
            flat, counts = words.encode(b.column("text"))
            data = np.insert(flat, np.cumsum(counts), end_id)
            ends = np.append(0, np.cumsum(counts + 1)) * words.width.itemsize
            ids = pa.Array.from_buffers(pa.binary(), b.num_rows,
                                        [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("slice"), ids], schema=_ENCODED)

    rows = docs.select(F.col("doc_id").cast("long"), slice_of("doc_id", bounds).alias("slice"), "text")
    return rows.mapInArrow(run, "doc_id long, slice int, ids binary")


def write_token_files(docs: DataFrame, path: str, end_id: int, out: str | None = None) -> str:
    """Encode ``docs`` and write token blocks; returns the folder. Each slice
    of doc ids is sorted and streamed into blocks by one task at a time."""
    spark = docs.sparkSession
    n = partitions(spark)
    out = out or scratch_path(spark, "token-files")

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(path).width
        current, offset, doc_ids, ids, held = None, 0, [], [], 0

        def flush():
            nonlocal offset, doc_ids, ids, held
            flat = np.frombuffer(b"".join(ids), width)
            block = write_block(doc_ids, [len(x) // width.itemsize for x in ids], flat)
            made = batch(_BLOCK, slice=[current], slice_offset=[offset], n_ids=[len(flat)], block=[block])
            offset, doc_ids, ids, held = offset + len(flat), [], [], 0
            return made

        for b in batches:
            for d, s, x in zip(*(b.column(c).to_pylist() for c in ("doc_id", "slice", "ids"))):
                if s != current:
                    if ids:
                        yield flush()
                    current, offset = s, 0
                doc_ids.append(d)
                ids.append(x)
                held += len(x) // width.itemsize
                if held >= BLOCK_IDS:
                    yield flush()
        if ids:
            yield flush()

    (encode_documents(docs, path, end_id, n)
     .repartitionById(n, F.col("slice"))
     .sortWithinPartitions("slice", F.col("doc_id").asc_nulls_first(), "ids")
     .mapInArrow(blocks, "slice int, slice_offset long, n_ids long, block binary")
     .write.parquet(out))
    return out


def read_token_files(spark, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, offset, block in zip(*(b.column(c).to_pylist() for c in ("slice", "slice_offset", "block"))):
                doc_ids, counts, ids = read_block(block)
                ends = np.cumsum(counts, dtype=np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * (e - c):4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                yield batch(_POSITION, doc_id=doc_ids, slice=[s] * len(doc_ids), offset=offset + ends - counts,
                            n_tokens=counts.astype(np.int64), ids_crc32=crcs)

    files = spark.read.schema("slice int, slice_offset long, n_ids long, block binary").parquet(folder)
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, as many as shuffle partitions at most.
    totals = (files.groupBy("slice").agg(F.sum("n_ids").alias("n"))
              .select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    placed = files.mapInArrow(decode, "doc_id long, slice int, offset long, n_tokens long, ids_crc32 long")
    return placed.join(F.broadcast(totals), "slice").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
