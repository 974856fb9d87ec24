"""Document fingerprints by winnowing (operator 4).

Rolling hashes of all ``K`` consecutive characters are taken; in every window
of ``WINDOW`` consecutive hashes the smallest is selected, the rightmost where
several are smallest. Positions are kept. Two texts that share
``K + WINDOW - 1`` consecutive characters therefore share a selected hash, and
no match shorter than ``K`` is ever reported.

A fingerprint's text is hexadecimal: per selected hash the distance from the
selection before it (one byte) and the hash (four bytes). Likeness is the
share of common hashes among all distinct hashes of two fingerprints.

Defined results: a text of fewer than ``K`` characters has one hash, of the
whole text; null and empty texts have an empty fingerprint, whose likeness is
1 to another empty one and 0 to all others; equal texts have equal
fingerprints; rows with a null ``doc_id`` order after all others; rows with
equal ``doc_id`` are ordered by text; a single document is its own successor;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.llm.common import partitions, pieces, slice_bounds, slice_of, with_fields

K = 12
WINDOW = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
_NO_ID = -(1 << 63)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _BASE)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, inverse)]), dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


def gram_hashes(chars: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all ``k`` consecutive characters."""
    up, down = _POWERS.get(len(chars) + 1)
    total = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(chars * up[:len(chars)], out=total[1:])
    h = (total[k:] - total[:-k]) * down[:len(chars) - k + 1]
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h >> np.uint64(32)


def sliding_min(values: np.ndarray, window: int) -> np.ndarray:
    """Smallest value of each ``window`` consecutive ones, by doubling."""
    if len(values) <= window:
        return values.min(keepdims=True)
    best, width = values, 1
    while 2 * width <= window:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    n = len(values) - window + 1
    return np.minimum(best[:n], best[window - width:window - width + n])


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Selected hashes and their positions, ascending."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(chars):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    h = gram_hashes(chars, min(k, len(chars)))
    # A later position gives a smaller low half: the rightmost of equal hashes wins.
    best = sliding_min((h << np.uint64(32)) | (_LOW - np.arange(len(h), dtype=np.uint64)), window)
    best = best[np.concatenate([[True], best[1:] != best[:-1]])]
    return (best >> np.uint64(32)).astype(np.uint32), (_LOW - (best & _LOW)).astype(np.int64)


def render(hashes: np.ndarray, positions: np.ndarray) -> str:
    out = np.empty((len(hashes), 5), np.uint8)
    out[:, 0] = np.diff(positions, prepend=-1)
    out[:, 1:] = hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sorted sets of hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id, hashes, positions`` of every document."""
    schema = with_fields(docs.select("doc_id").schema, "hashes array<long>, positions array<long>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            found = [winnow(t or "", k, window) for t in b.column("text").to_pylist()]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([h.astype(np.int64) for h, _ in found], kind),
                pa.array([p for _, p in found], kind)], names=["doc_id", "hashes", "positions"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def with_successor_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text, key, slice, tail``: documents dealt to slices of their
    id's range and sorted by falling id. The first document of each slice is
    added, as ``tail = 1``, to the end of the slice before it (the very first
    to the very last), so every row finds its successor in its own slice."""
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"))
    rows = rows.withColumn("slice", slice_of("key", slice_bounds(rows, "key", n)))
    # One row per slice, as many as shuffle partitions at most.
    heads = sorted(((r.slice, r.key) for r in rows.groupBy("slice").agg(F.max("key").alias("key")).collect()),
                   reverse=True)
    goes_to = [(key, heads[i - 1][0]) for i, (_, key) in enumerate(heads)]
    tails = spark.createDataFrame(goes_to, "key long, slice int")
    tail_rows = rows.drop("slice").join(F.broadcast(tails), "key").select(
        "doc_id", "text", "key", "slice", F.lit(1).alias("tail"))
    return (rows.select("doc_id", "text", "key", "slice", F.lit(0).alias("tail")).unionByName(tail_rows)
            .repartitionById(n, F.col("slice"))
            .sortWithinPartitions("slice", "tail", F.col("key").desc(), "text"))


def successor_report(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Per document: its fingerprint, that of its text with the second half
    replaced by the start of the successor's, and both likenesses."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = with_fields(docs.select("doc_id").schema,
                         "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                         "near_edited double, near_next double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = None  # the row that waits for its successor
        size = 0
        kind = None

        def flush():
            nonlocal out, size
            cols = list(zip(*out))
            types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
            out, size = [], 0
            return made

        def finish(row, follower):
            _, doc_id, text, _, (hashes, positions), own = row
            n = len(text)
            edited = text[:n - n // 2] + follower[2][:n // 2]
            other = winnow(edited, k, window)
            return (doc_id, n, sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), render(hashes, positions),
                    render(*other), likeness(own, np.unique(other[0])), likeness(own, follower[5]))

        for b in pieces(batches, "text"):
            kind = b.column("doc_id").type
            for doc_id, text, s, tail in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "slice", "tail"))):
                if held is not None and held[0] != s:
                    held = None  # the tail row that ended the slice before
                if held is None and tail:
                    continue
                text = text or ""
                found = winnow(text, k, window)
                row = (s, doc_id, text, tail, found, np.unique(found[0]))
                if held is not None and not held[3]:
                    out.append(finish(held, row))
                    size += len(text)
                    if size > 2 << 20 or len(out) >= 2000:
                        yield flush()
                held = row
        if out:
            yield flush()

    return with_successor_rows(docs).mapInArrow(run, schema)
