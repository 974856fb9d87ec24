"""BPE encoding and decoding by a pair occurrence index (operator 8).

The distinct new words of a piece of a partition are merged together: an index
maps every adjacent pair that has a merge rank to all its positions in those
words. Active ranks are taken in ascending order; a rank's merges are applied
at all its positions at once, and the lists of the pairs to the left and right
are extended. Words never influence each other, so this equals merging each
word by its lowest rank first. Where a merge makes a token that an earlier
rank also uses, only the leftmost position of each word is merged before the
ranks are looked at again.

Reads the public tokenizer's JSON file (vocabulary, merges, word-end suffix,
added tokens). Text is brought to NFC and lower case, split at white space and
cut by the file's word pattern, as its normaliser and pre-tokenizer define.

Defined results: null text is empty and has no ids, whose decoding is empty;
other columns are kept only if named in ``keep``; repeated rows are encoded
alike; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tracery.llm.common import give_back, pieces, with_fields

CACHE_ENTRIES = 300_000
#: Fixed value: Unicode white space.
SPACE = r"\t-\r \x85\xa0  -     　"
#: Fixed value: the word pattern of the tokenizer file.
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable bytes stand for themselves, the others follow from U+0100."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


class PairBpe:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab, suffix = file["model"]["vocab"], file["model"]["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        names = {i: t for t, i in {**vocab, **self.added}.items()}
        self.size = max(names) + 1
        self.names = [names.get(i, "") for i in range(self.size)]
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.words_of = regex.compile(WORD).findall
        self.chunks_of = regex.compile(f"[^{SPACE}]+").findall
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = self.left * self.size + self.right
        self.rank_of_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of_key]
        first_use = np.full(self.size, len(pairs), np.int64)
        for side in (self.left, self.right):
            np.minimum.at(first_use, side, np.arange(len(pairs)))
        self.goes_back = first_use[self.made] < np.arange(len(pairs))
        self.ids: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drops the caches at a task's end; the vocabulary stays."""
        self.ids.clear()
        self.chunks.clear()
        give_back()

    # -- merging ---------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of_key[at], -1)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each non-empty word."""
        size = np.array([len(w) for w in words], np.int64)
        n = int(size.sum())
        if not n:
            return []
        ends = np.cumsum(size) - 1
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[raw]
        sym[ends] = self.last[raw[ends]]
        after = np.arange(1, n + 1)
        after[ends] = -1
        before = np.arange(-1, n - 1)
        before[ends - size + 1] = -1
        word = np.repeat(np.arange(len(words)), size)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Enter the pairs that start at these positions."""
            rank = self._ranks(sym[at], sym[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for r, s, e in zip(rank[starts].tolist(), starts, [*starts[1:], len(at)]):
                if r in index:
                    index[r].append(at[s:e])
                else:
                    index[r] = [at[s:e]]
                    heapq.heappush(active, r)

        note(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            nxt = after[at]
            at = at[(sym[at] == a) & (nxt >= 0) & (sym[nxt] == b)]
            if not len(at):
                continue
            if a == b:  # in a run of equal symbols every second position starts a pair
                k = np.arange(len(at))
                new_run = np.ones(len(at), bool)
                new_run[1:] = after[at[:-1]] != at[1:]
                at = at[(k - np.maximum.accumulate(np.where(new_run, k, 0))) % 2 == 0]
            if self.goes_back[r]:
                first = np.unique(word[at], return_index=True)[1]
                rest = np.delete(at, first)
                at = at[first]
                if len(rest):
                    index[r] = [rest]
                    heapq.heappush(active, r)
            gone = after[at]
            sym[at] = self.made[r]
            sym[gone] = -1
            follow = after[gone]
            after[at] = follow
            inside = follow >= 0
            before[follow[inside]] = at[inside]
            prior = before[at]
            note(np.unique(np.concatenate([prior[prior >= 0], at[inside]])))
        kept = sym >= 0
        counts = np.bincount(word[kept], minlength=len(words))
        return np.split(sym[kept], np.cumsum(counts)[:-1])

    # -- texts -----------------------------------------------------------------

    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final-sigma rule
        return text.lower()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.chunks) > CACHE_ENTRIES:
            self.chunks.clear()
        if len(self.ids) > CACHE_ENTRIES:
            self.ids.clear()
        split: list[list] = []
        for text in texts:
            parts: list = []
            for part in self.special.split(text) if self.special and "<|" in text else [text]:
                if part in self.added:
                    parts.append(self.added[part])
                else:
                    parts.extend(self.chunks_of(self.normalise(part)))
            split.append(parts)
        cut = {c: self.words_of(c) for c in {c for parts in split for c in parts
                                             if c not in self.chunks and isinstance(c, str)}}
        new = list({w for ws in cut.values() for w in ws if w not in self.ids})
        for w, ids in zip(new, self.merge([w.encode() for w in new])):
            self.ids[w] = ids.astype("<i4").tobytes()
        for c, ws in cut.items():
            self.chunks[c] = b"".join([self.ids[w] for w in ws])
        chunks = self.chunks
        return [np.frombuffer(b"".join([chunks[c] if isinstance(c, str) else np.int32(c).tobytes() for c in parts]),
                              "<i4") for parts in split]

    def decode(self, ids: np.ndarray) -> str:
        """Token names joined by a space, as the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


_CODECS: dict[str, PairBpe] = {}


def codec(path: str) -> PairBpe:
    """One codec per Python worker; its caches serve one task."""
    if path not in _CODECS:
        _CODECS[path] = PairBpe(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids``."""
    schema = with_fields(docs.select(*keep).schema, "ids array<int>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in pieces(batches, "text"):
            ids = bpe.encode([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*keep, "ids"])
        bpe.forget()

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256``: each text is encoded and its
    ids are decoded again in the same task."""
    from hashlib import sha256

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in pieces(batches, "text"):
            found = bpe.encode([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(x) for x in found], pa.int64()), pa.array(found, pa.list_(pa.int32())),
                pa.array([sha256(bpe.decode(x).encode()).hexdigest() for x in found], pa.string()),
            ], names=["doc_id", "n_tokens", "ids", "decoded_sha256"])
        bpe.forget()

    schema = with_fields(docs.select("doc_id").schema, "n_tokens long, ids array<int>, decoded_sha256 string")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: each text is encoded
    and its ids decoded again in the same task."""
    from hashlib import sha256

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        number = [str(i) for i in range(bpe.size)]
        for b in pieces(batches, "text"):
            found = bpe.encode([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([sha256(" ".join(map(number.__getitem__, x.tolist())).encode()).hexdigest() for x in found],
                         pa.string()),
                pa.array([sha256(bpe.decode(x).encode()).hexdigest() for x in found], pa.string()),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    schema = with_fields(docs.select("doc_id").schema, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
