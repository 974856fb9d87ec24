"""Benchmark decontamination with one Aho-Corasick automaton (operator 1).

Benchmark items are normalised to words (ASCII lower case, runs of letters,
digits and all non-ASCII characters). Every 13 consecutive words of an item, or
the whole of a shorter item, are a window. All windows go into one automaton
over word numbers; a document is normalised the same way and scanned once, and
hits are mapped back to character offsets of the original text.

A benchmark of at most ``PART_BYTES`` of text is broadcast and its automaton
scans the documents in one map pass. A larger one is taken in parts of that
size: the documents are written once with a row number, one pass per part writes
the hits of its automaton (one row per document hit), and the hits of all parts
are merged by row number. The driver and a worker hold one part at a time.

Defined results: a null or empty text has no words and is not contaminated;
items with null or empty text have no window; the windows of an item without id
hit like others, but there is no id to report or count; items with equal text
are all reported; an empty benchmark contaminates nothing; other columns are
ignored, also where their names clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.llm.common import pieces, utf8, with_fields
from tracery.session import scratch_path

WINDOW = 13
SHARE = 20
#: Benchmark text per automaton and broadcast; every word starts a window of
#: 13 nodes, so an automaton takes a few hundred bytes for each word.
PART_BYTES = 2 << 20
#: On UTF-8 bytes, ``bytes.lower`` changes A-Z only and 0x80-0xFF is exactly the non-ASCII characters.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Windows:
    """The automaton of one part of the benchmark."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        import ahocorasick

        self.number: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = tuple(self.number.setdefault(w, len(self.number) + 1) for w in _WORD.findall(text.lower()))
            for k in range(max(1, len(words) - window + 1) if words else 0):
                held = holders.setdefault(words[k:k + window], set())
                if item is not None:
                    held.add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, found in holders.items():
            self.automaton.add_word(key, (len(key), tuple(sorted(found))))
        if holders:
            self.automaton.make_automaton()
        self.empty = not holders

    def scan(self, words: list[bytes]) -> list[tuple[int, int, tuple[str, ...]]]:
        """``(first word, end word, items)`` of every occurrence."""
        if self.empty:
            return []
        number = self.number.get
        ids = tuple([number(w, 0) for w in words])
        if not any(ids):
            return []
        return [(end + 1 - n, end + 1, items) for end, (n, items) in self.automaton.iter(ids)]


def parts(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in parts of bounded size (a longer item is a part of its own)."""
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary"))
    held: list[tuple[str | None, bytes]] = []
    size = 0
    for item, text in rows.filter("text is not null").toLocalIterator():
        if held and size + len(text) > part_bytes:
            yield held
            held, size = [], 0
        held.append((item, bytes(text)))
        size += len(text)
    if held:
        yield held


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans``: the items found and the merged
    hit spans as character offsets ``[start, end)`` of the original text."""
    held = parts(benchmark, part_bytes)
    first, second = next(held, []), next(held, None)
    schema = with_fields(docs.select("doc_id").schema, "n_words long, n_hit long, items array<string>, "
                         "spans array<struct<start:long,end:long>>")
    if second is not None:
        rows, hits = _passes(docs, chain([first, second], held), window)
        merged = rows.select("row", "d.doc_id", "d.text").join(hits, "row", "left").select("doc_id", "text", "ranges", "items")
        return merged.mapInArrow(_described, schema)
    shared = docs.sparkSession.sparkContext.broadcast(first)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Windows(shared.value, window)
        for b in pieces(batches, "text"):
            yield _report(b.column("doc_id"), [examine(t, automaton) for t in utf8(b.column("text"))])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` without the rows that the rule calls contaminated."""
    held = parts(benchmark, part_bytes)
    first, second = next(held, []), next(held, None)
    if second is not None:
        rows, hits = _passes(docs, chain([first, second], held), WINDOW)
        n_hit = F.aggregate("ranges", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")), _covered)
        bad = hits.select("row", "n_words", n_hit["n"].alias("n_hit")).filter(contaminated())
        return rows.join(bad, "row", "left_anti").select("d.*")
    shared = docs.sparkSession.sparkContext.broadcast(first)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Windows(shared.value)
        for b in pieces(batches, "text"):
            found = [examine(t, automaton)[:2] for t in utf8(b.column("text"))]
            yield b.filter(pa.array([not (hit and SHARE * hit >= n) for n, hit in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def examine(text: bytes, automaton: Windows) -> tuple[int, int, list[str], list[dict]]:
    """Words, words hit, items found and hit spans of one text."""
    lower = text.lower()
    words = _WORD.findall(lower)
    hits = automaton.scan(words)
    ranges = _merged([(s, e) for s, e, _ in hits])
    return len(words), sum(e - s for s, e in ranges), _items(hits), _offsets(text, lower, ranges)


def _items(hits: list[tuple[int, int, tuple[str, ...]]]) -> list[str]:
    return sorted({i for held in {h[2] for h in hits} for i in held})


def _report(doc_id: pa.Array, rows: list[tuple[int, int, list[str], list[dict]]]) -> pa.RecordBatch:
    n_words, n_hit, items, spans = zip(*rows)
    return pa.RecordBatch.from_arrays([
        doc_id, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ], names=["doc_id", "n_words", "n_hit", "items", "spans"])


def _passes(docs: DataFrame, held: Iterable[list[tuple[str | None, bytes]]], window: int) -> tuple[DataFrame, DataFrame]:
    """The documents as ``row, d`` (all columns) and their hits as ``row, n_words,
    ranges`` (word ranges of all parts, ascending), ``items``; one pass per part."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "contamination")
    docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("d")).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    texts = rows.select("row", F.col("d.text").alias("text"))
    for n, part in enumerate(held):
        shared = spark.sparkContext.broadcast(part)
        found = texts.mapInArrow(_scanner(shared, window), _HITS)
        found.write.parquet(f"{folder}/hits/part={n}")
        shared.destroy()
    hits = spark.read.schema(_HITS).parquet(f"{folder}/hits").groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return rows, hits


_HITS = "row long, n_words long, ranges array<struct<start:long,end:long>>, items array<string>"


def _scanner(shared, window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Windows(shared.value, window)
        for b in pieces(batches, "text"):
            out = []
            for row, text in zip(b.column("row").to_pylist(), utf8(b.column("text"))):
                words = _WORD.findall(text.lower())
                hits = automaton.scan(words)
                if hits:
                    ranges = [{"start": s, "end": e} for s, e in _merged([(s, e) for s, e, _ in hits])]
                    out.append({"row": row, "n_words": len(words), "ranges": ranges, "items": _items(hits)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("row", pa.int64()), ("n_words", pa.int64()),
                ("ranges", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ("items", pa.list_(pa.string()))]))

    return run


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, hits and character spans from merged word ranges."""
    for b in pieces(batches, "text"):
        rows = []
        for text, ranges, items in zip(utf8(b.column("text")), b.column("ranges").to_pylist(), b.column("items").to_pylist()):
            lower = text.lower()
            own = _merged([(r["start"], r["end"]) for r in ranges or ()])
            rows.append((len(_WORD.findall(lower)), sum(e - s for s, e in own), items or [], _offsets(text, lower, own)))
        yield _report(b.column("doc_id"), rows)


def _covered(seen, r):
    """Words covered so far by ascending ranges, and where the last one ends."""
    more = F.greatest(r["end"], seen["to"]) - F.greatest(r["start"], seen["to"])
    return F.struct((seen["n"] + F.greatest(more, F.lit(0))).alias("n"), F.greatest(r["end"], seen["to"]).alias("to"))


def _offsets(text: bytes, lower: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as character offsets: UTF-8 bytes that start a character are counted."""
    if not ranges:
        return []
    at = [(m.start(), m.end()) for m in _WORD.finditer(lower)]
    raw = np.frombuffer(text, np.uint8)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [{"start": int(chars[at[s][0]]), "end": int(chars[at[e - 1][1]])} for s, e in ranges]


def contaminated():
    """The rule: some word is hit, and at least one word in ``SHARE``."""
    return (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


#: The same result in DuckDB: all windows of all lengths, joined by their text.
ORACLE = r"""
with item_words as (
  select cast(item_id as varchar) item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark where text is not null),
windows as (
  select distinct item_id, least(len(w), 13) n, array_to_string(w[k:k + least(len(w), 13) - 1], ' ') key
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) k from item_words where len(w) > 0)),
doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from documents),
places as (
  select doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') key
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) k
        from doc_words, (select distinct n from windows) where len(w) >= n)),
hits as (select p.doc_id, p.k, p.n, i.item_id from places p join windows i using (n, key)),
hit_words as (select doc_id, count(distinct j) n_hit from (select doc_id, unnest(range(k, k + n)) j from hits) group by doc_id),
hit_items as (select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id, ',' order by item_id) items
              from hits group by doc_id)
select d.doc_id, len(d.w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(items, '')) items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) contaminated
from doc_words d left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
