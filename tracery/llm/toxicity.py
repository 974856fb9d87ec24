"""Toxicity scores by weak supervision (operator 5).

Features of a text are its words and the first three to six letters of its
words. Over a bounded sample of labelled training rows, the features that
separate the labels best become voters: each fires from a count of its own on.
A generative model treats the true label as hidden. It estimates every voter's
firing rates in both classes and the correlations between voters given the
class, by EM; a voter that others repeat is weighted down by them. The human
label is one more voter; its reliability is estimated but held between 0.99 and
0.9999, since a freer one lets the hidden class drift to the toxic texts of the
commonest language. So the posterior stays close to the labels. A logistic
classifier over all selected features is trained on the posterior labels and
scores every text.

Only rows with ``crc32(doc_id) mod LABEL_SPLIT != 0`` are learned from, at most
``SAMPLE`` of them (those with the smallest hash of the id), so what reaches
the driver is bounded: ``FEATURES`` features and the sample's counts of them.
``lang``, ``source``, ``doc_id`` and the labels are no inputs of a score.

Defined results: null and empty texts get the score of a text without any
feature; null labels and null ids are not learned from; of several labels of a
document the highest counts, of several texts the smallest; without training
rows of both labels every score is the share of toxic labels (0 without any);
an empty table gives an empty table; other columns are ignored.
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

from tracery.llm.common import crc_bucket, pieces, with_fields

LABEL_SPLIT = 5
SAMPLE = 10_000
FEATURES = 2048
VOTERS = 96
PREFIXES = (3, 4, 5, 6)
HASH_BITS = 24
CACHE_WORDS = 100_000
_WORD = re.compile(r"[^\W\d_]+").findall

def codes(word: str) -> tuple[int, ...]:
    """Hashed features of a word: the word itself and its beginnings."""
    names = [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]
    return tuple(zlib.crc32(n.encode()) >> (32 - HASH_BITS) for n in names)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and their counts."""
    words = Counter(_WORD((text or "").lower()))
    flat = [(c, n) for w, n in words.items() for c in codes(w)]
    code, count = np.array(flat, np.int64).reshape(-1, 2).T
    distinct, place = np.unique(code, return_inverse=True)
    return distinct, np.bincount(place, count, len(distinct)).astype(np.int64)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, split: int = LABEL_SPLIT) -> DataFrame:
    """``doc_id, text, toxic`` of a bounded sample of labelled training rows, one per id."""
    known = labels.filter(F.col("toxic").isNotNull() & (crc_bucket("doc_id", split) != 0)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # at most ``sample`` rows
    return docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def select_features(rows: DataFrame, n: int = FEATURES) -> list[int]:
    """The features whose presence separates the labels best (chi-square)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            toxic = np.asarray(b.column("toxic"))
            found = [features(t)[0] for t in b.column("text").to_pylist()]
            for label in (0, 1):
                code, often = np.unique(np.concatenate([np.zeros(0, np.int64), *(f for f, y in zip(found, toxic) if y == label)]),
                                        return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(often * (1 - label)), pa.array(often * label)],
                                                 names=["code", "clean", "toxic"])

    total = rows.agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).first()
    if not total.clean or not total.toxic:
        return []
    p, q = F.col("toxic") / F.lit(float(total.toxic)), F.col("clean") / F.lit(float(total.clean))
    share = (F.col("toxic") + F.col("clean")) / F.lit(float(total.toxic + total.clean))
    counts = rows.select("text", "toxic").mapInArrow(run, "code long, clean long, toxic long").groupBy("code").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    best = counts.filter("clean + toxic >= 4").orderBy(
        ((p - q) * (p - q) / (share * (1 - share) + 1e-9)).desc(), "code").limit(n)
    return [r.code for r in best.collect()]


class LabelModel:
    """Hidden labels behind firing voters, by EM."""

    def __init__(self, fired: np.ndarray, gold: np.ndarray, rounds: int = 25):
        n, voters = fired.shape
        post = np.where(gold == 1, 0.95, 0.05)
        self.weight = np.ones(voters)
        for _ in range(rounds):
            mass = np.array([(1 - post).sum(), post.sum()])
            rate = np.stack([((1 - post) @ fired + 0.5) / (mass[0] + 1), (post @ fired + 0.5) / (mass[1] + 1)])
            agree = np.array([((1 - post) * (gold == 0)).sum(), (post * (gold == 1)).sum()])
            # People are trusted at least this far, so the hidden class stays the labelled one.
            right = np.clip((agree + 1) / (mass + 2), 0.99, 0.9999)
            self.weight = 1 / (1 + self._repeated(fired, post, rate))
            on, off = np.log(rate[1] / rate[0]), np.log((1 - rate[1]) / (1 - rate[0]))
            z = np.log((mass[1] + 1) / (mass[0] + 1)) + fired @ (self.weight * (on - off)) + (self.weight * off).sum()
            z += np.where(gold == 1, np.log(right[1] / (1 - right[0])), np.log((1 - right[1]) / right[0]))
            post = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        self.rate, self.right, self.posterior = rate, right, post

    @staticmethod
    def _repeated(fired: np.ndarray, post: np.ndarray, rate: np.ndarray) -> np.ndarray:
        """Sum of each voter's positive correlations with the others, given the class."""
        total = np.zeros(fired.shape[1])
        for w, p in ((1 - post, rate[0]), (post, rate[1])):
            centred = (fired - p) * np.sqrt(w)[:, None]
            cov = centred.T @ centred / max(w.sum(), 1e-9)
            scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = np.clip(cov / scale[:, None] / scale, 0, 1)
            np.fill_diagonal(corr, 0)
            total += corr.sum(1) * w.mean()
        return total


class Classifier:
    def __init__(self, chosen: list[int], weight: np.ndarray, bias: float):
        self.at = {c: i for i, c in enumerate(chosen)}
        self.weight, self.bias = weight, bias
        self.words: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {**self.__dict__, "words": {}}

    def score(self, text: str | None) -> float:
        words, at = self.words, self.at
        flat: list[int] = []
        for w in _WORD((text or "").lower()):
            found = words.get(w)
            if found is None:
                if len(words) >= CACHE_WORDS:
                    words.clear()
                found = words[w] = tuple(at[c] for c in codes(w) if c in at)
            flat += found
        z = self.bias
        if flat:
            z += float(np.log1p(np.bincount(np.array(flat), minlength=len(self.weight))) @ self.weight)
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def _fires_from(counts: np.ndarray, gold: np.ndarray) -> int:
    """The count from which firing agrees best with the labels, 1 to 4."""
    gain = [((counts >= c) & (gold == 1)).sum() / max((gold == 1).sum(), 1)
            - ((counts >= c) & (gold == 0)).sum() / max((gold == 0).sum(), 1) for c in (1, 2, 3, 4)]
    return 1 + int(np.argmax(gain))


def _logistic(rows, cols, values, n, width, target, rounds=300, rate=0.1, l2=1e-4):
    """Adam on the mean log loss of soft labels, over sparse counts."""
    weight, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, values * weight[cols], n) + weight[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / n
        grad = np.append(np.bincount(cols, values * g[rows], width) + l2 * weight[:-1], g.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        weight = weight - rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return weight[:-1], float(weight[-1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    rows = training_rows(docs, labels, sample)
    chosen = select_features(rows)
    if not chosen:
        share = rows.agg(F.avg("toxic")).first()[0] or 0.0
        return Classifier([], np.zeros(0), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    known = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(chosen)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            at, often = [], []
            for text in b.column("text").to_pylist():
                code, n = features(text)
                k = np.minimum(np.searchsorted(known.value, code), len(known.value) - 1)
                hit = known.value[k] == code
                at.append(k[hit].astype(np.int32))
                often.append(n[hit].astype(np.int32))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(at, kind), pa.array(often, kind)],
                                             names=["doc_id", "toxic", "at", "often"])

    schema = with_fields(rows.select("doc_id", "toxic").schema, "at array<int>, often array<int>")
    found = rows.mapInArrow(run, schema).orderBy("doc_id", "toxic").toArrow()
    gold = np.asarray(found.column("toxic")).astype(np.float64)
    at, often = found.column("at").combine_chunks(), found.column("often").combine_chunks()
    row = np.repeat(np.arange(len(gold)), np.diff(np.asarray(at.offsets)))
    col, n = np.asarray(at.flatten()), np.asarray(often.flatten()).astype(np.float64)
    # The voters: features that toxic rows have more often, best first.
    seen = np.zeros((2, len(chosen)))
    np.add.at(seen, (gold[row].astype(int), col), 1)
    share = seen / np.maximum(np.array([[(gold == 0).sum()], [(gold == 1).sum()]]), 1)
    voters = np.argsort(-(share[1] - share[0]) / np.sqrt(share.sum(0) + 1e-9))[:VOTERS]
    counts = np.zeros((len(gold), len(voters)))
    place = np.full(len(chosen), -1)
    place[voters] = np.arange(len(voters))
    voting = place[col] >= 0
    counts[row[voting], place[col[voting]]] = n[voting]
    fired = np.stack([counts[:, j] >= _fires_from(counts[:, j], gold) for j in range(len(voters))], 1).astype(np.float64)
    model = LabelModel(fired, gold)
    weight, bias = _logistic(row, col, np.log1p(n), len(gold), len(chosen), model.posterior)
    return Classifier(known.value.tolist(), weight, bias)


def score_documents(docs: DataFrame, classifier: Classifier, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in pieces(batches, "text"):
            score = pa.array([model.score(t) for t in b.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), score], names=[*keep, "score"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(
        run, with_fields(docs.select(*keep).schema, "score double"))


def reject(docs: DataFrame, classifier: Classifier, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in pieces(batches, "text"):
            yield b.filter(pa.array([model.score(t) < threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_documents(docs, train(docs, labels))
    return scored.select("doc_id", F.coalesce(crc_bucket("doc_id", LABEL_SPLIT) == 0, F.lit(True)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
