"""Secret scans: fixed patterns and a character network (operator 7).

Three patterns give the base findings. Candidates are tokens of any kind of 16
or more characters, tokens of 8 or more of a wider class with a digit, what
follows a word such as password, pwd, secret, key or bearer (6 or more
characters of any kind), and the password of a URL. Every candidate that no
base finding overlaps is decided on by a small convolutional network over its
characters and the text around it, in numpy.

The network learns from labelled findings of four kinds: ``base``, candidates
that a base pattern covers (secrets; of every third the context is blanked);
``planted``, made-up secrets of many forms and alphabets, letters only among
them, put at the places of other candidates (secrets); ``clean``, candidates
that no base pattern covers, and ``word``, the corpus's own tokens without
digits or capitals put into the same forms as planted ones (no secrets). So neither the
patterns' keywords nor a keyword alone make a secret.

Its scores are calibrated (Platt scaling) on findings held out of the fit. The
threshold is the largest, in steps of 1/``STEPS`` of log odds, that keeps
``RECALL`` of all held out ``base`` findings of the table and of all held out
``planted`` ones: at every fifth candidate of the corpus one is planted.

At most ``SAMPLE`` findings of each kind, those with the smallest hash of
document and place, train the network; every candidate of every text is scored.
A token of any length is scored over its whole length, in overlapping windows,
and learned from in those that overlap the finding.

Defined results: null and empty texts have no spans; without findings to learn
from only the base patterns apply; repeated rows get equal spans; an empty
table gives an empty table; other columns are ignored. Offsets are characters
``[start, end)`` of the original text.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.llm.common import give_back, pieces, with_fields
from tracery.session import scratch_path

#: The base patterns.
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "learned")

LONG = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
_WIDE = "A-Za-z0-9+/_=.!@#$%^&*~-"
#: Tokens of the wider class with a digit among their first 16 characters.
MIXED = re.compile(rf"(?<![{_WIDE}])(?=[A-Za-z+/_=.!@#$%^&*~-]{{0,15}}[0-9])[{_WIDE}]{{8,}}")
CUES = ("passw", "passp", "passc", "pass ", "pass=", "pass:", "pwd", "secret", "token", "credential", "auth", "bearer", "login", "key")
CUED = re.compile(
    r"""(?ai)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credential|auth(?:orization)?|bearer|login|key)[a-z_]{0,12}["']?"""
    r"""[ \t]*(?:(?:is|was|basic|bearer|:=|=>|[:=])[ \t]*){0,2}["']?([^\s"'<>,;|]{6,})""")
URL = re.compile(r"://[^\s/:@]{1,64}:([^\s/@]{3,})@")
#: What planted secrets look like: where they stand, and what they are made of.
FORMS = ("pwd: {}", "password is {}", "Bearer {}", "Authorization: Basic {}", "login admin / {}", "https://admin:{}@db.example.com/x",
         "ssh key {}", "\"passphrase\": \"{}\"", "AUTH={}", "the secret {}", "--pwd {}", "credentials: {}")
_LOWER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = ((_DIGIT + "abcdef", 16, 40), (_LOWER + _LOWER.upper() + _DIGIT + "+/", 16, 44), (_LOWER, 16, 32),
             (_LOWER + _LOWER.upper(), 12, 32), (_LOWER + _LOWER.upper() + _DIGIT + "!@#$%", 8, 15),
             (_LOWER.upper() + _DIGIT, 12, 24))
FOUND = ("base", "planted", "clean", "word")
SAMPLE = 2000
RECALL = 0.98
#: Histogram bins per unit of log odds, and one of how many findings is held out.
STEPS, HELD = 1024, 5
LEFT, BODY, RIGHT, STRIDE = 24, 64, 8, 56
WIDTH = LEFT + BODY + RIGHT


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind number)`` of the base findings."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of the candidates; those that overlap are one."""
    found = [m.span() for m in LONG.finditer(text)] + [m.span() for m in MIXED.finditer(text)]
    low = text.lower()
    if any(c in low for c in CUES):
        found += [(m.start(1), m.start(1) + max(len(m[1].rstrip(".!?:)")), 6)) for m in CUED.finditer(text)]
    if "://" in text:
        found += [m.span(1) for m in URL.finditer(text)]
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def starts(start: int, end: int) -> range:
    """Where the windows over a token begin."""
    return range(start, max(end - BODY + STRIDE, start + 1), STRIDE)


def windows(text: str, start: int, end: int) -> list[bytes]:
    """The token in windows of ``BODY`` characters, each with the text around the token."""
    left, right = text[max(0, start - LEFT):start].rjust(LEFT, "\0"), text[end:end + RIGHT].ljust(RIGHT, "\0")
    return [(left + text[s:min(end, s + BODY)].ljust(BODY, "\0") + right).encode("ascii", "replace")
            for s in starts(start, end)]


def planted(text: str, start: int, end: int, seed: int) -> Iterator[tuple[str, list[bytes]]]:
    """A made-up secret in place of the token, and the token itself in the
    same form where it looks like a word: ``(kind, windows)``."""
    rng = np.random.default_rng(seed)
    head, tail = FORMS[rng.integers(len(FORMS))].split("{}")
    letters, least, most = ALPHABETS[rng.integers(len(ALPHABETS))]
    secret = "".join(letters[k] for k in rng.integers(len(letters), size=rng.integers(least, most + 1)))
    before, after = text[max(0, start - LEFT):start], text[end:end + RIGHT]
    for kind, value in (("planted", secret), ("word", text[start:end])):
        if kind == "planted" or value.isalpha() and value.islower():
            here = before + head + value + tail + after
            at = len(before) + len(head)
            yield kind, windows(here, at, at + len(value))


class CharNet:
    """Embedding, one convolution, pooling over token and context, logistic output."""

    EMBED, TAPS, FILTERS = 8, 5, 24

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.3, (128, self.EMBED)),
            "conv": rng.normal(0, 0.2, (self.TAPS * (self.EMBED + 1), self.FILTERS)),
            "conv_b": np.zeros(self.FILTERS),
            "out": rng.normal(0, 0.1, 3 * self.FILTERS),
            "out_b": np.zeros(1),
        }
        self.scale, self.shift = 1.0, 0.0
        #: The least log odds of a secret, in steps; None accepts nothing.
        self.cut: int | None = 0
        self.quality: dict[str, tuple[int, int]] = {}
        self.body = np.zeros(WIDTH - self.TAPS + 1, bool)
        self.body[LEFT:LEFT + BODY] = True

    def _forward(self, x: np.ndarray):
        p = self.p
        flag = np.zeros((len(x), WIDTH, 1))
        flag[:, LEFT:LEFT + BODY] = 1
        e = np.concatenate([p["embed"][x] * (x > 0)[..., None], flag], 2)
        n = WIDTH - self.TAPS + 1
        cols = np.concatenate([e[:, k:k + n] for k in range(self.TAPS)], 2)
        act = np.maximum(cols @ p["conv"] + p["conv_b"], 0)
        # Window positions after the token's end carry nothing.
        live = self.body & (x[:, :n] > 0)
        inside = act * live[..., None]
        outside = act * ~self.body[:, None]
        count = np.maximum(live.sum(1), 1)[:, None]
        pooled = np.concatenate([inside.max(1), outside.max(1), inside.sum(1) / count], 1)
        return pooled @ p["out"] + p["out_b"], (cols, act, inside, outside, live, count, pooled)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, rate: float = 0.004, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for s in range(0, len(x), 128):
                take = order[s:s + 128]
                step += 1
                for k, g in self._gradient(x[take], y[take], weight[take]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def _gradient(self, x, y, weight) -> dict[str, np.ndarray]:
        f, c, p = self.FILTERS, self.EMBED + 1, self.p
        z, (cols, act, inside, outside, live, count, pooled) = self._forward(x)
        dz = weight * (1 / (1 + np.exp(-z)) - y) / len(x)
        dpool = dz[:, None] * p["out"]
        dact = (dpool[:, None, 2 * f:] / count[:, None]) * live[..., None]
        rows, filters = np.arange(len(x))[:, None], np.arange(f)
        top = inside.argmax(1)
        dact[rows, top, filters] += dpool[:, :f] * (inside[rows, top, filters] > 0)
        top = outside.argmax(1)
        dact[rows, top, filters] += dpool[:, f:2 * f] * (outside[rows, top, filters] > 0)
        dact *= act > 0
        dcols = dact @ p["conv"].T
        dembed = np.zeros_like(p["embed"])
        n = cols.shape[1]
        for k in range(self.TAPS):
            at = x[:, k:k + n]
            np.add.at(dembed, at.reshape(-1), (dcols[:, :, k * c:k * c + c - 1] * (at > 0)[..., None]).reshape(-1, c - 1))
        return {"embed": dembed, "conv": np.tensordot(cols, dact, ((0, 1), (0, 1))), "conv_b": dact.sum((0, 1)),
                "out": pooled.T @ dz, "out_b": dz.sum(keepdims=True)}

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[s:s + 512])[0] for s in range(0, len(x), 512)] or [np.zeros(0)])

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling by Newton steps."""
        z = self.logits(x)
        a, b = 1.0, 0.0
        target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            g = np.array([((q - target) * z).sum() + 1e-3 * (a - 1), (q - target).sum()])
            v = q * (1 - q) + 1e-9
            h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-3]])
            a, b = np.array([a, b]) - np.linalg.solve(h, g)
        self.scale, self.shift = float(a), float(b)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.scale * self.logits(x) + self.shift, -30, 30)

    def steps(self, x: np.ndarray) -> np.ndarray:
        """Log odds in whole steps."""
        return np.floor(self.log_odds(x) * STEPS).astype(np.int64)

    @property
    def threshold(self) -> float:
        return 1.1 if self.cut is None else float(1 / (1 + np.exp(-self.cut / STEPS)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def as_codes(found: list[bytes]) -> np.ndarray:
    return (np.frombuffer(b"".join(found), np.uint8) & 0x7F).reshape(-1, WIDTH)


def findings(doc_id: object, text: str | None) -> Iterator[tuple[int, str, list[bytes]]]:
    """``(hash of the place, kind, windows)`` of every labelled finding of a text."""
    tokens = candidates(text or "")
    spans = base_spans(text) if tokens else []
    for s, e in tokens:
        order = zlib.crc32(f"{doc_id}:{s}".encode())
        hit = [(x, y) for x, y, _ in spans if s < y and x < e]
        mine = windows(text, s, e)
        if hit:
            yield order, "base", [w for k, w in zip(starts(s, e), mine) if any(k < y and x < min(e, k + BODY) for x, y in hit)]
        else:
            yield order, "clean", mine
            yield from ((order, *made) for made in planted(text, s, e, order))


def sampled(docs: DataFrame, sample: int) -> dict[str, list[tuple[int, bytes]]]:
    """``(hash, windows)`` of at most ``sample`` findings of each kind, by smallest hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, list] = {k: [] for k in FOUND}
        for b in pieces(batches, "text"):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for order, kind, mine in findings(doc_id, text):
                    # The greatest hash is on top, and goes when there are too many.
                    (heapq.heappush if len(best[kind]) < sample else heapq.heappushpop)(best[kind], (-order, b"".join(mine)))
        for kind, held in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(held), pa.string()), pa.array([-o for o, _ in held], pa.int64()),
                                              pa.array([w for _, w in held], pa.binary())], names=["kind", "order", "windows"])
        give_back()

    folder = scratch_path(docs.sparkSession, "secrets")
    docs.select("doc_id", "text").mapInArrow(run, "kind string, order long, windows binary").write.parquet(folder)
    found = docs.sparkSession.read.schema("kind string, order long, windows binary").parquet(folder)
    return {kind: [(r.order, bytes(r.windows)) for r in
                   found.filter(F.col("kind") == kind).orderBy("order", "windows").limit(sample).collect()] for kind in FOUND}


def held_out_scores(docs: DataFrame, net: CharNet) -> DataFrame:
    """``kind, bin, n``: the held out findings of every text by log odds, in steps;
    a finding's score is that of its best window."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            kinds, found = [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for order, kind, mine in findings(doc_id, text):
                    if order % HELD == 0:
                        kinds.append(kind)
                        found.append(mine)
            if found:
                size = np.array([len(x) for x in found])
                steps = shared.value.steps(as_codes([w for x in found for w in x]))
                best = np.maximum.reduceat(steps, np.cumsum(size) - size).tolist()
                total = Counter(zip(kinds, best))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.string()), pa.array([x for _, x in total], pa.int64()),
                                                  pa.array(list(total.values()), pa.int64())], names=["kind", "bin", "n"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "kind string, bin long, n long").groupBy("kind", "bin").agg(F.sum("n").alias("n"))


def set_threshold(docs: DataFrame, net: CharNet, recall: float) -> dict[str, tuple[int, int]]:
    """Sets the largest threshold, in steps, that keeps ``recall`` of the held out
    secrets of each kind; gives the held out findings of every kind and how many
    of them it flags. Only a histogram of bounded size reaches the driver."""
    bins = held_out_scores(docs, net).collect()
    least = []
    for kind in FOUND[:2]:
        mine = sorted((r.bin, r.n) for r in bins if r.kind == kind)
        left = int((1 - recall) * sum(n for _, n in mine))
        for b, n in mine:
            left -= n
            if left < 0:
                least.append(b)
                break
    net.cut = cut = min(least, default=None)
    return {kind: (sum(r.n for r in bins if r.kind == kind),
                   sum(r.n for r in bins if r.kind == kind and cut is not None and r.bin >= cut)) for kind in FOUND}


def train(docs: DataFrame, sample: int = SAMPLE, recall: float = RECALL) -> CharNet | None:
    """Fit on a bounded sample of labelled findings; None without both labels."""
    found = sampled(docs, sample)
    rows = [(order, float(kind in FOUND[:2]), kind, w) for kind in FOUND for order, w in found[kind]]
    x = as_codes([w for _, _, _, w in rows])
    size = [len(w) // WIDTH for _, _, _, w in rows]
    y, held = np.repeat([r[1] for r in rows], size), np.repeat([r[0] % HELD == 0 for r in rows], size).astype(bool)
    base = np.repeat([r[2] == "base" for r in rows], size).astype(bool)
    if not 0 < y.sum() < len(y):
        return None
    if not 0 < y[~held].sum() < (~held).sum():
        held[:] = False
    blank = x[~held & base][::3].copy()
    blank[:, :LEFT] = 0
    blank[:, LEFT + BODY:] = 0
    net = CharNet()
    net.fit(np.concatenate([x[~held], blank]), np.concatenate([y[~held], np.ones(len(blank))]))
    if not 0 < y[held].sum() < held.sum():
        held = ~held
    net.calibrate(x[held], y[held])
    net.quality = set_threshold(docs, net, recall)
    return net


def all_spans(texts: list[str | None], net: CharNet | None) -> list[list[tuple[int, int, int]]]:
    """Base spans of each text and the candidates that the network accepts."""
    spans, waiting, found = [], [], []
    for i, text in enumerate(texts):
        text = text or ""
        base = base_spans(text)
        spans.append(base)
        for s, e in candidates(text) if net else ():
            if not any(s < y and x < e for x, y, _ in base):
                mine = windows(text, s, e)
                waiting.extend([(i, s, e)] * len(mine))
                found.extend(mine)
    if found and net.cut is not None:
        for i, s, e in {w for w, q in zip(waiting, net.steps(as_codes(found)).tolist()) if q >= net.cut}:
            spans[i].append((s, e, 3))
    return [sorted(x) for x in spans]


def find_spans(docs: DataFrame, net: CharNet | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``spans``, an array of ``(start, end, kind)``."""
    schema = with_fields(docs.select(*keep).schema, "spans array<struct<start:long,end:long,kind:string>>")
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            spans = all_spans(b.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(
                [[{"start": s, "end": e, "kind": KINDS[k]} for s, e, k in x] for x in spans], kind)],
                names=[*keep, "spans"])
        give_back()

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Train on the table's own labelled findings, then scan it."""
    return find_spans(docs, train(docs), keep)


def digest(found: DataFrame) -> DataFrame:
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS[:3]],
                        F.sha2(text(F.filter("spans", lambda s: s["kind"] != "learned")), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"), count("learned"))


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """Each span, or run of overlapping spans, replaced by ``mask``."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span masked; null texts and all other columns stay,
    but ``n_chars``, where there is one, follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            texts = b.column("text").to_pylist()
            spans = all_spans(texts, shared.value)
            texts = [masked(t, [x[:2] for x in s], mask) if s else t for t, s in zip(texts, spans)]
            new = {"text": texts}
            if "n_chars" in b.schema.names:
                new["n_chars"] = [len(t) if s else n for t, s, n in zip(texts, spans, b.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[f.name], f.type) if f.name in new else b.column(f.name) for f in b.schema], schema=b.schema)
        give_back()

    return docs.mapInArrow(run, docs.schema)
