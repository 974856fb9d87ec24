"""Every operator against a plain version, on odd rows and on real ones."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import ROWS, SENTENCE, bag, pairs
from tracery.llm import (decontaminate, near_dup, pair_bpe, ppm, secrets, substring_dedup, token_files, toxicity, warc,
                         winnow)
from tracery.llm.queries import ORACLES, QUERIES, tokenizer

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.fixture(params=["odd", "small", "empty"])
def docs(request):
    return request.getfixturevalue(request.param)


# -- 1 ------------------------------------------------------------------------

def test_decontaminate(spark, docs, root):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    items += [(900, SENTENCE), (901, SENTENCE), (902, "one two"), (903, None), (904, ""), (905, "İstanbul"),
              (None, "two"), (None, SENTENCE + "x"), (None, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = decontaminate.digest(decontaminate.find_contamination(docs, benchmark))
    want = brute.contamination(pairs(docs), items)
    assert ordered(tuple(r) for r in got.collect()) == ordered(want)
    # The same with a pass for each of several parts.
    part_bytes = sum(len(t or "") for _, t in items) // 4
    assert sum(1 for _ in decontaminate.parts(benchmark, part_bytes)) > 2
    parts = decontaminate.find_contamination(docs, benchmark, part_bytes=part_bytes)
    assert bag(decontaminate.digest(parts), *got.columns) == ordered(want)
    assert bag(parts, *parts.columns) == bag(decontaminate.find_contamination(docs, benchmark), *parts.columns)
    for kept in (decontaminate.remove_contaminated(docs, benchmark),
                 decontaminate.remove_contaminated(docs, benchmark, part_bytes)):
        assert kept.columns == docs.columns
        assert bag(kept, "doc_id") == ordered((w[0],) for w in want if not w[5])


def test_items_without_id_in_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    docs = spark.createDataFrame([(1, SENTENCE), (2, "one two"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, SENTENCE), (7, "two"), (None, "two"), (None, None)], "item_id long, text string")
    got = decontaminate.digest(decontaminate.find_contamination(docs, items))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("benchmark", items.toArrow())
    want = con.execute(decontaminate.ORACLE).to_arrow_table().select(got.columns).to_pylist()
    assert bag(got, *got.columns) == ordered(tuple(r.values()) for r in want)
    assert [(r.n_hit > 0, r.n_items) for r in got.orderBy("doc_id").collect()] == [(True, 0), (True, 1), (False, 0)]


def test_contaminated_spans_map_to_the_original(spark):
    text = "Ünï — The QUICK brown-fox, jumps…"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    span = decontaminate.find_contamination(docs, items).first().spans[0]
    assert text[span.start:span.end] == "QUICK brown-fox"


def test_empty_benchmark(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(decontaminate.find_contamination(odd, none)).filter("contaminated").count() == 0


# -- 2 ------------------------------------------------------------------------

def test_ppm(docs):
    got = {}
    for r in ppm.score_corpus(docs).collect():
        got.setdefault(repr((r.doc_id, r.n_tokens)), []).append(r)
    rows = [(d, t if t is None or len(t) < 20000 else t) for d, t in pairs(docs)]
    want = brute.ppm(rows)
    assert sum(map(len, got.values())) == len(want)
    for doc_id, held, tokens, known, total, base, score in want:
        near_ones = [r for r in got[repr((doc_id, tokens))] if r.n_known == known and r.train_tokens == total
                     and r.held_out == held and abs(r.base_score - base) <= 1e-6 * abs(base) + 1e-9
                     and abs(r.score - score) <= 1e-5 * abs(score) + 1e-9]
        assert near_ones, (doc_id, tokens, known, total, base, score, got[repr((doc_id, tokens))])


# -- 3 ------------------------------------------------------------------------

def test_substring_dedup(docs):
    got = substring_dedup.dedup(docs)
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute.substrings(pairs(docs)))


def test_substring_dedup_over_many_blocks(odd):
    got = substring_dedup.repeated_spans(odd, 7, 5)
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute.substrings(pairs(odd)))


def test_suffix_array_and_common_prefixes():
    from tracery.llm.suffix_array import permuted_common_prefixes, suffix_array

    rng = np.random.default_rng(5)
    for _ in range(150):
        n, kinds = int(rng.integers(1, 160)), int(rng.choice([1, 2, 3, 30]))
        text = rng.integers(0, kinds, n).astype(np.uint8)
        if rng.random() < 0.3:
            text = np.tile(text[:int(rng.integers(1, 9))], 30)[:n]
        n = len(text)
        raw = text.tobytes()
        sa = suffix_array(text)
        assert sa.tolist() == sorted(range(n), key=lambda i: raw[i:])
        common = permuted_common_prefixes(text, sa, np.full(n, n))
        for x, y in zip(sa[1:], sa[:-1]):
            assert common[x] == len(os.path.commonprefix([raw[x:], raw[y:]]))


# -- 4 ------------------------------------------------------------------------

def test_winnowing(docs):
    got = ordered(tuple(r) for r in winnow.successor_report(docs).collect())
    rows = sorted(((d, t or "", d if d is not None else -(1 << 63)) for d, t in pairs(docs)), key=lambda r: (-r[2], r[1]))
    want = []
    for i, (doc_id, text, _) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        n = len(text)
        edited = text[:n - n // 2] + after[:n // 2]
        own, other, follower = (brute.winnowed(t, winnow.gram_hashes) for t in (text, edited, after))
        want.append((doc_id, n, brute.sha(edited), brute.rendered(*own), brute.rendered(*other),
                     brute.jaccard(own[1], other[1]), brute.jaccard(own[1], follower[1])))
    assert [g[:5] for g in got] == [w[:5] for w in ordered(want)]
    for g, w in zip(got, ordered(want)):
        assert g[5:] == pytest.approx(w[5:])


def test_winnowing_guarantee():
    rng = np.random.default_rng(3)
    letters = np.array(list("abcd "))
    common = "".join(rng.choice(letters, winnow.K + winnow.WINDOW - 1))
    for _ in range(30):
        a, b = ("".join(rng.choice(letters, 100)) + common + "".join(rng.choice(letters, 50)) for _ in range(2))
        assert set(winnow.winnow(a)[0]) & set(winnow.winnow(b)[0])


# -- 5 ------------------------------------------------------------------------

def test_toxicity_learns_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = toxicity.report(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in rows if r.toxic == 1]
    rest = [r.score for r in rows if r.toxic == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in rest])
    assert auc > 0.9
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (3, 1), (9, 0), (10, 0), (13, 0), (None, 1), (14, None), (7, 0), (17, 1)],
                                   "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    got = toxicity.report(odd, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (4, 5, 6)}) == 1
    assert toxicity.report(empty, labels).count() == 0
    assert toxicity.report(odd, labels.limit(0)).filter("score < 0.5").count() == len(ROWS)
    model = toxicity.train(odd, labels)
    assert toxicity.reject(odd, model).columns == odd.columns


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    rates = np.array([[0.02, 0.8], [0.1, 0.6], [0.3, 0.35]])
    fired = np.stack([rng.random(4000) < np.where(y, hi, lo) for lo, hi in rates], 1).astype(float)
    gold = np.where(rng.random(4000) < 0.02, ~y, y).astype(float)
    model = toxicity.LabelModel(np.hstack([fired, fired[:, :1]]), gold)
    assert np.abs(model.rate[:, :3].T - rates).max() < 0.06
    assert model.weight[0] < 0.7 and model.weight[1] > 0.8  # the repeated voter counts less
    assert ((model.posterior > 0.5) == y).mean() > 0.97


# -- 6 ------------------------------------------------------------------------

def test_warc_records(spark, tmp_path):
    html = ("<html><head><title>A &amp; B</title><style>p{}</style></head><body><script>x<y</script><!-- no -->"
            "<p>One<br>two &lt;3</p><a class=\"x\" href=\"/l\">link</a></body>")
    pages = spark.createDataFrame([(1, "http://x/ y", html), (2, None, None), (2, None, None), (None, "u", "")],
                                  "page_id long, url string, html string").withColumn("block", F.lit(1))
    records = warc.derivatives(warc.responses(pages))
    rows = records.collect()
    assert len(rows) == 8
    text = next(r for r in rows if r.page_id == 1 and r.warc_type == "conversion")
    meta = next(r for r in rows if r.page_id == 1 and r.warc_type == "metadata")
    assert text.block == "One\ntwo <3\nlink"
    assert "title: A & B\r\n" in meta.block and "outlink: /l\r\n" in meta.block
    assert text.refers_to == meta.refers_to and f"WARC-Concurrent-To: {meta.record_id}" in text.header
    warc.write_warc(records, str(tmp_path / "w"), "none")
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    found = 0
    while raw:  # as a WARC reader does: header, length, block, two line ends
        head, _, rest = raw.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        size = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert brute.sha(rest[:size]).encode() in head and rest[size:size + 4] == b"\r\n\r\n"
        raw, found = rest[size + 4:], found + 1
    assert found == 8
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


# -- 7 ------------------------------------------------------------------------

def base_secrets(text):
    found = []
    assign = secrets.ASSIGN.pattern
    import re
    for m in re.finditer(assign, text or ""):
        if len(m[2]) >= 6:
            found.append((m.start(), m.end(), "assign"))
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[0], ["assign", "access", "hex"].index(x[2])))


def test_secret_scan(docs):
    got = secrets.digest(secrets.scan(docs)).collect()
    want = []
    for doc_id, text in pairs(docs):
        spans = base_secrets(text)
        count = [sum(k == kind for _, _, k in spans) for kind in ("assign", "access", "hex")]
        want.append((doc_id, *count, brute.sha(",".join(f"{k}:{s}:{e}" for s, e, k in spans))))
    assert ordered((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == ordered(want)
    assert all(r.n_learned >= 0 for r in got)


def test_network_learns_labelled_findings():
    rng = np.random.default_rng(4)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(300)]
    numbers = ["".join(rng.choice(list("0123456789"), 16)) for _ in range(300)]
    x = secrets.as_codes([secrets.windows(f"some words token = {h} and more", 19, 59)[0] for h in hexes]
                         + [secrets.windows(f"call us at {n} today", 11, 27)[0] for n in numbers])
    y = np.repeat([1.0, 0.0], 300)
    net = secrets.CharNet()
    order = rng.permutation(600)
    net.fit(x[order[:400]], y[order[:400]])
    net.calibrate(x[order[400:]], y[order[400:]])
    accepted = net.score(x[order[400:]]) >= 0.5
    assert accepted[y[order[400:]] == 1].mean() >= 0.95 and accepted[y[order[400:]] == 0].mean() < 0.05


def test_network_gradient():
    rng = np.random.default_rng(2)
    net = secrets.CharNet()
    x, y, w = rng.integers(0, 128, (6, secrets.WIDTH)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0.0]), np.ones(6)

    def loss():
        z = net._forward(x)[0]
        return float(np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))))

    grad = net._gradient(x, y, w)
    for name, at in (("conv", (3, 2)), ("out", (5,)), ("embed", (int(x[0, 30]), 1)), ("conv_b", (4,)), ("out_b", (0,))):
        keep, step = net.p[name][at], 1e-5
        net.p[name][at] = keep + step
        high = loss()
        net.p[name][at] = keep - step
        low = loss()
        net.p[name][at] = keep
        assert grad[name][at] == pytest.approx((high - low) / (2 * step), abs=1e-5)


def test_redact(spark, odd):
    clean = secrets.redact(odd)
    assert clean.columns == odd.columns and clean.count() == len(ROWS)
    text = clean.filter("doc_id = 14").first()
    assert "hunter2" not in text.text and "0b96a8c8" not in text.text and "AKIA" not in text.text
    assert text.n_chars == len(text.text)
    assert bag(clean.filter("doc_id in (1, 4, 5, 13)"), "doc_id", "text") == bag(odd.filter("doc_id in (1, 4, 5, 13)"), "doc_id", "text")


# -- 8 ------------------------------------------------------------------------

def test_pair_bpe(docs):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = []
    for doc_id, text in pairs(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), brute.sha(" ".join(map(str, ids))),
                     brute.sha(library.decode(ids, skip_special_tokens=False))))
    assert ordered(tuple(r) for r in pair_bpe.digest_documents(docs, path).collect()) == ordered(want)
    ids = bag(pair_bpe.encode_documents(docs, path).withColumn("n", F.size("ids")), "doc_id", "n")
    assert ids == ordered(w[:2] for w in want)


def test_pair_bpe_random_words():
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abeinorst"), int(rng.integers(1, 15)))) for _ in range(4000)] + ["a" * i for i in range(1, 40)]
    text = " ".join(words)
    assert pair_bpe.PairBpe(path).encode([text])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


# -- 9 ------------------------------------------------------------------------

@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(docs, words):
    got = near_dup.near_duplicates(docs, words)
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute.near(pairs(docs), words))


def test_near_duplicate_chains_and_blocks(spark, monkeypatch):
    """Chains of near copies, many with a common passage, in blocks of a few rows."""
    rng = np.random.default_rng(11)
    passage = [f"p{i}" for i in range(40)]
    rows, text = [], [f"w{i}" for i in range(80)]
    for i in range(60):
        text = list(text)
        text[int(rng.integers(80))] = f"x{i}"
        rows.append((i, " ".join(text)))
    for i in range(60, 140):
        rows.append((i, " ".join(passage + [f"y{int(k)}" for k in rng.integers(0, 30, 12)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dup, "PIVOTS", 0)
    monkeypatch.setattr(near_dup.across_components, "__defaults__", (7,))
    got = near_dup.near_duplicates(docs, 4)
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute.near(rows, 4))


def test_signatures_meet_within_distance():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 16, (200, near_dup.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for i in range(200):
        at = rng.choice(near_dup.SYMBOLS, near_dup.DISTANCE, replace=False)
        b[i, at] ^= 1
    x, y = near_dup.chunk_keys(a), near_dup.chunk_keys(b)
    assert all(set(p) & set(q) for p, q in zip(x.tolist(), y.tolist()))
    first = near_dup.first_place(a != b)
    assert all(x[i, k] == y[i, k] and not (set(x[i, :k]) & set(y[i, :k])) for i, k in enumerate(first))


def test_keep_one(odd):
    kept = near_dup.keep_one(odd, 4)
    assert kept.columns == odd.columns
    want = {w[0] for w in brute.near(pairs(odd), 4) if w[3]} - {None}
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(want)
    assert kept.filter("doc_id is null").count() == 2


# -- 10 -----------------------------------------------------------------------

def test_token_files(docs, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_files.read_token_files(docs.sparkSession, token_files.write_token_files(docs, path, 2, str(tmp_path / "t")))
    rows = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in pairs(docs)]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    want, start = [], 0
    for doc_id, ids in rows:
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert ordered(tuple(r) for r in got.collect()) == ordered(want)


@pytest.mark.parametrize("top", [1, 200, 60_000, 1 << 32])
def test_block_round_trip(top):
    rng = np.random.default_rng(0)
    values = (rng.pareto(0.3, 5001) * 10).clip(0, top - 1).astype(np.uint32)
    control, data = token_files.pack(values)
    got = token_files.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values))
    assert (got == values).all()
    ids = rng.integers(0, min(top, 60_000), 1000).astype(np.uint16)
    doc_ids, counts, back = token_files.read_block(token_files.write_block([5, None, 7], [0, 400, 600], ids))
    assert doc_ids == [5, None, 7] and counts.tolist() == [0, 400, 600] and (back == ids).all()


# -- all ------------------------------------------------------------------------

def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert set(ORACLES) <= set(QUERIES)
