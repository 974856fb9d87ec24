"""Cases where an operator did less than the whole job."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import pairs
from tracery.llm import secrets, substring_dedup, warc


@pytest.fixture(scope="module")
def crowded(spark):
    """One passage edge in every document with different text around it."""
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(40)]
    rows = []
    for i in range(300):
        left, right = (" ".join(rng.choice(words, 8)) for _ in range(2))
        rows.append((i % 290, f"{left} the one common header of all documents: {right}" + "_" * int(rng.integers(0, 90))))
    return spark.createDataFrame(rows + [(None, rows[5][1]), (400, None)], "doc_id long, text string").cache()


@pytest.mark.parametrize("limits", [(1, 1), (3, 20), (1000, 20), (3, 1000)])
def test_crowded_grams_give_the_same_spans(crowded, limits):
    got = substring_dedup.repeated_spans(crowded, 5, 3, *limits)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(brute.substrings(pairs(crowded)), key=repr)


def test_no_suffix_array_takes_a_crowded_gram(crowded):
    blocks = substring_dedup.in_blocks(crowded, 5)
    judged = substring_dedup.judged_entries(blocks, 3, 10, 20)
    asked = substring_dedup.asked_texts(blocks, judged, 3, 10).collect()
    grams = np.concatenate([np.frombuffer(r.grams, "<u4") for r in asked if r.range < 3])
    assert np.unique(grams, return_counts=True)[1].max() <= 5 * 20
    strings = {r.range for r in asked if r.range >= 3}
    assert strings == {3, 4, 5}


LINKS = [
    ('<a href="/x">', ["/x"]), ("<a href='/x'>", ["/x"]), ("<a href=/x>", ["/x"]), ('<a href = "/x">', ["/x"]),
    ('<a data-href="/y" href="/x">', ["/x"]), ("<A class=b HREF\n=\n'/x y'>t</A>", ["/x y"]),
    ('<a href="/p?a=1&amp;b=2&quot;">', ['/p?a=1&b=2"']), ("<a href=/p?a=1&amp;b=2 class=c>", ["/p?a=1&b=2"]),
    ('<a title=" href=/no" href="/x">', ["/x"]), ('<a title="a > b" href="/x">', ["/x"]), ('<a download href="/x">', ["/x"]),
    ('<a href="/1" href="/2">', ["/1"]), ('<a href="it\'s">', ["it's"]), ("<a href=''>", [""]), ('<abbr href="/no">', []),
    ('<a data-href="/no">', []), ("<a name=top>", []), ('<a class="b"href="/x">', ["/x"]), ("<a href>x</a>", []),
    ('<a hrefs="/no">', []), ("<a href=/1><a href='/2'> <a\thref=\"/3\">", ["/1", "/2", "/3"]), (None, []),
]


def test_links_of_every_written_form(spark):
    pages = spark.createDataFrame([(i, "http://h/", h) for i, (h, _) in enumerate(LINKS)],
                                  "page_id long, url string, html string")
    rows = warc.derivatives(warc.responses(pages)).filter("warc_type = 'metadata'").collect()
    got = {r.page_id: [x[len("outlink: "):] for x in r.block.split("\r\n") if x.startswith("outlink: ")] for r in rows}
    assert [(LINKS[i][0], got[i]) for i in range(len(LINKS))] == LINKS


def test_threshold_keeps_recall_where_labels_look_alike(spark):
    """Equal tokens with and without a keyword far off: most held out secrets score below one half."""
    rng = np.random.default_rng(11)
    token = lambda: "".join(rng.choice(list("abcdefghijABCDEFGHIJ0123456789"), 24)) + "7"
    rows = [(i, f"token: {token()}" if i % 9 == 0 else f"seen {token()} here") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    net = secrets.train(docs, sample=60)
    lost = []
    for kind in ("base", "planted"):
        steps = np.sort([net.steps(secrets.as_codes(w)).max() for r in docs.collect() for order, k, w in secrets.findings(r.doc_id, r.text)
                         if k == kind and order % secrets.HELD == 0])
        assert len(steps) > 12  # more than the held out part of the sample
        assert net.quality[kind] == (len(steps), (steps >= net.cut).sum())
        lost.append(steps[int((1 - secrets.RECALL) * len(steps))])
    assert net.cut == min(lost)


SHAPES = ["zqxkvwjpfhgmtbnr", "hJ7#kq2!x", "kd93jfA0sLq2mZx8", "QWZXJKVPLMBTRNCY"]


def test_network_finds_secrets_of_other_forms(spark):
    """Letters only, short passwords, URL credentials; ordinary words in the same places stay."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(["the", "ing", "re", "on", "ed", "st", "er", "an"], 5))
    letters = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    rows = [(i, f"{word()} {word()} {word()} on 2021-03-{i % 28:02d} at 10.0.{i % 7}.{i % 251} see {word()}{word()} "
                + (f'token = "{rng.bytes(20).hex()}"' if i % 6 == 0 else "")) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    net = secrets.train(docs)
    assert all(flagged >= secrets.RECALL * n for n, flagged in (net.quality[k] for k in ("base", "planted")))
    assert all(flagged <= 0.05 * n for n, flagged in (net.quality[k] for k in ("clean", "word")))
    made, plain = [], []
    for _ in range(60):
        made += [f"use pwd: {letters(22)} now", f"https://root:{letters(8)}7!Qz@db.example.com/x", f"Authorization: Basic {letters(9)}4{letters(9)}Z="]
        plain += [f"the token {word()} is", f"a key {word()} of", f"{word()} {word()} 2020-01-05 10.0.3.77"]
    found = [any(k == 3 for _, _, k in x) for x in secrets.all_spans(made, net)]
    assert np.mean(found) >= 0.9
    assert np.mean([bool(x) for x in secrets.all_spans(plain, net)]) <= 0.1
    planted = spark.createDataFrame(list(enumerate(made + plain)), "doc_id long, text string")
    digest = secrets.digest(secrets.find_spans(planted, net)).collect()
    assert sum(r.n_learned for r in digest) >= 160
    # The same spans one candidate and one window at a time.
    for r, text in zip(sorted(digest, key=lambda r: r.doc_id), made + plain):
        spans = [(s, e, secrets.KINDS[k]) for s, e, k in secrets.base_spans(text)]
        for s, e in secrets.candidates(text):
            if not any(s < y and x < e for x, y, k in spans if k != "learned"):
                if max(int(net.steps(secrets.as_codes([w]))[0]) for w in secrets.windows(text, s, e)) >= net.cut:
                    spans.append((s, e, "learned"))
        order = [(s, secrets.KINDS.index(k), e) for s, e, k in spans]
        assert r.spans == ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(order))


def test_candidates():
    def values(text):
        return [text[s:e] for s, e in secrets.candidates(text)]

    assert values("an ordinaryandratherlongword here") == ["ordinaryandratherlongword"]
    assert values("pwd: abc!defg, next") == ["abc!defg"] and values("Password is hunter.") == ["hunter"]
    assert values("https://me:p!ss@host/x") == ["p!ss"] and values("short a1b2 words") == []
    assert values("x a1b2c3d4 y") == ["a1b2c3d4"] and values("") == [] and values("the key") == []
    for shape in SHAPES:
        assert [shape in v for v in values(f"secret={shape} and {shape}")] == [True, True]


def test_windows_learned_from_overlap_the_finding():
    text = "x" * 200 + "token=" + "ab12" * 10
    kinds = {k: w for _, k, w in secrets.findings(1, text)}
    assert 0 < len(kinds["base"]) < len(secrets.windows(text, 0, len(text)))


def test_threshold_may_lie_below_one_half(spark):
    net, rng = secrets.CharNet(), np.random.default_rng(2)
    x = rng.integers(97, 123, (400, secrets.WIDTH)).astype(np.uint8)
    net.calibrate(x, (np.arange(400) % 10 == 0).astype(float))
    token = lambda: "".join(rng.choice(list("abcdef0123456789"), 26)) + "7"
    docs = spark.createDataFrame([(i, f"token: {token()} x {token().upper()}") for i in range(80)], "doc_id long, text string")
    secrets.set_threshold(docs, net, secrets.RECALL)
    assert net.threshold < 0.5
