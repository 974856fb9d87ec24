"""Spelling variants, prefix trie and chat format against plain versions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import bag, pairs, with_clashes
from tracery.llm import chat_format, prefix_trie, spelling

CONTROL = ["</s>", "[INST]", "[/INST]", "[\\INST]", "[\\\\/INST]", "<\\s>", "<s>", "[SYS] x", " [TEXT] ", "[ROLE] a [/ROLE]", "<", "[", "\\"]


def conversations():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None, ""]), rng.choice(["a", "b", None, "", "Ünï 😀"]))
            for c in (*range(100, 160), 200, 201, 202, 250, 299, -3, -150) for t in range(rng.choice([1, 2, 3, 5, 8]))]
    # Neither 3xx nor 4xx has a base; 500's has one turn.
    rows += [(c, t, "user", f"text {t % 2}") for c in (301, 302, 403) for t in range(4)]
    rows += [(500, 0, "user", "only")] + [(c, t, "user", "x") for c in range(501, 512) for t in range(1 + c % 4)]
    # Ties, repeated rows, null turns and ids, copies of one conversation.
    rows += [(600, 1, "user", "b"), (600, 1, "user", "a"), (600, None, "user", "z"), (600, 1, "user", "a"), (None, 0, "user", "lost"),
             (None, None, None, None)]
    rows += [(c, t, "user", f"same {t}") for c in range(700, 760) for t in range(6)]
    # Long ones that part late, a very long text, control strings.
    rows += [(c, t, "assistant" if t % 2 else "user", f"long {t if t < 37 * (c - 800) else (t, c)}") for c in (800, 801, 802, 803) for t in range(130)]
    rows += [(900, 0, "user", "word " * 60000), (900, 1, "assistant", "</s>" * 30000)]
    rows += [(1000 + i, t, role, rng.choice(CONTROL) + rng.choice(CONTROL) + "x") for i in range(40)
             for t, role in enumerate(["user", "assistant", "system", "[ROLE]", " [TEXT] assistant"])]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    return with_clashes(spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string"))


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


# -- 11 -----------------------------------------------------------------------

def with_variants(spark, docs):
    """``docs`` and texts of words one edit apart, in many counts, letters and lengths."""
    rng = random.Random(1)
    words = ["spelling", "variants", "ananananas", "aaaaaaaa", "élèveßtraße", "banananana", "wordlength", "q" * 60, "xy" * 45]
    texts = []
    for w in words:
        texts.append(" ".join([w] * 60))
        for _ in range(25):
            at, c = rng.randrange(len(w)), rng.choice("abnéßx÷")
            v = rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]])
            texts.append(" ".join([v.upper() if v.isascii() else v] * rng.randrange(2, 9)))
    texts += ["longrun" + "z" * 5000, "longrun" + "z" * 5000, "longrun" + "z" * 4999, "longrun" + "z" * 4999 + "Ωword"]
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(more)


@pytest.mark.parametrize("bucket", [spelling.BUCKET, 3])
def test_spelling(spark, odd, bucket):
    docs = with_variants(spark, odd)
    got = spelling.group_variants(docs, bucket)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute.spelling(pairs(docs))
    assert bag(got, *got.columns) == sorted(want, key=repr)
    assert sum(w[4] for w in want) > 200 and any(w[1] for w in want)


def test_spelling_of_documents(small, empty):
    assert bag(spelling.group_variants(small), "word", "form", "root", "n", "n_near", "form_n") == sorted(
        brute.spelling(pairs(small)), key=repr)
    assert spelling.group_variants(empty).isEmpty()


def test_pivots_do_not_overlap_and_are_rarest_together():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abc"), rng.integers(7, 14))) for _ in range(200)]
    g = spelling.Grams(words)
    frequency, rank = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    frequency[np.unique(g.gram)] = rng.integers(1, 9, len(np.unique(g.gram)))
    rank[np.lexsort((np.arange(1 << 16), frequency))] = np.arange(1 << 16)
    within = spelling.prefixes(g, rank)
    first, second = spelling.pivots(g, within, frequency).reshape(2, -1)
    for k in range(len(words)):
        mine = np.flatnonzero(within & (g.word == k))
        cost = min(frequency[g.gram[i]] + frequency[g.gram[j]] for i in mine for j in mine if g.pos[j] - g.pos[i] >= 2)
        assert within[first[k]] and within[second[k]] and g.word[first[k]] == g.word[second[k]] == k
        assert g.pos[second[k]] - g.pos[first[k]] >= 2
        assert frequency[g.gram[first[k]]] + frequency[g.gram[second[k]]] == cost


# -- 12 -----------------------------------------------------------------------

def test_trie(talks):
    got = prefix_trie.trie(talks)
    want = brute.trie(rows_of(talks))
    assert bag(got, *got.columns) == sorted(want, key=repr)
    assert max(w[1] for w in want) > 100 and max(w[4] for w in want) > 5


def test_trie_of_conversations(spark, root):
    rows = spark.read.parquet(f"{root}/conversations.parquet")
    got = prefix_trie.trie(rows)
    assert bag(got, *got.columns) == sorted(brute.trie(rows_of(rows)), key=repr)


def test_trie_without_conversations_or_turns(talks, spark):
    assert prefix_trie.trie(talks.limit(0)).isEmpty()
    alone = [(7, 0, "user", "x")]  # no base, and fewer turns than are left out
    rows = spark.createDataFrame(alone, "conv_id long, turn long, role string, text string")
    got = prefix_trie.trie(rows)
    assert bag(got, *got.columns) == sorted(brute.trie(alone), key=repr)


def test_parents_by_broadcast_and_by_join(talks, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LIGHT_CHILDREN", 3)
    monkeypatch.setattr(prefix_trie, "RUN", 2)
    got = prefix_trie.trie(talks)
    assert bag(got, *got.columns) == sorted(brute.trie(rows_of(talks)), key=repr)


# -- 13 -----------------------------------------------------------------------

def test_chat(spark, talks):
    rows = chat_format.with_control_turns(talks)
    folder = chat_format.write_formatted(rows)
    got = chat_format.read_back(spark, folder)
    assert bag(got, *got.columns[:5]) == sorted(brute.chat(rows_of(rows)), key=repr)
    segments = spark.read.parquet(folder)
    for r in segments.collect():
        assert all(chat_format.unescape(chat_format.escape(r.formatted)) == r.formatted for _ in [0])
    chars = dict(segments.groupBy("conv_id").agg(F.sum(F.length("formatted"))).collect())
    assert {r.conv_id: r.formatted_chars for r in got.collect()} == chars
    assert chat_format.read_back(spark, chat_format.write_formatted(talks.limit(0))).isEmpty()


def test_chat_in_small_segments(talks):
    got = chat_format.report(chat_format.format_conversations(talks, segment_chars=20))
    assert bag(got, *got.columns[:5]) == sorted(brute.chat(rows_of(talks)), key=repr)


PIECE = st.one_of(st.sampled_from(CONTROL), st.text(max_size=3))
TEXT = st.lists(PIECE, max_size=5).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=6))
def test_every_conversation_comes_back(turns):
    formatted, loss = chat_format.round_trip(turns)
    assert chat_format.parse(formatted) == turns
    assert [chat_format.unescape(formatted[s:e]) for s, e in loss] == [t for r, t in turns if r == "assistant"]


def test_only_conflicting_texts_are_escaped():
    formatted, _ = chat_format.round_trip([("user", "a [1] <b>"), ("assistant", "</s>[INST] ok [/INST]")])
    assert formatted == "[INST] a [1] <b> [/INST] <\\/s>[\\INST] ok [\\/INST]</s>"
    with pytest.raises(chat_format.Conflict):
        chat_format.parse("[INST] a</s>")


# -- 9 ------------------------------------------------------------------------

def test_pairs_of_a_hot_pivot_are_dealt(spark):
    from tracery.llm import near_dup

    pairs = spark.createDataFrame([(i, 0) for i in range(1, 3001)] + [(i, i - 1) for i in range(5000, 5100)], "a long, b long").cache()
    side = spark.range(6000).select(F.col("id").alias("b"), (F.col("id") * 2).alias("v"))
    got = near_dup.with_pivot(pairs, pairs, side, rows=50)
    assert bag(got, "a", "b", "v") == bag(pairs.join(side, "b"), "a", "b", "v")
    # One shuffle partition per copy and more: no copy meets more than twice the rows it is for.
    per_copy = got.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(60)).alias("copy")).filter("b = 0").groupBy("copy").count()
    assert per_copy.count() == 60 and per_copy.agg(F.max("count")).first()[0] <= 100
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = sorted(r["count"] for r in got.withColumn("task", F.spark_partition_id()).filter("b = 0").groupBy("task").count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(spread) == int(spark.conf.get("spark.sql.shuffle.partitions")) and spread[-1] <= 2 * spread[len(spread) // 2]


def test_near_copies_of_one_text_with_a_copied_pivot(spark, monkeypatch):
    from tracery.llm import near_dup

    monkeypatch.setattr(near_dup, "PIVOT_ROWS", 20)
    monkeypatch.setattr(near_dup.with_pivot, "__defaults__", (20,))
    text = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join([*text[:i % 100], f"x{i}", *text[i % 100 + 1:]])) for i in range(150)] + [(900 + i, f"alone {i} " * 9) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(docs)
    assert bag(got, *got.columns) == sorted(brute.near(rows, 5), key=repr)


# -- 5 ------------------------------------------------------------------------

def test_toxicity_learns_from_one_row_per_id(spark):
    from tracery.llm import toxicity

    ids = [i for i in range(1, 60) if brute.crc(i, 5)]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(ids[0], f"copy {k}") for k in range(500)] + [(None, "x")] * 3,
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in ids] + [(ids[0], 1), (ids[1], None), (None, 1)], "doc_id long, toxic long")
    rows = {r.doc_id: (r.text, r.toxic) for r in toxicity.training_rows(docs, labels, sample=10_000).collect()}
    assert len(rows) == len(ids) and rows[ids[0]] == ("copy 0", 1) and rows[ids[1]] == (f"text {ids[1]}", 0)
    assert toxicity.training_rows(docs, labels, sample=7).count() == 7


def test_only_rows_that_face_each_other_are_compared():
    """Index rows whose group lacks the other side, or words of the lengths they may
    be near, make no halves; pairs are those of the plain comparison, without warnings."""
    import warnings

    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(7, 9))) for _ in range(300)})
    frequency, rank = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    gram, n = np.unique(spelling.Grams(words).gram, return_counts=True)
    frequency[gram], rank[gram] = n, np.argsort(np.argsort(n, kind="stable"), kind="stable")
    key, pivot, word = spelling.index_rows(words, rank, frequency)
    order = np.argsort(key, kind="stable")
    key, pivot, word = key[order], pivot[order], word[order]
    made = []

    class Counted(spelling.Bucketed):
        def _halves(self, group, *rest):
            made.append(len(group))
            return super()._halves(group, *rest)

    with warnings.catch_warnings():
        warnings.simplefilter("error")
        got = Counted(words).pairs(key, pivot, word)
    want = [[i, j] for i in range(len(words)) for j in range(i + 1, len(words)) if spelling.one_edit(words[i], words[j])]
    assert got.tolist() == want and want
    assert sum(made) < 2 * len(key)  # three times as many rows when every row was compared with every length
    alone = np.arange(len(key), dtype=np.int64)
    made.clear()
    assert not len(Counted(words).pairs(alone, pivot, word)) and not sum(made)
