"""The corpus pipeline's stages, each against a plain version of its decision."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import pairs
from tracery.llm import toxicity


def test_stages(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "near_duplicates", "decontamination", "secrets", "token_ids"]
    model = toxicity.train(docs, spark.read.parquet(f"{root}/labels.parquet"))
    want = {d for d, t in pairs(docs) if model.score(t) < 0.5}
    now = steps["toxicity"](spark, docs, root).cache()
    assert now.columns == columns and {d for d, _ in pairs(now)} == want
    want = {w[0] for w in brute.near(pairs(now), 5) if w[3]}
    now = steps["near_duplicates"](spark, now, root).cache()
    assert now.columns == columns and {d for d, _ in pairs(now)} == want
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    want = {w[0] for w in brute.contamination(pairs(now), items) if not w[5]}
    now = steps["decontamination"](spark, now, root).cache()
    assert now.columns == columns and {d for d, _ in pairs(now)} == want
    clean = steps["secrets"](spark, now, root).cache()
    assert clean.columns == columns and {d for d, _ in pairs(clean)} == want
    assert clean.filter(F.col("text").rlike("token = \"[0-9a-f]{40}")).isEmpty()
    last = steps["token_ids"](spark, clean, root)
    assert last.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and last.count() == len(want)
    whole = corpus_pipeline.run(spark, root)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(want)


def test_stages_on_odd_and_empty_rows(spark, odd, empty, root):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            out = stage(spark, docs, root)
            if name != "token_ids":
                assert out.columns == columns
            docs = out.cache()
        assert docs.count() <= odd.count()
