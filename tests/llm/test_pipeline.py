"""The registered queries and the pipeline, stage by stage."""

import brute
from corpus import FOLDER

import __spark_entry__
import corpus_pipeline
from switchboard.llm import quality, registry, toxicity
from switchboard.session import store


def test_every_operator_is_registered():
    names = set(registry.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert names <= set(__spark_entry__.queries()) and set(registry.oracle_sql()) <= names


def test_every_query_returns_all_rows(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name in ("op1_fingerprints", "op2_suffix_dedup", "op4_quality", "op5_bpe", "op6_kd_shards", "op7_span_dedup", "op8_near_dedup", "op10_toxicity", "op12_pieces", "op13_fill_middle"):
        out = registry.queries()[name](spark, FOLDER)
        assert out.select("doc_id").distinct().count() == out.count() == documents, name


def test_stages_equal_their_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality", "near_dedup", "suffix_dedup", "packing"]

    def after(name, frame):
        return store(stages[name](spark, frame, FOLDER), name)

    clean = after("toxicity", docs)
    scores = toxicity.with_score(docs, toxicity.fit(docs, labels), "s").collect()
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in scores if r.s < toxicity.REJECT}
    good = after("quality", clean)
    scores = quality.with_scores(clean, quality.fit(clean, labels), ["a", "b", "s"]).collect()
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores if r.s >= quality.KEEP}
    single = after("near_dedup", good)
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    groups = brute.components([t for _, t in rows], corpus_pipeline.SHINGLE, corpus_pipeline.SIMILAR)
    assert {r.doc_id for r in single.collect()} == {rows[i][0] for i, (n, g) in enumerate(groups) if not n or min(g) == i}
    cut = after("suffix_dedup", single)
    want = brute.first_kept([(r.doc_id, r.text) for r in single.collect()], corpus_pipeline.REPEAT)
    assert {r.doc_id: r.text for r in cut.collect()} == want
    assert all(f.columns == docs.columns for f in (clean, good, single, cut))
    packed = after("packing", cut)
    assert {r.doc_id for r in packed.collect()} == set(want)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.columns == packed.columns and whole.count() == packed.count()
    assert corpus_pipeline.ORACLE_SQL is None
