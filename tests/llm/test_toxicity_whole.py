"""Counts, steps and cut of the toxicity model come from all labelled texts, not from those that start it."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from switchboard.llm import toxicity
from switchboard.llm.frames import as_bytes


def told_of(spark, texts, labels):
    rows = [(k, label, text, k % toxicity.SLICES) for k, (text, label) in enumerate(zip(texts, labels, strict=True))]
    return spark.createDataFrame(rows, "doc_id long, toxic int, text string, slice int").repartition(5)


@pytest.fixture
def some():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 300))) for _ in range(60)] + ["...", "Rare"]
    return texts, [k % 2 for k in range(len(texts))]


def test_words_that_only_later_texts_have_are_learned(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_LABEL", 8)
    ids = spark.range(300).where("crc32(cast(id as string)) % 3 != 1").withColumn("toxic", (F.col("id") % 2).cast("int"))
    first = ids.where("toxic = 1").orderBy(F.xxhash64("id", F.lit("toxic")), "id").limit(8)
    start = {r.id for r in first.collect()}
    rng, made = random.Random(1), []
    for r in ids.collect():
        words = [f"w{rng.randrange(50)}" for _ in range(40)] + (["vile" if r.id in start else "foul"] if r.toxic else [])
        made.append((r.id, " ".join(words)))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    model = toxicity.fit(docs, ids.withColumnRenamed("id", "doc_id"))
    (slot,) = toxicity.Words(*as_bytes(pa.array(["foul"]))).slot
    assert model["words"][slot].any()


def test_live_slots_are_counted_over_all_texts(spark, some):
    texts, labels = some
    live = toxicity._live(told_of(spark, texts, labels))
    counts = {"words": {}, "pieces": {}}
    for text in texts:
        words = toxicity.Words(*as_bytes(pa.array([text])))
        for name, slots in (("words", words.slot), ("pieces", words.pieces)):
            for slot in set(slots.tolist()):
                counts[name][slot] = counts[name].get(slot, 0) + 1
    for name, found in counts.items():
        assert set(np.flatnonzero(live[name])) == {s for s, n in found.items() if n >= toxicity.SEEN_IN}


def test_a_gradient_is_the_sum_over_all_texts(spark, some):
    texts, labels = some
    model = toxicity.train(texts, labels)
    live = {k: np.ones(toxicity.SLOTS, bool) for k in ("words", "pieces")}
    share = np.array([0.01, 0.03])
    got = toxicity._gradient(told_of(spark, texts, labels), model, share, live)
    want = {k: np.zeros(v.shape) for k, v in model.items()}
    for text, label in zip(texts, labels, strict=True):
        words = toxicity.Words(*as_bytes(pa.array([text])))
        if not words.counted[0]:
            continue
        grad, slots = toxicity._slopes(words, model, np.zeros(1, int), np.zeros(1, int), np.array([label]), share[[label]])
        for k, g in grad.items():
            want[k] += g
        for k, found in slots.items():
            for rows, g in found:
                want[k][rows] += g
    for k, g in got.items():
        full = want[k] * 0
        if isinstance(g, tuple):
            full[g[0]] = g[1]
        else:
            full = g
        assert np.abs(want[k]).max() > 0 and np.allclose(full, want[k], rtol=1e-2, atol=1e-5)


def test_the_cut_is_set_by_all_texts(spark, some, monkeypatch):
    monkeypatch.setattr(toxicity, "CLEAN", 10)
    texts, labels = some
    model = toxicity.train(texts, labels)
    clean, toxic = toxicity.ends(told_of(spark, texts, labels), model)
    found = np.clip(toxicity.score_texts(model, *as_bytes(pa.array(texts))), 1e-9, 1 - 1e-9)
    logits = np.log(found / (1 - found))
    for got, label, share in ((clean, 0, 0.9), (toxic, 1, 0.05)):
        own = logits[np.array(labels) == label]
        assert got == pytest.approx(np.quantile(own, share, method="inverted_cdf"), abs=2 / toxicity.BINS)
