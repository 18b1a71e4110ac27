"""The trained models: gradients, held-out accuracy, odd tables."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus import nothing, odd  # noqa: F401
from pyspark.sql import functions as F

from switchboard.llm import quality, toxicity
from switchboard.llm.frames import as_bytes

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")]


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in toxicity._start(rng).items()}
    vectors, words = rng.standard_normal((9, toxicity.WIDTH)), rng.integers(0, 9, (5, toxicity.WINDOW))
    words[1, 5:], words[2, 1:] = -1, -1
    slope = np.arange(1, 6).astype(float)
    keep = {}
    toxicity._forward(model, vectors, words, keep)
    grad, d_vectors = toxicity._backward(model, vectors, keep, slope)

    def loss(m, v):
        return float((toxicity._forward(m, v, words) * slope).sum())

    for name in model:
        at = tuple(rng.integers(0, s) for s in model[name].shape)
        ends = []
        for step in (1e-2, -1e-2):
            moved = model | {name: model[name].copy()}
            moved[name][at] += step
            ends.append(loss(moved, vectors))
        assert grad[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-2, rel=2e-2, abs=2e-3)
    up, down = vectors.copy(), vectors.copy()
    up[3, 4], down[3, 4] = up[3, 4] + 1e-2, down[3, 4] - 1e-2
    assert d_vectors[3, 4] == pytest.approx((loss(model, up) - loss(model, down)) / 2e-2, rel=2e-2, abs=2e-3)


def test_windows_overlap_and_cover_every_word():
    for n in (1, 63, 64, 65, 112, 113, 500):
        words = toxicity.Words(*as_bytes(pa.array([" ".join(f"w{i}" for i in range(n)), None, "...", "a b"])))
        windows, length, owner = words.windows()
        assert owner.tolist() == [0] * (len(owner) - 1) + [3] and set(windows[owner == 0].ravel()) - {-1} == set(words.word[:n])
        assert all((w >= 0).sum() == k for w, k in zip(windows, length, strict=True))


def test_toxicity_of_held_out_documents(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    scored = {r.doc_id: r.score for r in toxicity.with_score(docs.select("doc_id", "text"), model).collect()}
    told = [(scored[r.doc_id], r.toxic) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    toxic, clean = [s for s, t in told if t], [s for s, t in told if not t]
    above = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert above > 0.85 and np.mean(np.array(clean) < toxicity.REJECT) > 0.9


def test_toxicity_of_odd_tables(odd, nothing, tables):
    model = toxicity.fit(*tables)
    got = toxicity.with_score(odd, model, "rating").collect()
    assert len(got) == 7 and all(r.rating == toxicity.EMPTY for r in got if not r.text)
    labels = tables[1]
    assert toxicity.keep_clean(nothing, labels).count() == 0
    assert toxicity.fit(tables[0], labels.where("toxic = 0")) is None
    assert toxicity.with_score(odd, None, "rating").where("rating <> 0").isEmpty()
    assert toxicity.keep_clean(odd, labels.where("false")).columns == odd.columns


def test_quality_of_labelled_documents(tables):
    docs, labels = tables
    half = labels.where(F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    scored = quality.with_scores(docs, quality.fit(docs, half), ["a", "b", "q"])
    rows = scored.join(labels.join(half, "doc_id", "left_anti"), "doc_id").select("q", "quality").collect()
    right = [(r.q >= quality.KEEP) == (r.quality == 1) for r in rows]
    kept = [r.q >= quality.KEEP for r in rows if r.quality == 1]
    assert np.mean(right) > 0.93 and np.mean(kept) > 0.95


def test_quality_of_odd_tables(odd, nothing, tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    got = quality.with_scores(odd, model, ["a", "b", "q"]).collect()
    assert len(got) == 7 and all(r.q == 0 for r in got if not r.text)
    assert quality.keep_good(nothing, labels).count() == 0
    assert quality.keep_good(odd, labels.where("false")).count() == 7
    assert quality.keep_good(odd.drop("source", "n_chars"), labels).columns == ["doc_id", "text", "lang", "_key", "score"]


def test_scores_are_the_same_in_any_batch(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    texts = [r.text for r in docs.orderBy("doc_id").limit(40).collect()]
    whole = toxicity.score_texts(model, *as_bytes(pa.array(texts)))
    single = [toxicity.score_texts(model, *as_bytes(pa.array([t])))[0] for t in texts]
    assert np.allclose(whole, single, atol=1e-4)


def test_toxicity_learns_from_long_texts(tables):
    docs, labels = tables
    long = docs.where("n_chars > 3000")
    model = toxicity.fit(long, labels)
    assert model is not None
    texts = {r.doc_id: r.text for r in long.select("doc_id", "text").collect()}
    told = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in texts and r.toxic is not None}
    scores = dict(zip(told, toxicity.score_texts(model, *as_bytes(pa.array([texts[i] for i in told])))))
    toxic, clean = ([scores[i] for i, t in told.items() if t == k] for k in (1, 0))
    # Few texts are left to learn from; without any, all scores were 0.
    assert np.mean([a > b for a in toxic for b in clean]) > 0.6


def test_training_in_parts_equals_training_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    word = lambda: f"w{rng.integers(40)}"
    texts = [" ".join([word() for _ in range(int(rng.integers(1, 400)))] + ["vile"] * (k % 2)) for k in range(24)]
    labels, models = [k % 2 for k in range(24)], []
    for at_once, chunk in ((10**6, 1 << 20), (5, 500)):
        monkeypatch.setattr(toxicity, "AT_ONCE", at_once)
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        models.append(toxicity.train(texts, labels))
    whole, parts = (toxicity.score_texts(m, *as_bytes(pa.array(texts))) for m in models)
    assert parts == pytest.approx(whole, abs=1e-3)


def test_windows_for_training_spread_over_long_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "MOST", 5)
    long = [f"wörd{i}" for i in range(64 + 32 * 9 + 7)]
    texts = [" ".join(long), "short text", "", " ".join(long[:192])]
    got = toxicity.drawn_windows(*as_bytes(pa.array(texts)))
    assert got[1:] == [[t] for t in texts[1:]]
    cut = [piece.split() for piece in got[0]]
    assert [len(c) for c in cut] == [toxicity.WINDOW] * 5 and cut[0] == long[:64] and cut[-1] == long[-64:]
    assert all(c == long[long.index(c[0]) :][:64] for c in cut)


def test_training_on_pieces_equals_training_on_texts():
    rng = np.random.default_rng(2)
    word = lambda: f"w{rng.integers(40)}"
    texts = [" ".join([word() for _ in range(64 + 32 * (k % 3))] + ["vile"] * (k % 2)) for k in range(24)]
    labels = [k % 2 for k in range(24)]
    pieces, owner = [], []
    for k, text in enumerate(texts):
        told = toxicity.Words(*as_bytes(pa.array([text])))
        size, words = int(told.counted[0]), text.split()
        base, length, _ = told.places(np.array([0]))
        pieces += [" ".join(words[a : a + n]) for a, n in zip(base, length, strict=True)]
        owner += [k] * len(base)
        assert base[-1] + length[-1] == size
    whole, parts = (toxicity.train(texts, labels), toxicity.train(pieces, labels, owner))
    scores = [toxicity.score_texts(m, *as_bytes(pa.array(texts))) for m in (whole, parts)]
    # Word counts a text are alike, so both start from the same tables.
    assert scores[1] == pytest.approx(scores[0], abs=1e-2)


def test_labels_that_contradict_each_other_are_not_drawn(tables):
    docs, labels = tables
    other = labels.withColumn("toxic", 1 - F.col("toxic"))
    assert toxicity.fit(docs, labels.unionByName(other)) is None


def test_views_tell_a_bounded_draw_of_all_unlabelled_texts(spark, tables):
    docs, labels = tables
    rows = quality._with_page(docs.select("doc_id", "text", *quality.PAGE_COLUMNS), quality._PAGE)
    rows = rows.select("doc_id", "text", *quality._PAGE)
    known = labels.where("quality in (0, 1)").select("doc_id").distinct()
    free = quality.Unlabelled(rows.unionByName(rows), known)
    own = rows.join(known, "doc_id", "left_anti").select("text", *quality._PAGE).distinct().count()
    assert free.rows.select("print").distinct().count() == own
    rng = np.random.default_rng(3)
    width = (quality.SHAPES + quality.TERMS, quality.PAGE)
    weights = [rng.standard_normal(n + 1) * 2 for n in width]
    views = quality._unpacked(free.rows.dropDuplicates(["print"]).select("text_f", "page_f").toArrow())
    edge = np.log(quality.SURE / (1 - quality.SURE))
    for counts in ([7, 5], [10**6, 10**6]):
        told = free.tell(weights, 1, counts)
        for k, (both, label) in enumerate(told):
            logit = quality._logit(views[k], weights[k])
            sure = [int((logit < -edge).sum()), int((logit > edge).sum())]
            assert [int((label == y).sum()) for y in (0, 1)] == [min(a, b) for a, b in zip(sure, counts, strict=True)]
            assert np.array_equal(quality._logit(both[k], weights[k]) > edge, label == 1)


def test_quality_labels_that_contradict_each_other_teach_nothing(tables):
    docs, labels = tables
    other = labels.withColumn("quality", 1 - F.col("quality"))
    assert quality.fit(docs, labels.unionByName(other)) is None
