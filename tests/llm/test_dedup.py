"""Near-duplicate, substring and span removal against plain versions."""

import random

import brute
import pytest
from corpus import documents, nothing, odd, texts  # noqa: F401
from pyspark.sql import functions as F

from switchboard.llm import components, near_dedup, span_dedup, suffix_dedup


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_components_equal_all_pairs(documents, texts, words, percent):
    want = {}
    for i, (size, group) in enumerate(brute.components(texts, words, percent)):
        want[3 * i + 1] = (size, 3 * min(group) + 1 if size else 3 * i + 1)
    got = near_dedup.near_components(documents, words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_components_do_not_depend_on_blocks(documents, texts, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    want = [3 * min(g) + 1 if n else 3 * i + 1 for i, (n, g) in enumerate(brute.components(texts, 3, 85))]
    got = near_dedup.near_components(documents).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == want


def test_one_document_of_each_component_stays(documents, texts):
    kept = near_dedup.keep_one(documents)
    assert kept.columns == documents.columns
    want = {3 * i + 1 for i, (n, g) in enumerate(brute.components(texts, 5, 80)) if not n or min(g) == i}
    assert {r.doc_id for r in kept.collect()} == want and kept.count() == len(want)


def test_near_copies_of_odd_tables(spark, odd, nothing):
    got = near_dedup.near_components(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.n_shingles == 5} == {5}
    six = spark.createDataFrame([(None, None), (None, ""), (None, ""), (7, ""), (7, ""), (8, None)], "doc_id long, text string")
    assert near_dedup.keep_one(six).count() == 6
    assert sorted((r.doc_id or 0, r.text or "") for r in near_dedup.keep_one(odd).collect()) == [
        (0, ""), (2, ""), (5, "a b c d e f g"), (5, "other words here"), (9, "")
    ]
    assert near_dedup.near_components(nothing).count() == 0 and near_dedup.keep_one(nothing).count() == 0


def test_connected_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    got = components.connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


@pytest.mark.parametrize("limit", [suffix_dedup.LIMIT, 2000, 200, 1])
def test_repeated_strings_equal_all_windows(documents, texts, limit):
    """Small limits: cores are extended over tasks, up to whole windows."""
    rows = {3 * i + 1: w for i, w in enumerate(brute.repeats(texts, 400))}
    found = {r.key: r for r in suffix_dedup.repeated_bytes(documents, 400, limit=limit).collect()}
    keyed = documents.select("doc_id", near_dedup.text_key().alias("key")).collect()
    copies = {k: sum(r.key == k for r in keyed) for k in {r.key for r in keyed}}
    for r in keyed:
        size, removed, spans, digest = rows[r.doc_id]
        if copies[r.key] == 1:
            got = found.get(r.key)
            assert (got.n_removed, got.n_spans, got.kept) == (removed, spans, digest) if got else removed == 0


def test_registered_query_counts_copies(spark, documents, texts, odd, tmp_path):
    """Every row, copies too; rows without doc_id and repeated rows are places like any others."""
    odd = odd.union(spark.createDataFrame([(None, "y" * 900, *[None] * 5), (None, "z" * 900 + "1", *[None] * 5)], odd.schema))
    documents.union(odd).write.parquet(str(tmp_path / "documents.parquet"))
    listed = [(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    want = sorted(((i, *w) for (i, _), w in zip(listed, brute.repeats([t for _, t in listed], 400), strict=True)), key=repr)
    got = suffix_dedup.op2(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == want


@pytest.mark.parametrize("length, limit", [(160, suffix_dedup.LIMIT), (256, suffix_dedup.LIMIT), (160, 300), (256, 1)])
def test_first_places_keep_their_strings(documents, texts, length, limit):
    want = brute.first_kept([(3 * i + 1, t) for i, t in enumerate(texts)], length)
    got = suffix_dedup.cut_repeats(documents, length, limit)
    assert got.columns == documents.columns
    rows = got.collect()
    assert {r.doc_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def test_strings_of_odd_tables(odd, nothing):
    assert suffix_dedup.cut_repeats(odd, 256).count() == odd.count()
    assert suffix_dedup.repeated_bytes(nothing).count() == 0 and suffix_dedup.cut_repeats(nothing).count() == 0


def test_spans_equal_plain_version(documents, texts):
    want = brute.without_spans([(3 * i + 1, t) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in span_dedup.without_repeats(documents).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 10


def test_spans_of_odd_tables(odd, nothing):
    assert span_dedup.without_repeats(odd).where(F.col("n_removed") > 0).count() == 0
    assert span_dedup.without_repeats(odd).count() == odd.count()
    assert span_dedup.without_repeats(nothing).count() == 0


def all_runs(cut, words=20, long=40):
    """Per document, the sentences in any run that stands elsewhere before; ``cut`` has lists of sentences."""
    first, runs = {}, []
    for i in sorted(cut):
        for a in range(len(cut[i])):
            for b in range(a, len(cut[i])):
                n = sum(len(s.split()) for s in cut[i][a : b + 1])
                if n >= (words if b > a else long):
                    key = " ".join(cut[i][a : b + 1])
                    first.setdefault(key, (i, a))
                    runs.append((key, i, a, b))
    gone = {i: set() for i in cut}
    for key, i, a, b in runs:
        if first[key] != (i, a):
            gone[i] |= set(range(a, b + 1))
    return gone


def test_longer_runs_go_whole(spark):
    rng = random.Random(3)
    sentence = lambda n: " ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(10**6)) for _ in range(n)) + "."
    passages = [[sentence(n) for n in sizes] for sizes in ((45, 39), (30, 5, 10), (5, 45, 3), (39, 45), (3, 3, 16, 2, 1), (12, 30, 6, 41, 2, 2))]
    cut = {}
    for k in range(48):
        p = passages[k % 6] if k < 24 else rng.choice(passages)[rng.randrange(2) :]
        cut[k] = [sentence(rng.randint(1, 25)) for _ in range(k % 3)] + p + [sentence(rng.randint(1, 50)) for _ in range(1 + k % 2)]
    want = all_runs(cut)
    assert want[6] == {0, 1} and want[7] == {1, 2, 3}
    docs = spark.createDataFrame([(i, " ".join(s)) for i, s in cut.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.text.split()) for r in span_dedup.without_repeats(docs).collect()}
    kept = {i: " ".join(s for k, s in enumerate(cut[i]) if k not in want[i]).split() for i in cut}
    assert got == {i: (len(want[i]), kept[i]) for i in cut}
