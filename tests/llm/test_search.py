"""Top-k, shards and fingerprints."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from corpus import FOLDER, documents, nothing, odd, texts  # noqa: F401
from pyspark.sql import functions as F

from checks.compare import differences
from switchboard.llm import fingerprints, kd_shards, topk


def _top(rows, k):
    valid = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in valid:
        if q % 20 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in valid if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


def test_top_k_equals_sorting(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(40) / 4]) for i in range(230)]
    rows += [(300, None), (320, [None, 1.0]), (340, [float("nan")] * 40), (360, [float("inf")] * 40), (None, [1.0] * 40)]
    rows += [(380, rows[20][1]), (381, rows[20][1]), (400, [0.5] * 10), (420, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    for blocks in ((512, 4096), (3, 50)):
        monkeypatch.setattr(topk, "QUERIES", blocks[0])
        monkeypatch.setattr(topk, "CANDIDATES", blocks[1])
        got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 20).collect()}
        assert got == _top(rows, 20)
    assert topk.top_k(df.where("false"), F.lit(True)).count() == 0


def test_large_components_are_exact(spark):
    rows = [(20 * i, [2.0**29 + i, -(2.0**28), 3.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 3, 1.0).collect()}
    want = {t for t in _scaled(rows, 3)}
    assert {(q, r, i) for q, r, i, _ in got} == {(q, r, i) for q, r, i, _ in want}


def _scaled(rows, k):
    for q, a in rows:
        found = sorted((-sum(int(x) * int(y) for x, y in zip(a, b)), i) for i, b in rows if i != q)[:k]
        yield from ((q, n + 1, i, -s) for n, (s, i) in enumerate(found))


def test_top_k_equals_sql(spark, con):
    
    assert differences(topk.op3(spark, FOLDER), con, topk.ORACLE) is None


def test_shards_are_even_and_slots_gapless(spark):
    rows = [(i, ("copy " * 30 if i % 3 == 0 else f"text {i} " * (i % 50 + 1)), f"s{i % 5}", "en", "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, shard string")
    got = kd_shards.kd_shards(df, 3).collect()
    assert len(got) == 2000
    total, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        text = rows[r.doc_id][1].encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(total) == set(range(8)) and max(total.values()) <= 1.03 * sum(total.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = collections.defaultdict(set)
    for r in got:
        groups[rows[r.doc_id][1]].add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) <= 1  # the copies are a third of all rows


def test_shards_of_odd_tables(odd, nothing):
    got = kd_shards.kd_shards(odd, 4).collect()
    assert len(got) == odd.count() and {r.shard for r in got} <= set(range(16))
    assert kd_shards.kd_shards(nothing, 4).count() == 0
    assert kd_shards.levels_for(1000, 100) == 4 and kd_shards.levels_for(0, 100) == 0


def test_edited_texts_and_equality(documents, texts):
    got = {r.doc_id: r for r in fingerprints.fingerprints(documents).collect()}
    prints = collections.defaultdict(set)
    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        row = got[3 * i + 1]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        prints[text].add(row.fingerprint)
        if edited == text:
            assert row.fingerprint == row.edited_fingerprint and row.near_edited == 1
    assert all(len(p) == 1 for p in prints.values()) and len(prints) == len({p for s in prints.values() for p in s})
    long = [got[3 * i + 1] for i, t in enumerate(texts) if t and t.count(".") > 12 and i > 3]
    assert all(r.near_edited > 0.45 for r in long) and sum(r.near_next < 0.3 for r in long) > len(long) / 2


def test_fingerprints_add_up_and_ignore_order(spark):
    rows = [(1, "one. 1\ntwo."), (2, "two.\none. 1"), (3, "one. 1"), (4, "two."), (5, "one. 1\nthree.")]
    df = spark.createDataFrame(rows, "k int, text string")
    v = {r.k: r.vector for r in fingerprints.sums(df, "k").collect()}
    assert v[1] == v[2] and v[1] != v[5]
    pair = spark.createDataFrame([(v[3], v[4], v[1])], "a array<long>, b array<long>, c array<long>")
    both = pair.select(
        fingerprints.combined(F.col("a"), F.col("b")).alias("s"), fingerprints.combined(F.col("c"), F.col("b"), -1).alias("d")
    ).first()
    assert both.s == v[1] and both.d == v[3]


def test_fingerprints_of_odd_tables(odd, nothing):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.near_next is None for r in rows if r.doc_id is None)
    assert fingerprints.fingerprints(nothing).count() == 0


def test_fingerprints_of_repeated_rows(spark, monkeypatch):
    """Copies are counted out in steps; the smallest text of the next id is the next document."""
    monkeypatch.setattr(fingerprints, "COPIES", 2)
    rows = [(1, "aaaa bbbb. cccc\ndddd")] * 5 + [(1, "other. words")] * 2 + [(2, "zz. yyyyyyyyyy"), (2, "mm. nnnnnnnnnn"), (2, None)]
    rows += [(None, "no number. here it is")] * 3 + [(None, None)]
    got = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    want = []
    for i, text in rows:
        text = text or ""
        cut = len(text) // 4
        after = {1: "", 2: "aaaa bbbb. cccc\ndddd", None: ""}[i]
        edited = text[: len(text) - cut] + after[:cut]
        want.append((i or 0, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    prints = {r.fingerprint for r in got if r.doc_id == 1 and r.n_chars == 20}
    assert len(prints) == 1 and all((r.near_next is None) == (r.doc_id is None) for r in got)


def plain_vector(text):
    """Sums of the components of all elements, and their number, from single hashes."""
    pieces = re.findall(rf"[^.!?\n]{{0,{fingerprints.PIECE}}}[.!?]+|[^.!?\n]{{1,{fingerprints.PIECE}}}", text)
    return collections.Counter(text.split("\n") + pieces)


def test_likeness_of_long_texts(spark):
    lines = ["\n".join(f"{'xyz'[k]} line {i}" for i in range(n)) for k, n in enumerate((55_000, 25_000, 70_000))]
    texts = [*lines, lines[0][: len(lines[0]) // 2] + lines[1], "\n" * 150_000 + "some words", "\n" * 150_000 + "other words"]
    counted = [plain_vector(t) for t in texts]
    df = spark.createDataFrame(sorted(set().union(*counted)), "string").select(
        "value", F.xxhash64("value").alias("h0"), F.xxhash64("value", F.lit(1)).alias("h1")
    )
    at, bits = {}, []
    for k, r in enumerate(df.collect()):
        at[r.value] = k
        bits.append([r.h0, r.h1])
    bits = np.array(bits, np.int64).view(np.uint64)
    vectors = []
    for c in counted:
        rows, times = np.array([at[e] for e in c]), np.array([*c.values()], np.int64)
        # Bit b of the lower half of lane b, bit 32 + b of its upper half.
        ones = [[int((times * (bits[rows, k // 32] >> np.uint64(k % 32 + up) & np.uint64(1)).astype(np.int64)).sum()) for k in range(64)] for up in (0, 32)]
        vectors.append([*ones[0], *ones[1], int(times.sum())])
    assert max(v[-1] for v in vectors) > 100_000
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    size = lambda v: float(((2 * v[:-1] - v[-1]).astype(object) ** 2).sum()) / 128
    for k, v in enumerate(vectors):
        assert got[k].fingerprint == "".join(f"{x % 65536:04X}" for x in got_order(v))
        a, b = np.array(v), np.array(vectors[(k + 1) % len(vectors)])
        assert got[k].near_next == pytest.approx(max(0.0, 1 - size(a - b) / (size(a) + size(b))), abs=1e-9)
    assert got[0].near_next < 0.3 and 0.5 < got[0].near_edited < 0.95


def got_order(vector):
    """Components in the order of the hexadecimal text: groups of four, the last of a group first."""
    return [vector[k + j] for k in range(0, 128, 4) for j in (3, 2, 1, 0)] + [vector[128]]
