"""Fill-in-the-middle against a plain version, and round trips through frames."""

import hashlib
import re
from itertools import pairwise

import numpy as np
import pytest
import zstandard
from corpus import documents, nothing, odd, texts  # noqa: F401

from switchboard.llm import fill_middle

EXTRA = ["has <S> inside", "<P", "<", "abc", "<<M", "a1b2", "x" * 300, "é<é>" * 200, "ab " * 400 + "z" * 700, "日本語" * 90]


def plain(doc_id, text, seed=1, plain_from=90, spm_below=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted([h[0] % (len(units) + 1), h[1] % (len(units) + 1)])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plain_from:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_below:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def every(spark, documents):  # noqa: F811
    extra = [(1000 + i, t, None, None, None, None, None) for i, t in enumerate(EXTRA * 6)]
    return documents.union(spark.createDataFrame(extra, documents.schema))


@pytest.mark.parametrize("frame", [1 << 16, 64, 7])
def test_forms_and_digests_equal_the_plain_version(every, frame, monkeypatch):
    """Short frames: cuts, words, markers and code points lie across frames."""
    values = {r.doc_id: r.text for r in every.collect()}
    monkeypatch.setattr(fill_middle, "FRAME", frame)
    got = []
    for doc_id, text in values.items():
        got.append(_by_hand(fill_middle, doc_id, text))
    for doc_id, row in zip(values, got, strict=True):
        n, form, p, m, output = plain(doc_id, values[doc_id])
        assert row == (n, form, p, m, output, values[doc_id] or ""), doc_id


def _by_hand(module, doc_id, text):
    """The task's code on one text."""
    n, form, _, _, _ = plain(doc_id, text)
    data = np.frombuffer((text or "").encode(), np.uint8)
    starts = module.unit_starts(data)
    frames = [
        {
            "units": int(starts[:a].sum()),
            "chars": int(((data[:a] & 0xC0) != 0x80).sum()),
            "inside": bool(a and module._LETTER[data[a - 1]]),
            "data": zstandard.ZstdCompressor().compress(data[a:b].tobytes()),
        }
        for a, b in pairwise(module._cuts(data, 0, len(data)))
    ]
    reader = module.Reader(int(starts.sum()), len(text or ""), frames)
    x = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    low, high = sorted([int(x[:8], 16) % (reader.n + 1), int(x[8:16], 16) % (reader.n + 1)])
    a, b = reader.cut(low), reader.cut(high)
    output = b"".join(module.output_of(reader, form, a[:2], b[:2]))
    cut = [output[k : k + 5] for k in range(0, len(output), 5)]
    back = b"".join(module.restored(module.Stored(iter(cut)), form)).decode()
    lengths = (None, None) if form == "plain" else (a[2], b[2] - a[2])
    return reader.n, form, *lengths, output.decode(), back


def test_frames_hold_the_text_and_its_counts(every):
    unpack = zstandard.ZstdDecompressor().decompress
    values = {r.doc_id: r.text or "" for r in every.collect()}
    for r in fill_middle.framed(every).collect():
        text = b"".join(unpack(f["data"]) for f in r.frames).decode()
        assert text == values[r.doc_id] and r.chars == len(text) and r.n == plain(r.doc_id, text)[0]
        assert r.marked == any(k in text for k in ("<P>", "<S>", "<M>"))
        assert [f["units"] for f in r.frames][:1] in ([0], []) and all(len(unpack(f["data"])) <= fill_middle.FRAME for f in r.frames)


def test_long_texts_have_many_frames(spark):
    texts = ["word " * 60_000, "a" * 200_000, "é" * 100_000, "日本" * 50_000 + "<S>"]  # noqa: F811
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    rows = fill_middle.framed(docs)
    assert min(len(r.frames) for r in rows.collect()) > 3
    for r in fill_middle.digests(fill_middle.decided(rows)).collect():
        n, form, p, m, output = plain(r.doc_id, texts[r.doc_id % 4])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert (r.output_sha256, r.restored_sha256) == (_sha(output), _sha(texts[r.doc_id % 4]))


def test_registered_digests_and_real_outputs(every):
    values = {r.doc_id: r.text for r in every.collect()}
    rows = fill_middle.decided(fill_middle.framed(every)).cache()
    outputs = fill_middle.transformed(rows).cache()
    sent = {r.doc_id: (r.form, r.output) for r in outputs.collect()}
    back = {r.doc_id: r.text for r in fill_middle.originals(outputs).collect()}
    forms = set()
    for r in fill_middle.digests(rows).collect():
        n, form, p, m, output = plain(r.doc_id, values[r.doc_id])
        forms.add(form)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert (r.output_sha256, r.restored_sha256) == (_sha(output), _sha(values[r.doc_id] or ""))
        assert sent[r.doc_id] == (form, output) and back[r.doc_id] == (values[r.doc_id] or "")
    assert forms == {"plain", "psm", "spm"}


def test_another_seed_and_other_rates_cut_the_same_frames(every):
    values = {r.doc_id: r.text for r in every.collect()}
    rows = fill_middle.decided(fill_middle.framed(every), seed=7, plain_from=100, spm_below=100)
    for r in fill_middle.transformed(rows).collect():
        want = plain(r.doc_id, values[r.doc_id], 7, 100, 100)
        assert (r.form, r.output) == (want[1], want[4])


def test_odd_tables(odd, nothing):  # noqa: F811
    assert fill_middle.digests(fill_middle.decided(fill_middle.framed(nothing))).count() == 0
    rows = fill_middle.digests(fill_middle.decided(fill_middle.framed(odd))).collect()
    assert len(rows) == odd.count()
    want = sorted((plain(r.doc_id, r.text)[:2] for r in odd.collect()))
    assert sorted((r.n, r.form) for r in rows) == want
