"""Pieces against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
from corpus import documents, nothing, odd, texts  # noqa: F401

from switchboard.llm import pieces

PATH = pieces.model_path()
ODD = [
    "", " ", "  a", "a  ", "▁", "▁▁x", "\x00a\x00", "日本語テスト。" * 50, "😀 x😀", "\n\n a\n", "<s> </s> <unk> <0x0A>", "é" * 300,
    "a" * 5000, "    " * 100, "  \t  x", " ⁇ ", "�", "ﬁ İ ß", "x\r\ny", "​z", "क्षत्रिय", "กขค", "مرحبا بك", None,
]
LETTERS = [chr(c) for c in range(32, 127)] + list("▁éßñ日本語кириллица😀\n\t") + ["▁"] * 5 + [" "] * 10


@pytest.fixture(scope="module")
def library():
    return pieces.library(PATH)


def _noise(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_ids_and_text_equal_the_library(texts, library):  # noqa: F811
    own, every = pieces.model(PATH), [t or "" for t in ODD + texts + _noise(1, 1500)]
    ids, offsets = own.encode(every)
    decoded = own.decode(ids, offsets)
    for k, text in enumerate(every):
        want = library.encode(text)
        assert ids[offsets[k] : offsets[k + 1]].tolist() == want, text[:40]
        assert decoded[k].decode() == library.decode(want)


def test_any_ids_decode_as_in_the_library(library):
    own, rng = pieces.model(PATH), random.Random(3)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(259), rng.randrange(32000), 29871]) for _ in range(rng.randint(0, 10))]
        got = own.decode(np.array(ids, np.int32), np.array([0, len(ids)]))[0].decode()
        assert got == library.decode(ids), ids


def test_kept_words_change_nothing(monkeypatch):
    own, every = pieces.Pieces(PATH), _noise(5, 200)
    want = [a.tolist() for a in own.encode(every)]
    monkeypatch.setattr(pieces, "KEPT", 10)
    for _ in range(3):
        assert [a.tolist() for a in own.encode(every)] == want
    assert own.merge("▁▁▁▁x") == own.encode(["   x"])[0].tolist()


def test_one_cut_of_any_length_equals_the_words_of_it(library):
    text = "".join(_noise(7, 400)).replace(" ", "")
    assert pieces.model(PATH).merge("▁" + text) == library.encode(text)


def test_digests_of_all_rows(documents, texts, library):  # noqa: F811
    got = {r.doc_id: r for r in pieces.digests(documents, PATH, check=True).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids, row = library.encode(text or ""), got[3 * i + 1]
        assert (row.n_tokens, row.agrees) == (len(ids), True)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_a_difference_is_told(library):
    other = pieces.Pieces(PATH)
    ids, offsets = other.encode(["one text", "two"])
    ids[0] += 1
    assert pieces._agree(library, ["one text", "two"], ids, offsets, other.decode(ids, offsets)) == [False, True]


def test_round_trip_of_arrays(documents, texts, library):  # noqa: F811
    back = {r.doc_id: r.text for r in pieces.texts_of(pieces.token_ids(documents, PATH), PATH).collect()}
    assert [back[3 * i + 1] for i in range(len(texts))] == [library.decode(library.encode(t or "")) for t in texts]


def test_odd_tables(odd, nothing):  # noqa: F811
    assert pieces.digests(nothing, PATH).count() == 0
    rows = pieces.digests(odd, PATH).collect()
    assert len(rows) == odd.count() and sum(r.n_tokens == 0 for r in rows) == 3
    assert [r.doc_id for r in rows].count(5) == 3


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "unigram.model"
    path.write_bytes(b"\x12\x02\x18\x01")
    with pytest.raises(ValueError):
        pieces.Pieces(str(path))
