"""Encoding against the tokenizers library, and packing."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from corpus import documents, nothing, odd, texts  # noqa: F401
from tokenizers import Tokenizer

from switchboard.llm import bpe, packing

ODD = [
    "Hello World's it'll 12 ab, !!", "ΣΑΣ İstanbul naïvé é é ﬁ", "a b c \x00 \x1c x",
    "<|endoftext|> hi <|startoftext|>x<|endoftext|>", "<|endof|>", "日本語 テスト", "'S don'T 's's", "1²½ ٣",
    "a" * 300 + "b" * 100 + " " + "abcdefgh" * 40, "é" * 200, None, "", " \n ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.tokenizer_path())


def test_ids_and_text_equal_the_library(documents, texts, library):
    own = bpe.encoder(bpe.tokenizer_path())
    every = [t or "" for t in ODD + texts]
    ids, offsets = own.encode(every)
    letters, places = own.decode(ids, offsets)
    for k, text in enumerate(every):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[offsets[k] : offsets[k + 1]].tolist() == want
        decoded = letters[min(places[k] + 1, places[k + 1]) : places[k + 1]].tobytes().decode()
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_digests_of_all_rows(documents, texts, library):
    got = {r.doc_id: r for r in bpe.digests(documents, bpe.tokenizer_path()).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = got[3 * i + 1]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_round_trip_of_arrays(documents, texts, library):
    path = bpe.tokenizer_path()
    back = {r.doc_id: r.text for r in bpe.texts_of(bpe.token_ids(documents, path), path).collect()}
    assert back[1] == library.decode(library.encode(texts[0], add_special_tokens=False).ids, skip_special_tokens=False)


def test_tokens_of_odd_tables(odd, nothing):
    path = bpe.tokenizer_path()
    assert bpe.digests(odd, path).count() == odd.count() and bpe.digests(nothing, path).count() == 0
    assert packing.pack(nothing, path).count() == 0 and packing.pack(odd, path).count() == odd.count()


def test_pieces_fill_sequences_without_gaps(documents, texts, library):
    rows = packing.pack(documents, bpe.tokenizer_path()).collect()
    ids = {3 * i + 1: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    pieces = collections.defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == r.piece * 4096 and len(own) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        pieces[r.doc_id].append(r.length)
    assert {d: sum(n) for d, n in pieces.items()} == {d: len(i) for d, i in ids.items()}
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096
    assert len(sequences) <= -(-sum(map(len, ids.values())) // 4096) + 1


@pytest.mark.parametrize("n", [1, 30, 3000, 60_000])
def test_plans_use_every_piece_in_few_sequences(n):
    rng = np.random.default_rng(n)
    sizes = np.maximum(rng.lognormal(6.2, 1.1, n).astype(int), 1) % 4096 + 1
    lengths, counts = np.unique(sizes, return_counts=True)
    used, sequences = collections.Counter(), 0
    for items, times in packing.plan(lengths, counts):
        assert sum(a * b for a, b in items) <= packing.CAPACITY
        used.update({a: b * times for a, b in items})
        sequences += times
    assert used == dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    assert sequences <= 1.005 * sizes.sum() / packing.CAPACITY + 1
