"""Encoding and decoding with a merge-type SentencePiece model.

Spaces become U+2581, a text that is not empty gets one in front, and each code point is a symbol.
All adjacent pairs of symbols that join to a piece wait in an agenda, ordered by the piece's score
and then by place. The best pair is joined, the pairs that the joined symbol forms with its
neighbours are added, and pairs whose symbols have changed are passed over, until the agenda is
empty. A symbol that is no piece is written as its bytes.

No pair can join across two code points that stand side by side in no piece, so texts are cut there
first, and each distinct cut of a chunk goes through one agenda. Workers keep a bounded number of
encoded cuts from chunk to chunk. The results do not depend on cuts or kept words: a vocabulary
with pieces across words only gives longer cuts.

``check`` runs the sentencepiece library over the same Arrow batches and says per row whether ids
and decoded text agree. Null texts are empty: no tokens. Very long texts are worked on whole. Every
row is encoded, repeated rows alike; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from switchboard.llm.frames import chunks, mix, powers, small_batches, table

SPACE = "▁"
# Encoded cuts that a worker keeps.
KEPT = 400_000
# Fixed values of the model format: kinds of pieces, and the merge type.
NORMAL, UNKNOWN, CONTROL, DEFINED, UNUSED, BYTE = range(1, 7)
MERGES = 2
_BASE = 0x9E3779B97F4A7C55


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of one message in the model file's wire format."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if key & 7 == 2 else ({5: 4, 1: 8}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all ranges, one after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class _Strings:
    """One byte string per token, written for a whole array of tokens at once."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(strings), np.uint8)

    def write(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and their offsets."""
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.letters[_ragged(self.places[ids], sizes)], ends[offsets]


class Pieces:
    """The pieces, scores and settings of a model file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        settings = {n: dict(_fields(v)) for n, v in fields if n in (2, 3)}
        trainer, normal = settings.get(2, {}), settings.get(3, {})
        self.prefix = normal.get(3, 1) == 1
        if trainer.get(3, 1) != MERGES or trainer.get(35, 0) != 1 or normal.get(2) or normal.get(4, 1) or normal.get(5, 1) != 1:
            raise ValueError("only merge-type models with byte fallback that leave texts as they are can be read")
        pieces, self.kinds = [], []
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        for n, value in fields:
            if n == 1:
                own = dict(_fields(value))
                text, kind = own[1].decode(), own.get(3, NORMAL)
                if kind in (DEFINED, UNUSED):
                    raise ValueError(f"piece {text!r} of kind {kind} is not read")
                if kind == NORMAL:
                    self.score[text] = -struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                    self.id[text] = len(pieces)
                pieces.append(text)
                self.kinds.append(kind)
        self.byte = [0] * 256
        for number, (text, kind) in enumerate(zip(pieces, self.kinds, strict=True)):
            if kind == BYTE:
                self.byte[int(text[1:-1], 16)] = number
        self.single = np.full(0x110000, -1, np.int32)
        for text, number in self.id.items():
            if len(text) == 1:
                self.single[ord(text)] = number
        # Code points that stand side by side in some piece, by classes; class 0 stands beside nothing.
        pairs = {text[k : k + 2] for text in self.id for k in range(len(text) - 1)}
        letters = sorted({c for pair in pairs for c in pair})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        self.beside = np.zeros(self.width * self.width, bool)
        self.beside[[self.letter[ord(a)] * self.width + self.letter[ord(b)] for a, b in pairs]] = True
        plain = []
        for text, kind in zip(pieces, self.kinds, strict=True):
            if kind == BYTE:
                plain.append(bytes([int(text[1:-1], 16)]))
            else:
                plain.append({CONTROL: b"", UNKNOWN: " ⁇ ".encode()}.get(kind, text.replace(SPACE, " ").encode()))
        self.plain = _Strings(plain)
        self.decimal = _Strings([b",%d" % number for number in range(len(pieces))])
        self.is_byte = np.array(self.kinds) == BYTE
        self.spaced = np.array([kind == NORMAL and text.startswith(SPACE) for text, kind in zip(pieces, self.kinds, strict=True)])
        self.kept: dict[str, list[int]] = {}

    def merge(self, word: str) -> list[int]:
        """Token ids of one cut, by the agenda."""
        score, size = self.score, len(word)
        symbols: list[str] = list(word)
        agenda = []
        for k in range(size - 1):
            rank = score.get(word[k : k + 2])
            if rank is not None:
                agenda.append((rank, k, k + 1, 2))
        if agenda:
            heapq.heapify(agenda)
            after, before = list(range(1, size + 1)), list(range(-1, size - 1))
            while agenda:
                _, left, right, length = heapq.heappop(agenda)
                a, b = symbols[left], symbols[right]
                if not a or not b or len(a) + len(b) != length:
                    continue
                joined = symbols[left] = a + b
                symbols[right] = ""
                following = after[left] = after[right]
                if following < size:
                    before[following] = left
                    rank = score.get(joined + symbols[following])
                    if rank is not None:
                        heapq.heappush(agenda, (rank, left, following, length + len(symbols[following])))
                ahead = before[left]
                if ahead >= 0:
                    rank = score.get(symbols[ahead] + joined)
                    if rank is not None:
                        heapq.heappush(agenda, (rank, ahead, left, length + len(symbols[ahead])))
        ids = []
        for symbol in symbols:
            if symbol:
                number = self.id.get(symbol)
                if number is None:
                    ids += [self.byte[b] for b in symbol.encode()]
                else:
                    ids.append(number)
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after another, and the n + 1 offsets of the texts in them."""
        first = SPACE if self.prefix else ""
        whole = [first + t.replace(" ", SPACE) if t else "" for t in texts]
        sizes = np.array([len(t) for t in whole], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        joined = "".join(whole)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        letter = self.letter[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.beside[letter[:-1] * self.width + letter[1:]]
        cut[ends[:-1][sizes > 0]] = True
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, len(points)))
        # Single pieces are looked up; all other cuts once per distinct cut.
        alone = np.where(lengths == 1, self.single[points[starts]], -1)
        other = np.flatnonzero(alone < 0)
        count = np.ones(len(starts), np.int64)
        place = np.zeros(len(starts), np.int64)
        flat: list[int] = []
        if len(other):
            sums = np.zeros(len(points) + 1, np.uint64)
            np.cumsum(mix(points.astype(np.uint64) + np.uint64(1 << 32)) * powers(_BASE, len(points)), out=sums[1:])
            back = powers(pow(_BASE, -1, 1 << 64), len(points))
            low, high = starts[other], starts[other] + lengths[other]
            key = mix((sums[high] - sums[low]) * back[low] + lengths[other].astype(np.uint64))
            _, some, which = np.unique(key, return_index=True, return_inverse=True)
            made = np.zeros(len(some), np.int64)
            if len(self.kept) > KEPT:
                self.kept.clear()
            for k, (a, b) in enumerate(zip(low[some].tolist(), high[some].tolist(), strict=True)):
                word = joined[a:b]
                ids = self.kept.get(word)
                if ids is None:
                    ids = self.merge(word)
                    if b - a <= 64:
                        self.kept[word] = ids
                made[k] = len(ids)
                flat += ids
            count[other] = made[which]
            place[other] = (np.cumsum(made) - made)[which]
        ids = np.repeat(alone, count).astype(np.int32)
        if len(other):
            filled = np.cumsum(count) - count
            ids[_ragged(filled[other], count[other])] = np.array(flat, np.int32)[_ragged(place[other], count[other])]
        before = np.concatenate([[0], np.cumsum(count)])
        return ids, before[np.searchsorted(starts, ends)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of all decoded texts: the space in front goes, bytes that form no code point become U+FFFD."""
        letters, places = self.plain.write(ids, offsets)
        data = letters.tobytes()
        first = self.prefix & (places[1:] > places[:-1])
        # The first token that writes anything.
        ends = np.cumsum(self.plain.sizes[ids])
        first[first] = self.spaced[ids[np.searchsorted(ends, places[:-1][first], side="right")]]
        out = [data[a + f : b] for a, b, f in zip(places[:-1].tolist(), places[1:].tolist(), first.tolist(), strict=True)]
        some = np.concatenate([[0], np.cumsum(self.is_byte[ids])])[offsets]
        for row in np.flatnonzero(some[1:] > some[:-1]).tolist():
            try:
                out[row].decode()
            except UnicodeDecodeError:
                out[row] = _mended(out[row])
        return out


def _mended(data: bytes) -> bytes:
    """Every byte that starts no whole code point becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        size = 1 if data[at] < 0xC0 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
        try:
            out.append(data[at : at + size].decode().encode())
            at += size
        except UnicodeDecodeError:
            out.append("�".encode())
            at += 1
    return b"".join(out)


_models: dict[str, Pieces] = {}
_libraries: dict[str, object] = {}


def model(path: str) -> Pieces:
    """The model of a file, read once in each worker."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def library(path: str):
    """The sentencepiece library's reader of a file, read once in each worker."""
    if path not in _libraries:
        from sentencepiece import SentencePieceProcessor

        _libraries[path] = SentencePieceProcessor(model_file=path)
    return _libraries[path]


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for part in chunks(batches, "text"):
            ids, offsets = own.encode([t or "" for t in part.column("text").to_pylist()])
            arrays = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), arrays], ["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def texts_of(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text``, decoded from the column ids; null where ids are null."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            flat = np.array([t for ids in lists for t in ids or []], np.int32)
            offsets = np.concatenate([[0], np.cumsum([len(ids or []) for ids in lists], dtype=np.int64)])
            texts = own.decode(flat, offsets)
            texts = [None if ids is None else t.decode() for ids, t in zip(lists, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, check: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens and the digests of decimal ids and decoded text; with ``check`` also ``agrees``."""
    small_batches(docs.sparkSession)
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", agrees boolean" if check else "")
    names = [k.split()[0] for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for part in chunks(batches, "text"):
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids, offsets = own.encode(texts)
            letters, places = own.decimal.write(ids, offsets)
            decoded = own.decode(ids, offsets)
            columns = [
                part.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array([sha256(letters[min(a + 1, b) : b]).hexdigest() for a, b in zip(places[:-1], places[1:], strict=True)], pa.string()),
                pa.array([sha256(t).hexdigest() for t in decoded], pa.string()),
            ]
            if check:
                columns.append(pa.array(_agree(library(path), texts, ids, offsets, decoded), pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names)

    return _texts(docs).mapInArrow(run, kinds)


def _agree(other, texts: list[str], ids: np.ndarray, offsets: np.ndarray, decoded: list[bytes]) -> list[bool]:
    out = []
    for k, text in enumerate(texts):
        want = other.encode(text)
        same = ids[offsets[k] : offsets[k + 1]].tolist() == want
        out.append(same and decoded[k].decode() == other.decode(want))
    return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")


def op12(spark, folder: str) -> DataFrame:
    """The registered query: every document, encoded, decoded and checked against the library."""
    return digests(table(spark, folder, "documents"), model_path(), check=True)
