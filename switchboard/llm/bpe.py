"""Byte-pair encoding and decoding with a public tokenizer's vocabulary.

A text is normalised (NFC, lower case), cut at white space, and cut further by the tokenizer's
pattern. Each distinct word of a chunk is encoded once, and workers keep a bounded number of encoded
words for the next chunks: a row holds the word's parts side by side,
and beside them the rank of each adjacent pair. Again and again the smallest rank of the row is
found, the boundary inside that pair is deleted, the parts move up, and the ranks next to the
merged part are looked up anew, until no pair has a rank. All words of like length go through
these steps together, one numpy row each. Words of more than ``SHORT`` bytes would take a square
number of steps; they keep their pairs in a heap, which merges in the same order.

Decoding writes the tokens' strings with a space between, as this tokenizer has no decoder.

Null texts are empty: no tokens. The strings of special tokens in a text stand for those tokens.
Very long texts are worked on whole. Every row is encoded, repeated rows alike.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from switchboard.llm.frames import Hasher, as_bytes, chunks, small_batches, table, word_spans

NONE = np.int32(2**31 - 1)
SHORT = 64
# Encoded words that a worker keeps.
KEPT = 300_000
CLASSES = (4, 8, 16, 32, SHORT)


class Known:
    """Token ids of words, by their hashes and sizes, from chunk to chunk; a full table begins anew."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.sizes = self.places = self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def find(self, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word (hashes ascend) is known, and where it is or belongs."""
        at = np.searchsorted(self.hashes, hashes)
        near = np.minimum(at, max(len(self.hashes) - 1, 0))
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), at
        return (self.hashes[near] == hashes) & (self.sizes[near] == sizes), at

    def add(self, at: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Words that are not known, at the places that ``find`` gave; long ones are not kept."""
        if len(self.hashes) + len(hashes) > KEPT:
            self.__init__()
            at = np.zeros(len(hashes), np.int64)
        near = np.minimum(at, max(len(self.hashes) - 1, 0))
        free = self.hashes[near] != hashes if len(self.hashes) else np.ones(len(hashes), bool)
        keep = np.flatnonzero(free & (sizes <= SHORT))
        places = (np.cumsum(counts) - counts)[keep]
        count = counts[keep]
        begin = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, ids[np.arange(count.sum()) + np.repeat(places - (begin - len(self.ids)), count)]])
        for name, values in (("hashes", hashes[keep]), ("sizes", sizes[keep]), ("places", begin), ("counts", count)):
            setattr(self, name, np.insert(getattr(self, name), at[keep], values))


class Encoder:
    """The vocabulary and merges of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        pairs = [(vocab[a] << 16 | vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(spec["model"]["merges"])]
        self.pairs = np.array([p[0] for p in sorted(pairs)], np.int64)
        self.ranks = np.array([p[1] for p in sorted(pairs)], np.int32)
        self.merged = np.array([p[2] for p in pairs], np.int32)
        letters = _byte_letters()
        self.byte = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + end] for b in range(256)], np.int32)
        size = max([*vocab.values(), *self.special.values()]) + 1
        strings = [b""] * size
        for token, number in (vocab | self.special).items():
            strings[number] = token.encode()
        self.strings = strings
        # " token" of all tokens in one array, to write decoded texts with.
        self.sizes = np.array([len(s) + 1 for s in strings], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(b" " + s for s in strings), np.uint8)
        self.known = Known()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 16 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)

    def _short(self, parts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Merge the rows of ``parts`` (``size`` used columns each) in place; returns the new sizes."""
        size = size.copy()
        rows, width = len(parts), parts.shape[1]
        inside = np.arange(width - 1) < (size - 1)[:, None]
        ranks = np.full((rows, width), NONE, np.int32)
        r, c = np.nonzero(inside)
        ranks[r, c] = self.rank(parts[r, c], parts[r, c + 1])
        live = np.arange(rows)
        work, near = parts.copy(), ranks
        column = np.arange(width)
        while len(live):
            at = near.argmin(axis=1)
            least = near[np.arange(len(live)), at]
            on = least != NONE
            if not on.all():
                done = ~on
                parts[live[done]] = work[done]
                live, work, near, at, least = live[on], work[on], near[on], at[on], least[on]
                if not len(live):
                    break
            here = np.arange(len(live))
            after = np.minimum(column + (column > at[:, None]), width - 1)
            work = np.take_along_axis(work, after, axis=1)
            work[here, at] = self.merged[least]
            after = np.minimum(column + (column >= at[:, None]), width - 1)
            near = np.take_along_axis(near, after, axis=1)
            size[live] -= 1
            near[here, np.minimum(size[live] - 1, width - 1)] = NONE
            left = np.flatnonzero(at > 0)
            near[left, at[left] - 1] = self.rank(work[left, at[left] - 1], work[left, at[left]])
            right = np.flatnonzero(at < size[live] - 1)
            near[right, at[right]] = self.rank(work[right, at[right]], work[right, at[right] + 1])
        return size

    def _long(self, parts: list[int]) -> list[int]:
        """One long word: pairs wait in a heap by rank, then place."""
        following, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        alive = [True] * len(parts)

        def ranked(places: list[int]) -> list[tuple[int, int, int, int]]:
            places = [i for i in places if 0 <= i and following[i] < len(parts)]
            if not places:
                return []
            left, right = ([parts[i] for i in places], [parts[following[i]] for i in places])
            found = self.rank(np.array(left), np.array(right)).tolist()
            return [(r, i, a, b) for r, i, a, b in zip(found, places, left, right, strict=True) if r != NONE]

        heap = ranked(list(range(len(parts) - 1)))
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = following[i]
            if not alive[i] or parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], alive[j], following[i] = int(self.merged[rank]), False, following[j]
            if following[i] < len(parts):
                before[following[i]] = i
            for pair in ranked([before[i], i]):
                heapq.heappush(heap, pair)
        return [p for p, on in zip(parts, alive, strict=True) if on]

    def words(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after another, and how many each word has."""
        count = np.zeros(len(sizes), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for width in CLASSES:
            some = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if len(some):
                column = np.arange(width)
                size = sizes[some]
                inside = column < size[:, None]
                letters = data[np.where(inside, starts[some][:, None] + column, 0)]
                parts = np.where(column == size[:, None] - 1, self.last[letters], self.byte[letters])
                count[some] = self._short(parts, size)
                done.append((some, parts))
        long = {}
        for word in np.flatnonzero(sizes > SHORT):
            letters = data[starts[word] : starts[word] + sizes[word]]
            long[word] = self._long([*self.byte[letters[:-1]].tolist(), int(self.last[letters[-1]])])
            count[word] = len(long[word])
        place = np.cumsum(count) - count
        ids = np.zeros(count.sum(), np.int32)
        for some, parts in done:
            inside = np.arange(parts.shape[1]) < count[some][:, None]
            ids[(place[some][:, None] + np.arange(parts.shape[1]))[inside]] = parts[inside]
        for word, parts in long.items():
            ids[place[word] : place[word] + count[word]] = parts
        return ids, count

    def normal(self, text: str) -> str:
        """NFC and lower case, letter by letter: a final sigma is a sigma."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after another, and the n + 1 offsets of the texts in them."""
        pieces, owner, fixed = [], [], []
        for row, text in enumerate(texts):
            cut = self.split.split(text) if "<|" in text else [text]
            for piece in cut:
                number = self.special.get(piece, -1)
                pieces.append("" if number >= 0 else self.normal(piece))
                owner.append(row)
                fixed.append(number)
        ids, count = self._encode(pieces)
        fixed_at = np.flatnonzero(np.array(fixed, np.int64) >= 0)
        if len(fixed_at):
            place = np.cumsum(count) - count
            ids = np.insert(ids, place[fixed_at], np.array(fixed, np.int32)[fixed_at])
            count[fixed_at] = 1
        total = np.bincount(np.array(owner, np.int64), count, len(texts)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(total)])

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens, and how many each has."""
        data, offsets = as_bytes(pa.array(pieces, pa.string()))
        starts, ends, row = word_spans(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(pieces), np.int64)
        hashes, first, which = np.unique(Hasher(data).ranges(starts, ends), return_index=True, return_inverse=True)
        starts, sizes = starts[first], (ends[first] - starts[first]).astype(np.int64)
        known, at = self.known.find(hashes, sizes)
        per, place = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        per[known], place[known] = self.known.counts[at[known]], self.known.places[at[known]]
        new = np.flatnonzero(~known)
        made, per[new] = self._cut(data, starts[new], sizes[new])
        place[new] = len(self.known.ids) + np.cumsum(per[new]) - per[new]
        ids = np.concatenate([self.known.ids, made])
        self.known.add(at[new], hashes[new], sizes[new], made, per[new])
        # From distinct words to all words, to texts.
        tokens = per[which]
        every = np.arange(tokens.sum()) + np.repeat(place[which] - (np.cumsum(tokens) - tokens), tokens)
        return ids[every], np.bincount(row, tokens, len(pieces)).astype(np.int64)

    def _cut(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that the pattern cuts into matches, one after another, and how many each has."""
        # Words of a-z alone are one match of the pattern; all others are cut by it.
        other = np.concatenate([[0], np.cumsum((data < 97) | (data > 122))])
        mixed = np.flatnonzero(other[starts + sizes] > other[starts])
        cut = [self.pattern.findall(data[starts[w] : starts[w] + sizes[w]].tobytes().decode()) for w in mixed]
        made = np.ones(len(sizes), np.int64)
        made[mixed] = [len(c) for c in cut]
        flat = [m.encode() for c in cut for m in c]
        lengths = np.array([len(m) for m in flat], np.int64)
        of = np.repeat(np.arange(len(made)), made)
        is_cut = np.zeros(len(made), bool)
        is_cut[mixed] = True
        begin, length = starts[of].astype(np.int64), sizes[of].astype(np.int64)
        begin[is_cut[of]] = len(data) + np.cumsum(lengths) - lengths
        length[is_cut[of]] = lengths
        data = np.concatenate([data, np.frombuffer(b"".join(flat), np.uint8)])
        ids, count = self.words(data, begin, length)
        return ids, np.bincount(of, count, len(made)).astype(np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all decoded texts, each with one leading space if it has tokens, and their offsets."""
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(self.places[ids] - ends[:-1], sizes)
        return self.letters[at], ends[offsets]


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from 256 on."""
    free = iter(range(256, 512))
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, read once in each worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in chunks(batches, "text"):
            ids, offsets = own.encode([t or "" for t in part.column("text").to_pylist()])
            arrays = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), arrays], ["doc_id", "ids"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def texts_of(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text``, decoded from the column ids."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = [None if i is None else " ".join(own.strings[t].decode() for t in i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens and the digests of ids and decoded text, without moving either."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in chunks(batches, "text"):
            ids, offsets = own.encode([t or "" for t in part.column("text").to_pylist()])
            letters, places = own.decode(ids, offsets)
            ids = ids.astype("<u4")
            spans, cuts = list(zip(offsets[:-1], offsets[1:], strict=True)), zip(places[:-1], places[1:], strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array([sha256(ids[a:b]).hexdigest() for a, b in spans]),
                    pa.array([sha256(letters[min(a + 1, b) : b]).hexdigest() for a, b in cuts]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5(spark, folder: str) -> DataFrame:
    """The registered query: every document, encoded and decoded."""
    return digests(table(spark, folder, "documents"), tokenizer_path())
