"""Removal of repeated passages by sliding spans of sentences.

A sentence ends at ``.``, ``!`` or ``?`` after a word, at a line break, and with the text. From each
sentence on, and up to each sentence, a span takes the fewest consecutive sentences, two at least,
that have ``WORDS`` words or more; a sentence of ``LONG`` words is a span by itself as well. Spans are
compared by a 128-bit hash of their words (runs without white space, A-Z lowered), so line breaks and
spacing don't matter. All places of a span but the first (smallest doc_id, then sentence) lose their
sentences. A text whose sentences all go becomes empty.

These spans, at most three a sentence, stand for all longer runs: each sentence of a run lies in the
span that begins with it, or, where that one would leave the run, in the span that ends the run.

First places are minima with partial aggregates; the places are then joined with the spans found
more than once. Only texts that lose something meet their list of sentences, which is never
longer than the text.

Null texts are empty; empty texts, texts too short for a span and empty tables lose nothing. Rows
that repeat doc_id and text are one document: they lose the same. Rows without doc_id come after
all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.frames import Hasher, as_bytes, chunks, lowered, mix, powers, small_batches, table, word_spans
from switchboard.session import store

WORDS, SENTENCES, LONG = 20, 2, 40
_BASES = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F)
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


class Sentences:
    """Sentences of all texts of a chunk: their words, places and rows."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray):
        lower = lowered(values)
        self.starts, self.ends, row = word_spans(values, offsets)
        self.words = Hasher(lower).ranges(self.starts, self.ends)
        lines = np.concatenate([[0], np.cumsum(values == 10)])
        last = np.ones(len(row), bool)
        if len(row):
            broken = lines[self.starts[1:]] > lines[self.ends[:-1]]
            last[:-1] = _ENDS[values[self.ends[:-1] - 1]] | broken | (row[1:] != row[:-1])
        stop = np.flatnonzero(last) + 1
        self.first, self.stop = np.concatenate([[0], stop])[:-1].astype(np.int64), stop
        self.row = row[self.first] if len(stop) else np.zeros(0, np.int64)
        self.begin = np.searchsorted(self.row, np.arange(len(offsets) - 1))  # first sentence of each text
        self.end = np.searchsorted(self.row, np.arange(len(offsets) - 1), side="right")

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last sentence of all spans."""
        n = len(self.row)
        at = np.arange(n)
        if not n:
            return at, at
        reach = np.searchsorted(self.stop, self.first + WORDS)  # the sentence in which enough words are there
        reach = np.maximum(reach, at + SENTENCES - 1)
        back = np.searchsorted(self.first, self.stop - WORDS, side="right") - 1  # the same towards the start
        back = np.minimum(back, at - SENTENCES + 1)
        on, to = reach < self.end[self.row], back >= self.begin[self.row]
        # A span that is found from both ends counts once.
        to &= (reach[back] != at) | (back < 0)
        alone = self.stop - self.first >= LONG
        return np.concatenate([at[on], back[to], at[alone]]), np.concatenate([reach[on], at[to], at[alone]])

    def hashes(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """Two hashes of the words from sentence ``a`` to sentence ``b``."""
        low, high = self.first[a], self.stop[b]
        out = []
        for base in _BASES:
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words * powers(base, len(self.words)))])
            back = powers(pow(base, -1, 1 << 64), len(sums))
            out.append(mix((sums[high] - sums[low]) * back[low] + (high - low).astype(np.uint64)))
        return out


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "text"):
        found = Sentences(*as_bytes(part.column("text")))
        a, b = found.spans()
        row = pa.array(found.row[a])
        place = a - found.begin[found.row[a]]
        one, two = (pa.array(h.view(np.int64)) for h in found.hashes(a, b))
        columns = [one, two, part.column("doc_id").take(row), part.column("tag").take(row)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(place), pa.array(b - a + 1)], ["h1", "h2", "doc_id", "tag", "place", "size"]
        )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the listed sentences: from a sentence's first word to the next one's."""
    for part in chunks(batches, "text"):
        values, offsets = as_bytes(part.column("text"))
        found = Sentences(values, offsets)
        texts, counts, gone = [], [], []
        for row, marks in enumerate(part.column("marks").to_pylist()):
            first, count = found.begin[row], found.end[row] - found.begin[row]
            out = np.zeros(count, bool)
            for mark in marks or []:
                out[mark["place"] : mark["place"] + mark["size"]] = True
            cuts = np.append(found.starts[found.first[first : first + count]], offsets[row + 1])
            if count:
                cuts[0] = offsets[row]
            kept = [values[cuts[k] : cuts[k + 1]].tobytes() for k in np.flatnonzero(~out)]
            texts.append(b"".join(kept).decode() if out.any() else part.column("text")[row].as_py())
            counts.append(int(count))
            gone.append(int(out.sum()))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
            ["doc_id", "n_sentences", "n_removed", "text"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_sentences, n_removed and the text that stays (null stays null)."""
    small_batches(docs.sparkSession)
    # A row is told apart by its doc_id and a tag of its text.
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc_id"),
        F.col("doc_id").isNull().alias("none"),
        F.xxhash64(F.col("text")).alias("tag"),
        "text",
    )
    schema = "h1 long, h2 long, doc_id long, tag long, place long, size long"
    spans = store(rows.select("doc_id", "tag", "text").mapInArrow(_spans, schema), "spans")
    place = F.struct("doc_id", "tag", "place")
    firsts = spans.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # Written first, so that the join meets two plain shuffles and a span with many places can be split.
    firsts = store(firsts.where("first != last").select("h1", "h2", "first"), "firsts")
    later = spans.join(firsts, ["h1", "h2"]).where(place != F.col("first"))
    marks = later.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("place", "size")).alias("marks"))
    told = rows.join(store(marks, "marks"), ["doc_id", "tag"], "left")
    told = told.select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "text", "marks")
    return told.mapInArrow(_without, "doc_id long, n_sentences long, n_removed long, text string")


def op7(spark, folder: str) -> DataFrame:
    """The registered query: all documents."""
    return without_repeats(table(spark, folder, "documents"))
