"""Packing of tokenised documents into sequences of at most ``CAPACITY`` tokens.

Only documents longer than a sequence are cut. The lengths of all pieces form a histogram of at
most ``CAPACITY`` counts, which is all the driver sees. On up to ``CLASSES`` classes of lengths it
solves the configuration linear program: cover each class's demand with as few configurations
(multisets of classes that fit a sequence) as possible. Multiplicative weights give each class a
price that falls as its demand is covered, and a knapsack by dynamic programming finds the
dearest configuration at these prices. The solution is rounded in exact lengths: each configuration, most used
first, is filled with lengths of its classes that are left, then with the longest lengths that
still fit, as many times at once as the counts allow; what remains is filled the same way from
the longest length down. Each step uses up a length or a configuration, so the number of
patterns does not depend on the number of documents.

Pieces learn their place from their number among the pieces of their length, counted per
partition and shifted by the counts of the partitions before.

Null texts are empty: one piece that holds the end token alone. Empty tables give no rows. Rows
that repeat a document are packed like any others; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from switchboard.llm.bpe import encoder, tokenizer_path
from switchboard.llm.frames import chunks, small_batches, table
from switchboard.session import store

CAPACITY = 4096
END = 1
CLASSES = 96
# Units of capacity in the knapsack, and the share of a class's demand that one step may cover.
UNITS = 512
STEP = 0.1

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(docs: DataFrame, path: str) -> DataFrame:
    """All pieces, numbered among those of their length in their partition (``part``, ``nth``)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, part = encoder(path), np.zeros(CAPACITY + 1, np.int64), TaskContext.get().partitionId()
        for rows in chunks(batches, "text"):
            ids, offsets = own.encode([t or "" for t in rows.column("text").to_pylist()])
            total = np.diff(offsets) + 1
            ids = np.insert(ids, offsets[1:], END).astype("<u4")
            base = np.cumsum(total) - total
            made = -(-total // CAPACITY)
            of = np.repeat(np.arange(len(made)), made)
            number = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
            start = number * CAPACITY
            length = np.minimum(total[of] - start, CAPACITY)
            begin = base[of] + start
            codes = [crc32(ids[a:b]) for a, b in zip(begin, begin + length, strict=True)]
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(order)) - np.searchsorted(ranked, ranked) + seen[ranked]
            seen += np.bincount(length, minlength=CAPACITY + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(of)),
                    pa.array(number.astype(np.int32)),
                    *map(pa.array, (start, length, np.array(codes, np.int64))),
                    pa.array(np.full(len(of), part, np.int32)),
                    pa.array(nth),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, PIECES)


def dearest(sizes: np.ndarray, prices: np.ndarray) -> np.ndarray:
    """Copies of each class in the configuration of the highest price that fits ``UNITS``."""
    best, chosen = np.zeros(UNITS + 1), np.full(UNITS + 1, -1)
    for room in range(1, UNITS + 1):
        fits = np.flatnonzero(sizes <= room)
        best[room] = best[room - 1]
        if len(fits):
            value = best[room - sizes[fits]] + prices[fits]
            at = int(value.argmax())
            if value[at] > best[room]:
                best[room], chosen[room] = value[at], fits[at]
    copies, room = np.zeros(len(sizes), np.int64), UNITS
    while room:
        if chosen[room] < 0:
            room -= 1
        else:
            copies[chosen[room]] += 1
            room -= sizes[chosen[room]]
    return copies


def configurations(lengths: np.ndarray, counts: np.ndarray) -> tuple[list[np.ndarray], list[tuple[np.ndarray, float]]]:
    """Classes (their lengths, ascending) and the configurations with their fractional use."""
    edges = np.searchsorted(np.cumsum(counts), counts.sum() * np.arange(1, CLASSES) / CLASSES)
    members = [m for m in np.split(np.arange(len(lengths)), np.unique(edges)) if len(m)]
    demand = np.array([counts[m].sum() for m in members], float)
    mean = np.array([np.average(lengths[m], weights=counts[m]) for m in members])
    sizes = np.maximum(np.rint(mean * UNITS / CAPACITY).astype(np.int64), 1)
    covered, use = np.zeros(len(members)), defaultdict(float)
    while covered.min() < 1:
        prices = np.exp(-np.log(len(members) + 1) / STEP * (covered - covered.min()) * STEP * 4) / demand
        copies = dearest(sizes, prices)
        on = np.flatnonzero(copies)
        times = STEP * (demand[on] / copies[on]).min()
        use[copies.tobytes()] += times
        covered += times * copies / demand
    found = [(np.frombuffer(c, np.int64), x / covered.mean()) for c, x in use.items()]
    return [lengths[m] for m in members], sorted(found, key=lambda f: -f[1])


class Filling:
    """Counts of the lengths that are left, and the patterns made of them."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        self.left = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
        self.lengths = lengths.tolist()  # ascending, those with a count
        self.patterns: list[tuple[list[tuple[int, int]], int]] = []

    def longest(self, room: int, taken: dict[int, int]) -> int:
        """The longest length left that fits, 0 if none does."""
        at = bisect_right(self.lengths, room) - 1
        while at >= 0 and self.left[self.lengths[at]] <= taken.get(self.lengths[at], 0):
            at -= 1
        return self.lengths[at] if at >= 0 else 0

    def fill(self, wanted: list[list[int]], most: int) -> int:
        """Make one pattern, first of one length out of each list, and use it up to ``most`` times."""
        room, taken = CAPACITY, defaultdict(int)
        for choice in wanted:
            able = [n for n in choice if n <= room and self.left.get(n, 0) > taken[n]]
            if able:
                n = max(able, key=lambda x: self.left[x] / (taken[x] + 1))
                taken[n] += 1
                room -= n
        while n := self.longest(room, taken):
            # Two lengths that fill the room are better than the longest and a gap.
            rest = room - n
            if rest and not self.longest(rest, taken):
                for first in self.near(room, taken):
                    if self.left.get(room - first, 0) > taken.get(room - first, 0) + (room == 2 * first):
                        n = first
                        break
            copies = max(1, min(room // n, (self.left[n] - taken[n]) // max(most, 1)))
            taken[n] += copies
            room -= n * copies
        taken = {n: c for n, c in taken.items() if c}
        times = min(most, *(self.left[n] // c for n, c in taken.items()))
        for n, c in taken.items():
            self.left[n] -= times * c
            if not self.left[n]:
                del self.left[n]
                self.lengths.remove(n)
        self.patterns.append((sorted(taken.items(), reverse=True), times))
        return times

    def near(self, room: int, taken: dict[int, int]) -> list[int]:
        """Up to 64 lengths that are left, from half of the room up."""
        low = bisect_right(self.lengths, room // 2)
        high = bisect_right(self.lengths, room - 1)
        return [n for n in self.lengths[low:high][::-1][:64] if self.left[n] > taken.get(n, 0)]


def plan(lengths: np.ndarray, counts: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns (length and copies of each) and how many sequences follow each of them."""
    order = np.argsort(lengths)
    lengths, counts = lengths[order], counts[order]
    filling = Filling(lengths, counts)
    if len(lengths) and lengths[-1] == CAPACITY:
        filling.fill([[CAPACITY]], int(counts[-1]))
        lengths, counts = lengths[:-1], counts[:-1]
    if len(lengths):
        classes, found = configurations(lengths, counts)
        for copies, use in found:
            slots = [classes[k].tolist() for k in np.flatnonzero(copies)[::-1] for _ in range(copies[k])]
            wanted = int(use)
            while wanted > 0 and any(n in filling.left for n in slots[0]):
                wanted -= filling.fill(slots, wanted)
    while filling.lengths:
        longest = filling.lengths[-1]
        filling.fill([[longest]], filling.left[longest])
    return filling.patterns


def places(patterns: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """Per length, in order of their numbers: the runs of pieces that follow one pattern."""
    rows, used, sequence = [], defaultdict(int), 0
    for items, times in patterns:
        offset = 0
        for length, copies in items:
            rows.append((length, used[length], copies, offset, sequence))
            used[length] += times * copies
            offset += length * copies
        sequence += times
    rows.sort()
    names = ("length", "first", "copies", "offset", "sequence")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: where it starts in its document, and its sequence and offset there."""
    spark = docs.sparkSession
    made = store(pieces(docs, path), "pieces")
    per_part = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = sorted((r.length, r.n) for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect())
    lengths = np.array([c[0] for c in counts], np.int64)
    layout = spark.sparkContext.broadcast(places(plan(lengths, np.array([c[1] for c in counts], np.int64))))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = made.join(before, ["part", "length"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = layout.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length, n = batch.column("length").to_numpy(), batch.column("n").to_numpy()
            run_ = np.searchsorted(at["length"] * (1 << 46) + at["first"], length * (1 << 46) + n, side="right") - 1
            n = n - at["first"][run_]
            sequence = at["sequence"][run_] + n // at["copies"][run_]
            offset = at["offset"][run_] + n % at["copies"][run_] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInArrow(run, schema)


def op9(spark, folder: str) -> DataFrame:
    """The registered query: all documents."""
    return pack(table(spark, folder, "documents"), tokenizer_path())
