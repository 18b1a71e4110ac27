"""Removal of long repeated byte strings, found on a Burrows-Wheeler transform.

A string of ``length`` bytes that also starts elsewhere, in the same document or in another, is
a repeat. Its bytes go from every place, or from every place but the first (``keep_first``).

Reduction. A window of ``length`` bytes picks the smallest hash among its 16-byte grams as its
anchor, so equal windows have equal anchors at equal places. Window starts that share an anchor
and a step of ``STEP`` bytes before it form a run; all its windows hold the same core of
``length - STEP + 1`` bytes. Runs whose core (64-bit hash) is found at one place only hold no
repeat; they are most of the corpus and never move again. What is left are contexts: up to
``STEP - 1`` bytes, the core, up to ``STEP - 1`` bytes. Equal contexts (128-bit hashes) are
merged with partial aggregates and weighted.

Search. Contexts are dealt by core and joined into blocks in which a core is one symbol, so that
a window has ``STEP`` symbols. Each block is sorted to that depth and transformed; intervals of
the transform are extended to the left breadth first, which gives the common prefix of
neighbouring suffixes by increasing value, and the extension stops at the window's length:
neighbours without a value there share a whole window. Groups of weight two or more are repeats.

A core may have very many different contexts, more than a task should hold (``LIMIT`` symbols). Its
interval is then extended over all tasks: each context is dealt to the next ``STEPS`` by its core and
the bytes beside it that all windows of a shorter run share. Equal ones merge again, most extended
cores have few contexts and are transformed as above, and the others are extended further, up to
whole windows. A context's marks come back as one bitmap, so a place is always one row per run.

Equal texts of at least ``length`` bytes are one text with a count; each of its bytes is a repeat by
definition. Null texts are empty; texts shorter than ``length`` and empty tables lose nothing; rows
that repeat a doc_id are places like any others.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.frames import Hasher, as_bytes, chunks, mix, small_batches, spare, text_key, text_of
from switchboard.session import store

GRAM = 16
STEP = 128
# Steps of the runs that the contexts of a crowded core are dealt to, one after the other.
STEPS = (16, 1)
CHUNK = 1 << 20
# Symbols of one transformed block, and of the contexts of one core that are transformed in one task.
BLOCK = 1 << 20
LIMIT = 3 << 20


def least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by prefix and suffix minima of blocks."""
    n = len(values)
    full = np.full(-(-n // width) * width + width, np.iinfo(values.dtype).max, values.dtype)
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Runs:
    """The runs of window starts of all texts of a chunk, as positions in its bytes."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray, length: int):
        self.values, self.offsets, self.length = values, offsets, length
        self.hasher = Hasher(values)
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.core = self.row = empty
        sizes = np.diff(offsets)
        if not (sizes >= length).any():
            return
        grams = self.hasher.grams(GRAM) & np.uint64(0xFFFFFFFF00000000)
        grams |= np.arange(len(grams), dtype=np.uint64)
        anchor = (least_ahead(grams, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rows = np.flatnonzero(sizes >= length)
        count = sizes[rows] - length + 1
        row = np.repeat(rows, count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + offsets[row]
        anchor = anchor[start]
        step = (anchor - start) // STEP
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (step[1:] != step[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        self.first, self.last = start[at], start[np.append(at[1:], len(start)) - 1]
        self.core, self.row = anchor[at] - STEP * step[at], row[at]

    def cores(self) -> np.ndarray:
        return self.hasher.ranges(self.core, self.core + self.length - STEP + 1)


def _cut(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a binary array."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = values[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _cores(length: int):
    """Rows (core, key, at) of all runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK):
            runs = Runs(*as_bytes(part.column("text")), length)
            at = (runs.first - runs.offsets[runs.row]).astype(np.int64)
            key = part.column("key").take(pa.array(runs.row))
            yield pa.RecordBatch.from_arrays([_long(runs.cores()), key, pa.array(at)], ["core", "key", "at"])

    return run


def _contexts(length: int, whole: bool):
    """Contexts of the flagged runs. ``whole``: with their bytes; else only where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK):
            runs = Runs(*as_bytes(part.column("text")), length)
            flags = part.column("flags")
            row = np.repeat(np.arange(part.num_rows), np.diff(flags.offsets.to_numpy()))
            marked = np.sort((row << 33) + flags.flatten().to_numpy())
            mine = (runs.row << 33) + runs.first - runs.offsets[runs.row]
            found = np.minimum(np.searchsorted(marked, mine), max(len(marked) - 1, 0))
            hit = marked[found] == mine if len(marked) else np.zeros(len(mine), bool)
            first, last, begin, row = (x[hit] for x in (runs.first, runs.last, runs.core, runs.row))
            end, stop = begin + length - STEP + 1, last + length
            second = Hasher(runs.values, 0xD1342543DE82EF95, 2)
            ids = []
            for n, h in enumerate((runs.hasher, second)):
                middle = h.ranges(begin, end)
                sides = mix(h.ranges(first, begin) + np.uint64(n)) ^ mix(h.ranges(end, stop) + np.uint64(7 + n))
                ids += [middle, mix(middle * np.uint64(3) + sides)]
            columns = [_long(ids[k]) for k in (0, 2, 1, 3)]
            columns += [part.column("least").take(pa.array(row)), pa.array(first - runs.offsets[row])]
            if whole:
                columns += [_cut(runs.values, first, begin), _cut(runs.values, end, stop)]
            else:
                columns += [part.column("key").take(pa.array(row))]
            yield pa.RecordBatch.from_arrays(columns, [*CONTEXT, *(["left", "right"] if whole else ["key"])])

    return run


CONTEXT = ["core1", "core2", "c1", "c2", "least", "at"]
_CONTEXT_SCHEMA = "core1 long, core2 long, c1 long, c2 long, least long, at long"


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array to ``depth`` symbols: prefix doubling, from four symbols on."""
    n = len(symbols)
    bits = np.uint64(max(int(symbols.max()).bit_length(), 1))
    fits = 4 if 4 * int(bits) <= 64 else 2
    key = np.zeros(n, np.uint64)
    for k in range(fits):
        key <<= bits
        key[: max(n - k, 0)] |= symbols[k:].astype(np.uint64)
    have = fits
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])]).astype(np.uint64)
        if have >= depth:
            return order
        key = rank * np.uint64(n + 1)
        key[: max(n - have, 0)] += rank[have:] + np.uint64(1)
        have *= 2


def shared_prefixes(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix shares ``depth`` symbols with the one before it in ``order``.

    Breadth-first backward extension. An interval holds the suffixes that begin with some
    string w; extending it by a symbol c gives the suffixes that begin with cw. If nothing is
    known yet of the place after an extended interval, the prefix shared there is as long as w,
    and the interval is extended in its turn. Lengths come in increasing order, so the search
    stops at ``depth`` and what is still unknown shares at least that much.
    """
    n = len(symbols)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    back = place[order - 1]  # row of the suffix that starts one symbol earlier
    lead = symbols[order]
    unknown = np.ones(n + 1, bool)
    unknown[0] = unknown[n] = False
    low, high = np.array([0]), np.array([n])
    for _ in range(depth):
        width = high - low
        at = np.cumsum(width) - width
        owner = np.repeat(np.arange(len(low)), width)
        rows = back[np.arange(width.sum()) + np.repeat(low - at, width)]
        turn = np.argsort(rows)
        rows, owner = rows[turn], owner[turn]
        new = np.ones(len(rows), bool)
        new[1:] = (np.diff(rows) != 1) | (owner[1:] != owner[:-1]) | (lead[rows[1:]] != lead[rows[:-1]])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(rows)) - 1
        low, high = rows[start], rows[stop] + 1
        told = unknown[high] if len(high) else np.zeros(0, bool)
        low, high = low[told], high[told]
        unknown[high] = False
        if not len(low):
            break
    unknown[n] = False
    return unknown[:n]


def _search(lengths: np.ndarray, symbols: np.ndarray, depth: int, weight, least, at):
    """Per window of ``depth`` symbols of all strings: repeated; here is its first place."""
    order = sorted_suffixes(symbols, depth)
    shared = shared_prefixes(symbols, order, depth)
    ends = np.cumsum(lengths)
    string = np.repeat(np.arange(len(lengths)), lengths)
    offset = np.arange(len(symbols)) - (ends - lengths)[string]
    window = offset <= (lengths - 1)[string] - depth  # the last symbol parts the strings
    order, group = order[window[order]], np.cumsum(~shared)[window[order]]
    group = np.unique(group, return_inverse=True)[1]
    total = np.bincount(group, weight[string[order]])
    whose, where = least[string[order]], at[string[order]] + offset[order]
    turn = np.lexsort((where, whose, group))
    head = np.ones(len(turn), bool)
    head[1:] = group[turn][1:] != group[turn][:-1]
    repeated, first = np.zeros(len(symbols), bool), np.zeros(len(symbols), bool)
    repeated[order] = total[group] >= 2
    first[order[turn[head]]] = True
    return repeated, first


def _transform(rows: list[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Marks of one block: per context with repeats, a bit for each window of it."""
    block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    name = lambda c: block.column(c).to_numpy(zero_copy_only=False)
    new = np.ones(block.num_rows, bool)
    new[1:] = (np.diff(name("core1")) != 0) | (np.diff(name("core2")) != 0)
    core = np.cumsum(new) - 1
    weight, least, at = name("n"), name("least"), name("at")
    (left, begins), (right, ends) = as_bytes(block.column("left")), as_bytes(block.column("right"))
    a, b = np.diff(begins), np.diff(ends)
    # A core with one context needs no sorting: its windows are as often there as the context.
    lone = np.bincount(core)[core] == 1
    pick = np.flatnonzero(lone & (weight >= 2))
    ones = [np.packbits(np.ones(n, np.uint8)).tobytes() for n in (a + b + 2 - step)[pick]]
    made = [(pick, [ones, ones])]
    pick = np.flatnonzero(~lone)
    if len(pick):
        lengths = a[pick] + b[pick] + 2
        close = np.cumsum(lengths)
        symbols = np.zeros(close[-1], np.int64)
        middle = close - lengths + a[pick]
        symbols[close - 1] = np.arange(len(pick)) + 257 + core[-1] + 1
        symbols[middle] = core[pick] + 257
        for values, places, sizes, to in ((left, begins, a, middle - a[pick]), (right, ends, b, middle + 1)):
            size = sizes[pick]
            beside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            symbols[np.repeat(to, size) + beside] = values[np.repeat(places[:-1][pick], size) + beside].astype(np.int64) + 1
        _, dense = np.unique(symbols, return_inverse=True)
        repeated, first = _search(lengths, dense, step, weight[pick], least[pick], at[pick])
        some = np.add.reduceat(repeated, close - lengths) > 0
        windows = (lengths - 1 - step)[some]
        spans = list(zip((close - lengths)[some], (close - lengths)[some] + windows + 1, strict=True))
        made.append((pick[some], [[np.packbits(bits[s:e]).tobytes() for s, e in spans] for bits in (repeated, first)]))
    for pick, marks in made:
        where = pa.array(pick)
        yield pa.RecordBatch.from_arrays(
            [*(block.column(c).take(where) for c in ("c1", "c2", "least", "at")), *(pa.array(m, pa.binary()) for m in marks)],
            ["c1", "c2", "least", "at", "repeated", "first"],
        )


def _blocks(step: int):
    """Blocks of whole cores, from rows in the order of cores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy() for c in ("core1", "core2")], axis=1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1), batch.num_rows]
            if size >= BLOCK and last != tuple(ids[0]):
                yield from _transform(kept, step)
                kept, size = [], 0
            bytes_ = batch.get_total_buffer_size()
            if size + bytes_ > BLOCK and len(cuts) > 2:  # end the block with the core that runs into this batch
                kept.append(batch.slice(0, cuts[-2]))
                yield from _transform(kept, step)
                kept, size = [batch.slice(cuts[-2])], 0
            else:
                kept.append(batch)
                size += bytes_
            last = tuple(ids[-1])
        if kept:
            yield from _transform(kept, step)

    return run


def _extended(step: int, shorter: int):
    """Contexts of runs of ``step`` windows as contexts of their parts of ``shorter`` windows.

    A window that starts d bytes before the core belongs to part d // shorter. All windows of part p
    hold the core, the shorter * p bytes before it and the step - shorter * (p + 1) bytes behind it:
    these make the part's core, what is left of the sides makes its context.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                left, right = row["left"], row["right"]
                far, near = len(left), step - 1 - len(right)
                core = struct.pack("<qqi", row["core1"], row["core2"], step)
                for part in range(near // shorter, far // shorter + 1):
                    begin, behind = shorter * part, step - shorter * (part + 1)
                    high, low = min(far, begin + shorter - 1), max(near, begin)
                    middle = blake2b(core + bytes([part]) + left[far - begin :] + right[:behind], digest_size=16).digest()
                    sides = left[far - high : far - begin], right[behind : step - 1 - low]
                    own = blake2b(middle + bytes([len(sides[0])]) + sides[0] + b"|" + sides[1], digest_size=16).digest()
                    ids = (*struct.unpack("<qq", middle), *struct.unpack("<qq", own))
                    at = row["at"] + far - high
                    out.append((row["c1"], row["c2"], far - high, high - low + 1, row["n"], *ids, row["least"], at, *sides))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(_PART.names, zip(*out, strict=True), strict=True)), schema=_PART)

    return run


_LONGS = ("o1", "o2", "offset", "windows", "n", "core1", "core2", "c1", "c2", "least", "at")
_PART = pa.schema([*((c, pa.int64()) for c in _LONGS), ("left", pa.binary()), ("right", pa.binary())])
_PART_SCHEMA = ", ".join([*(f"{c} long" for c in _LONGS), "left binary, right binary"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The marks of a context from those of its parts."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            bits = np.zeros((2, row["windows"]), np.uint8)
            for mark in row["marks"]:
                span = slice(mark["offset"], mark["offset"] + mark["windows"])
                for k, name in enumerate(("repeated", "first")):
                    if name == "repeated" or mark["here"]:
                        bits[k, span] = np.unpackbits(np.frombuffer(mark[name], np.uint8))[: mark["windows"]]
            out.append((row["c1"], row["c2"], row["least"], row["at"], *(np.packbits(b).tobytes() for b in bits)))
        names = ["c1", "c2", "least", "at", "repeated", "first"]
        kinds = [pa.int64()] * 4 + [pa.binary()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


_MARKS = "c1 long, c2 long, least long, at long, repeated binary, first binary"


def _merged(contexts: DataFrame) -> DataFrame:
    """Equal contexts as one with their weight and their first place."""
    merged = contexts.groupBy("core1", "core2", "c1", "c2").agg(
        F.sum("n").alias("n"),
        F.min(F.struct("least", "at")).alias("head"),
        *(F.any_value(c).alias(c) for c in ("left", "right")),
    )
    return merged.select("core1", "core2", "c1", "c2", "n", "head.least", "head.at", "left", "right")


def _marks(merged: DataFrame, step: int, limit: int) -> DataFrame:
    """Per context with repeats (c1, c2): its first place, and a bit for each of its windows."""
    core = ["core1", "core2"]
    size = F.sum(F.octet_length("left") + F.octet_length("right") + 2)
    crowded = store(merged.groupBy(*core).agg(size.alias("size")).where(F.col("size") > limit).select(*core), "crowded")
    if step == 1 or crowded.isEmpty():
        dealt = merged.repartition(*core).sortWithinPartitions(*core)
        return store(dealt.mapInArrow(_blocks(step), _MARKS), "marks")
    calm = _marks(merged.join(crowded, core, "left_anti"), step, limit)
    shorter = next(s for s in STEPS if s < step)
    parts = store(merged.join(crowded, core).mapInArrow(_extended(step, shorter), _PART_SCHEMA), "parts")
    found = _marks(store(_merged(parts), "merged"), shorter, limit).alias("m")
    here = (F.col("p.least") == F.col("m.least")) & (F.col("p.at") == F.col("m.at"))
    marks = F.collect_list(F.struct("p.offset", "p.windows", "m.repeated", "m.first", here.alias("here"))).alias("marks")
    # A context begins where its first part does, and ends with its last.
    places = parts.groupBy("o1", "o2").agg(
        F.any_value("least").alias("least"),
        F.min(F.col("at") - F.col("offset")).alias("at"),
        F.max(F.col("offset") + F.col("windows")).alias("windows"),
    )
    met = parts.alias("p").join(found, ["c1", "c2"]).groupBy("p.o1", "p.o2").agg(marks)
    met = met.join(places, ["o1", "o2"]).select(F.col("o1").alias("c1"), F.col("o2").alias("c2"), "least", "at", "windows", "marks")
    return store(calm.unionByName(met.mapInArrow(_gathered, _MARKS)), "marks")


def _removed(length: int, keep_first: bool, text: bool):
    """Coverage of every text by its repeated windows, and the bytes that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK):
            out = []
            for row in part.select(["key", "text", "marks"]).to_pylist():
                data = np.frombuffer(row["text"].encode(), np.uint8)
                change = np.zeros(len(data) + 1, np.int64)
                for mark in row["marks"]:
                    gone = np.unpackbits(np.frombuffer(mark["repeated"], np.uint8)).astype(bool)
                    if keep_first and mark["here"]:
                        gone &= ~np.unpackbits(np.frombuffer(mark["first"], np.uint8)).astype(bool)
                    starts = np.flatnonzero(gone) + mark["at"]
                    change[starts] += 1
                    change[starts + length] -= 1
                gone = np.cumsum(change[:-1]) > 0
                rest = data[~gone].tobytes()
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
                out.append((row["key"], int(gone.sum()), spans, rest.decode(errors="ignore") if text else sha256(rest).hexdigest()))
            columns = list(zip(*out, strict=True))
            types = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "n_removed", "n_spans", "kept"]
            )

    return run


def repeated_bytes(
    docs: DataFrame, length: int = 400, *, keep_first: bool = False, text: bool = False, limit: int = LIMIT
) -> DataFrame:
    """Per distinct text that loses bytes: key, n_removed, n_spans and ``kept``: SHA-256 or the text.

    Text is cut at whole characters: a character of which a byte goes is dropped.
    """
    if length < STEP + 2 * GRAM:
        raise ValueError(f"length must be at least {STEP + 2 * GRAM}")
    small_batches(docs.sparkSession)
    rows = docs.select(text_key().alias("key"), text_of().alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.where(F.octet_length("text") >= length)
    cores = store(rows.select("key", "text").mapInArrow(_cores(length), "core long, key binary, at long"), "cores")
    place = F.xxhash64("key", "at")
    twice = cores.groupBy("core").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    # Written first, so that the join meets two plain shuffles and a core with many places can be split.
    twice = store(twice.where("a != b").select("core"), "twice")
    flags = cores.join(twice, "core").groupBy("key").agg(F.collect_set("at").alias("flags"))
    # One text per key: rows with one key are equal, so any of them will do.
    texts = rows.groupBy("key").agg(F.any_value("text").alias("text"), F.min("doc_id").alias("least"))
    texts = store(texts.join(flags, "key").withColumn("least", F.coalesce("least", F.lit(-1))), "flagged")
    contexts = texts.mapInArrow(_contexts(length, True), f"{_CONTEXT_SCHEMA}, left binary, right binary")
    merged = store(_merged(contexts.withColumn("n", F.lit(1).cast("long"))), "contexts")
    marks = _marks(merged, STEP, limit)
    places = texts.mapInArrow(_contexts(length, False), f"{_CONTEXT_SCHEMA}, key binary")
    here = (F.col("p.least") == F.col("m.least")) & (F.col("p.at") == F.col("m.at"))
    found = places.alias("p").join(marks.alias("m"), ["c1", "c2"])
    found = found.groupBy("key").agg(
        F.collect_list(F.struct("p.at", "m.repeated", "m.first", here.alias("here"))).alias("marks")
    )
    return (
        texts.select("key", "text")
        .join(found, "key")
        .mapInArrow(_removed(length, keep_first, text), "key binary, n_removed long, n_spans long, kept string")
    )


def cut_repeats(docs: DataFrame, length: int = 256, limit: int = LIMIT) -> DataFrame:
    """``docs`` without the bytes of repeated strings but for their first place by doc_id and byte.

    Of equal texts of at least ``length`` bytes the one with the smallest doc_id keeps its text
    (where rows share that doc_id too, they are one document written twice, and all keep it);
    the others become empty. n_chars follows the text. All rows stay.
    """
    key, least, kept = spare(docs, "_key", "_least", "_kept")
    found = repeated_bytes(docs, length, keep_first=True, text=True, limit=limit)
    rows = docs.withColumn(key, text_key())
    firsts = rows.where(F.octet_length("text") >= length).groupBy(key).agg(F.min("doc_id").alias(least))
    changed = found.select(F.col("key").alias(key), F.col("kept").alias(kept))
    rows = rows.join(store(firsts.join(changed, key, "left"), "changed"), key, "left")
    copy = F.col(least).isNotNull() & ~F.col("doc_id").eqNullSafe(F.col(least))
    rows = rows.withColumn("text", F.when(copy, F.lit("")).otherwise(F.coalesce(kept, "text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).cast("long"))
    return rows.select(*docs.columns)


def op2(spark, folder: str) -> DataFrame:
    """The registered query: strings of 400 bytes, removed from every place."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.select("doc_id", text_key().alias("key"), text_of().alias("text")).select(
        "doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole")
    )
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    found = copies.join(repeated_bytes(docs, 400), "key", "left")
    every = (F.col("copies") > 1) & (F.col("n_bytes") >= 400)
    nothing = F.lit(0).cast("long")
    return rows.join(found, "key").select(
        "doc_id",
        "n_bytes",
        F.when(every, F.col("n_bytes")).otherwise(F.coalesce("n_removed", nothing)).alias("n_removed"),
        F.when(every, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", nothing)).alias("n_spans"),
        F.when(every, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
    )
