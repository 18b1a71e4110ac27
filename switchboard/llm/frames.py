"""Small helpers shared by the operators: session settings, tables, and text as byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one Arrow batch, and bytes of text worked on at once inside a task.
BATCH_ROWS = 1000
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts may be long: keep the Arrow batches that reach Python workers short."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``df`` has them already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """128-bit key of a text: equal texts share it."""
    return F.unhex(F.md5(text_of(column)))


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, done + limit, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def as_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the n + 1 offsets of the rows in it; null is empty."""
    kind = pa.large_binary() if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else pa.large_string()
    array = pc.fill_null(array.cast(kind), b"" if kind == pa.large_binary() else "")
    _, offsets, data = array.buffers()
    places = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[places[0] : places[-1]], places - places[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; a bijection, so different values stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


class Hasher:
    """Hashes of any byte ranges of one array, by one table of prefix sums."""

    def __init__(self, values: np.ndarray, base: int = _BASE, salt: int = 1):
        """``values`` holds bytes; ``salt`` picks the random values that stand for them."""
        letters = mix(np.arange(256, dtype=np.uint64) + np.uint64(salt * 256))
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(letters[values] * powers(base, len(values)), out=self.sums[1:])

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all ranges of ``size`` bytes, in order."""
        n = max(len(self.sums) - size, 0)
        return mix((self.sums[size:] - self.sums[:n]) * powers(self.inverse, n) + np.uint64(size))

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = powers(self.inverse, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def lowered(values: np.ndarray) -> np.ndarray:
    return _LOWER[values]


# White space and ASCII marks; letters of other alphabets are bytes from 128 on.
MARKS = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def word_spans(
    values: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _GAP
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without white space, or without ``gap``) and the row of each."""
    inside = np.zeros(len(values) + 2, np.int8)
    inside[1:-1] = ~gap[values]
    change = np.diff(inside)
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(values))])
    joined = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if len(joined):
        starts, ends = np.sort(np.append(starts, joined)), np.sort(np.append(ends, joined))
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1
