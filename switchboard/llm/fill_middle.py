"""Fill-in-the-middle over seekable compressed frames.

A text is kept as a list of independent zstandard frames of at most ``FRAME`` bytes, each with the
units and code points that lie before it. A unit is a run of letters A-Z, a-z or one other code
point. To cut a text after k units, only the frame in which unit k starts is decompressed and
searched; everything else is passed on frame by frame, so a text of any length is cut, put in its
new order, digested and put back with a few frames in memory. The frames are written to the shared
folder once: another seed or other rates cut the same frames again, and a lost executor reads them
again.

A null text is empty. An empty text, a text that holds a marker and a share of the others stay
plain. A row without doc_id is drawn by the empty number. Repeated rows come out repeated, an
empty table gives no rows, and columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.frames import as_bytes, chunks, small_batches, table
from switchboard.session import store

FRAME = 1 << 16
# The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_FRAMES = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("inside", pa.bool_()), ("data", pa.binary())])
FRAMED = "doc_id long, n long, chars long, marked boolean, frames array<struct<units: long, chars: long, inside: boolean, data: binary>>"


def unit_starts(values: np.ndarray, inside: bool = False) -> np.ndarray:
    """Whether a unit starts at each byte; ``inside``: the byte before is a letter."""
    letter = _LETTER[values]
    before = np.empty_like(letter)
    before[:1], before[1:] = inside, letter[:-1]
    return ((values & 0xC0) != 0x80) & ~(letter & before)


def _cuts(values: np.ndarray, start: int, end: int) -> list[int]:
    """Where frames of a text begin, and its end: at code points, ``FRAME`` bytes apart or a little less."""
    out = [start]
    while end - out[-1] > FRAME:
        at = out[-1] + FRAME
        while (values[at] & 0xC0) == 0x80:
            at -= 1
        out.append(at)
    return [*out, end] if end > start else out


def framed(docs: DataFrame) -> DataFrame:
    """Each row's text as frames, with its units (``n``), code points and whether it holds a marker."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for part in chunks(batches, "text"):
            values, offsets = as_bytes(part.column("text"))
            starts = unit_starts(values)
            # The first byte of a text starts a unit, whatever the text before ends with.
            starts[offsets[:-1][np.diff(offsets) > 0]] = True
            units = np.concatenate([[0], np.cumsum(starts)])
            chars = np.concatenate([[0], np.cumsum((values & 0xC0) != 0x80)])
            places, owner, marked = [], [0], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                places += [(a, x, y) for x, y in pairwise(_cuts(values, a, b))]
                owner.append(len(places))
                text = values[a:b].tobytes()
                marked.append(any(m in text for m in ORDERS["psm"]))
            first, low, high = np.array(places, np.int64).reshape(-1, 3).T
            frames = pa.StructArray.from_arrays(
                [
                    pa.array(units[low] - units[first]),
                    pa.array(chars[low] - chars[first]),
                    pa.array((low > first) & _LETTER[values[np.maximum(low, 1) - 1]] if len(low) else np.zeros(0, bool)),
                    pa.array([packer.compress(values[x:y].tobytes()) for _, x, y in places], pa.binary()),
                ],
                fields=list(_FRAMES),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(units[offsets[1:]] - units[offsets[:-1]]),
                    pa.array(chars[offsets[1:]] - chars[offsets[:-1]]),
                    pa.array(marked, pa.bool_()),
                    pa.ListArray.from_arrays(pa.array(owner, pa.int32()), frames),
                ],
                ["doc_id", "n", "chars", "marked", "frames"],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, FRAMED)


def decided(rows: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Add ``form`` and the units ``low`` and ``high`` after which prefix and middle end.

    All are drawn from the SHA-256 of seed and doc_id, so they don't depend on order or partitions.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    plain = (F.col("n") == 0) | F.col("marked") | (h[2] % 100 >= plain_from)
    cuts = [h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)]
    return rows.withColumns(
        {
            "form": F.when(plain, "plain").when(h[3] % 100 < spm_below, "spm").otherwise("psm"),
            "low": F.least(*cuts),
            "high": F.greatest(*cuts),
        }
    )


class Reader:
    """One text as frames; a frame is decompressed when it is asked for, the last one is kept."""

    def __init__(self, n: int, chars: int, frames: list[dict]):
        self.n, self.chars, self.frames = n, chars, frames
        self.units = [f["units"] for f in frames]
        self.unpacker = zstandard.ZstdDecompressor()
        self.kept: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.kept[0] != k:
            self.kept = (k, self.unpacker.decompress(self.frames[k]["data"]))
        return self.kept[1]

    def cut(self, units: int) -> tuple[int, int, int]:
        """Frame and byte in it after the first ``units`` units, and the code points before."""
        if units >= self.n:
            return len(self.frames), 0, self.chars
        k = bisect_right(self.units, units) - 1
        values = np.frombuffer(self.frame(k), np.uint8)
        at = int(np.flatnonzero(unit_starts(values, self.frames[k]["inside"]))[units - self.units[k]])
        return k, at, self.frames[k]["chars"] + int(((values[:at] & 0xC0) != 0x80).sum())

    def read(self, start: tuple[int, int], end: tuple[int, int]) -> Iterator[bytes]:
        """The bytes between two cuts, a frame at a time."""
        for k in range(start[0], min(end[0] + 1, len(self.frames))):
            data = self.frame(k)
            data = data[start[1] if k == start[0] else 0 : end[1] if k == end[0] else len(data)]
            if data:
                yield data


def output_of(reader: Reader, form: str, low: tuple[int, int], high: tuple[int, int]) -> Iterator[bytes]:
    """The text in its form, a frame at a time."""
    first, last = (0, 0), (len(reader.frames), 0)
    if form == "plain":
        yield from reader.read(first, last)
        return
    spans = {PREFIX: (first, low), MIDDLE: (low, high), SUFFIX: (high, last)}
    for marker in ORDERS[form]:
        yield marker
        yield from reader.read(*spans[marker])


class Stored:
    """A stream of bytes put into frames as it comes, whose ranges can be read again."""

    def __init__(self, stream: Iterator[bytes]):
        packer, self.unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        self.frames: list[bytes] = []
        self.ends: list[int] = [0]
        for data in stream:
            self.frames.append(packer.compress(data))
            self.ends.append(self.ends[-1] + len(data))

    def read(self, start: int, end: int) -> Iterator[bytes]:
        k = max(bisect_right(self.ends, start) - 1, 0)
        while k < len(self.frames) and self.ends[k] < end:
            data = self.unpacker.decompress(self.frames[k])
            yield data[max(start - self.ends[k], 0) : end - self.ends[k]]
            k += 1

    def find(self, marker: bytes, start: int) -> int:
        """First place of the marker from ``start`` on; it may lie across frames."""
        at, tail = start, b""
        for data in self.read(start, self.ends[-1]):
            found = (tail + data).find(marker)
            if found >= 0:
                return at - len(tail) + found
            at, tail = at + len(data), (tail + data)[-(len(marker) - 1) :]
        raise ValueError(f"no {marker!r} in the output")


def restored(output: Stored, form: str) -> Iterator[bytes]:
    """The text, from output and form alone."""
    if form == "plain":
        yield from output.read(0, output.ends[-1])
        return
    places, at = [], 0
    for marker in ORDERS[form]:
        at = output.find(marker, at)
        places.append(at)
        at += len(marker)
    spans = dict(zip(ORDERS[form], zip(places, [*places[1:], output.ends[-1]], strict=True), strict=True))
    for marker in (PREFIX, MIDDLE, SUFFIX):
        start, end = spans[marker]
        yield from output.read(start + len(marker), end)


def _hex(stream: Iterator[bytes]) -> str:
    digest = sha256()
    for data in stream:
        digest.update(data)
    return digest.hexdigest()


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[dict, Reader, tuple, tuple]]:
    """Each row with its reader and its two cuts, one row's frames at a time."""
    for k in range(batch.num_rows):
        row = batch.slice(k, 1).to_pylist()[0]
        reader = Reader(row["n"], row["chars"], row["frames"])
        plain = row["form"] == "plain"
        yield row, reader, (0, 0, 0) if plain else reader.cut(row["low"]), (0, 0, 0) if plain else reader.cut(row["high"])


def transformed(rows: DataFrame) -> DataFrame:
    """doc_id, form and the ``output`` text of decided frames."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, reader, low, high in _rows(batch):
                text = b"".join(output_of(reader, row["form"], low[:2], high[:2])).decode()
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([row["doc_id"]], pa.int64()), "form": [row["form"]], "output": [text]})

    return rows.select("doc_id", "n", "chars", "frames", "form", "low", "high").mapInArrow(run, "doc_id long, form string, output string")


def originals(outputs: DataFrame) -> DataFrame:
    """doc_id and ``text`` from the columns form and output."""
    small_batches(outputs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                b"".join(restored(Stored(iter([o.encode()])), f)).decode()
                for f, o in zip(batch.column("form").to_pylist(), batch.column("output").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return outputs.select("doc_id", "form", "output").mapInArrow(run, "doc_id long, text string")


DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def digests(rows: DataFrame) -> DataFrame:
    """Per row of decided frames: lengths in code points and the digests of output and restored text."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in DIGESTS.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for row, reader, low, high in _rows(batch):
                plain, sent = row["form"] == "plain", sha256()

                def stream(reader=reader, form=row["form"], low=low, high=high, sent=sent) -> Iterator[bytes]:
                    for data in output_of(reader, form, low[:2], high[:2]):
                        sent.update(data)
                        yield data

                back = _hex(restored(Stored(stream()), row["form"]))
                lengths = (None, None) if plain else (low[2], high[2] - low[2])
                out.append((row["doc_id"], row["n"], row["form"], *lengths, sent.hexdigest(), back))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.select("doc_id", "n", "chars", "frames", "form", "low", "high").mapInArrow(run, DIGESTS)


def op13(spark, folder: str) -> DataFrame:
    """The registered query: every document, cut, put in order, and put back."""
    frames = store(framed(table(spark, folder, "documents")), "frames")
    return digests(decided(frames))


ORACLE = """
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
    ), cut AS (
        SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, len(u) AS n,
               CAST('0x' || substr(x, 1, 8) AS BIGINT) % (n + 1) AS k1, CAST('0x' || substr(x, 9, 8) AS BIGINT) % (n + 1) AS k2,
               CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 AS r3, CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 AS r4
        FROM drawn
    ), formed AS (
        SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r3 >= 90 THEN 'plain'
                       WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form,
               array_to_string(u[1:least(k1, k2)], '') AS p, array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], '') AS m,
               array_to_string(u[greatest(k1, k2) + 1:], '') AS s
        FROM cut
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(CASE WHEN form = 'plain' THEN text ELSE p || m || s END) AS restored_sha256
    FROM formed"""
