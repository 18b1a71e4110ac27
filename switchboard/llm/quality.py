"""Quality of documents by co-training two views.

One view sees the text: shares of upper case, digits, marks, white space and repeated words, word
lengths, and ``TERMS`` hashed word counts. The other sees what is known about the page: source,
language, length, and pairs of them, hashed. Each is a logistic regression fitted in numpy. In
every round all unlabelled texts are scored by both views, as a Spark job over stored features; a view is
sure of a text to which it gives a chance of ``SURE`` or more for either label, and a uniform draw of those it
is sure of, by hashes and in the labels' own proportion, teaches the other view. (The very surest alone would be
a handful of extremes, all alike.) A part of the labelled texts is kept out of all rounds: on it each
view's output is calibrated (Platt), and the two calibrated outputs are combined. All rows are
then scored with the fixed-size model.

The driver sees at most ``PER_LABEL`` labelled texts of each label, those with the smallest hashes of
doc_id, and in the n-th round at most n times ``GIVEN`` told by each view, all as feature vectors.
Copies (equal in text, source, language and length) are told once.

Texts without words score 0. Without labels of both kinds all texts score 0.5, and none is
rejected. Ids labelled both ways count as unlabelled; of several rows of one labelled id the smallest is taken.
Rows without doc_id teach nothing. Null source, lang or doc_id count as values of their own; tables without those
columns have them null. Repeated rows are scored alike. Texts of any length are read whole, one at a time if long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.llm.frames import Hasher, as_bytes, chunks, lowered, small_batches, spare, table, word_spans
from switchboard.session import store

TERMS, SHAPES, PAGE = 512, 12, 256
PER_LABEL, GIVEN = 2000, 200
ROUNDS, SURE = 4, 0.9
# Tasks that first thin out the sure texts of a view and label.
SPREAD = 64
KEEP = 0.5
PAGE_COLUMNS = ("source", "lang", "n_chars")
_CLASS = np.zeros((256, 6), np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (65 <= _b < 91, 97 <= _b < 123, 48 <= _b < 58, _c in ".,;:'", _b < 128 and _c in "!?#$%&*|<>{}[]=_+~^/\\@\"-()", _b == 10)


def text_view(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the texts of a chunk, one row each, and their numbers of words."""
    starts, ends, row = word_spans(values, offsets)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    words = np.bincount(row, minlength=n)
    some = np.maximum(words, 1)
    shapes = np.zeros((n, SHAPES))
    for k in range(_CLASS.shape[1]):
        total = np.concatenate([[0], np.cumsum(_CLASS[values, k])])
        shapes[:, k] = (total[offsets[1:]] - total[offsets[:-1]]) / size
    hashes = Hasher(lowered(values)).ranges(starts, ends)
    order = np.lexsort((hashes, row))
    again = np.zeros(len(row), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    shapes[:, 6] = np.bincount(row[order], again, n) / some
    shapes[:, 7] = np.bincount(row, ends - starts, n) / some / 10
    marks = _CLASS[values[ends - 1], 4] if len(ends) else np.zeros(0)
    shapes[:, 8] = np.bincount(row, marks, n) / some
    shapes[:, 9] = np.bincount(row, ends - starts == 1, n) / some
    shapes[:, 10] = np.log1p(words) / 10
    shapes[:, 11] = np.bincount(row, ends - starts > 20, n) / some
    slot = row * TERMS + (hashes % np.uint64(TERMS)).astype(np.int64)
    terms = np.sqrt(np.bincount(slot, minlength=n * TERMS).reshape(n, TERMS) / some[:, None])
    return np.hstack([np.sqrt(shapes), terms]).astype(np.float32), words


def page_view(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Hashed slots of the page's columns, their pairs, and the bin of the length: six per row."""
    texts = [pc.fill_null(batch.column(c).cast(pa.string()), "\0").to_pylist() for c in names[:2]]
    sizes = np.nan_to_num(batch.column(names[2]).to_numpy(zero_copy_only=False).astype(float), nan=-1)
    bins = np.where(sizes < 0, 99, np.log2(np.maximum(sizes, 0) + 1) * 2).astype(int)
    rows = zip(*texts, bins.tolist(), strict=True)
    keys = [[f"s{s}", f"l{a}", f"n{n}", f"s{s}l{a}", f"l{a}n{n}", f"s{s}n{n}"] for s, a, n in rows]
    data, offsets = as_bytes(pa.array([k for row in keys for k in row], pa.string()))
    hashes = Hasher(data, salt=5).ranges(offsets[:-1], offsets[1:])
    return (hashes % np.uint64(PAGE)).astype(np.int64).reshape(-1, 6)


def _one_hot(slots: np.ndarray) -> np.ndarray:
    out = np.zeros((len(slots), PAGE), np.float32)
    out[np.arange(len(slots))[:, None], slots] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3, steps: int = 100) -> np.ndarray:
    """Weights (last: bias) of a logistic regression, by Adam on all rows."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w, mean, square = (np.zeros(x.shape[1]) for _ in range(3))
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        slope = weight * (1 / (1 + np.exp(-(x @ w))) - y)
        g = x.T @ slope + decay * np.append(w[:-1], 0)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        w -= 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


# What a view tells: features of both views, and labels.
Told = tuple[list[np.ndarray], np.ndarray]


def co_train(
    views: list[np.ndarray], y: np.ndarray, tell: Callable[[list[np.ndarray], int, list[int]], list[Told]] | None = None
) -> dict | None:
    """Fit both views with each other's sure labels; calibrate and combine them.

    ``tell(weights, turn, counts)`` returns, per view, texts that it is sure of, at most ``counts`` of each label.
    """
    if len(np.unique(y)) < 2:
        return None
    # Every fourth labelled text of each label calibrates; small sets calibrate on all.
    nth = np.zeros(len(y), np.int64)
    for label in (0, 1):
        nth[y == label] = np.arange((y == label).sum())
    check = nth % 4 == 3
    if min((y[check] == label).sum() for label in (0, 1)) < 5:
        fit = check = np.ones(len(y), bool)
    else:
        fit = ~check
    base = y[fit].mean()
    extra = [(x[:0], np.zeros(0)) for x in views]
    weights: list[np.ndarray] = []
    for turn in range(ROUNDS + 1):
        weights = []
        for x, (more, labels) in zip(views, extra, strict=True):
            known = np.where(y[fit] == 1, 0.5 / base, 0.5 / (1 - base))
            told = np.where(labels == 1, 0.5 / base, 0.5 / (1 - base)) * 0.5
            weights.append(logistic(np.vstack([x[fit], more]), np.append(y[fit], labels), np.append(known, told)))
        if turn == ROUNDS or tell is None:
            break
        most = GIVEN * (turn + 1)
        (of_text, by_text), (of_page, by_page) = tell(weights, turn, [int(most * (1 - base)), int(most * base)])
        extra = [(of_page[0], by_page), (of_text[1], by_text)]  # each view learns from the other's labels
    scales = []
    for x, w in zip(views, weights, strict=True):
        scales.append(logistic(_logit(x[check], w)[:, None] / 10, y[check], np.ones(check.sum()), 1e-4, 400))
    both = np.stack([_logit(_logit(x, w)[:, None] / 10, s) for x, w, s in zip(views, weights, scales, strict=True)], axis=1)
    joint = logistic(both[check] / 10, y[check], np.ones(check.sum()), 1e-4, 400)
    return {"weights": weights, "scales": scales, "joint": joint}


def score(model: dict | None, views: list[np.ndarray]) -> np.ndarray:
    """Columns: probability by the text, by the page, by both."""
    n = len(views[0])
    if model is None:
        return np.full((n, 3), 0.5)
    parts = zip(views, model["weights"], model["scales"], strict=True)
    both = np.stack([_logit(_logit(x, w)[:, None] / 10, s) for x, w, s in parts], axis=1)
    every = np.column_stack([both, _logit(both / 10, model["joint"])])
    return 1 / (1 + np.exp(-np.clip(every, -30, 30)))


def _with_page(docs: DataFrame, names: list[str]) -> DataFrame:
    kinds = ("string", "string", "double")
    values = zip(names, PAGE_COLUMNS, kinds, strict=True)
    return docs.withColumns({n: (F.col(c) if c in docs.columns else F.lit(None)).cast(k) for n, c, k in values})


_PAGE = [f"_{c}" for c in PAGE_COLUMNS]


def _features(docs: DataFrame, kept: str) -> DataFrame:
    """The columns ``kept`` (names and types) and the packed features of both views."""
    names = [c.split()[0] for c in kept.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            text, _ = text_view(*as_bytes(part.column("text")))
            page = page_view(part, _PAGE).astype(np.int16)
            packed = [pa.array([r.tobytes() for r in view], pa.binary()) for view in (text, page)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *packed], [*names, "text_f", "page_f"])

    return docs.mapInArrow(run, f"{kept}, text_f binary, page_f binary")


def _unpacked(found: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
    """Both views of rows of ``_features``."""
    packed = [np.frombuffer(b"".join(found.column(c).to_pylist()), t) for c, t in (("text_f", np.float32), ("page_f", np.int16))]
    return [packed[0].reshape(-1, SHAPES + TERMS), _one_hot(packed[1].reshape(-1, 6))]


class Unlabelled:
    """The features of all texts without a label, stored, one row for all copies."""

    def __init__(self, rows: DataFrame, known: DataFrame):
        rows = rows.where("doc_id is not null").withColumn("print", F.xxhash64("text", *_PAGE))
        free = rows.select("doc_id", "print").join(known.select("doc_id"), "doc_id", "left_anti")
        one = free.groupBy("print").agg(F.min("doc_id").alias("doc_id"))
        kept = f"doc_id {dict(rows.dtypes)['doc_id']}, print long"
        # Narrow rows decide; the features, not the texts, are moved.
        self.rows = store(_features(rows, kept).join(one, ["doc_id", "print"], "left_semi"), "unlabelled")

    def tell(self, weights: list[np.ndarray], turn: int, counts: list[int]) -> list[Told]:
        """A uniform draw of the texts that each view is sure of, at most ``counts`` of each label."""
        edge = float(np.log(SURE / (1 - SURE)))

        def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                for at in range(0, part.num_rows, 1024):
                    some = part.slice(at, 1024)
                    for view, (x, w) in enumerate(zip(_unpacked(some), weights, strict=True)):
                        logit = _logit(x, w)
                        on = np.flatnonzero(np.abs(logit) > edge)
                        columns = [some.column("print").take(pa.array(on)), np.full(len(on), view), (logit[on] > 0).astype(int)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["print", "view", "label"])

        found = self.rows.select("print", "text_f", "page_f").mapInArrow(sure, "print long, view long, label long")
        # Repeated rows of one document are told once.
        found = found.distinct().withColumn("place", F.xxhash64("print", F.lit(turn))).withColumn("part", F.pmod("print", F.lit(SPREAD)))
        most = F.when(F.col("label") == 1, counts[1]).otherwise(counts[0])
        for by in (["view", "label", "part"], ["view", "label"]):
            nth = F.row_number().over(Window.partitionBy(*by).orderBy("place", "print"))
            found = found.withColumn("nth", nth).where(F.col("nth") <= max(counts)).where(F.col("nth") <= most)
        # At most the sum of ``counts`` of each view.
        chosen = F.broadcast(found.select("print", "view", "label"))
        got = self.rows.select("print", "text_f", "page_f").join(chosen, "print").dropDuplicates(["print", "view"])
        got = got.toArrow().sort_by([("print", "ascending"), ("view", "ascending")])
        views, by = _unpacked(got), got.column("view").to_numpy()
        label = got.column("label").to_numpy().astype(float)
        return [([x[by == view] for x in views], label[by == view]) for view in (0, 1)]


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Draw the bounded sample of labelled texts and fit on the driver, with labels told by all other texts."""
    small_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label"))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    known = known.where("label = most").drop("most")
    used = [c for c in ("doc_id", "text", *PAGE_COLUMNS) if c in docs.columns]
    rows = _with_page(docs.select(*used), _PAGE).select("doc_id", "text", *_PAGE)
    # The sample is drawn by id first; texts are read for it alone.
    ids = docs.select("doc_id").distinct().join(known, "doc_id")
    place = F.xxhash64("doc_id")
    wanted = [ids.where(F.col("label") == k).orderBy(place, "doc_id").limit(PER_LABEL) for k in (0, 1)]
    # At most 2 * PER_LABEL ids.
    drawn = rows.join(F.broadcast(wanted[0].union(wanted[1])), "doc_id")
    drawn = drawn.groupBy("doc_id", "label").agg(F.min(F.struct("text", *_PAGE)).alias("row"))
    drawn = drawn.select(F.xxhash64("doc_id").alias("place"), "label", "row.*")
    got = _features(drawn, "place long, label int").toArrow().sort_by("place")
    label = got.column("label").to_numpy().astype(float)
    if len(np.unique(label)) < 2:
        return None
    return co_train(_unpacked(got), label, Unlabelled(rows, known).tell)


def with_scores(docs: DataFrame, model: dict | None, names: list[str]) -> DataFrame:
    """All columns of ``docs`` and, as ``names``, the probabilities by text, by page and by both."""
    small_batches(docs.sparkSession)
    told = docs.sparkSession.sparkContext.broadcast(model)  # a few kilobytes
    columns, page = docs.columns, spare(docs, *_PAGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            text, words = text_view(*as_bytes(part.column("text")))
            found = score(told.value, [text, _one_hot(page_view(part, page))])
            if told.value is not None:
                found[words == 0, 2] = 0
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), *map(pa.array, found.T.copy())], [*columns, *names]
            )

    fields = [*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)]
    return _with_page(docs, page).mapInArrow(run, T.StructType(fields))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score ``KEEP`` or more."""
    names = spare(docs, "_by_text", "_by_page", "_quality")
    scored = with_scores(docs, fit(docs, labels), names)
    return scored.where(F.col(names[2]) >= KEEP).drop(*names)


def op4(spark, folder: str) -> DataFrame:
    """The registered query: all documents."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    docs = docs.select("doc_id", "text", *PAGE_COLUMNS)
    scored = with_scores(docs, fit(docs, labels), ["text_score", "page_score", "score"])
    return scored.select("doc_id", "text_score", "page_score", "score", (F.col("score") >= KEEP).alias("keep"))
