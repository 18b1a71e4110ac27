"""Toxicity of whole texts: a bidirectional gated recurrent network with attention pooling.

Words (runs of letters and digits, A-Z lowered) come in as the sum of two learned vectors: one of
the hashed word, one of its hashed four-byte pieces, in which the piece at the word's start
counts as another. Two gated recurrent units read a window of ``WINDOW`` words forwards and
backwards, attention weighs their states, and one output gives the window's probability. All
overlapping windows of a text are scored (every ``STRIDE`` words, the last one up to the end), and the text's
score is the largest of them. A longer text has more windows that may score high by chance, so
the cut is then set halfway between a logit that all clean training texts but one in ``CLEAN`` stay below and
one that 19 in 20 of the toxic ones reach, and scores are shifted to have it at ``REJECT``.

Training has two parts. A start is made in plain numpy on the driver, on at most ``PER_LABEL`` labelled texts of
each label: those with the smallest hashes of doc_id. Of a text with more than ``MOST`` windows the tasks cut ``MOST``
out, evenly over its whole length, and only those reach the driver, so a very long text is no burden there.
They are read ``CHUNK`` bytes at a time, and a step runs through its windows ``AT_ONCE`` at a time, so only the
word numbers of all texts are held at once. From this start ``PASSES`` passes go over all labelled texts, whole and
with all their windows: a step is a Spark job whose tasks sum the gradient over one of ``SLICES`` slices, both labels
weighing the same, and the driver gets one gradient of the model's size. Which hashes are in ``SEEN_IN`` texts
or more, and so may learn, is counted over all of them, and so is the cut, from scores made in tasks.
A text is toxic if any of its windows is (noisy or), so its label needs no place. In the start, hashes seen in
fewer than ``SEEN_IN`` of its texts keep a zero vector. Scoring covers every row and needs the
model only, whose size is fixed.

Null and empty texts and texts without words score ``EMPTY``. Without labels of both kinds every
text scores 0. Repeated rows are scored alike. Null labels are no labels, and ids labelled both ways
are not drawn; of several texts of one id the smallest is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.llm.frames import MARKS, Hasher, as_bytes, chunks, lowered, small_batches, spare, table, word_spans
from switchboard.session import fresh_path

WINDOW, STRIDE = 64, 32
PER_LABEL, SEEN_IN = 600, 3
# Steps over all labelled texts: passes, steps of a pass, their rate, bytes of text at once.
PASSES, SLICES, PASS_RATE = 1, 8, 0.005
STEP_BYTES = 1 << 16
# One clean text in CLEAN may be above the lower end of the cut; places of a logit that are told apart.
CLEAN, BINS = 800, 256
# Windows of one text that train.
MOST = 256
SLOTS = 1 << 15
WIDTH, STATE, LOOK = 16, 8, 8
EPOCHS, RATE, DOCS_A_STEP = 6, 0.02, 32
EMPTY = 0.0
REJECT = 0.7
PIECE = 4
# Windows that run in step with each other.
TOGETHER = 2048
# Windows of a training step at once, and bytes of text on the driver.
AT_ONCE, CHUNK = 512, 1 << 18


def _within(count: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each n of ``count``."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _numbered(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of ``at``, all below ``size``, and an array that has their numbers at their places."""
    there = np.zeros(size, bool)
    there[at] = True
    return np.flatnonzero(there), np.cumsum(there) - 1


def _distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order; for numbers without many repeats quicker than ``np.unique``."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])[: len(x)]]


class Words:
    """The distinct words of some texts, their hashed pieces, and the texts as word numbers."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray):
        values = lowered(values)
        starts, ends, self.row = word_spans(values, offsets, MARKS)
        hasher = Hasher(values)
        hashes = hasher.ranges(starts, ends)
        order = np.argsort(hashes)  # any place of a word will do
        new = np.append(True, np.diff(hashes[order]) != 0)[: len(order)]
        first, self.word = order[new], np.empty(len(order), np.int64)
        self.word[order] = np.cumsum(new) - 1
        self.hashes = hashes[first]
        self.slot = (self.hashes % np.uint64(SLOTS)).astype(np.int64)
        starts, ends = starts[first], ends[first]
        count = np.maximum(ends - starts - PIECE + 1, 1)
        self.cuts = np.cumsum(count) - count
        of = np.repeat(np.arange(len(count)), count)
        at = np.arange(count.sum()) - self.cuts[of]
        begin = starts[of] + at
        pieces = hasher.ranges(begin, np.minimum(begin + PIECE, ends[of])) + (at == 0).astype(np.uint64)
        self.pieces = (pieces % np.uint64(SLOTS)).astype(np.int64)
        self.weight = (1 / np.sqrt(count)).astype(np.float32)
        self.count, self.counted = count, np.bincount(self.row, minlength=len(offsets) - 1)

    def vectors(self, model: dict[str, np.ndarray]) -> np.ndarray:
        """One input vector per distinct word."""
        if not len(self.slot):
            return np.zeros((0, WIDTH), np.float32)
        pieces = np.add.reduceat(model["pieces"][self.pieces], self.cuts, axis=0)
        return model["words"][self.slot] + pieces * self.weight[:, None]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all windows (-1 after the end), their lengths, and their texts."""
        base, length, owner = self.places(np.flatnonzero(self.counted))
        return self.read(base, length), length, owner

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of the windows of texts that have words, their lengths, and their texts."""
        size = self.counted[rows]
        made = np.maximum(-(-(size - WINDOW) // STRIDE), 0) + 1
        of = np.repeat(np.arange(len(rows)), made)
        number = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
        start = np.minimum(number * STRIDE, np.maximum(size[of] - WINDOW, 0))
        return np.searchsorted(self.row, rows)[of] + start, np.minimum(size[of], WINDOW), rows[of]

    def read(self, base: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Word numbers of windows (-1 after the end)."""
        at = base[:, None] + np.arange(WINDOW)
        inside = np.arange(WINDOW) < length[:, None]
        return np.where(inside, self.word[np.minimum(at, max(len(self.word) - 1, 0))] if len(self.word) else -1, -1)

    def per_text(self, owner: np.ndarray, texts: int) -> np.ndarray:
        """Numbers of words of texts that came in pieces; ``owner`` says whose piece each is."""
        return np.bincount(owner, self.counted, texts).astype(np.int64)

    @classmethod
    def joined(cls, texts: list[str]) -> Words:
        """The words of all texts or pieces, read ``CHUNK`` bytes at a time."""
        parts, done, known = [], 0, {}
        fields: dict[str, list] = {k: [] for k in ("slot", "count", "weight", "pieces")}
        for part in chunks(iter([pa.record_batch([pa.array(texts, pa.string())], ["text"])]), "text", CHUNK):
            own = cls(*as_bytes(part.column("text")))
            number = np.empty(len(own.hashes), np.int32)
            for k, h in enumerate(own.hashes.tolist()):
                number[k] = known.setdefault(h, len(known))
            new = np.flatnonzero(number >= done)
            new = new[np.argsort(number[new])]
            at = np.repeat(own.cuts[new], own.count[new]) + _within(own.count[new])
            for k, values in (("slot", own.slot[new]), ("count", own.count[new]), ("weight", own.weight[new]), ("pieces", own.pieces[at])):
                fields[k].append(values.astype(np.int32) if k == "pieces" else values)
            done = len(known)
            parts.append((number[own.word], own.counted))
        out = cls.__new__(cls)
        for k, values in fields.items():
            setattr(out, k, np.concatenate(values))
        out.word = np.concatenate([w for w, _ in parts])
        out.counted = np.concatenate([c for _, c in parts])
        out.row = np.repeat(np.arange(len(texts), dtype=np.int32), out.counted)
        out.cuts = np.cumsum(out.count) - out.count
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _unit(
    projected: np.ndarray, index: np.ndarray, live: np.ndarray, model: dict, side: str, states: np.ndarray, keep: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fills in the states of one gated recurrent unit over all steps (first axis); steps that are not live keep the state.

    ``projected``, the words' inputs, is used up. Windows lie along the last axis, so that each part of a state is one run of numbers. Returns the gates, the new values and
    their inner parts: with ``keep`` of all steps, else of the last.
    """
    recurrent, bias = np.array(model[f"u_{side}"].T, order="C"), model[f"n_{side}"][:, None]
    # Gates are 0.5 * tanh(0.5 * x) + 0.5; the inner half is taken here, which is exact.
    recurrent[: 2 * STATE] *= 0.5
    projected[:, : 2 * STATE] *= 0.5
    windows, kept = index.shape[1], len(index) if keep else 1
    gates = np.empty((kept, 2 * STATE, windows), projected.dtype)
    fresh, inner = (np.empty((kept, STATE, windows), projected.dtype) for _ in range(2))
    back = np.empty((3 * STATE, windows), projected.dtype)
    rows = np.empty((windows, 3 * STATE), projected.dtype)
    inputs = rows.T
    full = live.all(axis=1)
    h = np.zeros((STATE, windows), projected.dtype)
    for t in range(len(index)):
        at = t % kept
        np.take(projected, index[t], axis=0, out=rows, mode="clip")  # without a copy; no index is out of bounds
        np.matmul(recurrent, h, out=back)
        zr = np.add(inputs[: 2 * STATE], back[: 2 * STATE], out=gates[at])
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        np.add(back[2 * STATE :], bias, out=inner[at])
        n = np.multiply(zr[STATE:], inner[at], out=fresh[at])
        n += inputs[2 * STATE :]
        np.tanh(n, out=n)
        new = np.subtract(h, n, out=states[t])
        new *= zr[:STATE]
        new += n
        if not full[t]:
            np.copyto(new, h, where=~live[t])
        h = new
    return gates, fresh, inner


# The order in which a unit goes through the steps, and its part of a state.
SIDES = (("f", slice(None), slice(0, STATE)), ("b", slice(None, None, -1), slice(STATE, None)))


def _forward(model: dict, vectors: np.ndarray, words: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows of word numbers."""
    live = np.ascontiguousarray((words >= 0).T)
    index = np.ascontiguousarray(np.maximum(words, 0).T)
    both = np.empty((len(index), 2 * STATE, len(words)), vectors.dtype)
    for side, turn, part in SIDES:
        projected = vectors @ model[f"w_{side}"] + model[f"c_{side}"]
        steps = _unit(projected, index[turn], live[turn], model, side, both[turn, part], keep is not None)
        if keep is not None:
            keep[side] = steps
    look = np.ascontiguousarray(model["look"].T) @ both
    look += model["look_c"][:, None]
    look = np.ascontiguousarray(np.tanh(look, out=look).transpose(0, 2, 1))
    share = np.where(live, look @ model["ask"], np.float32(-1e9))
    share -= share.max(axis=0)
    np.exp(share, out=share)
    share /= share.sum(axis=0)
    pooled = np.ascontiguousarray(np.einsum("tn,thn->hn", share, both).T)
    if keep is not None:
        keep |= {"both": both, "look": look, "share": share, "pooled": pooled, "live": live, "index": index}
    return pooled @ model["out"] + model["out_c"]


def _per_word(index: np.ndarray, values: np.ndarray, words: int) -> np.ndarray:
    """Sums of ``values``, a row for each column of the result, over the places of each word."""
    out = np.empty((words, len(values)), np.float32)
    for k, row in enumerate(values):
        out[:, k] = np.bincount(index, row, words)
    return out


def _backward(model: dict, vectors: np.ndarray, keep: dict, slope: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters and of the word vectors; ``slope`` is that of the logits."""
    grad = {"out": keep["pooled"].T @ slope, "out_c": slope.sum(keepdims=True)}
    pooled = slope[:, None] * model["out"]
    states, look, share = keep["both"], keep["look"], keep["share"]
    both = np.ascontiguousarray(states.transpose(0, 2, 1))
    d_both = share[:, :, None] * pooled
    d_share = np.einsum("tnh,nh->tn", both, pooled)
    force = share * (d_share - (share * d_share).sum(axis=0))
    grad["ask"] = np.einsum("tn,tna->a", force, look)
    d_look = force[:, :, None] * model["ask"] * (1 - look * look)
    grad["look"] = np.einsum("tnh,tna->ha", both, d_look)
    grad["look_c"] = d_look.sum(axis=(0, 1))
    d_both += d_look @ model["look"].T
    d_vectors = np.zeros_like(vectors)
    full = keep["live"].all(axis=1)
    for side, turn, part in SIDES:
        outside, live, index = d_both[turn, :, part], keep["live"][turn], keep["index"][turn]
        own, whole = states[turn, part], full[turn]
        gates, n, inner = keep[side]
        z, r = gates[:, :STATE], gates[:, STATE:]
        before = np.concatenate([np.zeros_like(own[:1]), own[:-1]])
        before_n, rest_z, rest_n, rest_r = before - n, 1 - z, 1 - n * n, 1 - r
        before = np.ascontiguousarray(before.transpose(0, 2, 1))
        recurrent = model[f"u_{side}"]
        d_u, d_n = np.zeros_like(recurrent), np.zeros_like(model[f"n_{side}"])
        steps = np.empty((3 * STATE, *index.shape), np.float32)
        d_back = np.empty((3 * STATE, index.shape[1]), own.dtype)
        pre_z, pre_r, d_inner = d_back[:STATE], d_back[STATE : 2 * STATE], d_back[2 * STATE :]
        d_h = np.zeros_like(own[0])
        for t in range(len(index) - 1, -1, -1):
            total = d_h + outside[t].T
            d_new = total if whole[t] else np.where(live[t], total, 0)
            pre_n = d_new * rest_z[t]
            pre_n *= rest_n[t]
            np.multiply(d_new, before_n[t], out=pre_z)
            pre_z *= z[t]
            pre_z *= rest_z[t]
            np.multiply(pre_n, inner[t], out=pre_r)
            pre_r *= r[t]
            pre_r *= rest_r[t]
            np.multiply(pre_n, r[t], out=d_inner)
            by_window = np.ascontiguousarray(d_back.T)
            d_u += before[t].T @ by_window
            d_n += by_window[:, 2 * STATE :].sum(axis=0)
            steps[: 2 * STATE, t], steps[2 * STATE :, t] = d_back[: 2 * STATE], pre_n
            d_h = recurrent @ d_back
            d_h += d_new * z[t] if whole[t] else np.where(live[t], d_new * z[t], total)
        d_in = _per_word(index.ravel(), steps.reshape(3 * STATE, -1), len(vectors))
        grad |= {f"u_{side}": d_u, f"n_{side}": d_n, f"w_{side}": vectors.T @ d_in, f"c_{side}": d_in.sum(axis=0)}
        d_vectors += d_in @ model[f"w_{side}"].T
    return grad, d_vectors


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
    model = {"look": draw(2 * STATE, LOOK, by=0.3), "look_c": np.zeros(LOOK, np.float32), "ask": draw(LOOK, by=0.3)}
    model |= {"out": draw(2 * STATE, by=0.3), "out_c": np.full(1, -2, np.float32)}
    for side in "fb":
        model |= {f"w_{side}": draw(WIDTH, 3 * STATE, by=0.25), f"c_{side}": np.zeros(3 * STATE, np.float32)}
        model |= {f"u_{side}": draw(STATE, 3 * STATE, by=0.3), f"n_{side}": np.zeros(STATE, np.float32)}
    return model


def _tables(words: Words, counted: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Random vectors for hashes found in enough texts, zero for all others; ``counted`` words are of each text."""
    out = {}
    texts = {"words": np.zeros(SLOTS, np.int64), "pieces": np.zeros(SLOTS, np.int64)}
    ends = np.cumsum(counted)
    for begin, end in zip(ends - counted, ends):
        own = np.unique(words.word[begin:end])
        at = np.repeat(words.cuts[own], words.count[own]) + _within(words.count[own])
        texts["words"][np.unique(words.slot[own])] += 1
        texts["pieces"][np.unique(words.pieces[at])] += 1
    for name, counts in texts.items():
        seen = counts >= SEEN_IN
        out[name] = np.where(seen[:, None], rng.standard_normal((SLOTS, WIDTH)) * 0.1, 0).astype(np.float32)
        out[f"{name}_on"] = seen
    return out


def _inputs(words: Words, model: dict, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Vectors of the distinct words of windows, the windows in their numbers, those words, their pieces and weights."""
    used, number = _numbered(windows[windows >= 0], len(words.slot))
    index = np.append(number, -1)[windows]
    count = words.count[used]
    cut = np.cumsum(count) - count
    pieces = words.pieces[np.repeat(words.cuts[used], count) + _within(count)]
    weight = words.weight[used][:, None]
    vectors = model["words"][words.slot[used]] + np.add.reduceat(model["pieces"][pieces], cut, axis=0) * weight
    return vectors, index, used, pieces, weight


def _summed(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and the sums of their rows."""
    rows, number = _numbered(at, SLOTS)
    out = np.zeros(len(rows) * WIDTH, np.float32)
    # Numbers one by one: numpy is quick at these, not at rows.
    np.add.at(out, (number[at][:, None] * WIDTH + np.arange(WIDTH)).ravel(), values.astype(np.float32, copy=False).ravel())
    return rows, out.reshape(-1, WIDTH)


def _slopes(
    words: Words, model: dict, whose_piece: np.ndarray, some: np.ndarray, truth: np.ndarray, share: np.ndarray | float, at_once: int = 0
) -> tuple[dict, dict[str, list]]:
    """Gradients of the parameters, and rows of those of the tables, over the texts ``some``; ``share`` is their weight."""
    base, length, piece = words.places(np.flatnonzero(np.isin(whose_piece, some) & (words.counted > 0)))
    # Noisy or: a text is clean if all its windows are.
    whose = np.searchsorted(np.sort(some), whose_piece[piece])
    at_once = at_once or AT_ONCE
    parts = [slice(at, at + at_once) for at in range(0, len(base), at_once)]
    chance = np.empty(len(base))
    for part in parts:
        keep: dict = {}
        used = _inputs(words, model, words.read(base[part], length[part]))
        chance[part] = _sigmoid(_forward(model, used[0], used[1], keep if len(parts) == 1 else None).astype(np.float64))
    clean = np.exp(np.bincount(whose, np.log1p(-np.clip(chance, 0, 1 - 1e-7)), len(some)))
    toxic = np.clip(1 - clean, 1e-6, 1)
    ratio = np.where(truth[np.sort(some)] == 1, -clean / toxic, 1.0)
    slope = (chance * (ratio * share)[whose]).astype(np.float32)
    grad: dict = {}
    slots: dict[str, list] = {"words": [], "pieces": []}
    for part in parts:
        if len(parts) > 1:
            keep = {}
            used = _inputs(words, model, words.read(base[part], length[part]))
            _forward(model, used[0], used[1], keep)
        more, d_vectors = _backward(model, used[0], keep, slope[part])
        grad = {k: grad[k] + g if k in grad else g for k, g in more.items()}
        _, _, distinct, pieces, weight = used
        for name, at, d in (
            ("words", words.slot[distinct], d_vectors),
            ("pieces", pieces, np.repeat(d_vectors * weight, words.count[distinct], axis=0)),
        ):
            slots[name].append(_summed(at, d))
    return grad, slots


def _update(model: dict, moments: dict, grad: dict, rate: float, step: int) -> None:
    """One step of Adam; the gradients of tables are rows and their values."""
    size = np.sqrt(sum(float((g[1] if isinstance(g, tuple) else g).astype(np.float64).__pow__(2).sum()) for g in grad.values()))
    for k, g in grad.items():
        rows, g = g if isinstance(g, tuple) else (slice(None), g)
        g = g / max(size, 1.0)
        mean, square = moments[k]
        mean[rows] = 0.9 * mean[rows] + 0.1 * g
        square[rows] = 0.99 * square[rows] + 0.01 * g * g
        scale = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        model[k][rows] -= rate * scale * mean[rows] / (np.sqrt(square[rows]) + 1e-6)


def train(
    pieces: list[str], labels: list[int], owner: list[int] | None = None, seed: int = 7
) -> dict[str, np.ndarray] | None:
    """Fit the network; None unless both labels occur among texts with words.

    Every piece is a whole text, unless ``owner``, in ascending order, says to which text it belongs.
    """
    if not pieces:
        return None
    words = Words.joined(pieces)
    truth = np.array(labels, np.float32)
    whose_piece = np.arange(len(pieces)) if owner is None else np.array(owner)
    counted = words.per_text(whose_piece, len(truth))
    told = np.flatnonzero(counted)
    if len(set(truth[told])) < 2:
        return None
    rng = np.random.default_rng(seed)
    tables = _tables(words, counted, rng)
    on = {k: tables.pop(f"{k}_on") for k in ("words", "pieces")}
    model = _start(rng) | tables
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for some in np.array_split(rng.permutation(told), -(-len(told) // DOCS_A_STEP)):
            step += 1
            grad, slots = _slopes(words, model, whose_piece, some, truth, 1 / len(some))
            for name, found in slots.items():
                rows, total = _summed(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
                live = on[name][rows]
                grad[name] = (rows[live], total[live])
            _update(model, moments, grad, rate, step)
    return model


def calibrate(model: dict, clean: float, toxic: float) -> None:
    """Shift the logits so that ``REJECT`` lies halfway between a logit of clean and one of toxic texts."""
    model["out_c"] = model["out_c"].astype(np.float64) + np.log(REJECT / (1 - REJECT)) - (clean + toxic) / 2


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a task the slots of words and of pieces are."""
    total = {name: np.zeros(SLOTS, np.int64) for name in ("words", "pieces")}
    for part in chunks(batches, "text"):
        words = Words(*as_bytes(part.column("text")))
        row, word = np.divmod(_distinct(words.row.astype(np.int64) * len(words.slot) + words.word), max(len(words.slot), 1))
        at = np.repeat(words.cuts[word], words.count[word]) + _within(words.count[word])
        for name, texts, slot in (("words", row, words.slot[word]), ("pieces", np.repeat(row, words.count[word]), words.pieces[at])):
            total[name] += np.bincount(_distinct(texts * SLOTS + slot) % SLOTS, minlength=SLOTS)
    for name, found in total.items():
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(found[at])], ["name", "row", "n"])


def _live(told: DataFrame) -> dict[str, np.ndarray]:
    """The slots found in ``SEEN_IN`` texts or more, told by all texts."""
    found = told.select("text").mapInArrow(_seen, "name string, row long, n long")
    # At most ``SLOTS`` numbers of words and of pieces.
    got = found.groupBy("name", "row").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN_IN).collect()
    live = {name: np.zeros(SLOTS, bool) for name in ("words", "pieces")}
    for r in got:
        live[r.name][r.row] = True
    return live


def _gradient(told: DataFrame, model: dict, share: np.ndarray, live: dict[str, np.ndarray]) -> dict:
    """The gradient over all windows of all texts of ``told``, summed in tasks and by Spark; ``share`` is the weight of a label's texts."""
    sent = told.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(v.shape) for k, v in sent.value.items()}
        for part in chunks(batches, "text", STEP_BYTES):
            words, truth = Words(*as_bytes(part.column("text"))), part.column("toxic").to_numpy()
            some = np.flatnonzero(words.counted)
            if not len(some):
                continue
            grad, slots = _slopes(words, sent.value, np.arange(part.num_rows), some, truth, share[truth[some]], TOGETHER)
            for k, g in grad.items():
                total[k] += g
            for k, found in slots.items():
                for rows, g in found:
                    total[k][rows] += g
        for k, g in total.items():
            g = g.reshape(-1, g.shape[-1])
            rows = np.flatnonzero(g.any(axis=1))
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * g.shape[1])
            values = pa.ListArray.from_arrays(ends, pa.array(g[rows].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(rows), pa.string()), pa.array(rows), values], ["name", "row", "values"])

    parts = told.select("toxic", "text").mapInArrow(run, "name string, row long, values array<double>")
    sums = [F.sum(F.get("values", F.lit(n))).alias(f"v{n}") for n in range(3 * STATE)]
    # As many rows as the model has, whatever the corpus.
    got = parts.groupBy("name", "row").agg(*sums).toArrow().sort_by([("name", "ascending"), ("row", "ascending")])
    sent.unpersist()
    names, row = np.array(got.column("name").to_pylist()), got.column("row").to_numpy()
    wide = np.column_stack([got.column(f"v{n}").to_numpy() for n in range(3 * STATE)])
    grad = {}
    for k, v in model.items():
        own = names == k
        rows, values = row[own], wide[own, : v.shape[-1]]
        if k in live:
            on = live[k][rows]
            grad[k] = (rows[on], values[on])
        else:
            grad[k] = np.zeros(v.shape)
            grad[k].reshape(-1, v.shape[-1])[rows] = values
    return grad


def refine(model: dict[str, np.ndarray], told: DataFrame) -> None:
    """Steps over all texts of ``told``: each takes the texts of one slice, and each text has its part in one step of a pass."""
    live = _live(told)
    counted = dict(told.groupBy("toxic").count().collect())
    share = np.array([SLICES / 2 / counted[label] for label in (0, 1)])
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    for step in range(1, PASSES * SLICES + 1):
        grad = _gradient(told.where(F.col("slice") == step % SLICES), model, share, live)
        _update(model, moments, grad, PASS_RATE, step)


def ends(told: DataFrame, model: dict[str, np.ndarray]) -> tuple[float, float]:
    """A logit that all clean texts but one in ``CLEAN`` stay below, and one that 19 in 20 toxic texts reach, of all texts of ``told``."""
    score = F.least(F.greatest("score", F.lit(1e-9)), F.lit(1 - 1e-9))
    place = F.floor(F.log(score / (1 - score)) * BINS).alias("place")
    # Counts of at most 42 * BINS places for each label.
    got = with_score(told.select("toxic", "text"), model).groupBy("toxic", place).count().orderBy("place").collect()
    out = []
    for label, share in ((0, 1 - 1 / CLEAN), (1, 0.05)):
        places, counts = np.array([(r.place, r["count"]) for r in got if r.toxic == label]).T
        reached = np.cumsum(counts)
        out.append(float(places[np.searchsorted(reached, share * reached[-1])] + 0.5) / BINS)
    return out[0], out[1]


def score_texts(model: dict | None, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores of all texts of a chunk."""
    out = np.full(len(offsets) - 1, EMPTY)
    if model is None:
        return np.zeros(len(offsets) - 1)
    words = Words(values, offsets)
    windows, length, owner = words.windows()
    vectors = words.vectors(model)
    order = np.argsort(length, kind="stable")
    best = np.zeros(len(owner))
    for at in range(0, len(order), TOGETHER):
        some = order[at : at + TOGETHER]
        best[some] = _sigmoid(_forward(model, vectors, windows[some][:, : length[some[-1]]]).astype(np.float64))
    np.maximum.at(out, owner, best)
    return out


def drawn_windows(values: np.ndarray, offsets: np.ndarray) -> list[list[str]]:
    """Of every text of a chunk the whole text, or ``MOST`` of its windows, spread over its length."""
    starts, ends, row = word_spans(values, offsets, MARKS)
    counted = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(counted) - counted
    cut = lambda a, b: values[a:b].tobytes().decode("utf-8", "replace")
    out = []
    for k, size in enumerate(counted.tolist()):
        made = max(-(-(size - WINDOW) // STRIDE), 0) + 1
        if made <= MOST:
            out.append([cut(offsets[k], offsets[k + 1])])
            continue
        at = first[k] + np.minimum(np.arange(MOST) * (made - 1) // (MOST - 1) * STRIDE, size - WINDOW)
        out.append([cut(starts[w], ends[w + WINDOW - 1]) for w in at.tolist()])
    return out


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "text"):
        found = pa.array(drawn_windows(*as_bytes(part.column("text"))), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*part.select(["place", "kind"]).columns, found], ["place", "kind", "pieces"])


def fit(docs: DataFrame, labels: DataFrame, held_out: bool = True) -> dict[str, np.ndarray] | None:
    """Train on labelled texts; with ``held_out`` the rows with crc32(doc_id) % 3 = 1 stay unseen."""
    small_batches(docs.sparkSession)
    labels = labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    labels = labels.where("doc_id is not null and toxic in (0, 1)")
    if held_out:
        labels = labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    told = labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    told = told.where("toxic = most").drop("most")
    # One text of each id, in slices that a step can read alone.
    rows = docs.select("doc_id", "text").where(F.char_length("text") > 0).join(told, "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    path = fresh_path(docs.sparkSession, "told")
    rows.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int")).write.partitionBy("slice").parquet(path)
    told = docs.sparkSession.read.schema(f"doc_id {dict(rows.dtypes)['doc_id']}, toxic int, text string, slice int").parquet(path)

    def some(kind: str, label: int) -> DataFrame:
        place = F.xxhash64("doc_id", F.lit(kind))
        fitting = told.where(F.col("toxic") == label).select("doc_id", place.alias("place"))
        return fitting.orderBy("place", "doc_id").limit(PER_LABEL).withColumn("kind", F.lit(kind))

    # Ids are drawn first, on narrow rows: at most 2 * PER_LABEL, and as many texts.
    drawn = some("clean", 0).union(some("toxic", 1))
    found = told.join(F.broadcast(drawn), "doc_id").select("place", "kind", "text")
    windows = found.mapInArrow(_cut_out, "place long, kind string, pieces array<string>")
    # At most ``MOST`` windows, or as many words in one text.
    texts = sorted(windows.collect())
    owner = [k for k, text in enumerate(texts) for _ in text.pieces]
    model = train([p for text in texts for p in text.pieces], [int(text.kind == "toxic") for text in texts], owner)
    if model is not None:
        refine(model, told)
        calibrate(model, *ends(told, model))
    return model


def with_score(docs: DataFrame, model: dict | None, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``column``, the score of the column text."""
    small_batches(docs.sparkSession)
    told = docs.sparkSession.sparkContext.broadcast(model)  # about 4 MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            scores = score_texts(told.value, *as_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*part.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score less than ``REJECT``."""
    (name,) = spare(docs, "_toxicity")
    return with_score(docs, fit(docs, labels), name).where(F.col(name) < REJECT).drop(name)


def op10(spark, folder: str) -> DataFrame:
    """The registered query: every document's score."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )
