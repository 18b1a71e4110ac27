"""Steps of the toxicity network: windows along the last axis, inputs gathered step by step, sums of single numbers."""

import tracemalloc

import numpy as np
import pyarrow as pa

from switchboard.llm import toxicity
from switchboard.llm.frames import as_bytes


def plain_logit(model, vectors, words):
    """Of one window, word by word."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    words, size = words[words >= 0], toxicity.STATE
    states = {}
    for side, order in (("f", range(len(words))), ("b", range(len(words) - 1, -1, -1))):
        h, states[side] = np.zeros(size), np.zeros((len(words), size))
        for t in order:
            x, back = vectors[words[t]] @ model[f"w_{side}"] + model[f"c_{side}"], h @ model[f"u_{side}"]
            z, r = np.split(sigmoid(x[: 2 * size] + back[: 2 * size]), 2)
            n = np.tanh(x[2 * size :] + r * (back[2 * size :] + model[f"n_{side}"]))
            states[side][t] = h = (1 - z) * n + z * h
    both = np.concatenate([states["f"], states["b"]], axis=1)
    force = np.tanh(both @ model["look"] + model["look_c"]) @ model["ask"]
    share = np.exp(force - force.max())
    return float(share / share.sum() @ both @ model["out"] + model["out_c"][0])


def made(windows):
    rng = np.random.default_rng(5)
    words = rng.integers(0, 40, (windows, toxicity.WINDOW))
    for k in range(0, windows, 3):
        words[k, 1 + k % toxicity.WINDOW :] = -1
    return toxicity._start(rng), rng.standard_normal((40, toxicity.WIDTH)).astype(np.float32), words


def test_logits_equal_a_plain_network():
    model, vectors, words = made(50)
    got = toxicity._forward(model, vectors, words)
    assert np.allclose(got, [plain_logit(model, vectors, w) for w in words], atol=1e-5)
    # A window alone and in a batch, with and without what a gradient needs.
    assert np.allclose(got[:7], toxicity._forward(model, vectors, words[:7], {}), atol=1e-6)


def test_inputs_of_all_steps_are_never_held_at_once():
    model, vectors, words = made(1024)
    tracemalloc.start()
    toxicity._forward(model, vectors, words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The states of both sides, what attention sees of them twice, and less than as much again; inputs alone are three times STATE.
    assert peak < 4 * words.size * (2 * toxicity.STATE + 2 * toxicity.LOOK + 2 * toxicity.STATE)


def test_sums_of_rows_are_in_order_and_quick_to_make():
    rng = np.random.default_rng(2)
    at, values = rng.integers(0, 50, 4000) * 7, rng.standard_normal((4000, toxicity.WIDTH)).astype(np.float32)
    rows, number = np.unique(at, return_inverse=True)
    want = np.zeros((len(rows), toxicity.WIDTH), np.float32)
    np.add.at(want, number, values)
    got = toxicity._summed(at, values)
    assert np.array_equal(got[0], rows) and np.array_equal(got[1], want)
    found, number = toxicity._numbered(at, toxicity.SLOTS)
    assert np.array_equal(found, rows) and np.array_equal(found[number[at]], at)
    for x in (at, at[:1], at[:0]):
        assert np.array_equal(toxicity._distinct(x), np.unique(x))


def test_texts_without_words_count_nothing():
    for texts in ([None, "", "..."], ["..."], ["a a", None, "a b"]):
        seen = list(toxicity._seen(iter([pa.record_batch([pa.array(texts, pa.string())], ["text"])])))
        words = toxicity.Words(*as_bytes(pa.array(texts, pa.string())))
        counts = sorted(n for b in seen for name, n in zip(b["name"].to_pylist(), b["n"].to_pylist(), strict=True) if name == "words")
        assert counts == ([1, 2] if len(words.hashes) else [])
