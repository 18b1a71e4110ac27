"""Inputs shared by the tests of the corpus operators."""

import random

import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, score string"


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def prose(seed, n):
    rng, out = random.Random(seed + 1), []
    for w in words(seed, n):
        out.append(w + rng.choice(["", "", "", "", ".", ",", ".\n"]))
    return " ".join(out)


@pytest.fixture(scope="session")
def texts():
    """Unlike texts, copies, near copies, shared passages, repeats within a text, and odd cases."""
    base, passage = prose(1, 300), prose(2, 120)
    near = base.split(" ")
    near[40] = "changed"
    far = base.split(" ")
    for k in range(0, 300, 12):
        far[k] = f"x{k}"
    out = [base, base, " ".join(near), " ".join(far), None, "", " \n\t ", "word", "Word", "two words", passage]
    out += [prose(10 + k, 80) + " " + passage + " " + prose(30 + k, 60) for k in range(6)]
    out += [passage + " - " + passage, "ab" * 700, "é" * 500 + "z", "日本語。" * 120, "x" * 399, "x" * 401]
    out += [prose(50 + k, 150) for k in range(8)] + [prose(70, 4000)]
    return out


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts under numbers with gaps, with columns whose names the operators use themselves."""
    rows = [(3 * i + 1, t, "en" if i % 3 else None, f"s{i % 4}", len(t) if t else 0, "k", "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Repeated rows, a repeated doc_id, and rows without one."""
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (5, "other words here"), (None, "a b c d e f g"), (None, None), (9, None), (2, "")]
    return spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in rows], SCHEMA)
