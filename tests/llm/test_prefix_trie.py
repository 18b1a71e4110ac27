"""Prefix tries against a plain version that lists every prefix."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from switchboard.llm import prefix_trie
from switchboard.llm.prefix_trie import ITEM, Parentheses, Trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string"


def plain_paths(rows):
    """Ordered turns of each conversation."""
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def plain_rebuilt(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = paths.get(base, [])[:h] + own[h:]
    return out


def plain_nodes(paths):
    members, stops = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
        stops[tuple(paths[c])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    saved, leaves = collections.Counter(), collections.Counter()
    for p, own in members.items():
        size = len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(own) - 1) * size
            leaves[p[:d]] += p not in kids
    out = []
    for p, own in members.items():
        ends = hashlib.sha256(",".join(map(str, stops[p])).encode()).hexdigest()
        out.append((own[0], len(p), members[p[:-1]][0] if p else None, len(own), kids[p], leaves[p], saved[p], ends))
    return sorted(out, key=repr)


def got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def conversations(seed, n, kinds=3, longest=6):
    """Few kinds of turns: many shared prefixes, copies, and conversations that end inside others."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        conv = c * 3 - n
        for k in range(rng.randint(1, longest)):
            rows.append((conv, k, rng.choice(["user", "bot"]), rng.choice(["", "a", "é" * 3, "long text"][:kinds])))
    return rows


@pytest.fixture(scope="module")
def rows():
    hot = [(c, k, "user", "same") for c in range(2000, 2090) for k in range(4)]
    inside = [(c, k, "user", "same") for c in range(2100, 2120) for k in range(6)]
    odd = [(7, None, None, None), (7, None, "user", None), (7, 3, None, "x"), (7, 3, "", "x"), (7, 3, "", "w"), (None, 0, "user", "x")]
    odd += [(-13, 0, "user", "same"), (5003, 2, "user", "only"), (5003, 2, "user", "only")]
    alone = [(9000, k, "bot", f"t{k}") for k in range(300)]
    return conversations(1, 120) + hot + inside + odd + alone + [(9005, k, "bot", f"t{k}") for k in range(200)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", "k") for r in rows], SCHEMA).repartition(5)


def test_paths_are_in_order_and_rebuilt(spark, frame, rows):
    want = plain_paths(rows)
    paths = {r.conv_id: bytes(r.path) for r in prefix_trie.paths_of(frame).collect()}

    def path(turns):
        return b"".join(
            hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest() + len(t.encode()).to_bytes(8, "big") for r, t in turns
        )

    assert paths == {c: path(t) for c, t in want.items()}
    again = {r.conv_id: bytes(r.path) for r in prefix_trie.rebuilt(prefix_trie.paths_of(frame)).collect()}
    assert again == {c: path(t) for c, t in plain_rebuilt(want).items()}
    assert any(not p for p in again.values())  # turnless ones are members of the root


@pytest.mark.parametrize("turns", [1, 9, 60, 1 << 18])
def test_nodes_equal_the_plain_version_with_shards_of_any_size(frame, rows, turns):
    """Small shards: most nodes lie on spines, and copies and their prefixes lie in many shards."""
    paths = prefix_trie.rebuilt(prefix_trie.paths_of(frame))
    assert got(prefix_trie.nodes(paths, turns)) == plain_nodes(plain_rebuilt(plain_paths(rows)))


@pytest.mark.parametrize("seed", range(4))
def test_random_conversations(spark, seed):
    rows = conversations(seed, 60, kinds=2, longest=4)
    df = spark.createDataFrame([(*r, "d", "k") for r in rows], SCHEMA)
    assert got(prefix_trie.nodes(prefix_trie.paths_of(df), 7 + seed)) == plain_nodes(plain_paths(rows))


def test_an_empty_table_has_no_root(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.nodes(prefix_trie.paths_of(empty)).count() == 0
    unnamed = spark.createDataFrame([(None, 1, "user", "x", "d", "k")], SCHEMA)
    assert prefix_trie.nodes(prefix_trie.paths_of(unnamed)).count() == 0


def test_only_turnless_conversations_have_a_root(spark):
    paths = spark.createDataFrame([(4, b""), (2, b"")], "conv_id long, path binary")
    digest = hashlib.sha256(b"2,4").hexdigest()
    assert got(prefix_trie.nodes(paths)) == [(2, 0, None, 2, 0, 1, 0, digest)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=900), st.integers(0, 10**6))
def test_findclose_equals_a_stack(climbs, seed):
    steps, depth, rng = [1], 1, random.Random(seed)
    for c in climbs:
        steps += [1] * c
        depth += c
        for _ in range(rng.randint(0, depth - 1)):
            steps.append(-1)
            depth -= 1
    steps = np.array(steps + [-1] * depth, np.int8)
    want, stack = {}, []
    for k, s in enumerate(steps.tolist()):
        if s > 0:
            stack.append(k)
        else:
            want[stack.pop()] = k
    opens = np.flatnonzero(steps > 0)
    assert Parentheses(steps).findclose(opens).tolist() == [want[k] for k in opens.tolist()]


def test_one_shard_by_itself():
    items = [bytes([k]) * 16 + (k + 1).to_bytes(8, "big") for k in range(4)]
    paths = sorted([items[0], items[0] + items[1], items[0] + items[1], items[0] + items[2], items[3]])
    trie = Trie(np.array([9, 5, 7, 1, 3]), paths)
    assert "".join("()"[s < 0] for s in trie.steps.tolist()) == "((()())())"
    assert trie.members.tolist() == [5, 4, 2, 1, 1] and trie.least.tolist() == [1, 1, 5, 1, 3]
    assert trie.leaves.tolist() == [3, 2, 1, 1, 1] and trie.parent.tolist() == [-1, 0, 1, 1, 0]
    assert len(items[0]) == ITEM and trie.bytes.tolist() == [0, 1, 2, 3, 4]
