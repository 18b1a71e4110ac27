"""Shared prefixes of conversations, on tries held as balanced parentheses.

A conversation is a path of turns; equal first turns are one path from the root. Conversations are
sorted by path over all tasks and cut into shards of neighbours. Each shard writes its trie as
balanced parentheses with the smallest and largest excess of every block and, above the blocks, of
every pair of blocks: ``findclose`` steps over blocks that can't hold the answer and so gives each
node's subtree. Counts of "()" pairs give leaves, and running sums in preorder give savings.

Only nodes on a shard's first and last path can lie in other shards too. These spines carry what
hangs below them and are merged by their prefix: counts are added, a prefix that several shards
hold weighs once, and sums from the deepest node up give what lies below. All other nodes are final
in their shard. No task holds more than a shard, however many conversations share a prefix.

Turns are ordered by ``turn`` (null first), ties by role, then text; a null role or text is empty.
Rows without conv_id belong to no conversation. Repeated rows are turns of their own. A very long
text moves once, to be put in order; from then on a turn is 24 bytes, and a conversation's turns
are one row. An empty table has no nodes, not even a root. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from switchboard.llm.frames import table
from switchboard.session import store

# Turns of one shard (a longer conversation is a shard by itself), and positions of one excess block.
SHARD_TURNS = 1 << 18
BLOCK = 64
# Bytes of a turn in a path: a 128-bit hash and the length of the text.
ITEM = 24
EMPTY = sha256(b"").hexdigest()
NODE, SPINE, ENDS = 0, 1, 2


class Parentheses:
    """A sequence of 1 (open) and -1 (close) with the range of the excess per block and pair of blocks."""

    def __init__(self, steps: np.ndarray):
        self.excess = np.cumsum(steps, dtype=np.int64)
        blocks = -(-len(steps) // BLOCK)
        size = 1 << max(blocks - 1, 0).bit_length()
        # Positions behind the end are as high as the last one: nothing is found there.
        padded = np.full(size * BLOCK, np.iinfo(np.int64).max)
        padded[: len(steps)] = self.excess
        self.padded = padded
        low = padded.reshape(size, BLOCK).min(axis=1)
        padded = np.where(padded == np.iinfo(np.int64).max, -1, padded)
        high = padded.reshape(size, BLOCK).max(axis=1)
        self.low, self.high = [low], [high]
        while len(self.low[-1]) > 1:
            self.low.append(self.low[-1].reshape(-1, 2).min(axis=1))
            self.high.append(self.high[-1].reshape(-1, 2).max(axis=1))
        self.opened = np.cumsum(steps > 0)
        pair = np.zeros(len(steps), np.int64)
        pair[:-1] = (steps[:-1] > 0) & (steps[1:] < 0)
        self.pairs = np.cumsum(pair)

    def _scan(self, at: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First position from ``at`` to the end of its block with the target excess, or -1."""
        found, left = np.full(len(at), -1), np.arange(len(at))
        at = at.copy()
        while len(left):
            hit = self.padded[at] == target[left]
            found[left[hit]] = at[hit]
            on = ~hit & ((at + 1) % BLOCK != 0)
            left, at = left[on], at[on] + 1
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The position that closes each open one: the first behind it whose excess is one less."""
        target = self.excess[opens] - 1
        out = np.full(len(opens), -1)
        here = (opens + 1) % BLOCK != 0
        out[here] = self._scan(opens[here] + 1, target[here])
        some = np.flatnonzero(out < 0)
        block, want = opens[some] // BLOCK, target[some]
        level = np.zeros(len(some), np.int64)
        climbing = np.arange(len(some))
        for k in range(len(self.low)):
            if not len(climbing):
                break
            # The right neighbour, where it belongs to the same pair, holds the answer or is passed over.
            beside = block[climbing] + 1
            left = block[climbing] % 2 == 0
            beside = np.minimum(beside, len(self.low[k]) - 1)
            held = left & (self.low[k][beside] <= want[climbing]) & (want[climbing] <= self.high[k][beside])
            block[climbing[held]] = beside[held]
            level[climbing[held]] = k
            climbing = climbing[~held]
            block[climbing] //= 2
        for k in range(len(self.low) - 1, 0, -1):
            down = np.flatnonzero(level == k)
            first = block[down] * 2
            inside = (self.low[k - 1][first] <= want[down]) & (want[down] <= self.high[k - 1][first])
            block[down] = np.where(inside, first, first + 1)
            level[down] = k - 1
        out[some] = self._scan(block * BLOCK, want)
        return out


class Trie:
    """The nodes of sorted paths in preorder; node 0 is the root."""

    def __init__(self, convs: np.ndarray, paths: list[bytes]):
        self.convs = convs
        self.lengths = lengths = np.array([len(p) // ITEM for p in paths], np.int64)
        items = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 3)
        starts = np.cumsum(lengths) - lengths
        # Turns that a conversation shares with the one before it.
        common = np.zeros(len(paths), np.int64)
        equal = np.arange(1, len(paths))
        while len(equal):
            k = common[equal]
            on = (lengths[equal] > k) & (lengths[equal - 1] > k)
            equal, k = equal[on], k[on]
            equal = equal[(items[starts[equal] + k] == items[starts[equal - 1] + k]).all(axis=1)]
            common[equal] += 1
        opens = lengths - common
        closes = np.append(0, lengths[:-1]) - common
        opens[0] += 1
        runs = np.append(np.stack([closes, opens], 1).ravel(), lengths[-1] + 1)
        self.steps = np.repeat(np.resize(np.array([-1, 1], np.int8), len(runs)), runs)
        tree = Parentheses(self.steps)
        at = np.flatnonzero(self.steps > 0)
        closed = tree.findclose(at)
        self.size = n = len(at)
        self.depth = tree.excess[at] - 1
        self.end = tree.opened[closed]  # the first node behind the subtree
        self.leaves = tree.pairs[closed] - np.where(at > 0, tree.pairs[at - 1], 0)
        first = np.repeat(np.arange(len(paths)), opens)
        self.bytes = np.zeros(n, np.int64)
        self.bytes[1:] = items[starts[first[1:]] + self.depth[1:] - 1, 2].astype(np.int64)
        # Where conversations end; those below a node are neighbours.
        self.stop = np.cumsum(opens) - 1
        last = np.searchsorted(self.stop, self.end)
        self.members = last - first
        behind = np.append(convs, np.iinfo(np.int64).max)
        self.least = np.minimum.reduceat(behind, np.stack([first, last], 1).ravel())[::2]
        by_depth = np.lexsort((np.arange(n), self.depth))
        keys = self.depth[by_depth] * n + by_depth
        above = (self.depth[1:] - 1) * n + np.arange(1, n)
        self.parent = np.append(-1, by_depth[np.searchsorted(keys, above, side="right") - 1])

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sums of ``values`` over each node's subtree."""
        sums = np.append(0, np.cumsum(values))
        return sums[self.end] - sums[: self.size]

    def stops(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last (excluded) conversation that ends in each node."""
        nodes = np.arange(self.size)
        return np.searchsorted(self.stop, nodes), np.searchsorted(self.stop, nodes, side="right")


def path_keys(path: bytes) -> list[bytes]:
    """A 128-bit key of every prefix, the empty one first."""
    digest = md5()
    out = [digest.digest()]
    for k in range(0, len(path), ITEM):
        digest.update(path[k : k + ITEM])
        out.append(digest.digest())
    return out


_COLUMNS = [
    ("kind", pa.int32()), ("path_id", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()),
    ("parent_key", pa.binary()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("bytes", pa.int64()), ("ends_sha256", pa.string()),
    ("ids", pa.list_(pa.int64())),
]
_SCHEMA = (
    "kind int, path_id long, conv_id long, depth long, key binary, parent_key binary, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, bytes long, ends_sha256 string, ids array<long>"
)


def _batch(rows: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[n], k) if n in columns else pa.nulls(rows, k) for n, k in _COLUMNS]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in _COLUMNS])


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def shard_rows(number: int, convs: np.ndarray, paths: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Final nodes, spines and the ends of spine nodes of one shard."""
    trie = Trie(convs, paths)
    n = trie.size
    last = trie.end == n
    edge = last.copy()
    edge[: trie.lengths[0] + 1] = True
    keys = dict(zip(range(trie.lengths[0] + 1), path_keys(paths[0]), strict=True))
    keys |= dict(zip(np.flatnonzero(last).tolist(), path_keys(paths[-1]), strict=True))
    inner = ~edge
    weight = (trie.members - 1) * trie.bytes
    low, high = trie.stops()
    nodes = np.flatnonzero(inner)
    if len(nodes):
        children = np.bincount(trie.parent[1:], minlength=n)
        under = edge[trie.parent[nodes]]
        ends = [sha256(_joined(convs[a:b])).hexdigest() if b > a else EMPTY for a, b in zip(low[nodes], high[nodes], strict=True)]
        yield _batch(
            len(nodes),
            kind=np.full(len(nodes), NODE, np.int32),
            conv_id=trie.least[nodes],
            depth=trie.depth[nodes],
            parent_key=[keys[p] if u else None for p, u in zip(trie.parent[nodes].tolist(), under.tolist(), strict=True)],
            parent_conv_id=pa.array(trie.least[trie.parent[nodes]], mask=under),
            n_convs=trie.members[nodes],
            n_children=children[nodes],
            n_leaves=trie.leaves[nodes],
            saved_tokens=trie.below(weight)[nodes],
            ends_sha256=ends,
        )
    # What hangs below a spine node beside the spines.
    hanging = [trie.below(np.where(inner, weight, 0)), trie.below(np.where(inner & (trie.end == np.arange(n) + 1), 1, 0))]
    spine = np.flatnonzero(edge)
    for sums in hanging:
        whole = sums.copy()
        np.subtract.at(sums, trie.parent[spine[1:]], whole[spine[1:]])
    kids = np.bincount(trie.parent[nodes], minlength=n)
    paths_of = [np.arange(trie.lengths[0] + 1)] + ([np.flatnonzero(last)] if len(paths) > 1 else [])
    for side, path in enumerate(paths_of):
        again = np.zeros(len(path), bool) if side == 0 else path <= trie.lengths[0]
        names = [keys[p] for p in path.tolist()]
        yield _batch(
            len(path),
            kind=np.full(len(path), SPINE, np.int32),
            path_id=np.full(len(path), 2 * number + side),
            conv_id=trie.least[path],
            depth=trie.depth[path],
            key=names,
            parent_key=[None, *names[:-1]],
            n_convs=np.where(again, 0, trie.members[path]),
            n_children=np.where(again, 0, kids[path]),
            n_leaves=np.where(again, 0, hanging[1][path]),
            saved_tokens=np.where(again, 0, hanging[0][path] + trie.members[path] * trie.bytes[path]),
            bytes=trie.bytes[path],
        )
    ended = spine[high[spine] > low[spine]]
    if len(ended):
        ids = [convs[low[v] : high[v]].tolist() for v in ended]
        yield _batch(
            len(ended), kind=np.full(len(ended), ENDS, np.int32), conv_id=[i[0] for i in ids], key=[keys[v] for v in ended.tolist()], ids=ids
        )


def shards(paths: DataFrame, turns: int = SHARD_TURNS) -> DataFrame:
    """The rows of all shards of ``conv_id`` and ``path``; conv_ids must differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        convs: list[int] = []
        held: list[bytes] = []
        weight = 0
        for batch in batches:
            for conv, path in zip(batch.column("conv_id").to_pylist(), batch.column("path").to_pylist(), strict=True):
                more = len(path) // ITEM + 1
                if held and weight + more > turns:
                    yield from shard_rows(number, np.array(convs, np.int64), held)
                    convs, held, weight, number = [], [], 0, number + 1
                convs.append(conv)
                held.append(path)
                weight += more
        if held:
            yield from shard_rows(number, np.array(convs, np.int64), held)

    order = ["path", "conv_id"]
    ordered = paths.select("conv_id", "path").repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, _SCHEMA)


def nodes(paths: DataFrame, turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of the paths: smallest member, depth, its parent's, members,
    children, childless nodes below, bytes saved below, and the digest of the conversations that end in it."""
    rows = store(shards(paths, turns), "trie")
    spine = rows.where(F.col("kind") == SPINE)
    merged = spine.groupBy("key").agg(
        F.min("path_id").alias("owner"),
        F.max("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("hanging"),
    )
    merged = store(merged, "spines")
    kids = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    children = (F.col("hanging") + F.coalesce("kids", F.lit(0))).alias("n_children")
    merged = merged.join(kids, "key", "left").select("key", "owner", "depth", "parent_key", "conv_id", "n_convs", children)
    # From the deepest node of every path up; a prefix in several paths weighs in one of them.
    owned = spine.join(merged.select("key", "owner", F.col("n_children").alias("all_children")), "key")
    own = F.col("path_id") == F.col("owner")
    up = Window.partitionBy("path_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    saved = F.col("saved_tokens") - F.when(own, F.col("bytes")).otherwise(0)
    leaves = F.col("n_leaves") + F.when(own & (F.col("all_children") == 0), 1).otherwise(0)
    lifted = owned.select("key", F.sum(saved).over(up).alias("s"), F.sum(leaves).over(up).alias("l"))
    totals = lifted.groupBy("key").agg(F.sum("s").alias("saved_tokens"), F.sum("l").alias("n_leaves"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ends = ends_of(rows.where(F.col("kind") == ENDS).select("key", "conv_id", "ids"))
    top = merged.join(totals, "key").join(parents, "parent_key", "left").join(ends, "key", "left")
    top = top.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))).select(columns)
    final = rows.where(F.col("kind") == NODE)
    deep = final.where("parent_key is null").select(columns)
    hung = final.where("parent_key is not null").drop("parent_conv_id").join(parents, "parent_key").select(columns)
    return top.unionByName(deep).unionByName(hung)


def ends_of(pieces: DataFrame) -> DataFrame:
    """``key`` and the SHA-256 of all its ids, ascending; pieces come in order and are not held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for k in range(batch.num_rows):
                own, ids = batch.column("key")[k].as_py(), batch.column("ids")[k].values.to_numpy()
                if own != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = own, sha256(_joined(ids))
                else:
                    digest.update(b"," + _joined(ids))
            yield _digests(done)
        if key is not None:
            yield _digests([(key, digest.hexdigest())])

    dealt = pieces.repartition("key").sortWithinPartitions("key", "conv_id")
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def _digests(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"]
    )


def paths_of(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``path``: 24 bytes a turn, in order."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id is not null")
    # Rows are put in order over all tasks, so that a long conversation fills several.
    order = ["conv_id", "turn", "role", "text"]
    size = F.octet_length("text")
    item = F.concat(
        F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")), F.lpad(F.hex(size.cast("long")), 16, "0")
    )
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ordered.select("conv_id", F.struct(F.monotonically_increasing_id().alias("at"), item.alias("item")).alias("turn"))
    turns = F.sort_array(F.collect_list("turn"))
    whole = placed.groupBy("conv_id").agg(turns.alias("turns"))
    return whole.select("conv_id", F.unhex(F.array_join(F.col("turns.item"), "")).alias("path"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % 5, h = crc32(c) % 9,
    and goes on with its own turns behind its first h."""
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9 * ITEM).cast("int")
    heads = paths.where(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("base"), F.substr("path", F.lit(1), F.lit(8 * ITEM)).alias("head"))
    rows = paths.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")
    begun = F.substr(F.coalesce("head", F.lit(b"")), F.lit(1), taken)
    return rows.select("conv_id", F.concat(begun, F.substr("path", taken + 1)).alias("path"))


def op11(spark, folder: str) -> DataFrame:
    """The registered query: the prefixes of all rebuilt conversations."""
    paths = store(paths_of(table(spark, folder, "conversations")), "paths")
    return nodes(store(rebuilt(paths), "rebuilt"))


ORACLE = """
    WITH code AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
    ), own AS (
        SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
               ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ), drawn AS (
        SELECT conv_id, p, xor(4294967295, list_reduce(
               list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) % 9 AS h
        FROM own, code
    ), whole AS (
        SELECT o.conv_id, list_concat(coalesce(b.p[1:o.h], []), o.p[o.h + 1:]) AS p
        FROM drawn o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
    ), steps AS (
        SELECT conv_id, len(p) AS n, p, unnest(range(len(p) + 1)) AS d FROM whole
    ), prefixes AS (
        SELECT conv_id, n, d, md5(CAST(to_json(p[1:d]) AS VARCHAR)) AS s, CASE WHEN d > 0 THEN md5(CAST(to_json(p[1:d - 1]) AS VARCHAR)) END AS up,
               CASE WHEN d > 0 THEN strlen(p[d].t) ELSE 0 END AS b
        FROM steps
    ), counted AS (
        SELECT s, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n, any_value(b) AS b,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends
        FROM prefixes GROUP BY s, d
    ), kids AS (SELECT up AS s, count(*) AS k FROM counted WHERE up IS NOT NULL GROUP BY up
    ), under AS (
        SELECT DISTINCT v.s AS v, u.s AS u FROM prefixes v JOIN prefixes u ON u.conv_id = v.conv_id AND u.d >= v.d
    ), sums AS (
        SELECT v, CAST(sum((n - 1) * b) AS BIGINT) AS saved, count(*) FILTER (k IS NULL) AS leaves
        FROM under JOIN counted ON counted.s = u LEFT JOIN kids ON kids.s = u GROUP BY v
    )
    SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs, coalesce(k, 0) AS n_children, leaves AS n_leaves,
           saved AS saved_tokens, c.ends AS ends_sha256
    FROM counted c JOIN sums ON v = c.s LEFT JOIN kids ON kids.s = c.s LEFT JOIN counted p ON p.s = c.up"""
