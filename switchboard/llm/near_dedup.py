"""Near-duplicate documents by HyperMinHash registers, banding and exact verification.

A document is the set of its distinct word shingles. One hash per shingle picks one of
``REGISTERS`` buckets; a bucket keeps its smallest second hash, compressed to the count of
leading zeros and ten mantissa bits. Bands of neighbouring registers give candidates, the
registers' agreement (less the collisions expected by chance) drops hopeless ones, and the
full sets decide. Equal sets form one class first, so copies cost nothing after that.

Pairs of a bucket are never listed. First every class meets only the smallest class of its
bucket. In buckets whose members don't hang together by then, tasks compare registers block by
block and report who does, one row per member at most. The clusters that come out hold every pair
that can be near. They are then compared on the full sets, block by block again; a task reports
fewer links than it has documents.

Two sets at a similarity of 0.85 share one of the 32 bands of four registers but for a chance
of about 1e-10, at 0.8 of 1e-7. The registers drop a pair only if they agree in less than the
threshold by six standard errors.

Null and empty texts have no shingles: no class, no links, their own component. Fewer words
than a shingle: the whole sequence is one shingle. Repeated rows are copies like any others.
Rows without doc_id get null as component unless a numbered row shares it. Tables may be empty;
other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.components import connected
from switchboard.llm.frames import Hasher, as_bytes, chunks, lowered, mix, small_batches, spare, text_key, text_of, word_spans
from switchboard.session import store

REGISTERS = 128
BAND = 4
MANTISSA = 10
# Members, and shingles, of a block whose members are compared with each other at once.
BLOCK = 1024
BLOCK_SHINGLES = 1_000_000
# Share of matching registers expected by chance at ten mantissa bits.
_CHANCE = 0.169919487159739 * 2.0 ** (2 - MANTISSA)


def shingles(values: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles, and the n + 1 offsets of the rows in them."""
    values = lowered(values)
    starts, ends, _ = word_spans(values, offsets)
    hashes = Hasher(values).ranges(starts, ends)
    first = np.searchsorted(starts, offsets[:-1])
    count = np.diff(np.append(first, len(starts)))
    length = np.minimum(count, words)
    made = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    places = np.concatenate([[0], np.cumsum(made)])
    rows = np.repeat(np.arange(len(made)), made)
    at = np.arange(places[-1]) - places[rows] + first[rows]
    out = mix(length[rows].astype(np.uint64))
    for k in range(words):
        live = length[rows] > k
        out[live] = mix(out[live] * np.uint64(3) + hashes[at[live] + k])
    return out, places


def distinct(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, sorted, and their offsets."""
    sets = [np.unique(hashes[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else hashes[:0]), np.concatenate([[0], np.cumsum(sizes)])


def registers(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """HyperMinHash registers, 16 bits each, of every row; empty buckets take the next one's value."""
    rows = len(places) - 1
    least = np.full((rows, REGISTERS), np.iinfo(np.uint64).max, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(places))
    bucket = (hashes % np.uint64(REGISTERS)).astype(np.int64)
    np.minimum.at(least.reshape(-1), row * REGISTERS + bucket, mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))
    empty = least == np.iinfo(np.uint64).max
    # The bits of a double are its exponent (leading zeros) and mantissa; ten of these are kept.
    code = (least.astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA)) - np.uint64(1023 << MANTISSA)
    code = np.minimum(code, 65535).astype(np.uint16)
    twice = np.where(np.hstack([empty, empty]), 2 * REGISTERS, np.arange(2 * REGISTERS))
    nearest = np.minimum.accumulate(twice[:, ::-1], axis=1)[:, ::-1][:, :REGISTERS] % REGISTERS
    return np.take_along_axis(code, nearest, axis=1)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            hashes, places = distinct(*shingles(*as_bytes(part.column("text")), words))
            sizes = np.diff(places)
            sums = [
                np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(h)])[places])
                for h in (hashes, mix(hashes + np.uint64(77)))
            ]
            digest = np.stack(sums, axis=1).astype(">u8")
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("key"),
                    pa.array(sizes, pa.int64()),
                    pa.array([d.tobytes() if n else None for d, n in zip(digest, sizes, strict=True)], pa.binary()),
                    pa.array([r.tobytes() for r in registers(hashes, places)], pa.binary()),
                ],
                ["doc_id", "key", "n_shingles", "cls", "registers"],
            )

    return run


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, key of the text, set size, digest of the set (null if empty), registers."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), text_of().alias("text"))
    schema = "doc_id long, key binary, n_shingles long, cls binary, registers binary"
    return rows.mapInArrow(_sets(words), schema)


def _agree(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less the collisions by chance."""
    ratio = np.minimum(sizes_a, sizes_b) / np.maximum(np.maximum(sizes_a, sizes_b), 1)
    chance = _CHANCE * 4 * ratio / (1 + ratio) ** 2
    equal = (a == b).mean(axis=-1)
    return np.maximum(equal - chance, 0) / (1 - chance)


def _hopeful(a, b, sizes_a, sizes_b, percent: int) -> np.ndarray:
    """Pairs that can reach the threshold: by size always, by registers where the sets are large."""
    least, most = np.minimum(sizes_a, sizes_b), np.maximum(sizes_a, sizes_b)
    # Small sets leave registers empty, which then repeat others: fewer count as independent.
    told = np.minimum(REGISTERS, np.maximum(least, 2) / 2)
    floor = percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / told)
    return (least * 100 >= most * percent) & (_agree(a, b, sizes_a, sizes_b) >= floor)


def _estimated(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                left, right = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                    for c in ("registers_a", "registers_b")
                )
                sizes = [part.column(c).to_numpy() for c in ("n_a", "n_b")]
                keep = _hopeful(left, right, *sizes, percent)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return run


def _estimate(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that the registers hold for near."""
    side = lambda c: classes.select(
        F.col("cls").alias(c), F.col("registers").alias(f"registers_{c}"), F.col("n_shingles").alias(f"n_{c}")
    )
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_estimated(percent), "a binary, b binary")


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each key together, from rows in the order of keys."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [batch.column(n).dictionary_encode().indices.to_numpy() for n in names]
        new = np.any([c[1:] != c[:-1] for c in codes], axis=0)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(batch.column(n)[start].as_py() for n in names)
            if key != last and kept:
                yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                kept = []
            kept.append(batch.slice(start, stop - start))
            last = key
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def _stars(nodes: pa.Array, label: np.ndarray) -> pa.RecordBatch:
    """Links from all nodes of one label to the smallest of them."""
    order = np.array(sorted(range(len(nodes)), key=nodes.to_pylist().__getitem__), np.int64)
    _, first, code = np.unique(label[order], return_index=True, return_inverse=True)
    least = order[first[code]]
    moved = np.flatnonzero(least != order)
    take = lambda at: nodes.take(pa.array(at))
    return pa.RecordBatch.from_arrays([take(order[moved]), take(least[moved])], ["a", "b"])


def _clusters(percent: int):
    """Links between the roots of members of one bucket's two blocks which the registers hold for near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["bucket", "low", "high"]):
            rows = np.frombuffer(b"".join(group.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            sizes, block = group.column("n_shingles").to_numpy(), group.column("block").to_numpy()
            _, first, code = np.unique(
                group.column("root").dictionary_encode().indices.to_numpy(), return_index=True, return_inverse=True
            )
            label = first[code]  # rows that hang together already have the first one's number
            left, right = (np.flatnonzero(block == group.column(c)[0].as_py()) for c in ("low", "high"))
            step = max(1, (1 << 22) // (REGISTERS * max(len(right), 1)))
            for at in range(0, len(left), step):
                some = left[at : at + step]
                near = _hopeful(rows[some][:, None], rows[right][None], sizes[some][:, None], sizes[right][None], percent)
                near &= label[some][:, None] != label[right][None]
                for k in np.flatnonzero(near.any(axis=1)):
                    met = np.unique(label[right[near[k]]])
                    label[np.isin(label, met)] = label[some[k]]
            yield _stars(group.column("root").take(pa.array(first)), label[first])

    return run


def _exact(words: int, percent: int):
    """Links within one cluster's two blocks, from the full sets.

    Documents that links found before join already are not compared again. Each set of linked
    documents is reported as a star, so there are fewer links than documents, and a cluster of one
    pair of blocks needs no further round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["cluster", "low", "high"]):
            hashes, places = distinct(*shingles(*as_bytes(group.column("text")), words))
            _, ids = np.unique(hashes, return_inverse=True)
            sizes, block = np.diff(places), group.column("block").to_numpy()
            left, right = (np.flatnonzero(block == group.column(c)[0].as_py()) for c in ("low", "high"))
            label = np.arange(group.num_rows)
            seen = np.zeros(len(ids) + 1, np.int8)
            for i in left:
                others = right[label[right] != label[i]]
                close = np.minimum(sizes[others], sizes[i]) * 100 >= np.maximum(sizes[others], sizes[i]) * percent
                others = others[close]
                if not len(others):
                    continue
                mine = ids[places[i] : places[i + 1]]
                seen[mine] = 1
                lengths = sizes[others]
                ends = np.cumsum(lengths)
                picked = ids[np.repeat(places[others + 1] - ends, lengths) + np.arange(ends[-1])]
                shared = np.add.reduceat(seen[picked], ends - lengths, dtype=np.int64)
                seen[mine] = 0
                for j in others[100 * shared >= percent * (sizes[i] + lengths - shared)]:
                    if label[j] != label[i]:
                        label[label == label[j]] = label[i]
            yield _stars(group.column("cls"), label)

    return run


def _blocked(rows: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """``rows`` of each group dealt to all pairs of its blocks: columns low, high, block, other columns."""
    dealt = rows.join(groups, name).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")


def _together(rows: DataFrame, name: str) -> DataFrame:
    """Rows of a pair of blocks in one task, side by side."""
    return rows.repartition(name, "low", "high").sortWithinPartitions(name, "low", "high")


def _blocks(members, shingles_):
    """How many blocks keep each of them small."""
    return F.greatest(F.ceil(F.greatest(members / BLOCK, shingles_ / BLOCK_SHINGLES)), F.lit(1)).cast("int")


def near_components(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """Per row of ``docs``: doc_id, key, n_shingles, root (one per component, null without words)
    and component_id (smallest doc_id reachable)."""
    small_batches(docs.sparkSession)
    pair = "a binary, b binary"
    sets = store(shingle_sets(docs, words), "sets")
    classes = sets.where("cls is not null").groupBy("cls").agg(
        F.min("key").alias("key"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("registers").alias("registers")
    )
    classes = store(classes, "classes")
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)),
        lambda k: F.xxhash64(k, F.expr("registers").substr(k * F.lit(2 * BAND) + 1, F.lit(2 * BAND))),
    )
    members = classes.select("cls", F.explode(bands).alias("bucket"))
    heads = members.groupBy("bucket").agg(F.min("cls").alias("b"), F.count(F.lit(1)).alias("members")).where("members > 1")
    heads = store(heads, "heads")
    shared = store(members.join(heads, "bucket"), "members")
    stars = shared.where("cls != b").select(F.col("cls").alias("a"), "b").distinct()
    joined = connected(_estimate(stars, classes, percent))
    # Buckets whose members don't hang together yet are compared in full, by registers.
    rooted = shared.where("members > 2").join(joined.withColumnRenamed("node", "cls"), "cls", "left")
    rooted = store(rooted.select("bucket", "cls", F.coalesce("root", "cls").alias("root")), "rooted")
    mixed = rooted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = mixed.where("low != high").select("bucket", _blocks(F.col("n"), F.lit(0)).alias("blocks"))
    dealt = _blocked(rooted, mixed, "bucket").join(classes.select("cls", "n_shingles", "registers"), "cls")
    near = _together(dealt, "bucket").mapInArrow(_clusters(percent), pair)
    # What is joined already counts as its root from here on.
    merged = connected(near)
    clusters = joined.join(merged.select(F.col("node").alias("root"), F.col("root").alias("into")), "root", "left")
    clusters = clusters.select(F.col("node").alias("cls"), F.coalesce("into", "root").alias("cluster")).union(merged).distinct()
    # Clusters are compared on their full sets. Texts move once, by the same plan at every size.
    wanted = store(clusters.join(classes.select("cls", "key", "n_shingles"), "cls"), "clustered")
    sizes = wanted.groupBy("cluster").agg(_blocks(F.count(F.lit(1)), F.sum("n_shingles")).alias("blocks"))
    texts = docs.select(text_key().alias("key"), text_of().alias("text"))
    texts = texts.join(wanted.select("cls", "key").hint("merge"), "key")
    # One text per class: rows with one key are equal, so any of them will do.
    texts = store(texts.groupBy("key", "cls").agg(F.any_value("text").alias("text")).drop("key"), "texts")
    dealt = _blocked(wanted.select("cluster", "cls"), sizes, "cluster").join(texts, "cls")
    links = _together(dealt, "cluster").mapInArrow(_exact(words, percent), pair)
    roots = connected(links)
    placed = sets.drop("registers").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    placed = placed.withColumn("root", F.coalesce("root", "cls"))
    least = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id",
        "key",
        "n_shingles",
        "root",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the one with the smallest doc_id.

    Rows that repeat the kept document, id and text, go too. Rows without words are linked with
    nothing, so all of them stay, rows that repeat each other too.
    """
    found = near_components(docs, words, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("kept")
    kept = found.where("root is not null").groupBy("root").agg(first).select("kept.doc_id", "kept.key")
    wordless = found.where("root is null").select("key").distinct()
    own, key = spare(docs, "_id", "_key")
    kept = kept.select(F.col("doc_id").alias(own), F.col("key").alias(key))
    rows = docs.withColumns({own: F.col("doc_id").cast("long"), key: text_key()})
    same = rows[own].eqNullSafe(kept[own]) & (rows[key] == kept[key])
    others = rows.join(wordless.withColumnRenamed("key", key), key, "left_semi").drop(own, key)
    return rows.join(kept, same, "left_semi").dropDuplicates([own, key]).drop(own, key).unionByName(others)


def op8(spark, folder: str) -> DataFrame:
    """The registered query: 3-word shingles, similarity 0.85."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return near_components(docs, 3, 85).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
