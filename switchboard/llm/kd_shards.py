"""Shards of near equal bytes: a k-d tree over the documents' metadata.

Dimensions: length, and the hashed source, language and text. Every node is cut along its widest
dimension (its range there, as a share of the whole range) at the median weighted with
bytes, until ``2 ** levels`` leaves are there. Medians are found by distributed counting: a node's
range of values is laid out in ``BINS`` bins, bytes and rows per bin are summed, and the bin in
which half of the bytes are reached becomes the next range. Ties are ordered by the hash of the text, then
doc_id, and copies of a text share the smallest source and language of their group. So equal texts stay
together; a cut falls among them only where they hold more than ``WHOLE`` of the bytes on one
side of it, and no value is too frequent to be cut. The driver sees at most nodes times bins sums, whatever the corpus.

All of it is Spark's own expressions. Null texts have no bytes and size 1; null metadata counts as
a value of its own; rows without doc_id come first among their ties. Rows that agree in everything cannot be told
apart and go to one side together. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.llm.frames import table, text_of
from switchboard.operators.ranking import row_positions
from switchboard.session import store

BINS = 1024
WHOLE = 0.004
DIMENSIONS = ("size", "source_hash", "lang_hash", "text_crc32")
TIES = ("text_crc32", "doc_key")


@dataclass
class Cut:
    """The search for one node's median: ``order[:len(fixed)]`` are known, the next lies in [low, high]."""

    order: tuple[str, ...]
    half: float
    low: int
    high: int
    before: int = 0
    fixed: list[int] = field(default_factory=list)
    done: bool = False

    @property
    def column(self) -> str:
        return self.order[len(self.fixed)]

    @property
    def width(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // BINS))

    def inside(self) -> Column:
        known = F.lit(True)
        for name, value in zip(self.order, self.fixed, strict=False):
            known &= F.col(name) == F.lit(value)
        return known & F.col(self.column).between(self.low, self.high)

    def bin(self) -> Column:
        """Whole division of decimals: exact over the range of a long."""
        number = lambda x: f"cast({x} as decimal(20,0))"
        return F.expr(f"cast(({number(self.column)} - {number(self.low)}) div {number(self.width)} as int)")

    def left(self) -> Column:
        """Rows before the cut: less than (fixed..., low) in the order."""
        below = F.lit(False)
        equal = F.lit(True)
        for name, value in zip(self.order, [*self.fixed, self.low], strict=False):
            below |= equal & (F.col(name) < F.lit(value))
            equal &= F.col(name) == F.lit(value)
        return below


def narrow(docs: DataFrame) -> DataFrame:
    """The columns that decide, one row per document; the text is read here only."""
    named = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in docs.columns else F.lit(0)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_key"),
        (F.octet_length(text_of()) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
        named("source").cast("long").alias("source_hash"),
        named("lang").cast("long").alias("lang_hash"),
    )
    text = ["text_crc32", "size"]
    groups = rows.groupBy(*text).agg(*(F.min(c).alias(c) for c in ("source_hash", "lang_hash")))
    return rows.drop("source_hash", "lang_hash").join(groups, text)


def _ranges(rows: DataFrame) -> dict[int, dict[str, tuple[int, int]]]:
    columns = dict.fromkeys((*DIMENSIONS, *TIES))
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    found = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()
    return {r.node: {"bytes": (r.bytes, 0)} | {c: (r[f"min_{c}"], r[f"max_{c}"]) for c in columns} for r in found}


def _cuts(rows: DataFrame, whole: dict[str, tuple[int, int]], nodes: dict) -> dict[int, Cut]:
    """The cut of every node, all searched for at once."""
    cuts = {}
    for node, ends in nodes.items():
        share = {d: (ends[d][1] - ends[d][0]) / max(whole[d][1] - whole[d][0], 1) for d in DIMENSIONS}
        widest = max(DIMENSIONS, key=lambda d: (share[d], -DIMENSIONS.index(d)))
        order = (widest, *(t for t in TIES if t != widest))
        cuts[node] = Cut(order, ends["bytes"][0] / 2, *ends[widest])
    while open_ := {n: c for n, c in cuts.items() if not c.done}:
        inside, place = F.lit(False), F.lit(None).cast("int")
        for node, cut in open_.items():
            mine = (F.col("node") == node) & cut.inside()
            inside |= mine
            place = F.when(mine, cut.bin()).otherwise(place)
        sums = (
            rows.where(inside)
            .groupBy("node", place.alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
            .collect()
        )
        for node, cut in open_.items():
            at = cut.before
            mine = sorted((s.bin, s.bytes, s.rows) for s in sums if s.node == node)
            for found in mine:
                if at + found[1] >= cut.half:
                    break
                at += found[1]
            cut.before, low = at, cut.low + found[0] * cut.width
            cut.low, cut.high = low, min(low + cut.width - 1, cut.high)
            ends = nodes[node]
            last = len(cut.order) - len(cut.fixed) if cut.low == cut.high else 0
            if found[2] == 1 or last == 1 or (last == 2 and found[1] <= WHOLE * cut.half):
                # One row, a small group of copies, or rows that can't be told apart: to the lighter side.
                cut.done = True
                if cut.half - at > at + found[1] - cut.half:
                    cut.low = cut.high + 1
            elif cut.low == cut.high:
                cut.fixed.append(cut.low)
                cut.low, cut.high = ends[cut.column]
    return cuts


def levels_for(total: int, target: int) -> int:
    """How often to halve ``total`` bytes until leaves have at most ``target``."""
    return max(0, math.ceil(math.log2(max(total, 1) / max(target, 1))))


def kd_shards(docs: DataFrame, levels: int) -> DataFrame:
    """doc_id, size, text_crc32, shard (0 to ``2 ** levels`` - 1) and slot of every row."""
    rows = store(narrow(docs), "narrow")
    placed = rows.withColumn("node", F.lit(0))
    nodes = _ranges(placed)
    whole = nodes.get(0, {})
    for _ in range(levels):
        node = F.col("node") * 2
        for number, cut in _cuts(placed, whole, nodes).items():
            node = F.when((F.col("node") == number) & ~cut.left(), F.lit(2 * number + 1)).otherwise(node)
        placed = placed.withColumn("node", node)
        nodes = _ranges(placed)
    order = [F.col("node"), F.col("doc_key"), F.col("text_crc32")]
    numbered = row_positions(placed.select("doc_id", "doc_key", "size", "text_crc32", "node"), order)
    firsts = numbered.groupBy("node").agg(F.min("position").alias("first"))
    # One row per shard.
    return numbered.join(F.broadcast(firsts), "node").select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("node").cast("int").alias("shard"),
        (F.col("position") - F.col("first")).cast("long").alias("slot"),
    )


def op6(spark, folder: str) -> DataFrame:
    """The registered query: 16 shards by the law of bytes."""
    return kd_shards(table(spark, folder, "documents"), 4).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
