"""A whole table in one order, as a plan.

Bounds of the order cut the rows into ranges, so a hot key fills as many ranges as it needs and no
task holds it. Bounds are plain values: they are drawn from the order's columns alone by one small
job, or given, as the daily batch keeps them. From them on everything is a plan: rows are shuffled by
range once, windows run within ranges, and one row per range carries counts and edges across. A view
made of these forms shows the rows its tables hold when it is read. Bounds that no longer fit the
data make ranges of unlike size; they never change a result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.operators import files
from switchboard.session import store

# Sampled rows per range, bytes of a range, and bounds that one expression compares in a row.
PER_RANGE = 40
RANGE_BYTES = 128 << 20
LEAVES = 256


@dataclass(frozen=True)
class Bounds:
    """Sorted values of an order that cut it into ranges, as JSON."""

    schema: str
    values: tuple[str, ...]


# Bounds, or what gives them for rows and their order; None draws them.
Given = Bounds | Callable[[DataFrame, Sequence[Column]], Bounds] | None


class Kept:
    """Bounds of named orders, kept in a folder. They are drawn when an order is first used, and again
    after ``renew``, so that a plan over them needs no job."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.known: dict[str, Bounds] = {}

    def named(self, name: str) -> Callable[[DataFrame, Sequence[Column]], Bounds]:
        def give(df: DataFrame, order: Sequence[Column]) -> Bounds:
            if name not in self.known:
                number, note = files.newest(self.spark, self.folder, name)
                if not note:
                    drawn = bounds_of(df, order)
                    note = {"schema": drawn.schema, "values": list(drawn.values)}
                    files.publish(self.spark, self.folder, name, number + 1, note)
                self.known[name] = Bounds(note["schema"], tuple(note["values"]))
            return self.known[name]

        return give

    def renew(self) -> None:
        files.remove(self.spark, self.folder)
        self.known.clear()


def named(kept: Kept | None, name: str) -> Given:
    return kept.named(name) if kept else None


def key_of(df: DataFrame, order: Sequence[Column]) -> list[Column]:
    """The order's columns, times as microseconds."""
    kinds = df.select(*[c.alias(f"_k{n}") for n, c in enumerate(order)]).schema.fields
    parts = [F.unix_micros(c) if isinstance(f.dataType, T.TimestampType) else c for c, f in zip(order, kinds, strict=True)]
    return [p.alias(f"_k{n}") for n, p in enumerate(parts)]


def bounds_of(df: DataFrame, order: Sequence[Column]) -> Bounds:
    """Bounds from a sample of the order's columns: a number of rows that is fixed per range."""
    spark = df.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # A table whose size Spark cannot tell counts as small; ranges stay as many as shuffle partitions.
    ranges = max(wanted, min(size // RANGE_BYTES, 100 * wanted) if size < 1 << 60 else 0)
    keys = df.select(F.struct(*key_of(df, order)).alias("k"))
    drawn = keys.select("k", F.rand(7).alias("r")).orderBy("r").limit(PER_RANGE * ranges).select("k")
    listed = [r.j for r in drawn.orderBy("k").select(F.to_json("k").alias("j")).collect()]
    step = max(len(listed) / ranges, 1)
    picked = dict.fromkeys(listed[int(n * step)] for n in range(1, ranges) if int(n * step) < len(listed))
    return Bounds(keys.schema["k"].dataType.simpleString(), tuple(picked))


def in_ranges(df: DataFrame, order: Sequence[Column], bounds: Given = None) -> DataFrame:
    """``df`` with the columns of its order, ``_k0``, ``_k1`` and so on, and its range ``_range``."""
    bounds = bounds(df, order) if callable(bounds) else bounds or bounds_of(df, order)
    values = [F.from_json(F.lit(v), bounds.schema) for v in bounds.values]
    key = F.struct(*[F.col(f"_k{n}") for n in range(len(order))])


    def place(among: list[Column], low: int, high: int) -> Column:
        """How many of the values are not above the key, by halves."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < among[middle], place(among, low, middle)).otherwise(place(among, middle + 1, high))

    keyed = df.select("*", *key_of(df, order))
    if len(values) <= LEAVES:
        return keyed.withColumn("_range", place(values, 0, len(values)))
    # Many bounds: by halves to a group of them, then by counting within the group.
    step = -(-len(values) // LEAVES)
    groups = [values[n : n + step] for n in range(0, len(values), step)]
    listed = F.array(*[F.array(*g) for g in groups])
    at = keyed.withColumn("_g", place([g[0] for g in groups], 0, len(groups)))
    inside = F.when(F.col("_g") == 0, F.lit(0)).otherwise(
        (F.col("_g") - 1) * step + F.size(F.filter(F.get(listed, F.col("_g") - 1), lambda b: b <= key))
    )
    return at.withColumn("_range", inside).drop("_g")


def _keys(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c[:2] == "_k" and c[2:].isdigit()]


def _within(rows: DataFrame):
    return Window.partitionBy("_range").orderBy(*_keys(rows))


def _per_range(rows: DataFrame, own: Column) -> DataFrame:
    """``own`` per range: one row for each, from one row per range and task. The empty list keeps
    Spark from sorting all rows for a value that is a struct."""
    nothing = F.collect_list(F.when(F.lit(False), F.lit(0))).alias("_nothing")
    return rows.groupBy("_range").agg(own.alias("own"), nothing).where("size(_nothing) = 0").select("_range", "own")


def _carried(ranges: DataFrame, step: Column, first: Column, kind: str) -> DataFrame:
    """``_range``, ``_carry``, the fold of ``step`` over the ranges before it, and ``_total``, over all.

    There is one row per range, so all of them are one array.
    """
    listed = ranges.agg(F.sort_array(F.collect_list(F.struct("_range", "own"))).alias("all"))
    start = F.struct(first.cast(kind).alias("state"), F.array().cast(f"array<struct<_range:int,_carry:{kind}>>").alias("out"))
    folded = F.aggregate(
        "all",
        start,
        lambda acc, r: F.struct(
            step(acc["state"], r["own"]).cast(kind).alias("state"),
            F.concat(acc["out"], F.array(F.struct(r["_range"].alias("_range"), acc["state"].alias("_carry")))).alias("out"),
        ),
    )
    return listed.select(folded.alias("f")).select(F.col("f.state").alias("_total"), F.inline("f.out"))


def positions(df: DataFrame, order: Sequence[Column], out: str = "position", bounds: Given = None) -> DataFrame:
    """Add the 1-based position and ``<out>_total``; ``order`` must identify each row."""
    rows = in_ranges(df, order, bounds)
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("own"))
    rows = rows.withColumn("_in", F.row_number().over(_within(rows)))
    before = _carried(sizes, lambda state, own: state + own, F.lit(0), "bigint")
    placed = rows.join(F.broadcast(before), "_range")
    position = (F.col("_in") + F.col("_carry")).cast("long").alias(out)
    return placed.select(*df.columns, position, F.col("_total").alias(f"{out}_total"))


def ranks(df: DataFrame, order: Sequence[Column], out: str = "rank", bounds: Given = None) -> DataFrame:
    """Add ``<out>`` (rank), ``<out>_dense`` and ``<out>_total``; equal keys share a rank.

    Ranks are computed once per distinct key and joined back; the join back can be split where a
    key holds many rows.
    """
    named = [c.alias(f"_{n}") for n, c in enumerate(order)]
    groups = df.select(F.struct(*named).alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    by = [F.col(f"_key._{n}") for n in range(len(order))]
    rows = in_ranges(groups, by, bounds)
    kind = "struct<keys:bigint,rows:bigint>"
    own = F.struct(F.count(F.lit(1)).alias("keys"), F.sum("_n").alias("rows"))
    sizes = rows.groupBy("_range").agg(own.alias("own"))
    within = _within(rows)
    earlier = F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"_in": F.row_number().over(within), "_before": F.coalesce(earlier, F.lit(0).cast("long"))})
    add = lambda s, o: F.struct((s["keys"] + o["keys"]).alias("keys"), (s["rows"] + o["rows"]).alias("rows"))
    zero = F.struct(F.lit(0).cast("long").alias("keys"), F.lit(0).cast("long").alias("rows"))
    before = _carried(sizes, add, zero, kind)
    placed = rows.join(F.broadcast(before), "_range").select(
        F.col("_key").alias("_placed"),
        (F.col("_before") + F.col("_carry.rows") + 1).alias(out),
        (F.col("_in") + F.col("_carry.keys")).alias(f"{out}_dense"),
        F.col("_total.rows").alias(f"{out}_total"),
    )
    keyed = df.withColumn("_key", F.struct(*named))
    return keyed.join(placed, F.col("_key") == F.col("_placed")).drop("_key", "_placed")


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str],
    value: Sequence[str],
    out: str,
    *,
    following: bool = False,
    bounds: Given = None,
) -> DataFrame:
    """Add ``out``: a struct of ``value`` from the previous (or following) row of the key.

    Order is ``ts``, then ``tiebreak``; ``ts`` must not be NULL. ``out`` is NULL at the end.
    """
    rows = in_ranges(df, [F.col(c) for c in (*keys, ts, *tiebreak)], bounds)
    return beside(rows, keys, value, out, following=following).select(*df.columns, out)


def beside(
    rows: DataFrame, keys: Sequence[str], value: Sequence[str], out: str, *, following: bool = False, label: str | None = None
) -> DataFrame:
    """``neighbour`` of rows that are in ranges already; rows may have been left out since.

    With ``label`` the rows are stored with their neighbours within ranges, so that what made them runs
    once, and not again for the edges of the ranges.
    """
    whole = F.struct(F.struct(*keys).alias("k"), F.struct(*value).alias("v"))
    near = (F.lead if following else F.lag)(whole).over(_within(rows))
    placed = rows.withColumn("_near", near)
    if label:
        rows = placed = store(placed, label)
    edges = _per_range(rows, (F.min_by if following else F.max_by)(whole, F.struct(*_keys(rows))))
    # The last row of the nearest range before (or the first of the nearest one behind) that has rows.
    kind = edges.schema["own"].dataType.simpleString()
    if following:
        edges = edges.withColumn("_range", -F.col("_range"))
    carry = _carried(edges, lambda state, own: own, F.lit(None), kind)
    if following:
        carry = carry.withColumn("_range", -F.col("_range"))
    met = placed.join(F.broadcast(carry), "_range")
    found = F.coalesce("_near", "_carry")
    return met.withColumn(out, F.when(found["k"].eqNullSafe(F.struct(*keys)), found["v"])).drop("_near", "_carry", "_total")


def running_sum(rows: DataFrame, weight: str, out: str) -> DataFrame:
    """Add the sum of ``weight`` over all rows up to this one, of rows in ranges; NULL counts as nothing."""
    inside = _within(rows).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("_range").agg(F.coalesce(F.sum(weight), F.lit(0)).cast("long").alias("own"))
    before = _carried(sums, lambda state, own: state + own, F.lit(0), "bigint")
    seen = rows.withColumn(out, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return seen.join(F.broadcast(before), "_range").withColumn(out, F.col(out) + F.col("_carry")).drop("_carry", "_total")
