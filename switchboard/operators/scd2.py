"""Slowly changing history (type 2): versions with validity ranges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.functions.text import surrogate, utc_text
from switchboard.operators import runs
from switchboard.operators.dedup import greatest_by
from switchboard.operators.layout import Value
from switchboard.operators.orders import beside, in_ranges
from switchboard.operators.sink import read_table, rewrite_partitions, without
from switchboard.schemas import TABLES, Table
from switchboard.session import store

YEAR = "seen_year"


def history(
    observed: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    id_column: str,
) -> DataFrame:
    """Version history of ``keys`` from timed observations.

    Observations of a key at one instant are reduced to the greatest; a run of observations
    with the same ``tracked`` values becomes one version. Adds ``eff_from_ts``,
    ``eff_to_ts`` (start of the next version), ``is_current``, ``eff_from_year`` and the MD5
    surrogate of the keys and ``eff_from_ts``. Running it again over its inputs gives the
    same rows.
    """
    rows = observed.where(F.col(ts).isNotNull())
    # Stored, as the bounds, the edges and the rows of the ranges each read them.
    rows = store(greatest_by(rows, [*keys, ts], [F.col(c) for c in tracked], tracked), "observed")
    # One order serves both steps: the second looks along the first's rows that are left.
    rows = beside(in_ranges(rows, [F.col(c) for c in (*keys, ts)]), keys, tracked, "_before")
    values = F.struct(*tracked)
    starts = rows.where(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(values)).drop("_before")
    starts = beside(starts, keys, [ts], "_next", following=True, label="starts")
    return starts.select(
        surrogate(*[F.col(k) for k in keys], utc_text(F.col(ts))).alias(id_column),
        *keys,
        *tracked,
        F.col(ts).alias("eff_from_ts"),
        F.col("_next")[ts].alias("eff_to_ts"),
        F.col("_next").isNull().alias("is_current"),
        F.year(ts).cast("long").alias("eff_from_year"),
    )


def observations(table: str, keys: Sequence[str], tracked: Sequence[str], ts: str) -> Table:
    """Layout of a history's observations: stored by run, partitioned by the year they were made in."""
    kinds = dict(TABLES[table].columns)
    columns = [*[f"{c} {kinds[c]}" for c in (*keys, *tracked)], f"{ts} TIMESTAMP", f"{YEAR} BIGINT"]
    return Table(f"{table}_seen", ", ".join(columns), pk=[*keys, ts], partition=YEAR)


def splice(
    spark: SparkSession,
    path: str,
    seen: str,
    table: str,
    arriving: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    id_column: str,
    run: dt.date,
) -> set[Value]:
    """Put the observations that ``run`` delivers into the stored history at ``path``; returns the years written.

    All observations are kept at ``seen`` by run, so a run may come late or again. A key's versions
    that end before the first instant that changes for it stay. From there on its versions are made
    anew from its observations, of which only those from that instant on are read: on an ordinary
    day the open versions, and no observation but the arriving ones. Only years whose versions
    differ are rewritten. The result is that of ``history`` over what all runs delivered.
    """
    spec = observations(table, keys, tracked, ts)
    rows = greatest_by(arriving.where(F.col(ts).isNotNull()), [*keys, ts], [F.col(c) for c in tracked], tracked)
    # What this run delivered before and does not deliver any more changes the history too.
    columns = [*keys, *tracked, ts]
    again = run.isoformat() in runs.notes(spark, seen)
    before = runs.delivered(spark, seen, spec, run).select(columns)
    runs.deliver(rows.withColumn(YEAR, F.year(ts)), seen, spec, run)
    now = runs.delivered(spark, seen, spec, run).select(columns)
    changes = now.unionByName(before.subtract(now)) if again else now
    since = store(changes.groupBy(*keys).agg(F.min(ts).alias("_since")), "since")
    first = since.agg(F.min("_since")).first()[0]
    if first is None:
        return set()
    since = since.select(*[F.col(k).alias(f"_{k}") for k in keys], "_since")
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    # Plain values reach the scans; the exact bound is each key's own.
    stored = read_table(spark, path, table)
    open_since = F.col("eff_to_ts").isNull()
    old = stored.where(open_since | (F.col("eff_to_ts") >= F.lit(first))).join(since, same)
    old = old.where(open_since | (F.col("eff_to_ts") >= F.col("_since")))
    old = store(old.select(*TABLES[table].names, "_since"), "affected")
    known = runs.delivered(spark, seen, spec).where((F.col(YEAR) >= first.year) & (F.col(ts) >= F.lit(first)))
    known = known.join(since, same).where(F.col(ts) >= F.col("_since")).select(columns)
    begun = old.where(F.col("eff_from_ts") < F.col("_since")).withColumnRenamed("eff_from_ts", ts).select(columns)
    old = old.drop("_since")
    made = store(TABLES[table].conform(history(known.unionByName(begun), keys, tracked, ts, id_column)), "versions")
    # Both differences by one grouping: a version that is on one side only has gone or is new.
    sides = made.withColumn("_made", F.lit(1)).unionByName(old.withColumn("_made", F.lit(0)))
    alone = sides.groupBy(*made.columns).agg(F.min("_made").alias("_low"), F.max("_made").alias("_high")).where("_low = _high")
    alone = store(alone, "differing")
    gone, new = (alone.where(F.col("_low") == side).drop("_low", "_high") for side in (0, 1))
    years = {y for (y,) in gone.select("eff_from_year").distinct().collect()}
    if not years and new.isEmpty():
        return set()
    # A version is told by its key and start: the surrogate of a NULL key is NULL.
    told = [*keys, "eff_from_ts"]
    versions = gone.select(told).union(new.select(told)).distinct()
    return rewrite_partitions(
        spark, path, table, versions, lambda kept: without(kept, versions).unionByName(new), years
    )[0]
