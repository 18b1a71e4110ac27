"""Data-quality jobs. Each returns small result rows computed by aggregation over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.functions import time
from switchboard.functions.text import surrogate, utc_text
from switchboard.operators.slices import neighbour
from switchboard.plans.facts import UNKNOWN
from switchboard.schemas import TABLES
from switchboard.session import drop_shuffles, store

# From this size on a number is epoch milliseconds: as seconds it lies in the year 5138.
MILLIS_FROM = 100_000_000_000
PASS, FAIL = "PASS", "FAIL"


def _status(ok: Column) -> Column:
    return F.when(ok, PASS).otherwise(FAIL).alias("status")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def pk_unique(df: DataFrame, table: str, pk: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and keys that occur more than once."""
    per_key = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_keys"),
    )
    return counts.select(F.lit(table).alias("table_name"), "*", _status(F.col("duplicate_keys") == 0))


def table_populated(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", _status(F.col("row_count") > 0)
        )
        for name, df in tables.items()
    ]
    return _union(frames)


def epoch_range(df: DataFrame, table: str, units: Mapping[str, str]) -> DataFrame:
    """Per epoch column: range, how many values have the size of milliseconds, and the unit this shows.

    ``units`` maps columns to the unit their name promises, ``s`` or ``ms``. A column fails
    when most of its values have the other unit.
    """
    aggs = []
    for c in units:
        big = F.abs(F.col(c)) >= MILLIS_FROM
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(units[c]).alias("declared_unit"),
                F.count(c).alias("value_count"),
                F.min(c).alias("min_value"),
                F.max(c).alias("max_value"),
                F.count(F.when(big, 1)).alias("millis_count"),
            )
        )
    rows = df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
    shown = F.when(F.col("value_count") == 0, F.col("declared_unit")).otherwise(
        F.when(F.col("millis_count") * 2 > F.col("value_count"), "ms").otherwise("s")
    )
    return (
        rows.withColumn("table_name", F.lit(table))
        .withColumn("detected_unit", shown)
        .withColumn("status", _status(F.col("detected_unit") == F.col("declared_unit")))
    )


def string_dates(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Per 14-digit date column: NULL, parsed and rejected values."""
    aggs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("null_count"),
            F.count(time.from_digits(c)).alias("parsed_count"),
            F.count(F.when(F.col(c).isNotNull() & time.from_digits(c).isNull(), 1)).alias("rejected_count"),
        )
        for c in columns
    ]
    rows = df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
    return rows.select(F.lit(table).alias("table_name"), "*", _status(F.col("rejected_count") == 0))


def string_date_rejects(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with at least one date text that does not parse."""
    bad = [F.col(c).isNotNull() & time.from_digits(c).isNull() for c in columns]
    return df.where(reduce(lambda a, b: a | b, bad))


def fk_default(fact: DataFrame, table: str, keys: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key: rows, unknown (-1), NULL and orphaned references.

    ``keys`` maps a fact column to its dimension and the dimension's key. References are
    counted per key value first, so the check against the dimension sees each value once.
    """
    frames = []
    for column, (dim, dim_key) in keys.items():
        known = dim.select(F.col(dim_key).alias("_k")).distinct().withColumn("_known", F.lit(True))
        refs = fact.groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("n")).join(known, "_k", "left")
        is_unknown = F.col("_k") == UNKNOWN
        orphan = F.col("_k").isNotNull() & ~is_unknown & F.col("_known").isNull()

        def total(cond):
            return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

        counts = refs.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            total(is_unknown).alias("unknown_count"),
            total(F.col("_k").isNull()).alias("null_count"),
            total(orphan).alias("orphan_count"),
        )
        frames.append(
            counts.select(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("key_name"),
                "*",
                _status((F.col("null_count") == 0) & (F.col("orphan_count") == 0)),
            )
        )
    return _union(frames)


def _as_stored(kind: T.DataType) -> T.DataType:
    """The type as files give it back: every part may be NULL."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_stored(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_stored(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_as_stored(kind.keyType), _as_stored(kind.valueType))
    return kind


def schema_contract(df: DataFrame, table: str) -> DataFrame:
    """Declared against actual columns, plus a scan for NULL keys, NULL partition values and numbers that overflow.

    One row with the number of declared columns, of differences in name, order or type, nested fields
    included (files give every column back as nullable), the partition column's actual type, the rows
    that lie in the NULL partition, with a NULL key, and the values outside their declared precision: sums are stored
    with room for more. A table fails by all of these but NULL partition values, which events without a time may have.
    """
    spec = TABLES[table]
    expected, actual = spec.stored.fields, df.schema.fields
    differences = abs(len(expected) - len(actual)) + sum(
        1 for e, a in zip(expected, actual) if (e.name, _as_stored(e.dataType)) != (a.name, _as_stored(a.dataType))
    )
    have = {f.name: f.dataType for f in actual}
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.pk if c in have], F.lit(False))
    overflow = F.lit(0)
    for e in spec.schema.fields:
        if isinstance(e.dataType, T.DecimalType) and e.name in have:
            digits = e.dataType.precision - e.dataType.scale
            # No wider than it must be: next to a wide sum a wider type would round the sum to whole numbers.
            top = F.lit(10**digits).cast(T.DecimalType(digits + 1, 0))
            overflow = overflow + F.when(F.abs(F.col(e.name)) >= top, 1).otherwise(0)
    part = spec.partition if spec.partition in have else None
    counts = df.agg(
        F.count(F.when(F.col(part).isNull() if part else F.lit(False), 1)).alias("null_partition_rows"),
        F.count(F.when(null_key, 1)).alias("null_key_rows"),
        F.coalesce(F.sum(overflow), F.lit(0)).cast("long").alias("overflow_values"),
    )
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(len(expected)).cast("long").alias("declared_columns"),
        F.lit(differences).cast("long").alias("schema_differences"),
        F.lit(have[part].simpleString().upper() if part else None).cast("string").alias("partition_type"),
        "null_partition_rows",
        "null_key_rows",
        "overflow_values",
        _status((F.lit(differences) == 0) & (F.col("null_key_rows") == 0) & (F.col("overflow_values") == 0)),
    )


def negative_values(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Per measure that should not fall below zero: how many values do, and the smallest.

    Approved exceptions can exceed the time they are taken from.
    """
    aggs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("value_count"),
            F.count(F.when(F.col(c) < 0, 1)).alias("negative_count"),
            F.min(c).alias("min_value"),
        )
        for c in columns
    ]
    rows = df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
    return rows.select(F.lit(table).alias("table_name"), "*", _status(F.col("negative_count") == 0))


def scd2_integrity(history: DataFrame, table: str, keys: Sequence[str], id_column: str) -> DataFrame:
    """Surrogates that are not the MD5 of their parts, keys without exactly one current row, and
    versions whose end is not the start of the next one."""
    own = surrogate(*[F.col(k) for k in keys], utc_text(F.col("eff_from_ts")))
    rows = neighbour(
        history.select(id_column, *keys, "eff_from_ts", "eff_to_ts", "is_current"),
        keys,
        "eff_from_ts",
        [id_column],
        ["eff_from_ts"],
        "_next",
        following=True,
    )
    broken = ~F.col("eff_to_ts").eqNullSafe(F.col("_next.eff_from_ts"))
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~F.col(id_column).eqNullSafe(own), 1)).alias("bad_id"),
        F.count(F.when(F.col("is_current"), 1)).alias("current"),
        F.count(F.when(broken, 1)).alias("broken"),
    )
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("version_count"),
        F.coalesce(F.sum("bad_id"), F.lit(0)).alias("bad_surrogates"),
        F.count(F.when(F.col("current") != 1, 1)).alias("keys_without_one_current"),
        F.coalesce(F.sum("broken"), F.lit(0)).alias("broken_ranges"),
    )
    problems = F.col("bad_surrogates") + F.col("keys_without_one_current") + F.col("broken_ranges")
    return counts.select(F.lit(table).alias("table_name"), "*", _status(problems == 0))


def difference(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
    """Rows of each side that the other side lacks, as bags."""
    right = right.select(left.columns)
    sides = left.select(F.lit(1).alias("_side"), "*").unionByName(right.select(F.lit(-1).alias("_side"), "*"))
    net = sides.groupBy(*left.columns).agg(
        F.sum("_side").alias("_net"), F.count(F.when(F.col("_side") == 1, 1)).alias("_left")
    )
    counts = net.agg(
        F.coalesce(F.sum("_left"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("_net") > 0, F.col("_net"))), F.lit(0)).alias("missing_rows"),
        F.coalesce(F.sum(F.when(F.col("_net") < 0, -F.col("_net"))), F.lit(0)).alias("extra_rows"),
    )
    ok = (F.col("missing_rows") == 0) & (F.col("extra_rows") == 0)
    return counts.select(F.lit(label).alias("comparison"), "*", _status(ok))


def edge_values(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` as parquet, CSV and JSON lines, read each back and compare with the original.

    CSV is read with line breaks inside quotes, so texts may hold any character.
    """
    spark = df.sparkSession
    csv = {"header": True, "multiLine": True, "escape": '"', "lineSep": "\n"}
    csv |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.parquet(f"{folder}/parquet")
    df.write.options(**csv, emptyValue='""').csv(f"{folder}/csv")
    df.write.option("ignoreNullFields", False).json(f"{folder}/json")
    back = {
        "parquet": spark.read.schema(df.schema).parquet(f"{folder}/parquet"),
        "csv": spark.read.schema(df.schema)
        .options(**csv, emptyValue="", nullValue="\u0000")
        .csv(f"{folder}/csv"),
        "json": spark.read.schema(df.schema).json(f"{folder}/json"),
    }
    return _union([difference(df, other, name) for name, other in back.items()])


def dim_date_match(loaded: DataFrame, source: DataFrame) -> DataFrame:
    return difference(source, loaded, "dim_date")


def table_diff(left: DataFrame, right: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Column-by-column comparison of two tables on their key.

    One row per column with compared and differing values, a coverage row that counts keys
    found on one side only, and a row that counts keys repeated on a side: of those the
    greatest row is compared. NULLs are equal to each other. Both sides are reduced per key
    in one aggregation, so repeated keys never form pairs.
    """
    values = [c for c in left.columns if c not in pk]
    right = right.select(left.columns)
    packed = F.struct(*values)
    empty = F.when(F.lit(False), packed)
    sides = left.select(*pk, packed.alias("l"), empty.alias("r")).unionByName(
        right.select(*pk, empty.alias("l"), packed.alias("r"))
    )
    keys = sides.groupBy(*pk).agg(
        F.max("l").alias("l"), F.max("r").alias("r"), F.count("l").alias("n_l"), F.count("r").alias("n_r")
    )
    both = (F.col("n_l") > 0) & (F.col("n_r") > 0)
    repeated = (F.col("n_l") > 1) | (F.col("n_r") > 1)

    def line(name: str, compared: Column, differing: Column) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.when(compared, 1)).alias("compared"),
            F.count(F.when(differing, 1)).alias("differing"),
        )

    lines = [line(c, both, both & ~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))) for c in values]
    lines += [line("(coverage)", F.lit(True), ~both), line("(repeated keys)", F.lit(True), repeated)]
    rows = keys.agg(F.array(*lines).alias("a")).select(F.inline("a"))
    return rows.select("*", _status(F.col("differing") == 0))


def _checksums(df: DataFrame, key: str, values: Sequence[str], spans: Sequence[tuple[int, int]], width: int) -> DataFrame:
    """Rows and the sum of their hashes per ``width`` keys, of the rows whose key lies in one of the spans."""
    inside = reduce(lambda a, b: a | b, [F.col(key).between(low, high) for low, high in spans])
    hashed = F.xxhash64(*values).cast("decimal(38,0)")
    step = F.floor((F.col(key) - F.lit(spans[0][0])) / width).cast("long").alias("_step")
    return df.where(inside).groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("h"))


def unlike_ranges(
    left: DataFrame, right: DataFrame, key: str, *, fan: int = 64, levels: int = 2
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Ranges of an integer key in which two tables differ, and per level how many ranges were compared and differ.

    Each level cuts the ranges that differ into ``fan`` parts and compares counts and sums of row
    hashes per part; the filters on the key keep the scans out of all other ranges. At most
    ``fan`` numbers per unlike range of the level before come back.
    """
    values = left.columns
    bounds = left.select(key).unionByName(right.select(key)).agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    if bounds.low is None:
        return [], []
    width = bounds.high - bounds.low + 1
    spans, found = [(bounds.low, bounds.high)], []
    for _ in range(levels):
        width = -(-width // fan)
        a = _checksums(left, key, values, spans, width).alias("a")
        b = _checksums(right, key, values, spans, width).alias("b")
        same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.h").eqNullSafe(F.col("b.h"))
        both = a.join(b, "_step", "full").select("_step", same.alias("same")).collect()
        begin = spans[0][0]
        steps = sorted(r["_step"] for r in both if not r.same)
        found.append((len(both), len(steps)))
        # Parts are cut from the begin of the first span, so a part may reach over the end of its own.
        spans = [(begin + s * width, begin + (s + 1) * width - 1) for s in steps]
        if not spans:
            break
    return spans, found


def ranged_diff(left: DataFrame, right: DataFrame, key: str, *, fan: int = 64, levels: int = 2) -> DataFrame:
    """``table_diff`` of the key ranges in which two tables differ; the others are not read in full.

    Also one row per level with the ranges that hold rows and those that differ. Rows without a key are
    compared in full.
    """
    right = right.select(left.columns)
    spans, found = unlike_ranges(left, right, key, fan=fan, levels=levels)
    merged: list[tuple[int, int]] = []
    for low, high in spans:  # neighbours become one filter
        merged[-1:] = [(merged[-1][0], high)] if merged and low <= merged[-1][1] + 1 else [*merged[-1:], (low, high)]
    picked = reduce(lambda a, b: a | b, [F.col(key).between(*m) for m in merged], F.col(key).isNull())
    out = table_diff(left.where(picked), right.where(picked), [key])
    lines = [(f"(ranges, level {n + 1})", a, b, PASS if not b else FAIL) for n, (a, b) in enumerate(found)]
    return out.unionByName(left.sparkSession.createDataFrame(lines, "column_name string, compared long, differing long, status string"))


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Result rows of several checks as text, failures first, then a coverage line.

    Each check is written, and its shuffles removed, before the next begins.
    """
    lines = []
    for name, rows in checks.items():
        others = [c for c in rows.columns if c != "status"]
        parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in others]
        line = rows.select(F.lit(name).alias("check_name"), F.concat_ws(" ", *parts).alias("detail"), "status")
        lines.append(store(line, f"report-{name}"))
        drop_shuffles(line.sparkSession)
    found = _union(lines)
    totals = found.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("status") == FAIL, 1)).alias("bad"))
    coverage = totals.select(
        F.lit("coverage").alias("check_name"),
        F.concat(F.lit("checked "), F.col("n").cast("string"), F.lit(", failed "), F.col("bad").cast("string")).alias(
            "detail"
        ),
        _status(F.col("bad") == 0),
    )
    rank = F.when(F.col("check_name") == "coverage", 2).when(F.col("status") == FAIL, 0).otherwise(1)
    return found.unionByName(coverage).orderBy(rank, "check_name", "detail")
