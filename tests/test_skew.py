"""The forms for hot keys give what the plain forms give."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from switchboard.operators import ranking, skew, slices, textagg
from switchboard.operators.scd2 import history
from switchboard.plans import facts, views


@pytest.fixture(scope="module")
def contacts(spark):
    """A third of all rows belong to one customer, some to none."""
    rows = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("c"), (F.col("id") % 40).cast("string"))).alias("customer_ref"),
        F.timestamp_seconds(F.lit(1705276800) + F.pmod(F.xxhash64("id"), F.lit(40 * 86400))).alias("start_ts"),
    )
    rows = rows.withColumn("end_ts", F.expr("start_ts + make_dt_interval(0, 0, 0, pmod(id, 7000))"))
    rows = rows.withColumn("end_ts", F.when(F.col("id") % 17 != 0, F.col("end_ts")))
    return rows.withColumns(
        {
            "resolved_flag": F.col("id") % 5 != 0,
            "date_key": F.lit(20240115).cast("long"),
            "program_sk": F.col("id") % 4,
            "interaction_id": F.col("id").cast("string"),
            "channel": F.lit("V"),
        }
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(spark, contacts, rows, how):
    left = contacts.select("id", "customer_ref")
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("c1", 3), ("c2", 4), (None, 5)], "customer_ref string, v long"
    )
    plain = left.join(right, "customer_ref", how).select("id", "customer_ref", "v")
    spread = skew.spread_join(left, right, "customer_ref", how=how)
    assert rows(spread, "id", "customer_ref", "v") == rows(plain)


def test_join_many_equals_plain_left_join(spark, contacts, rows):
    left = spark.createDataFrame([("hot", 1), ("c1", 3), ("nobody", 4), (None, 5)], "customer_ref string, v long")
    right = contacts.select("customer_ref", "id")
    plain = left.join(right, "customer_ref", "left").select("customer_ref", "v", "id")
    assert rows(skew.join_many(left, right, "customer_ref"), "customer_ref", "v", "id") == rows(plain)


def test_lookup_keeps_rows_without_a_key(spark, contacts, rows):
    dim = spark.createDataFrame([("hot", 9), (None, 8)], "customer_ref string, sk long")
    out = skew.lookup(contacts.select("id", "customer_ref"), dim, "customer_ref")
    assert out.count() == contacts.count()
    assert out.where("customer_ref is null and sk is not null").isEmpty()
    assert out.where("sk = 9").count() == contacts.where("customer_ref = 'hot'").count()


@pytest.mark.parametrize("following", [False, True])
def test_neighbour_equals_plain_window(contacts, rows, following):
    df = contacts.select("id", "customer_ref", "start_ts")
    w = Window.partitionBy("customer_ref").orderBy("start_ts", "id")
    step = F.lead if following else F.lag
    plain = df.select("id", step("id").over(w), step("start_ts").over(w))
    out = slices.neighbour(
        df, ["customer_ref"], "start_ts", ["id"], ["id", "start_ts"], "n", following=following
    )
    assert rows(out, "id", "n.id", "n.start_ts") == rows(plain)


@pytest.mark.parametrize("per_interaction", [False, True])
def test_first_contact_resolution_equals_interval_join(contacts, rows, per_interaction):
    f, r = contacts.alias("f"), contacts.alias("r")
    joined = f.where("resolved_flag").join(
        r,
        (F.col("f.customer_ref") == F.col("r.customer_ref"))
        & (F.col("r.start_ts") > F.col("f.end_ts"))
        & (F.col("r.start_ts") <= F.col("f.end_ts") + F.expr("INTERVAL 7 DAYS")),
        "left",
    )
    total = F.count_distinct("f.id") if per_interaction else F.count(F.lit(1))
    brute = joined.groupBy("f.date_key", "f.program_sk").agg(
        total, F.count(F.when(F.col("r.id").isNull(), 1))
    )
    out = views.first_contact_resolution(contacts, per_interaction=per_interaction)
    assert rows(out, "date_key", "program_sk", "resolved_interactions", "fcr_count") == rows(brute)


def test_repeat_contacts_do_not_depend_on_ranges(spark, contacts, rows):
    whole = rows(views.repeat_contact_window(contacts))
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert rows(views.repeat_contact_window(contacts)) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ordered_join_equals_sorted_concatenation(contacts):
    df = contacts.select("customer_ref", (F.unix_seconds("start_ts") * 1000).alias("ms"), "interaction_id")
    out = textagg.ordered_join(df, ["customer_ref"], "ms", "interaction_id", ">", "path")
    got = {r.customer_ref: r.path for r in out.collect()}
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.ms, r.interaction_id)):
        want.setdefault(r.customer_ref, []).append(r.interaction_id)
    assert got == {k: ">".join(v) for k, v in want.items()}


def test_history_does_not_depend_on_ranges(spark, contacts, rows):
    seen = contacts.where("customer_ref is not null").select(
        F.col("customer_ref").alias("agent_id"), (F.col("id") % 2).alias("unit"), F.col("start_ts").alias("seen_ts")
    )
    whole = rows(history(seen, ["agent_id"], ["unit"], "seen_ts", "h"))
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert rows(history(seen, ["agent_id"], ["unit"], "seen_ts", "h")) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def _scores(spark):
    values = [(i, None if i % 11 == 0 else float(i % 13)) for i in range(200)]
    return spark.createDataFrame(values, "id long, score double")


def test_positions_and_tiles_equal_global_windows(spark, rows):
    df = _scores(spark)
    order = Window.orderBy(F.col("score").desc_nulls_last(), "id")
    plain = df.select("id", F.row_number().over(order), *[F.ntile(t).over(order) for t in (3, 7, 500)])
    out = ranking.row_positions(df, [*ranking.descending("score"), *ranking.ascending("id")])
    tiles = [ranking.ntile(t, F.col("position"), F.col("position_total")) for t in (3, 7, 500)]
    assert rows(out, "id", "position", *tiles) == rows(plain)


def test_tie_ranks_equal_global_windows(spark, rows):
    df = _scores(spark)
    order = Window.orderBy(F.col("score").asc_nulls_first())
    plain = df.select("id", F.rank().over(order), F.dense_rank().over(order), F.percent_rank().over(order))
    out = ranking.tie_ranks(df, ranking.ascending("score"), "r")
    pct = ranking.percent_rank(F.col("r"), F.col("r_total"))
    assert rows(out, "id", "r", "r_dense", pct) == rows(plain)


def test_ranking_of_nothing_and_of_one_row(spark):
    empty = _scores(spark).where("id < 0")
    assert ranking.row_positions(empty, ranking.ascending("id")).count() == 0
    one = ranking.tie_ranks(_scores(spark).where("id = 5"), ranking.ascending("score"), "r")
    assert one.select("r", "r_dense", "r_total", ranking.percent_rank(F.col("r"), F.col("r_total"))).collect() == [
        (1, 1, 1, 0.0)
    ]


def test_billing_keeps_every_line_of_a_hot_invoice(spark):
    day = dt.date(2024, 1, 15)
    line = spark.range(100).select(
        F.col("id").alias("invoice_line_id"),
        F.when(F.col("id") < 40, 1).otherwise(F.col("id")).cast("long").alias("invoice_id"),
        F.lit(1).cast("decimal(12,2)").alias("qty"),
        F.lit(2).cast("decimal(12,4)").alias("unit_rate"),
        F.lit(3).cast("decimal(14,2)").alias("line_amount"),
        F.lit(False).alias("adjustment_flag"),
    )
    invoice = spark.range(100).select(
        F.col("id").alias("invoice_id"),
        F.lit(5).cast("long").alias("client_id"),
        F.lit(6).cast("long").alias("program_id"),
        F.lit("O").alias("status"),
        F.lit("2024-01").alias("period_month"),
    )
    program = spark.createDataFrame([(6, 6)], "program_id long, program_sk long")
    client = spark.createDataFrame([(7,)], "client_id long")
    card = spark.createDataFrame(
        [(1, 6, "S", "9", day, None), (2, 6, "T", "8", day, None)],
        "rate_card_id long, program_id long, service_code string, rate string, snapshot_date date, effective_ts timestamp",
    )
    out = facts.fact_billing_line(line, invoice, program, client, card, day)
    assert out.count() == 200
    assert out.select("invoice_line_id").distinct().count() == 100
    assert {r.client_sk for r in out.collect()} == {5}
    single = facts.fact_billing_line(line, invoice, program, client, card, day, one_rate_per_program=True)
    assert single.count() == 100 and {r.service_code for r in single.collect()} == {"T"}


def test_join_many_shuffles_the_left_side_once(spark, rows):
    left = spark.range(1000).selectExpr("if(id % 10 = 0, null, id % 7) as k", "id as v")
    right = spark.range(50).selectExpr("if(id % 5 = 0, null, id % 4) as k", "id as w")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        out = skew.join_many(left, right, "k")
        got = rows(out, "k", "v", "w")
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert got == rows(left.join(right, "k", "left").select("k", "v", "w"))
    finally:
        spark.conf.set(name, before)
    assert "ReusedExchange" in plan and plan.count("Range (0, 1000") == 1
