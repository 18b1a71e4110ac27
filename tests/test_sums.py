"""Totals beyond the declared precision of their column."""

import datetime as dt
from decimal import Decimal

from switchboard.operators import sink
from switchboard.plans import aggs, quality
from switchboard.schemas import TABLES
from switchboard.session import fresh_path

MONTH = dt.date(2024, 1, 1)
MOST, MOST_12 = Decimal("999999999999.99"), Decimal("9999999999.99")


def table(spark, name, *records):
    spec = TABLES[name]
    return spark.createDataFrame([tuple(r.get(c) for c in spec.names) for r in records], spec.schema)


def lines(spark):
    return table(
        spark, "fact_billing_line", *[{"client_sk": 1, "program_sk": p, "line_amount": MOST, "period_month": MONTH} for p in (7, 7, 8)]
    )


def billing(spark):
    credits = table(spark, "ods_sla_credit", *[{"program_id": 7, "credit_amount": MOST_12, "period_month": MONTH}] * 2)
    telco = table(spark, "stg_file_telco_invoice", *[{"client_code": "CL1", "charge_amount": MOST_12, "bill_period": "2024-01"}] * 2)
    client = table(spark, "dim_client", {"client_sk": 1, "client_id": 1, "client_code": "CL1"})
    return aggs.agg_billing_monthly(lines(spark), credits, telco, client)


def test_billing_totals_beyond_the_declared_precision_are_whole(spark, rows):
    out = billing(spark)
    columns = ("program_sk", "billed_amount", "sla_credit_amount", "telco_cost_amount", "net_revenue")
    assert rows(out, *columns) == [
        (7, 2 * MOST, 2 * MOST_12, 2 * MOST_12, 2 * MOST - 2 * MOST_12),
        (8, MOST, Decimal("0.00"), 2 * MOST_12, MOST),
    ]
    path = fresh_path(spark, "sums")
    sink.replace_table(out, path, "agg_billing_monthly")
    assert rows(sink.read_table(spark, path, "agg_billing_monthly"), *columns) == rows(out, *columns)


def test_rollup_totals_beyond_the_declared_precision_are_whole(spark, rows):
    fact, survey = table(spark, "fact_interaction"), table(spark, "fact_csat_survey")
    program = table(spark, "dim_program", *[{"program_sk": p, "client_id": 1, "line_of_business": "X"} for p in (7, 8)])
    out = aggs.agg_program_monthly(fact, survey, lines(spark), program)
    got = rows(out, "program_sk", "grouping_level", "billed_amount")
    assert (7, 0, 2 * MOST) in got and (None, 3, 3 * MOST) in got and (None, 7, 3 * MOST) in got


def test_contract_counts_totals_beyond_the_declared_precision(spark):
    out = quality.schema_contract(billing(spark), "agg_billing_monthly").first()
    # All four totals of program 7 and the carrier cost of program 8.
    assert (out.schema_differences, out.overflow_values, out.status) == (0, 5, "FAIL")
    assert TABLES["agg_billing_monthly"].schema["billed_amount"].dataType.precision == 14
