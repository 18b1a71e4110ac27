"""Which inputs build which table, in load order, and the daily batch that runs it.

The order of `STEPS` is the load order: a step only reads staging tables and earlier steps.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.operators import orders
from switchboard.operators.runs import deliver
from switchboard.operators.sink import read_table, replace_partition, replace_table
from switchboard.plans import aggs, cleanse, dims, facts, history, masters, merges, views
from switchboard.schemas import TABLES, layer_of
from switchboard.session import apply_settings, fresh_path

DAY, WEEK, MONTH, WHOLE, STATE, HISTORY = "day", "week", "month", "whole", "state", "history"


@dataclass(frozen=True)
class Step:
    """``build(*inputs, run_date)`` makes ``target``; a STATE step also gets the stored table first.

    ``write`` says what a run replaces: what it delivered before for its day or month, the partition
    of its day, week or month, or the table; or that its delivery is merged into the stored state
    or history. A step with ``scoped`` inputs can be limited to
    some periods: it then reads only their days from these inputs.
    """

    target: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    write: str
    dated: bool = True
    scoped: tuple[str, ...] = ()

    def run(
        self,
        get: Callable[[str], DataFrame],
        run_date: dt.date,
        current: DataFrame | None = None,
        periods: set[dt.date] | None = None,
    ) -> DataFrame:
        limited = self.scoped if periods is not None else ()
        args = [self._within(get(i), periods) if i in limited else get(i) for i in self.inputs]
        if self.write == STATE:
            args.insert(0, current)
        return self.build(*args, run_date) if self.dated else self.build(*args)

    def period(self, day: dt.date) -> tuple[dt.date, dt.date]:
        """First and last day of the period that holds ``day``."""
        if self.write == WEEK:
            first = day - dt.timedelta(days=day.weekday())
            return first, first + dt.timedelta(days=6)
        if self.write == MONTH:
            first = day.replace(day=1)
            return first, (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
        return day, day

    def partition_value(self, first: dt.date) -> dt.date | int:
        """Partition of the period that starts on ``first``."""
        return _key(first) if TABLES[self.target].partition.endswith("_key") else first

    def _within(self, df: DataFrame, periods: set[dt.date]) -> DataFrame:
        """Rows of the periods, by a filter on the bare partition column."""
        if "date_key" in df.columns:
            spans = [F.col("date_key").between(*map(_key, self.period(p))) for p in sorted(periods)]
            return df.where(reduce(lambda a, b: a | b, spans))
        if "bill_period" in df.columns:
            return df.where(F.col("bill_period").isin([f"{p:%Y-%m}" for p in sorted(periods)]))
        return df.where(F.col("period_month").isin(sorted(periods)))


def _key(day: dt.date) -> int:
    return int(f"{day:%Y%m%d}")


def _day_of(value: dt.date | int) -> dt.date:
    """Day of a partition value: a date or a ``yyyymmdd`` key."""
    return value if isinstance(value, dt.date) else dt.datetime.strptime(str(value), "%Y%m%d").date()


def _agg(target: str, build, period: str, scoped: tuple[str, ...], *others: str) -> Step:
    return Step(target, build, (*scoped, *others), period, dated=False, scoped=scoped)


def _state(target: str, build, *inputs: str) -> Step:
    return Step(target, build, inputs, STATE, dated=False)


def _history(target: str, build, *inputs: str) -> Step:
    return Step(target, build, inputs, HISTORY, dated=False)


def _whole(target: str, build, *inputs: str) -> Step:
    return Step(target, build, inputs, WHOLE)


def _day(target: str, build, *inputs: str) -> Step:
    return Step(target, build, inputs, DAY)


STEPS: list[Step] = [
    # Masters, change feeds and histories.
    _state("ods_client_acid", merges.client, "stg_crm_client"),
    _state("ods_agent_acid", merges.agent, "stg_hr_agent"),
    _state("ods_ticket_acid", merges.ticket, "stg_tkt_ticket", "stg_tkt_ticket_event"),
    _state("ods_invoice_acid", merges.invoice, "stg_fin_invoice"),
    _state("ods_timesheet", merges.timesheet, "stg_fin_timesheet_delta"),
    _state("ods_payroll_adjustment", merges.payroll_adjustment, "stg_fin_payroll_adj_delta"),
    _state("ods_sla_credit", merges.sla_credit, "stg_crm_sla_credit_delta"),
    _state("ods_callback_request", merges.callback_request, "stg_tel_callback_request_delta"),
    _state("ods_shift_swap", merges.shift_swap, "stg_wfm_shift_swap_delta"),
    _state("ods_ticket_worklog", merges.ticket_worklog, "stg_tkt_worklog_delta"),
    _state("ods_attrition_event", merges.attrition_event, "stg_hr_attrition_event_delta"),
    _day("ods_rate_card", merges.rate_card, "stg_fin_rate_card", "stg_fin_rate_card_change_delta"),
    _history("ods_agent_scd2", history.agent, "stg_hr_agent", "stg_hr_employment_event"),
    _history("ods_agent_skill_scd2", history.agent_skill, "stg_hr_agent_skill", "stg_hr_skill"),
    _history("ods_agent_assignment_scd2", history.agent_assignment, "obs_assignment"),
    # Cleansing.
    _day("ods_program", cleanse.program, "stg_crm_program"),
    _day("ods_contract", cleanse.contract, "stg_crm_contract"),
    _day("ods_contract_line", cleanse.contract_line, "stg_crm_contract_line"),
    _day("ods_org_unit", cleanse.org_unit, "stg_hr_org_unit"),
    _day("ods_queue", cleanse.queue, "stg_tel_queue"),
    _day("ods_schedule", cleanse.schedule, "stg_wfm_schedule", "stg_wfm_shift"),
    _day("ods_adherence_event", cleanse.adherence_event, "stg_wfm_adherence_event"),
    _day("ods_call", cleanse.call, "stg_tel_call", "stg_tel_call_segment"),
    _day("ods_ivr_session", cleanse.ivr_session, "stg_file_ivr_logs"),
    _day("ods_chat_session", cleanse.chat_session, "stg_file_chat_transcripts"),
    _day("ods_email_interaction", cleanse.email_interaction, "stg_file_email_interaction"),
    _day("ods_survey_response", cleanse.survey_response, "stg_file_survey_csat"),
    _day("ods_qa_evaluation", cleanse.qa_evaluation, "stg_file_qa_forms"),
    _day("ods_dialer_attempt", cleanse.dialer_attempt, "stg_file_dialer_result"),
    _day(
        "ods_interaction",
        cleanse.interaction,
        "ods_call",
        "ods_chat_session",
        "ods_email_interaction",
        "stg_file_interaction_export",
    ),
    # Dimensions.
    _whole("dim_agent", dims.dim_agent, "ods_agent_scd2", "ods_agent_acid", "ods_org_unit"),
    _whole("dim_client", dims.dim_client, "ods_client_acid", "stg_crm_client_contact"),
    _whole("dim_program", dims.dim_program, "ods_program", "ods_contract"),
    _whole("dim_queue", dims.dim_queue, "ods_queue"),
    _whole("dim_site", dims.dim_site, "ods_org_unit"),
    _whole("dim_shift", dims.dim_shift, "stg_wfm_shift"),
    _whole("dim_org", dims.dim_org, "ods_org_unit"),
    _whole("dim_disposition", dims.dim_disposition, "stg_tel_disposition_code"),
    # Facts.
    _day("fact_interaction", facts.fact_interaction, "ods_interaction", "dim_agent", "dim_program", "dim_queue", "dim_client"),
    _day("fact_agent_activity", facts.fact_agent_activity, "stg_tel_agent_state_event", "ods_adherence_event", "dim_agent"),
    _day("fact_queue_interval", facts.fact_queue_interval, "ods_call", "dim_queue", "stg_crm_sla_target"),
    _day("fact_csat_survey", facts.fact_csat_survey, "ods_survey_response", "fact_interaction"),
    _day("fact_qa_evaluation", facts.fact_qa_evaluation, "ods_qa_evaluation", "fact_interaction"),
    Step(
        "fact_billing_line",
        facts.fact_billing_line,
        ("stg_fin_invoice_line", "ods_invoice_acid", "dim_program", "ods_client_acid", "ods_rate_card"),
        MONTH,
    ),
    _day(
        "fact_adherence_daily",
        facts.fact_adherence_daily,
        "ods_schedule",
        "ods_adherence_event",
        "stg_wfm_timeoff_request",
        "dim_agent",
    ),
    _day(
        "fact_ticket", facts.fact_ticket, "ods_ticket_acid", "stg_tkt_ticket_event", "stg_tkt_category", "dim_agent"
    ),
    _day("fact_ivr_path", facts.fact_ivr_path, "ods_ivr_session"),
    # Aggregates, from the days of their period.
    _agg(
        "agg_agent_daily",
        aggs.agg_agent_daily,
        DAY,
        ("fact_interaction", "fact_agent_activity", "fact_adherence_daily"),
        "dim_agent",
    ),
    _agg("agg_agent_weekly", aggs.agg_agent_weekly, WEEK, ("agg_agent_daily",)),
    _agg("agg_queue_hourly", aggs.agg_queue_hourly, DAY, ("fact_queue_interval",), "stg_wfm_forecast"),
    _agg(
        "agg_site_daily",
        aggs.agg_site_daily,
        DAY,
        ("fact_interaction", "fact_queue_interval", "fact_adherence_daily"),
        "dim_agent",
        "dim_queue",
        "dim_program",
    ),
    _agg(
        "agg_program_monthly",
        aggs.agg_program_monthly,
        MONTH,
        ("fact_interaction", "fact_csat_survey", "fact_billing_line"),
        "dim_program",
    ),
    _agg(
        "agg_csat_rollup_monthly", aggs.agg_csat_rollup_monthly, MONTH, ("fact_csat_survey",), "dim_program"
    ),
    _agg(
        "agg_billing_monthly",
        aggs.agg_billing_monthly,
        MONTH,
        ("fact_billing_line", "ods_sla_credit", "stg_file_telco_invoice"),
        "dim_client",
    ),
]

VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "vw_org_hierarchy": (views.org_hierarchy, ("ods_org_unit",)),
    "vw_active_agents_ndv": (views.active_agents_ndv, ("fact_interaction", "dim_agent")),
    "vw_csat_rollup": (views.csat_rollup, ("fact_csat_survey", "dim_program")),
    "vw_call_driver_regex": (views.call_driver_regex, ("ods_call", "dim_disposition")),
    "vw_repeat_contact_window": (views.repeat_contact_window, ("ods_interaction",)),
    "vw_billing_reconciliation": (views.billing_reconciliation, ("stg_fin_invoice", "ods_invoice_acid")),
    "vw_agent_roster_current": (views.agent_roster_current, ("ods_agent_scd2", "ods_agent_assignment_scd2")),
    "vw_agent_scorecard": (
        views.agent_scorecard,
        ("agg_agent_daily", "fact_qa_evaluation", "ods_agent_skill_scd2", "dim_agent"),
    ),
    "vw_attrition_risk": (views.attrition_risk, ("fact_adherence_daily", "ods_attrition_event", "dim_agent")),
    "vw_queue_sla_attainment": (
        views.queue_sla_attainment,
        ("fact_queue_interval", "dim_queue", "stg_crm_sla_target"),
    ),
    "vw_first_contact_resolution": (views.first_contact_resolution, ("fact_interaction",)),
    "vw_occupancy_utilization": (views.occupancy_utilization, ("fact_agent_activity", "dim_agent")),
    "vw_shrinkage_analysis": (
        views.shrinkage_analysis,
        ("fact_adherence_daily", "dim_agent", "ods_schedule", "dim_shift"),
    ),
    "vw_program_margin": (
        views.program_margin,
        ("agg_billing_monthly", "ods_timesheet", "ods_payroll_adjustment", "ods_contract_line", "ods_contract"),
    ),
    "vw_client_executive_summary": (
        views.client_executive_summary,
        (
            "dim_client",
            "dim_program",
            "agg_program_monthly",
            "agg_csat_rollup_monthly",
            "agg_billing_monthly",
            "fact_ticket",
        ),
    ),
}


def table_path(root: str, name: str) -> str:
    return f"{root}/{layer_of(name)}/{name}"


def run_day(
    spark: SparkSession,
    root: str,
    staging: Callable[[str], DataFrame],
    run_date: dt.date,
    *,
    only: set[str] | None = None,
    changes_from: dt.date | None = None,
) -> None:
    """Load every table of ``root`` for ``run_date``, in order; ``staging`` gives the raw inputs.

    Days may be run in any order, and again. Rows are stored by the run that delivered them, so a
    run replaces its own rows in every partition and no others. Masters take the run date's delivery,
    histories its observations, change-merged tables the changes of extract dates from
    ``changes_from`` on (the run date unless told otherwise); what they keep is decided by the times
    in the rows. Aggregates are refreshed for the run's period and for every period that late rows
    or changes of this run have touched. Tables that are replaced whole show the last run.
    """
    apply_settings(spark)
    built = {s.target for s in STEPS}
    # Partitions that this run has written, per table: what aggregates above must refresh.
    written: dict[str, set] = {}

    def get(name: str) -> DataFrame:
        return read_table(spark, table_path(root, name), name) if name in built else staging(name)

    for step in STEPS:
        if only is not None and step.target not in only:
            continue
        path = table_path(root, step.target)
        if step.scoped:
            days = {run_date} | {_day_of(v) for i in step.scoped for v in written.get(i, ()) if v is not None}
            periods = {step.period(d)[0] for d in days}
            rows = step.run(get, run_date, periods=periods)
            values = {step.partition_value(p) for p in periods}
            written[step.target] = replace_partition(rows, path, step.target, values, mode="strict")
        elif step.write in (DAY, MONTH):
            written[step.target] = deliver(step.run(get, run_date), path, step.target, step.period(run_date)[0])
        elif step.write == HISTORY:
            observed = masters.observed_on(step.target, get, run_date)
            written[step.target] = masters.splice_history(spark, path, step.target, observed, run_date)
        elif step.target in masters.MASTERS:
            masters.load_master(spark, path, step.target, get, run_date)
        elif step.write == STATE:
            feed = get(step.inputs[0]).where(F.col("extract_date") >= F.lit(changes_from or run_date))
            written[step.target] = masters.merge_changes(spark, path, step.target, feed, step.build)
        else:
            replace_table(step.run(get, run_date), path, step.target)
    refresh_views(spark)


# The views whose ranks, neighbours or counts run along a whole order.
ORDERED = {"vw_repeat_contact_window", "vw_agent_scorecard", "vw_attrition_risk", "vw_first_contact_resolution"}
# Per application: what its views were registered over.
_registered: dict[str, tuple[Callable[[str], DataFrame], orders.Kept]] = {}


def register_views(spark: SparkSession, get: Callable[[str], DataFrame], bounds: str | None = None) -> None:
    """Make the analyst queries available to SQL under their names.

    They are plans over the tables that ``get`` gives; nothing is computed but, the first time, the
    bounds of the orders, which are kept in the folder ``bounds``. ``run_day`` refreshes the views, so
    that they show its rows and need not be registered again.
    """
    kept = orders.Kept(spark, bounds or fresh_path(spark, "bounds"))
    _registered[spark.sparkContext.applicationId] = (get, kept)
    refresh_views(spark)


def refresh_views(spark: SparkSession) -> None:
    """Let registered views look at the tables' present files, over the bounds that are kept."""
    if spark.sparkContext.applicationId not in _registered:
        return
    get, kept = _registered[spark.sparkContext.applicationId]
    for name, (build, inputs) in VIEWS.items():
        frames = [get(i) for i in inputs]
        (build(*frames, kept=kept) if name in ORDERED else build(*frames)).createOrReplaceTempView(name)
