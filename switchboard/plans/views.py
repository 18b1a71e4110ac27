"""The fifteen analyst queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.functions import time
from switchboard.functions.numbers import count_if, ratio, round_long
from switchboard.functions.text import EMBEDDED_REF, call_driver, first_group
from switchboard.operators import orders, ranking
from switchboard.operators.dedup import greatest_by
from switchboard.operators.slices import count_following, neighbour
from switchboard.operators.tree import root_paths
from switchboard.plans.aggs import HANDLE_STATES, PROMOTER, READY
from switchboard.plans.facts import SL_METRIC

# Contact windows, amount tolerance, blended labour rate, open ticket statuses.
REPEAT_SECONDS = 259_200
FOLLOW_UP_SECONDS = 7 * time.DAY_SECONDS
AMOUNT_TOLERANCE = "0.01"
LABOUR_RATE = 18.50
SKETCH_BITS = 12
OPEN_STATUSES = ("OPEN", "PENDING")


def newest(df: DataFrame, keys: list[str], day: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot of each key, or of the whole table without keys."""
    last = df.groupBy(*keys).agg(F.max(day).alias("_last"))
    if not keys:  # one row
        return df.join(F.broadcast(last), F.col(day).eqNullSafe(F.col("_last"))).drop("_last")
    last = last.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.col(day).eqNullSafe(F.col("_last"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(last, same).drop("_last", *[f"_{k}" for k in keys])


def org_hierarchy(org_unit: DataFrame) -> DataFrame:
    """Paths of all units, of the newest snapshot where the table holds several."""
    if "snapshot_date" in org_unit.columns:
        org_unit = newest(org_unit, [])
    keep = ["org_unit_id", "unit_code", "unit_name", "unit_type", "site_code"]
    rows = root_paths(org_unit, "org_unit_id", "parent_unit_id", "unit_name", keep)
    return rows.select(*keep, "root_unit_id", "depth", "path_names")


def active_agents_ndv(interaction: DataFrame, agent: DataFrame, rsd: float = 0.05) -> DataFrame:
    """Approximate active agents and agent-channel pairs per day and site."""
    sites = agent.select("agent_sk", "site_code")
    pair = F.concat(F.col("agent_sk").cast("string"), F.lit("|"), F.col("channel"))
    return (
        interaction.join(sites, "agent_sk")
        .groupBy("date_key", "site_code")
        .agg(
            F.approx_count_distinct("agent_sk", rsd).alias("approx_active_agents"),
            F.approx_count_distinct(pair, rsd).alias("approx_agent_channel_pairs"),
            F.count(F.lit(1)).alias("interactions"),
        )
    )


def active_agent_sketches(fact: DataFrame, agent: DataFrame) -> DataFrame:
    """Per day and site a sketch of the agents that handled interactions, to be stored by the daily batch."""
    return (
        fact.join(agent.select("agent_sk", "site_code"), "agent_sk")
        .groupBy("date_key", "site_code")
        .agg(F.hll_sketch_agg("agent_sk", SKETCH_BITS).alias("agents"), F.count(F.lit(1)).alias("interactions"))
    )


def active_agents_over(sketches: DataFrame, *period: Column) -> DataFrame:
    """Active agents of any periods from the stored sketches; no fact is read. With ``SKETCH_BITS`` of 12
    the relative standard error is 1.6 %, and up to some hundred agents the estimate is the count."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("agents")).alias("active_agents")
    return sketches.groupBy(*period).agg(merged, F.sum("interactions").alias("interactions"))


def csat_rollup(survey: DataFrame, program: DataFrame) -> DataFrame:
    """Rollup of client and program with the grouping bit mask.

    Surveys are totalled per program before the join and the rollup expands those totals only.
    """
    totals = survey.groupBy("program_sk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("csat_score").alias("csat"),
        F.count("csat_score").alias("csat_n"),
        count_if(F.col("nps_score") >= PROMOTER).alias("up"),
    )
    rows = totals.join(program.select("program_sk", "client_id", "program_code"), "program_sk")
    return (
        rows.rollup("client_id", "program_code")
        .agg(
            F.sum("n").alias("surveys"),
            (F.sum("csat") / F.sum("csat_n")).alias("avg_csat"),
            (F.sum("up") / F.sum("n") * 100).alias("pct_promoters"),
            F.grouping_id().cast("long").alias("grouping_level"),
        )
        .select("client_id", "program_code", "surveys", "avg_csat", "pct_promoters", "grouping_level")
    )


def call_driver_regex(call: DataFrame, disposition: DataFrame) -> DataFrame:
    """Calls by driver class and embedded reference.

    The patterns run once per disposition, not once per call; calls are totalled per code first.
    """
    totals = call.groupBy("call_date", "queue_id", "disposition_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("talk_seconds").alias("talk"),
        F.count("talk_seconds").alias("talk_n"),
    )
    classes = disposition.select(
        "disposition_code",
        call_driver(F.col("disposition_desc")).alias("call_driver"),
        first_group(F.col("disposition_desc"), EMBEDDED_REF).alias("embedded_ref_no"),
    )
    return (
        totals.join(classes, "disposition_code")
        .groupBy("call_date", "queue_id", "call_driver", "embedded_ref_no")
        .agg(F.sum("n").alias("calls"), ratio(F.sum("talk"), F.sum("talk_n")).alias("avg_talk_seconds"))
    )


def repeat_contact_window(interaction: DataFrame, kept: orders.Kept | None = None) -> DataFrame:
    """Previous contact of the customer and whether it was within 72 hours.

    Contacts that start together are ordered by interaction id. Customers with very many
    contacts (a shared mailbox counts as one customer) fill several ranges of the order.
    """
    rows = interaction.where(F.col("customer_ref").isNotNull() & (F.col("customer_ref") != "")).select(
        "interaction_id", "customer_ref", "channel", "start_ts"
    )
    timed, untimed = rows.where(F.col("start_ts").isNotNull()), rows.where(F.col("start_ts").isNull())
    timed = neighbour(
        timed,
        ["customer_ref"],
        "start_ts",
        ["interaction_id", "channel"],
        ["start_ts"],
        "_prev",
        bounds=orders.named(kept, "repeat_contact_window"),
    )
    timed = timed.withColumn("prev_contact_ts", F.col("_prev.start_ts")).drop("_prev")
    both = timed.unionByName(untimed, allowMissingColumns=True)
    gap = time.seconds("start_ts") - time.seconds("prev_contact_ts")
    repeated = F.when(gap <= REPEAT_SECONDS, 1).otherwise(0).cast("long")
    return both.select(*rows.columns, "prev_contact_ts", repeated.alias("repeat_within_72h"))


def billing_reconciliation(staged: DataFrame, invoice: DataFrame, *, floor_ms: bool = False) -> DataFrame:
    """Staged against master amount and issue time.

    Staged milliseconds are rounded to seconds while the master's are cut off, so issue times
    from half a second on differ by one; ``floor_ms`` cuts both off.
    """
    raw = F.col("issued_ts_sec") / 1000
    second = F.floor(raw).cast("long") if floor_ms else round_long(raw)
    lhs = staged.select(
        "invoice_id", "invoice_no", F.col("total_amount").alias("staged_amount"), second.alias("_s")
    )
    rhs = invoice.select(
        "invoice_id", F.col("total_amount").alias("ods_amount"), F.col("issued_ts").alias("ods_issued_ts")
    )
    drift = time.seconds("ods_issued_ts") - F.col("_s")
    off = F.abs(F.col("staged_amount") - F.col("ods_amount")) > F.lit(AMOUNT_TOLERANCE).cast("decimal(5,2)")
    return lhs.join(rhs, "invoice_id").select(
        "invoice_no",
        "staged_amount",
        "ods_amount",
        time.from_seconds("_s").alias("staged_issued_ts"),
        "ods_issued_ts",
        drift.alias("drift_seconds"),
        F.when(off, "AMOUNT_MISMATCH").when(drift != 0, "TS_MISMATCH").otherwise("OK").alias("recon_status"),
    )


def agent_roster_current(history: DataFrame, assignment: DataFrame) -> DataFrame:
    """Newest slice per agent, whatever its flag says, with the current assignments.

    An agent with several current assignments appears once per assignment.
    """
    kept = ["employee_no", "org_unit_id", "job_grade", "employment_type", "status", "eff_from_ts"]
    order = [F.col(c) for c in ("eff_from_ts", "agent_history_id")]
    newest = greatest_by(history, ["agent_id"], order, kept)
    current = assignment.where(F.col("is_current")).select(
        "agent_id",
        F.col("program_id").alias("current_program_id"),
        F.col("queue_id").alias("current_queue_id"),
        "role_on_program",
    )
    return newest.join(current, "agent_id", "left")


def agent_scorecard(
    daily: DataFrame, evaluation: DataFrame, skill: DataFrame, agent: DataFrame, kept: orders.Kept | None = None
) -> DataFrame:
    """Averages per current agent, percent rank of handle time and quartile of QA score.

    The quartile orders equal scores by agent.
    """
    perf = daily.groupBy("agent_sk").agg(
        F.avg("avg_handle_seconds").alias("aht"),
        F.avg("adherence_pct").alias("adherence"),
        F.sum("interactions_handled").alias("volume"),
    )
    qa = evaluation.groupBy("agent_sk").agg(F.avg("overall_pct").alias("avg_qa_pct"))
    skills = (
        skill.where(F.col("is_current") & F.col("certified"))
        .groupBy("agent_id")
        .agg(F.count(F.lit(1)).alias("certified_skills"))
    )
    rows = (
        agent.where(F.col("is_current"))
        .select("agent_sk", "agent_id", "full_name", "site_code", "job_grade")
        .join(perf, "agent_sk")
        .join(qa, "agent_sk", "left")
        .join(skills, "agent_id", "left")
        .withColumn("certified_skills", F.coalesce("certified_skills", F.lit(0)))
    )
    rows = orders.ranks(rows, ranking.ascending("aht"), "_r", orders.named(kept, "agent_scorecard_aht"))
    rows = rows.withColumn("aht_pctile", ranking.percent_rank(F.col("_r"), F.col("_r_total")))
    order = [*ranking.descending("avg_qa_pct"), *ranking.ascending("agent_sk")]
    rows = orders.positions(rows, order, "_p", orders.named(kept, "agent_scorecard_qa"))
    return rows.withColumn("qa_quartile", ranking.ntile(4, F.col("_p"), F.col("_p_total"))).select(
        "agent_sk",
        "full_name",
        "site_code",
        "job_grade",
        "aht",
        "adherence",
        "volume",
        "avg_qa_pct",
        "certified_skills",
        "aht_pctile",
        "qa_quartile",
    )


def attrition_risk(
    adherence: DataFrame, notice: DataFrame, agent: DataFrame, kept: orders.Kept | None = None
) -> DataFrame:
    """Risk of active agents: HIGH in the lowest adherence fifth or with any notice, MEDIUM in the
    second fifth. Weekly volume does not enter the result, so it is not read."""
    adh = adherence.groupBy("agent_sk").agg(F.avg("adherence_pct").alias("adherence_90d"))
    notices = notice.groupBy("agent_id").agg(F.count(F.lit(1)).alias("notice_events"))
    rows = (
        agent.where(F.col("is_current") & (F.col("status") == "ACTIVE"))
        .select("agent_sk", "agent_id", "full_name", "site_code")
        .join(adh, "agent_sk")
        .join(notices, "agent_id", "left")
        .withColumn("notice_events", F.coalesce("notice_events", F.lit(0)))
    )
    order = [*ranking.ascending("adherence_90d"), *ranking.ascending("agent_sk")]
    rows = orders.positions(rows, order, "_p", orders.named(kept, "attrition_risk"))
    band = ranking.ntile(5, F.col("_p"), F.col("_p_total"))
    risk = F.when((band == 1) | (F.col("notice_events") > 0), "HIGH").when(band == 2, "MEDIUM").otherwise("LOW")
    return rows.select(
        "agent_sk",
        "agent_id",
        "full_name",
        "site_code",
        "adherence_90d",
        "notice_events",
        risk.alias("attrition_risk"),
    )


def queue_sla_attainment(interval: DataFrame, queue: DataFrame, target: DataFrame) -> DataFrame:
    """Service level per queue and day against its target; a missing level or target is MISSED.

    Several targets of a queue repeat its intervals in both sums, which leaves the quotient
    as it is; the highest target counts. So targets are reduced to one row per queue.
    """
    totals = interval.groupBy("queue_sk", "date_key").agg(
        F.sum("answered_in_sl").alias("in_sl"), F.sum("answered").alias("answered")
    )
    targets = (
        target.where(F.col("metric_code") == SL_METRIC)
        .groupBy("queue_id")
        .agg(F.max("target_value").alias("target_value"), F.count(F.lit(1)).alias("copies"))
    )
    rows = totals.join(
        queue.select("queue_sk", "queue_id", "queue_code", "media_type"), "queue_sk"
    ).join(targets, "queue_id", "left")
    copies = F.coalesce("copies", F.lit(1))
    grouped = rows.groupBy("queue_code", "media_type", "date_key").agg(
        (ratio(F.sum(F.col("in_sl") * copies), F.sum(F.col("answered") * copies)) * 100).alias("sl_pct"),
        F.max("target_value").alias("sl_target"),
    )
    met = F.col("sl_pct") >= F.col("sl_target")
    return grouped.withColumn("attainment", F.when(met, "MET").otherwise("MISSED"))


def first_contact_resolution(
    interaction: DataFrame,
    kept: orders.Kept | None = None,
    *,
    per_interaction: bool = False,
) -> DataFrame:
    """Share of resolved interactions without another contact of the customer within 7 days.

    As in the interval self-join, an interaction with several later contacts counts once per
    contact in the denominator; ``per_interaction`` counts it once. Only the number of later
    contacts is needed, so no pair is ever formed. Interactions without a customer or an end
    match nothing and count as first-contact successes.
    """
    counted = count_following(
        interaction.select("customer_ref", "start_ts", "end_ts", "resolved_flag", "date_key", "program_sk"),
        "customer_ref",
        "start_ts",
        "end_ts",
        FOLLOW_UP_SECONDS,
        ["date_key", "program_sk"],
        asks="resolved_flag",
        bounds=orders.named(kept, "first_contact_resolution"),
    )
    weight = F.col("rows") if per_interaction else F.col("rows") * F.greatest("matches", F.lit(1))
    grouped = counted.groupBy("date_key", "program_sk").agg(
        F.sum(weight).alias("resolved_interactions"),
        F.sum(F.when(F.col("matches") == 0, F.col("rows")).otherwise(0)).alias("fcr_count"),
    )
    return grouped.withColumn("fcr_pct", F.col("fcr_count") / F.col("resolved_interactions") * 100)


def occupancy_utilization(activity: DataFrame, agent: DataFrame) -> DataFrame:
    def seconds_in(cond):
        return F.sum(F.when(cond, F.col("state_seconds")).otherwise(0))

    state = F.col("state_code")
    rows = activity.groupBy("date_key", "agent_sk").agg(
        seconds_in(state.isin(*HANDLE_STATES)).alias("handle_seconds"),
        seconds_in(state == READY).alias("ready_seconds"),
        seconds_in(state.startswith("AUX")).alias("aux_seconds"),
        seconds_in(state.isin(*HANDLE_STATES, READY)).alias("_staffed"),
    )
    return rows.join(agent.select("agent_sk", "site_code"), "agent_sk").select(
        "date_key",
        "site_code",
        "agent_sk",
        "handle_seconds",
        "ready_seconds",
        "aux_seconds",
        (ratio(F.col("handle_seconds"), F.col("_staffed")) * 100).alias("occupancy_pct"),
    )


def shrinkage_analysis(
    adherence: DataFrame, agent: DataFrame, schedule: DataFrame, shift: DataFrame
) -> DataFrame:
    """Lost against scheduled minutes per day and site, with schedules and overnight shifts.

    Minutes of an agent-day count once per schedule of that day, as in the join of the two
    tables. They are weighted by the number of schedules instead of being repeated; schedules
    and shifts are counted on their own, from the schedule side.
    """
    grain = ["date_key", "site_code"]
    minutes = adherence.join(agent.select("agent_sk", "agent_id", "site_code"), "agent_sk")
    minutes = minutes.withColumn("lost", F.col("exception_minutes") + F.col("timeoff_minutes"))
    overnight = shift.where(F.col("overnight_flag")).select("shift_id", "shift_sk")
    planned = schedule.select(
        "agent_id", "shift_id", "schedule_id", time.date_key("sched_date").alias("date_key")
    ).join(overnight, "shift_id", "left")

    copies = planned.groupBy("agent_id", "date_key").agg(F.count(F.lit(1)).alias("_copies"))
    weight = F.coalesce("_copies", F.lit(1))
    totals = (
        minutes.join(copies, ["agent_id", "date_key"], "left")
        .groupBy(*grain)
        .agg(
            F.sum(F.col("scheduled_minutes") * weight).alias("scheduled_minutes"),
            F.sum(F.col("worked_minutes") * weight).alias("worked_minutes"),
            F.sum(F.col("lost") * weight).alias("shrinkage_minutes"),
        )
    )
    agent_days = minutes.select("agent_id", *grain).distinct()
    counts = (
        planned.join(agent_days, ["agent_id", "date_key"])
        .groupBy(*grain)
        .agg(
            F.count_distinct("schedule_id").alias("schedules"),
            F.count_distinct("shift_sk").alias("overnight_shifts"),
        )
    )
    pct = ratio(F.col("shrinkage_minutes"), F.col("scheduled_minutes")) * 100
    return totals.join(counts, grain, "left").select(
        *grain,
        "scheduled_minutes",
        "worked_minutes",
        "shrinkage_minutes",
        pct.alias("shrinkage_pct"),
        F.coalesce("schedules", F.lit(0)).alias("schedules"),
        F.coalesce("overnight_shifts", F.lit(0)).alias("overnight_shifts"),
    )


def program_margin(
    billing: DataFrame,
    timesheet: DataFrame,
    adjustment: DataFrame,
    contract_line: DataFrame,
    contract: DataFrame | None = None,
    *,
    by_program: bool = True,
) -> DataFrame:
    """Revenue less estimated labour and payroll adjustments, with committed minimums.

    Labour is joined on program and month, and the minimums of the program's contracts are added
    up, each as of its newest snapshot: one row per billing row, at any size. The literal query
    (``by_program=False``) joins labour on the month alone and then puts every contract's minimum next to
    every row, so its result has rows x programs x contracts rows by definition; use it on the
    small inputs it was made for.
    """
    if by_program and contract is None:
        raise ValueError("the contracts are needed to tell which program a minimum belongs to")
    labour = timesheet.groupBy("program_id", F.col("work_month").alias("period_month")).agg(
        F.sum("billable_minutes").alias("minutes")
    )
    adjustments = adjustment.groupBy("period_month").agg(F.sum("amount").alias("total_adjustments"))
    if by_program:
        contract_line, contract = newest(contract_line, ["contract_id"]), newest(contract, ["contract_id"])
    minimums = contract_line.groupBy("contract_id").agg(F.sum("min_commit").alias("committed_min"))
    if by_program:
        labour = labour.withColumnRenamed("program_id", "program_sk")
        owners = contract.groupBy("contract_id").agg(F.max("program_id").alias("program_sk"))
        minimums = (
            minimums.join(owners, "contract_id").groupBy("program_sk").agg(F.sum("committed_min").alias("committed_min"))
        )
        rows = billing.join(labour, ["program_sk", "period_month"], "left").join(minimums, "program_sk", "left")
    else:
        rows = billing.join(labour.drop("program_id"), "period_month", "left")
        rows = rows.join(minimums.drop("contract_id"), F.lit(True), "left")
    rows = rows.join(adjustments, "period_month", "left")
    cost = F.col("minutes") / 60.0 * LABOUR_RATE
    margin = F.col("net_revenue").cast("double") - cost - F.coalesce("total_adjustments", F.lit(0)).cast("double")
    return rows.select(
        "period_month",
        "client_sk",
        "program_sk",
        "billed_amount",
        "net_revenue",
        cost.alias("est_labor_cost"),
        "total_adjustments",
        margin.alias("est_margin"),
        "committed_min",
    )


def client_executive_summary(
    client: DataFrame,
    program: DataFrame,
    program_monthly: DataFrame,
    csat_monthly: DataFrame,
    billing_monthly: DataFrame,
    ticket: DataFrame,
) -> DataFrame:
    """Monthly hub: leaf program rows with satisfaction, billing and tickets.

    Satisfaction and billing are matched by program and month only, so a program with several
    rollup rows or billed clients repeats its row.
    """
    tickets = ticket.groupBy("program_sk").agg(
        count_if(F.col("status").isin(*OPEN_STATUSES)).alias("open_tickets"),
        count_if(F.col("sla_breached_flag")).alias("sla_breached_tickets"),
    )
    leaf = program_monthly.where(F.col("grouping_level") == 0).select(
        "program_sk", "period_month", "interactions", "avg_handle_seconds", "avg_csat"
    )
    csat = csat_monthly.select("program_sk", "period_month", "pct_promoters", "pct_detractors")
    billed = billing_monthly.select(
        "program_sk", "period_month", "billed_amount", "sla_credit_amount", "net_revenue"
    )
    owners = program.select("program_sk", "program_code", "client_id").join(
        client.select("client_id", "client_code", "client_name"), "client_id"
    )
    return (
        owners.join(leaf, "program_sk")
        .join(csat, ["program_sk", "period_month"], "left")
        .join(billed, ["program_sk", "period_month"], "left")
        .join(tickets, "program_sk", "left")
        .select(
            "client_code",
            "client_name",
            "period_month",
            "program_code",
            "interactions",
            "avg_handle_seconds",
            "avg_csat",
            "pct_promoters",
            "pct_detractors",
            "billed_amount",
            "sla_credit_amount",
            "net_revenue",
            "open_tickets",
            "sla_breached_tickets",
        )
    )
