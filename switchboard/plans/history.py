"""Slowly changing histories of agents, their skills and their assignments.

Each history has a function that gives its observations; the history is made of all of them, or
the observations of one delivery are spliced into the stored history.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.functions import time
from switchboard.operators.scd2 import history
from switchboard.schemas import conform


@dataclass(frozen=True)
class History:
    """Keys, tracked columns and surrogate of a history, and the function that gives its observations."""

    keys: list[str]
    tracked: list[str]
    id_column: str
    observed: Callable[..., DataFrame]
    ts: str = "seen_ts"

    def build(self, table: str, *inputs: DataFrame) -> DataFrame:
        return conform(history(self.observed(*inputs), self.keys, self.tracked, self.ts, self.id_column), table)


def agents_seen(snapshot: DataFrame, event: DataFrame) -> DataFrame:
    """Agents as seen in daily snapshots and employment events.

    A snapshot shows the agent at the start of its load date; an event shows the agent with
    the unit it moved to, other attributes as in the snapshot that came with it.
    """
    tracked = AGENT.tracked
    seen = snapshot.select("agent_id", *tracked, F.col("load_date").cast("timestamp").alias("seen_ts"))
    newest = (
        snapshot.groupBy("agent_id", "load_date")
        .agg(F.max(F.struct(*tracked)).alias("_m"))
        .select("agent_id", "load_date", *[F.col(f"_m.{c}").alias(c) for c in tracked])
    )
    moved = event.select("agent_id", "load_date", "to_org_unit_id", time.from_seconds("event_ts").alias("seen_ts"))
    moves = moved.join(newest.drop("org_unit_id"), ["agent_id", "load_date"])
    return seen.unionByName(moves.withColumnRenamed("to_org_unit_id", "org_unit_id").drop("load_date"))


def skills_seen(agent_skill: DataFrame, skill: DataFrame) -> DataFrame:
    """Skills per (agent, skill), seen at ``effective_ts``; unknown skills keep a NULL code."""
    codes = skill.groupBy("skill_id").agg(F.max_by("skill_code", F.struct("load_date", "created_ts")).alias("skill_code"))
    return agent_skill.withColumn("seen_ts", time.from_seconds("effective_ts")).join(codes, "skill_id", "left")


def assignments_seen(observed: DataFrame) -> DataFrame:
    """Assignments per (agent, program).

    No feed of assignments is defined, so the input is any table of observations with
    ``agent_id``, ``program_id``, ``queue_id``, ``role_on_program`` and ``seen_ts``.
    """
    return observed.withColumn("seen_ts", F.col("seen_ts").cast("timestamp"))


AGENT = History(
    ["agent_id"], ["employee_no", "org_unit_id", "job_grade", "employment_type", "status"], "agent_history_id", agents_seen
)
SKILL = History(["agent_id", "skill_id"], ["skill_code", "proficiency", "certified"], "agent_skill_history_id", skills_seen)
ASSIGNMENT = History(["agent_id", "program_id"], ["queue_id", "role_on_program"], "assignment_history_id", assignments_seen)
HISTORIES = {"ods_agent_scd2": AGENT, "ods_agent_skill_scd2": SKILL, "ods_agent_assignment_scd2": ASSIGNMENT}


def agent(snapshot: DataFrame, event: DataFrame) -> DataFrame:
    """Agent versions."""
    return AGENT.build("ods_agent_scd2", snapshot, event)


def agent_skill(agent_skill: DataFrame, skill: DataFrame) -> DataFrame:
    """Skill versions per (agent, skill)."""
    return SKILL.build("ods_agent_skill_scd2", agent_skill, skill)


def agent_assignment(observed: DataFrame) -> DataFrame:
    """Assignment versions per (agent, program)."""
    return ASSIGNMENT.build("ods_agent_assignment_scd2", observed)
