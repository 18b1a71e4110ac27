"""Paths of a self-referencing tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DEPTH = 6
PATH_SEPARATOR = " > "


def root_paths(
    nodes: DataFrame,
    node: str,
    parent: str,
    name: str,
    keep: list[str],
    max_depth: int = MAX_DEPTH,
    within: str | None = None,
) -> DataFrame:
    """Every node reachable from a root within ``max_depth`` steps, with root, depth and path.

    Each node climbs to its ancestors by ``max_depth`` equi joins on the parent id, all in one
    plan. A node that has not met a root by then is deeper or sits on a cycle and is left out,
    as in the top-down recursion. ``within`` names a kept column that holds separate trees apart,
    such as the day of a snapshot.
    """
    up = nodes.select(
        *([F.col(within).alias("_of")] if within else []),
        F.col(node).alias("_id"), F.col(parent).alias("_up"), F.col(name).alias("_name"), F.lit(1).alias("_hit")
    )
    walk = nodes.select(
        *keep,
        F.col(node).alias("root_unit_id"),
        F.col(parent).alias("_next"),
        F.lit(0).cast("long").alias("depth"),
        F.col(name).alias("path_names"),
    )
    for _ in range(max_depth):
        met = walk["_next"] == up["_id"]
        joined = walk.join(up, met & walk[within].eqNullSafe(up["_of"]) if within else met, "left")
        climbed = F.col("_hit").isNotNull()
        walk = joined.select(
            *keep,
            F.when(climbed, F.col("_id")).otherwise(F.col("root_unit_id")).alias("root_unit_id"),
            # An id that names no node stays put: it never turns into a root.
            F.when(climbed, F.col("_up")).otherwise(F.col("_next")).alias("_next"),
            F.when(climbed, F.col("depth") + 1).otherwise(F.col("depth")).alias("depth"),
            F.when(climbed, F.concat("_name", F.lit(PATH_SEPARATOR), "path_names"))
            .otherwise(F.col("path_names"))
            .alias("path_names"),
        )
    return walk.where(F.col("_next").isNull()).drop("_next")
