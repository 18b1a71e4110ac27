"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from switchboard.session import store


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, of links ``a``, ``b`` of any ordered type.

    Alternating star steps: every node hands its larger neighbours, then its smaller ones, to
    the smallest node it knows, until each node has one smaller neighbour at most and none has both
    smaller and larger ones: then all are stars. That is counted while a round's smallest
    neighbours are written, so links that are stars already cost one round of counting. Links
    and smallest neighbours are written to the shared folder each round; minima are partial before
    they are shuffled. No links: no rows. Self-links and repeated links change nothing.
    """
    count = F.count(F.lit(1)).alias("n")
    seen = Observation()
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = store(edges.observe(seen, count), "links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        known = both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        known = known.select("a", F.least("a", "low").alias("m"), F.expr("low < a and a < high").alias("between"))
        met = Observation()
        tally = (count, F.count_if(F.col("a") == F.col("m")).alias("roots"), F.count_if("between").alias("between"))
        known = store(known.observe(met, *tally), "least")  # the join then meets two plain shuffles, which can be split
        if not met.get.get("between") and met.get.get("n", 0) == seen.get.get("n", 0) + met.get.get("roots", 0):
            return known.select(F.col("a").alias("node"), F.col("m").alias("root"))
        large = edges.join(known.select(F.col("a").alias("b"), "m"), "b").select("a", F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))))
        small = large.join(least, "a").select(ends.alias("e")).select("e.a", "e.b").where("a != b").distinct()
        seen = Observation()
        edges = store(small.observe(seen, count), "links")
