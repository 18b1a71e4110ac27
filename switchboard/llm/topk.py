"""Exact top-k by inner product: branch and bound over columns.

Queries and candidates are dealt into blocks of bounded size and every query block meets every
candidate block once. Inside a meeting the candidates lie column by column. Scores grow by ``COLUMNS``
dimensions at a time; after each step a query's candidates are compacted to those that can still
reach its k-th score, where the mass of the dimensions to come bounds what they can add
(Cauchy-Schwarz). Only the best k of each meeting leave the task, and a limited window merges
them per query.

Components are floor(scale * x), x as double. Scores are integers, computed exactly: in doubles
while every partial sum stays below 2 ** 53, else in whole numbers of any size, clipped to a long
at the end. Null vectors and vectors with null or non-finite components take no part, nor do rows
without an id. Shorter vectors count as filled up with zeros. Rows that repeat an id are one query (that of the
smallest vector) and separate candidates; a query's own id is never its candidate. Ties go to the
smaller id. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from switchboard.llm.frames import table
from switchboard.session import store

COLUMNS = 16
QUERIES, CANDIDATES = 512, 4096


def _matrix(column: pa.ChunkedArray, width: int, scale: float) -> np.ndarray:
    """One row per vector, filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.arange(width) < sizes[:, None]] = np.floor(scale * lists.flatten().to_numpy().astype(np.float64))
    return out


def best(queries: np.ndarray, own: np.ndarray, columns: np.ndarray, ids: np.ndarray, k: int):
    """Query numbers, candidate numbers and scores of each query's k best; ``columns`` is column-major."""
    width = columns.shape[0]
    top = np.abs(queries).max(initial=0) * np.abs(columns).max(initial=0) * max(width, 1)
    if top >= 2**53:
        whole = [[int(v) for v in row] for row in queries]
        scores = np.array([[sum(a * int(b) for a, b in zip(q, c, strict=True)) for c in columns.T] for q in whole], object)
        scores = np.clip(scores, -(2**63), 2**63 - 1)
        found = []
        for q in range(len(queries)):
            live = [c for c in range(len(ids)) if ids[c] != own[q]]
            found += [(q, c, int(scores[q, c])) for c in sorted(live, key=lambda c: (-scores[q, c], ids[c]))[:k]]
        return found
    steps = list(range(0, width, COLUMNS)) or [0]
    square = np.cumsum((columns**2)[::-1], axis=0)[::-1]
    rest = [np.sqrt(square[s + COLUMNS]) if s + COLUMNS < width else None for s in steps]
    own_rest = [np.sqrt((queries[:, s + COLUMNS :] ** 2).sum(axis=1)) for s in steps]
    first = queries[:, :COLUMNS] @ columns[:COLUMNS]
    found = []
    for q in range(len(queries)):
        live = np.flatnonzero(ids != own[q])
        score = first[q, live]
        for n, s in enumerate(steps):
            if n:
                score = score + queries[q, s : s + COLUMNS] @ columns[s : s + COLUMNS, live]
            if rest[n] is not None and len(live) > k:
                more = own_rest[n][q] * rest[n][live] * (1 + 1e-9) + 1e-6
                least = score - more
                floor = np.partition(least, len(least) - k)[len(least) - k]
                keep = score + more >= floor
                live, score = live[keep], score[keep]
        order = np.lexsort((ids[live], -score))[:k]
        found += [(q, c, int(x)) for c, x in zip(live[order], score[order], strict=True)]
    return found


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` (vec_id, embedding) where ``is_query``."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
    )
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = store(asked.withColumnRenamed("vec_id", "query_id"), "queries")
    n_left, n_right = -(-asked.count() // QUERIES), -(-rows.count() // CANDIDATES)
    if not n_left:
        n_left = 1
    block = lambda name, n: F.pmod(F.xxhash64(name), F.lit(max(n, 1))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))
    left = asked.withColumns({"left": block("query_id", n_left), "right": every(n_right)})
    right = rows.withColumn("right", block("vec_id", n_right)).withColumn("left", every(n_left))

    def meet(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list = []
        if queries.num_rows and candidates.num_rows:
            sides = [t.column("embedding").combine_chunks() for t in (queries, candidates)]
            width = max(int(np.diff(s.offsets.to_numpy()).max()) for s in sides)
            ids = candidates.column("vec_id").to_numpy()
            own = queries.column("query_id").to_numpy()
            columns = np.ascontiguousarray(_matrix(candidates.column("embedding"), width, scale).T)
            found = best(_matrix(queries.column("embedding"), width, scale), own, columns, ids, k)
        at = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table(
            {
                "query_id": pa.array([int(own[q]) for q in at[0]], pa.int64()),
                "vec_id": pa.array([int(ids[c]) for c in at[1]], pa.int64()),
                "score": pa.array(at[2], pa.int64()),
            }
        )

    met = left.groupBy("left", "right").cogroup(right.groupBy("left", "right"))
    found = met.applyInArrow(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3(spark, folder: str) -> DataFrame:
    """The registered query: every twentieth vector against all others."""
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
