"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are cut into segments; with w components a segment, means m and
deviations s, the squared distance of two vectors is at least
sum of w * ((mq - mx)^2 + (sq - sx)^2). As |q - x|^2 = |q|^2 + |x|^2 - 2 q.x, that lower
bound on the distance is an upper bound on the inner product. Levels run from few to
more segments: each evaluates only the pairs that may still reach a query's k-th best
known score, then raises that score by exact products of the pairs that it likes best.
Survivors of the last level get exact integer scores.

The stated query set meets all rows in blocks: a grid of at most ``QUERY_BLOCK``
queries by ``ROW_BLOCK`` rows per cell (expected sizes; queries and rows are counted
first), each cell a bounded group, and the cells' best k are merged per query with a
rank limit before the exchange. Rows are copied once per block of queries.

Edge cases: vectors that are null or hold null or non-finite components take no
part, nor do rows whose id is null or no integer; shorter vectors count as ending in
zeros; ties go to the smaller id; rows that repeat an id are candidates of other
queries as often as they occur, and a query appears once per id (the first by
components); fewer than k other rows give fewer results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shuffle_partitions, ship

ship(__name__)

QUERY_BLOCK, ROW_BLOCK, STRIP = 8192, 8192, 256
LEVELS = (1, 4, 16, 64)
EXACT = 2.0**52


def matrix(vectors) -> np.ndarray:
    """The integer vectors floor(256 x), one per row, in doubles (exact below 2^53)."""
    rows = [np.floor(256.0 * np.asarray(v, dtype=np.float64)) for v in vectors]
    width = max(map(len, rows), default=0)
    width = -(-max(width, 1) // LEVELS[-1]) * LEVELS[-1]
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def widen(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


def statistics(a: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that a dot product of two rows bounds the vectors' own."""
    parts = a.reshape(len(a), segments, -1)
    scale = np.sqrt(parts.shape[2])
    return np.hstack([parts.mean(2) * scale, parts.std(2) * scale])


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of paired rows."""
    if len(q) == 0:
        return np.zeros(0, object)
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for u, v in zip(q, x, strict=True)], dtype=object)


def levels_of(width: int) -> tuple[int, ...]:
    """Numbers of segments whose statistics are cheaper than the vectors themselves."""
    return tuple(s for s in LEVELS if 4 * s <= width) or LEVELS[:1]


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th largest value; minus infinity where there are fewer."""
    return np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(scores), -np.inf)


def best(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int) -> tuple[list, dict]:
    """(query, id, score) of each query's k best rows in a cell, and how many pairs each level evaluated.

    Pairs stay a mask while many are left (one dense product of the rows still in play
    is then cheaper) and become a list once few are.
    """
    width = max(q.shape[1], x.shape[1])
    q, x = widen(q, width), widen(x, width)
    steps = levels_of(width)
    out, seen = [], dict.fromkeys((*steps, "exact"), 0)
    levels = [(statistics(q, s), statistics(x, s)) for s in steps]
    small = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width < EXACT
    longest = max(1.0, float(np.linalg.norm(x, axis=1).max(initial=0)))
    picks = min(2 * k, len(x))
    for at in range(0, len(q), STRIP):
        ids, qs = q_ids[at : at + STRIP], q[at : at + STRIP]
        alive = ids[:, None] != x_ids[None, :]
        known = np.full((len(qs), k), -np.inf)  # best exact scores so far, of distinct rows
        tried = np.zeros(alive.shape, bool)
        slack = 1e-9 * np.linalg.norm(qs, axis=1) * longest + 1e-6
        for level, (a, b) in zip(steps, levels, strict=True):
            n = int(alive.sum())
            seen[level] += n
            bound = np.full(alive.shape, -np.inf)
            if 8 * n > alive.size:
                live = np.flatnonzero(alive.any(axis=0))
                bound[:, live] = a[at : at + STRIP] @ b[live].T
            elif n:
                i, j = np.nonzero(alive)
                bound[i, j] = np.einsum("ij,ij->i", a[at + i], b[j])
            alive &= bound >= (known.min(axis=1) - slack)[:, None]
            # The pairs that this level likes best and that have no exact score yet raise the limit.
            hopes = np.where(alive & ~tried, bound, -np.inf)
            liked = np.argpartition(-hopes, picks - 1, axis=1)[:, :picks]
            rows = np.repeat(np.arange(len(qs)), picks)
            usable = np.take_along_axis(hopes, liked, 1) > -np.inf
            score = np.where(usable, exact(qs[rows], x[liked.ravel()]).astype(np.float64).reshape(usable.shape), -np.inf)
            tried[rows, liked.ravel()] |= usable.ravel()
            known = np.sort(np.hstack([known, score]), axis=1)[:, -k:]
            alive &= bound >= (known.min(axis=1) - slack)[:, None]
        seen["exact"] += int(alive.sum())
        if small and 8 * int(alive.sum()) > alive.size and len(x) > k:
            scores = np.where(alive, qs @ x.T, -np.inf)
            i, j = np.nonzero(alive & (scores >= kth(scores, k)[:, None]))
            score = scores[i, j].astype(np.int64)
        else:
            i, j = np.nonzero(alive)
            score = np.concatenate([exact(qs[i[p : p + 65536]], x[j[p : p + 65536]]) for p in range(0, len(i), 65536)] or [np.zeros(0, np.int64)])
        order = np.lexsort((x_ids[j], -score, i)) if score.dtype != object else np.array(sorted(range(len(i)), key=lambda p: (i[p], -score[p], x_ids[j[p]])), dtype=int)
        i, j, score = i[order], j[order], score[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        out += zip(ids[i[keep]].tolist(), x_ids[j[keep]].tolist(), score[keep].tolist(), strict=True)
    return out, seen


def top_k(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row whose id is divisible by ``every``."""
    finite = F.expr(f"{vector} IS NOT NULL AND {id_col} IS NOT NULL AND NOT exists({vector}, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
    rows = df.filter(finite).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id IS NOT NULL")
    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    n = counted["n"]
    n_query = max(1, -(-counted["q"] // QUERY_BLOCK))
    n_row = max(-(-n // ROW_BLOCK), min(2 * shuffle_partitions(df.sparkSession), -(-n // 256)), 1)
    grid = lambda salt, blocks: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(blocks)).cast("int")
    # Repeated ids would share a block; the row number spreads them.
    spread = rows.withColumn("row", F.monotonically_increasing_id())
    left = queries.withColumn("qb", grid("q", n_query)).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_row - 1))))
    right = spread.withColumn("cb", F.pmod(F.xxhash64("id", "row"), F.lit(n_row)).cast("int")).drop("row").withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))))

    def cell(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        found: list = []
        if len(q) and len(x):
            found, _ = best(q["id"].to_numpy(), matrix(q["v"]), x["id"].to_numpy(), matrix(x["v"]), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    near = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(cell, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    """op5: the five best rows of every fiftieth vector."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.id AS query_id, c.id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q, v c WHERE q.id % 50 = 0 AND c.id <> q.id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
