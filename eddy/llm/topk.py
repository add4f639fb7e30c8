"""Exact top-k inner products with norm-bucketed retrieval (operator 4).

Candidates are put in order of their length (Euclidean norm) and cut into
buckets of about ``bucket_rows`` rows of similar length. A query keeps a
threshold: its k-th best score so far. For a bucket whose longest vector has
length m, only vectors with cosine of at least ``threshold / (|q| m)`` matter:

* above 1 the bucket is skipped;
* a low local threshold leaves length pruning: the bucket is sorted by length,
  so the vectors with ``|q| |p| >= threshold`` are a prefix of it, and the whole
  prefix is verified by one matrix product;
* a high local threshold (``coord_from`` or more) leaves coordinate pruning: on
  the query's largest coordinates every vector of that cosine lies inside an
  interval around the query's own value, so only the rows inside all intervals
  are verified.

Every score is an exact integer product. Ties go to the smaller id.

Scale: the query set is stated (a share of the rows), candidates and queries meet
in blocks, one task per pair of blocks, nothing broadcast. Blocks of candidates are
ranges of their length (a hash parts equal lengths, so hot norms and equal vectors
spread). A first round takes the starting threshold of all queries from the block of
the longest vectors; then queries are ranged by the length their threshold asks for,
and pairs of blocks whose lengths rule each other out are dropped before any row is
copied: a block of queries meets the blocks up to a last one. Each pair returns its
best k per query, which are merged by rank. The driver reads one number a block.

Edge cases: vectors that are NULL, or hold a NULL or a non-finite component,
take no part; an empty vector is one of length 0; a shorter vector is extended
by zeros. Scores beyond 2^53 are computed in 64-bit integers. NULL ids take no
part as queries and come last in ties; repeated rows are candidates of their
own, and a query skips every row with its own id; of query rows that share an id all
are searched and their scores ranked together. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, ship_by_value, stored

BUCKET_ROWS = 4096
QUERY_ROWS = 2048
K = 20
SCALE = 64
#: local cosine threshold from which coordinates are pruned, and how many
COORD_FROM, COORDS = 0.6, 4
#: stands for a NULL id inside tasks: the largest long, last in ties
NO_ID = (1 << 63) - 1


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, v, is_query, norm2`` of the rows that take part; ``v`` are integers."""
    x = F.transform(F.col(vec_col).cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))))
    ok = F.col(vec_col).isNotNull() & F.forall(
        F.col(vec_col).cast("array<double>"),
        lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return (df.where(ok).select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), x.alias("v"), "is_query")
            .withColumn("norm2", norm2))


def matrix(column) -> np.ndarray:
    """Rows as one matrix, shorter ones extended by zeros: float64 where every
    product is exact in it, else int64."""
    width = max((len(x) for x in column), default=0)
    out = np.zeros((len(column), width), np.int64)
    for i, x in enumerate(column):
        out[i, :len(x)] = x
    return out


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact ``q @ p.T``."""
    w = min(q.shape[1], p.shape[1])
    q, p = q[:, :w], p[:, :w]
    if not q.size or not p.size:
        return np.zeros((len(q), len(p)), np.int64)
    most = float(np.abs(q).max()) * float(np.abs(p).max()) * w
    if most < 2 ** 53:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search_bucket(queries: pd.DataFrame, bucket: pd.DataFrame, k: int, coord_from: float, coords: int):
    """Best k of one bucket for each query: arrays of query id, id, score."""
    norm = np.sqrt(bucket["norm2"].to_numpy(float))
    order = np.argsort(-norm, kind="stable")
    norm, ids = norm[order], bucket["id"].to_numpy(np.int64)[order]
    p = matrix(bucket["v"].tolist())[order]
    q = matrix(queries["v"].tolist())
    qid = queries["id"].to_numpy(np.int64)
    qn = np.sqrt(queries["norm2"].to_numpy(float))
    low = queries["floor"].to_numpy(float)  # NaN: no threshold yet
    slack = 1 + 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(np.isnan(low), -np.inf, low / (qn * norm[0]))
        local = np.where(qn * norm[0] == 0, np.where(low > 0, np.inf, -np.inf), local)
    prefix = np.full(len(q), len(p))
    positive = local > 0
    prefix[positive] = np.searchsorted(-norm, -(low[positive] / (qn[positive] * slack)), side="right")
    prefix[local > slack] = 0
    by_coord = (local >= coord_from) & (prefix > 0)
    out = []

    def emit(i, rows, scores):
        keep = ids[rows] != qid[i]
        rows, scores = rows[keep], scores[keep]
        if not np.isnan(low[i]):
            near = scores >= low[i]
            rows, scores = rows[near], scores[near]
        top = best(scores, ids[rows], k)
        out.append((np.full(len(top), qid[i]), ids[rows][top], scores[top]))

    plain = np.flatnonzero(~by_coord & (prefix > 0))
    for at in range(0, len(plain), 256):
        part = plain[at:at + 256]
        n = int(prefix[part].max())
        s = products(q[part], p[:n])
        for j, i in enumerate(part):
            emit(i, np.arange(prefix[i]), s[j, :prefix[i]])
    if by_coord.any():
        unit = p / np.maximum(norm, 1e-300)[:, None]
        for i in np.flatnonzero(by_coord):
            t = min(1.0, local[i] / slack)
            own = q[i, :unit.shape[1]] / qn[i]
            alive = np.arange(prefix[i])
            for f in np.argsort(-np.abs(own))[:coords]:
                # |unit_p - t unit_q| is smallest at the cone's axis: the f-th
                # coordinate of a unit vector within the cone
                half = np.sqrt(max(0.0, (1 - t * t) * (1 - own[f] ** 2)))
                top = 1.0 if own[f] >= t else own[f] * t + half
                low_f = -1.0 if own[f] <= -t else own[f] * t - half
                x = unit[alive, f]
                alive = alive[(x >= low_f - 1e-9) & (x <= top + 1e-9)]
            if len(alive):
                emit(i, alive, products(q[i:i + 1], p[alive])[0])
    if not out:
        return [np.zeros(0, np.int64)] * 3
    return [np.concatenate(c) for c in zip(*out)]


def cogrouped(k, coord_from, coords):
    def run(queries, bucket):
        if not len(queries) or not len(bucket):
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="int64")})
        a, b, c = search_bucket(queries, bucket, k, coord_from, coords)
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})
    return run


def top_inner_products(vectors: DataFrame, is_query: Column, *, k: int = K, scale: int = SCALE,
                       id_col="vec_id", vec_col="embedding", bucket_rows: int = BUCKET_ROWS,
                       query_rows: int = QUERY_ROWS, coord_from: float = COORD_FROM, coords: int = COORDS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each row of
    ``vectors`` for which ``is_query`` (an expression over its columns) holds."""
    spark = vectors.sparkSession
    kept = vectors.select(id_col, vec_col, F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = stored(integer_vectors(kept, id_col, vec_col, scale), "vectors")
    queries = rows.where(f"is_query and id != {NO_ID}")

    n, n_queries = rows.agg(F.count("*"), F.coalesce(F.sum(F.expr(f"int(is_query and id != {NO_ID})")), F.lit(0))).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # blocks are ranges from the longest vectors to the shortest; the hash parts equal lengths
    h = F.xxhash64("id", "v")
    blocks = (rows.select("id", "v", "norm2", h.alias("h")).repartitionByRange(parts_for(spark, n, bucket_rows), F.col("norm2").desc(), "h")
              .withColumn("block", F.spark_partition_id()).drop("h"))
    blocks = stored(blocks, "topk-blocks")
    longest = {r["block"]: r["m"] for r in blocks.groupBy("block").agg(F.max("norm2").alias("m")).collect()}
    run = cogrouped(k, coord_from, coords)
    out = "query_id long, vec_id long, score long"

    def search(q, c):
        """Every block of queries against the blocks of ``c`` that it shares a row with."""
        q = q.select(*[F.col(x).alias(x) for x in q.columns])  # both sides stem from one table
        return q.groupBy("qb", "block").cogroup(c.groupBy("qb", "block")).applyInPandas(run, out)

    # thresholds: the k-th best score of each query among the longest vectors
    n_query = parts_for(spark, n_queries, query_rows)
    seeds = queries.select("id", "v", "norm2", F.pmod(h, F.lit(n_query)).cast("int").alias("qb"), F.lit(min(longest)).alias("block"), F.lit(None).cast("double").alias("floor"))
    head = blocks.where(F.col("block") == min(longest)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))))
    seed = search(seeds, head)
    floors = (seed.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
              .select(F.col("query_id").alias("id"), F.col("least").cast("double").alias("floor")))
    # a query with a positive threshold needs vectors of some length; queries that need
    # much length come last, so block b is needed by the query blocks up to some number
    need = F.when(F.col("floor") > 0, F.col("floor") / F.sqrt("norm2")).otherwise(0.0)  # |q| > 0 where the k-th score is
    asked = queries.select("id", "v", "norm2").join(floors, "id", "left").withColumn("need", F.coalesce(need, F.lit(0.0)))
    asked = stored(asked.repartitionByRange(n_query, "need", F.xxhash64("id", "v")).withColumn("qb", F.spark_partition_id()), "topk-queries")
    least = {r["qb"]: r["m"] for r in asked.groupBy("qb").agg(F.min("need").alias("m")).collect()}
    qbs, bs = np.array(sorted(least)), np.array(sorted(longest))
    wants, has = np.array([least[x] for x in qbs]), np.sqrt([longest[x] for x in bs]) * (1 + 1e-9)
    pairs_of = lambda names, last: spark.createDataFrame([(int(x), int(y)) for x, y in zip(names, last)], "i int, last int")
    last_b = pairs_of(qbs, [bs[np.flatnonzero(has >= w)[-1]] if (has >= w).any() else -1 for w in wants]).withColumnRenamed("i", "qb")
    last_q = pairs_of(bs, [qbs[np.flatnonzero(wants <= m)[-1]] if (wants <= m).any() else -1 for m in has]).withColumnRenamed("i", "block")
    asked = asked.join(last_b, "qb").where("last >= 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last")))).select("id", "v", "norm2", "qb", "block", "floor")
    offered = blocks.join(last_q, "block").where("last >= 0").withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("last")))).select("id", "v", "norm2", "qb", "block")
    found = search(asked, offered)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    top = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return top.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

ship_by_value(__name__)
