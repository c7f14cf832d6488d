"""Nearest neighbours from randomly rotated one-bit codes.

Unit vectors are taken relative to their mean, rotated at random into ``bits`` dimensions and cut to their
signs. Packed bits and three scalars per vector estimate its inner product with a query without bias:
<code, rotated query> / <code, rotated vector>, and bound the estimate's error with high probability. Only
vectors whose upper bound reaches the fifth best similarity known so far are reranked with the originals.

The stated queries meet all vectors in a grid of bounded blocks of either, each cell a task of its own; a
cell gives the best few for each of its queries, and these are merged. Blocks are dealt by a hash of id and
vector, so equal vectors and equal ids, however many, spread over all cells.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import materialise, read

#: Vectors, and queries, in a cell at most (about).
BLOCK, QUERIES = 32_768, 2_048
BITS_PER_DIM = 2
#: The error bound in standard deviations; the chance to miss a neighbour falls exponentially in its square.
EPSILON = 3.0


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of double) of the rows that take part, and ``copies``, how many rows have both."""
    values = F.col("embedding").cast("array<double>")
    fine = (F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0))
    return vectors.filter(F.coalesce(fine, F.lit(False))).select("vec_id", values.alias("embedding")) \
        .groupBy("vec_id", "embedding").agg(F.count("*").alias("copies"))


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """dim x bits, with orthonormal rows: a random rotation into at least as many dimensions."""
    bits = -(-dim * BITS_PER_DIM // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((bits, dim)))
    return np.ascontiguousarray((q * np.sign(np.diag(r))).T)


def encode(unit: np.ndarray, mean: np.ndarray, turn: np.ndarray):
    """Packed signs; and by vector: residual norm, <code, residual direction>, <residual, mean>."""
    residual = unit - mean
    norm = np.linalg.norm(residual, axis=1)
    turned = residual @ turn / np.where(norm > 0, norm, 1)[:, None]
    aligned = np.abs(turned).sum(1) / math.sqrt(turn.shape[1])
    return np.packbits(turned > 0, axis=1), np.stack([norm, np.where(norm > 0, aligned, 1), residual @ mean], 1)


def estimate(codes: np.ndarray, scalars: np.ndarray, query: np.ndarray, mean: np.ndarray, turn: np.ndarray):
    """Estimated cosines (vectors x queries) and their error bounds, by vector and by query (to multiply)."""
    bits = turn.shape[1]
    norm, aligned, on_mean = scalars.T
    relative = query - mean
    turned = (relative @ turn).astype(np.float32)
    signs = np.unpackbits(codes, axis=1).astype(np.float32)
    inner = (2 * (signs @ turned.T) - turned.sum(1)) / math.sqrt(bits)
    cosine = inner * (norm / aligned).astype(np.float32)[:, None]
    cosine += on_mean.astype(np.float32)[:, None] + (query @ mean).astype(np.float32)
    by_vector = norm * np.sqrt(np.maximum(1 - aligned ** 2, 0)) / aligned * EPSILON / math.sqrt(bits - 1)
    return cosine, by_vector + 1e-5, np.linalg.norm(relative, axis=1) + 1e-5


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines, summed one component after another in double precision."""
    def inner(a, b):
        return np.cumsum(a * b, axis=-1)[..., -1]
    return inner(vectors, query) / (np.sqrt(inner(vectors, vectors)) * np.sqrt(inner(query, query)))


def _cell(k: int, means: dict[int, bytes]):
    def best(key, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": [], "copies": []}
        if len(data) and len(asked):
            dim = int(key[0])
            mean, turn = np.frombuffer(means[dim]), rotation(dim)
            ids, copies = data["vec_id"].to_numpy(), data["copies"].to_numpy()
            vectors = np.frombuffer(b"".join(data["vector"])).reshape(-1, dim)
            codes = np.frombuffer(b"".join(data["code"]), np.uint8).reshape(len(ids), -1)
            scalars = np.frombuffer(b"".join(data["scalars"])).reshape(-1, 3)
            unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
            query_ids, query_copies = asked["vec_id"].to_numpy(), asked["copies"].to_numpy()
            queries = np.frombuffer(b"".join(asked["vector"])).reshape(-1, dim)
            for at in range(0, len(queries), 128):
                here = slice(at, at + 128)
                found = _search(k, ids, vectors, unit, codes, scalars, query_ids[here], queries[here], mean, turn)
                for query_id, times, (rows, score) in zip(query_ids[here], query_copies[here], found):
                    out["query_id"].append(np.full(len(rows), query_id))
                    out["vec_id"].append(ids[rows])
                    out["score"].append(score)
                    # A pair counts for each row of its query and of its candidate; k are enough.
                    out["copies"].append(np.minimum(copies[rows], k) * min(times, k))
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in out.items()})
    return best


def _search(k, ids, vectors, unit, codes, scalars, query_ids, queries, mean, turn):
    """For each query the places of its k nearest vectors, nearest first, and their cosines."""
    unit_queries = queries / np.linalg.norm(queries, axis=1)[:, None]
    cosine, by_vector, by_query = estimate(codes, scalars, unit_queries, mean, turn)
    for j, query_id in enumerate(query_ids):
        guess = np.where(ids == query_id, -np.inf, cosine[:, j])
        first = np.argpartition(guess, -8 * k)[-8 * k:] if len(guess) > 8 * k else np.arange(len(guess))
        known = np.sort(unit[first[guess[first] > -np.inf]] @ unit_queries[j])
        floor = known[-k] if len(known) >= k else -np.inf
        reached = guess + by_vector * by_query[j] >= floor
        reached[first] = True  # their cosines are known, whatever their bounds
        chosen = np.flatnonzero(reached & (guess > -np.inf))
        close = unit[chosen] @ unit_queries[j]
        if len(close) > k:
            kept = close >= np.partition(close, -k)[-k] - 1e-9
            chosen = chosen[kept]
        score = exact(vectors[chosen], queries[j])
        order = np.lexsort((ids[chosen], -score))[:k]
        yield chosen[order], score[order]


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each vec_id divisible by ``every``.

    Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows
    without vec_id. Repeated rows are candidates each for itself: one that occurs three times may take three ranks.
    All rows of a query_id, repeated or with different vectors, share its k ranks; rows of the query's own
    vec_id are no candidates. Vectors of different length are not compared. Fewer candidates than k give fewer rows; ties go to the smaller vec_id; an empty table gives none.
    """
    spark = vectors.sparkSession
    chosen = materialise(usable(vectors).withColumn("dim", F.size("embedding")), "vectors")

    def sums(batches):
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = np.array(part["embedding"].tolist())
                yield pd.DataFrame({"dim": [dim], "n": [len(x)], "at": [list(range(dim))],
                                    "total": [(x / np.linalg.norm(x, axis=1)[:, None]).sum(0).tolist()]})

    totals = (
        chosen.select("dim", "embedding").mapInPandas(sums, "dim int, n long, at array<int>, total array<double>")
        .select("dim", "n", F.explode(F.arrays_zip("at", "total")).alias("z"))
        .groupBy("dim", "z.at").agg(F.sum("n").alias("n"), F.sum("z.total").alias("total")).collect())
    means = {d: np.array([r["total"] / r["n"] for r in sorted(totals, key=lambda r: r["at"]) if r["dim"] == d]).tobytes()
             for d in {r["dim"] for r in totals}}

    def coded(batches):
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = np.array(part["embedding"].tolist())
                codes, scalars = encode(x / np.linalg.norm(x, axis=1)[:, None], np.frombuffer(means[dim]), rotation(dim))
                yield pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), "copies": part["copies"].to_numpy(), "dim": dim, "vector": [v.tobytes() for v in x],
                                    "code": [c.tobytes() for c in codes], "scalars": [s.tobytes() for s in scalars]})

    index = materialise(chosen.mapInPandas(
        coded, "vec_id long, copies long, dim int, vector binary, code binary, scalars binary"), "codes")
    counts = index.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    blocks = max(-(-counts["n"] // BLOCK), spark.sparkContext.defaultParallelism)
    asked = max(-(-counts["q"] // QUERIES), 1)

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    cells = ["dim", "block", "asked"]
    found = (
        dealt(index, "block", blocks, "asked", asked).groupBy(*cells)
        .cogroup(dealt(index.filter(F.col("vec_id") % every == 0).select("vec_id", "copies", "dim", "vector"),
                       "asked", asked, "block", blocks).groupBy(*cells))
        .applyInPandas(_cell(k, means), "query_id long, vec_id long, score double, copies long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # At most k copies of at most k candidates from each cell are still wanted.
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), k=5, every=50)


SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x for x in embedding if x <> 0]) > 0),
n AS (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(c.e, q.e) / (c.norm * q.norm) AS score
  FROM n q JOIN n c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
