"""Exact top-k search by inner product: a table of distances to pivots bounds every score before it is computed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimweave.llm.common import column_of, table, work_folder, written

#: Pivots, and the rows (of smallest hash) from which they are chosen.
PIVOTS, PIVOT_SAMPLE = 16, 2000

#: Rows, and queries, that meet in one task.
ROWS, QUERIES = 8_192, 2_048

#: Candidates scored at a time in order of their bounds.
STEP = 1024


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, v) with v = floor(256 x) of each component as double.

    Rows with a null key, a null vector or a null or non-finite component take no part.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite).select(key, whole.alias("v"))


def choose_pivots(vectors: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those before it."""
    if not len(vectors):
        return vectors
    picked = [0]
    distance = ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(picked) < most and distance.max() > 0:
        picked.append(int(distance.argmax()))
        distance = np.minimum(distance, ((vectors - vectors[picked[-1]]) ** 2).sum(axis=1))
    return vectors[picked]


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of an array of lists as a matrix; shorter vectors end in zeros."""
    flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    if len(lengths) and (lengths == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        out[i, : b - a] = flat[a:b]
    return out


def search_block(
    queries: np.ndarray, rows: np.ndarray, to_pivots: np.ndarray, of_queries: np.ndarray, longest: float,
    own: np.ndarray, row_ids: np.ndarray, k: int,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, scores) of the k best rows for each query; ties go to the smaller row id.

    Vectors get one more component that gives all rows the length sqrt(longest) and is 0 in queries.
    Then squared distance = |q|^2 + longest - 2 score, so the distances of query and row to a pivot
    differ by no more than what a score allows: the largest difference over all pivots bounds it. Rows
    are scored from the best bound on, until k scores are above the next bound; the rest can't be among
    the best, ties included.
    """
    exact = longest < 1 << 52 and (queries.astype(float) ** 2).sum(axis=1).max(initial=0) < 1 << 52
    kind = np.float64 if exact else object  # sums of products are whole numbers that doubles hold, or Python's
    queries, rows = queries.astype(kind), rows.astype(kind)
    found = []
    for i, query in enumerate(queries):
        gap = np.abs(to_pivots - of_queries[i]).max(axis=1) if to_pivots.shape[1] else np.zeros(len(rows))
        length = float(query @ query)
        bound = (length + longest - gap * gap) / 2
        bound += 1 + 1e-9 * (length + longest)  # for what rounding may take
        bound[row_ids[:, 1] == own[i]] = -np.inf  # a query is no candidate of its own
        order = np.argsort(-bound, kind="stable")
        order = order[: len(order) - int((row_ids[:, 1] == own[i]).sum())]
        at, best, scores = 0, np.empty(0, np.int64), np.empty(0, kind)
        while at < len(order) and (len(best) < k or bound[order[at]] >= scores[-1]):
            part = order[at : at + STEP]
            at += STEP
            new = rows[part] @ query
            if len(best) == k:
                part, new = part[new >= scores[-1]], new[new >= scores[-1]]
            best, scores = np.concatenate((best, part)), np.concatenate((scores, new))
            rank = np.lexsort((row_ids[best, 0], -scores))[:k] if exact else np.array(
                sorted(range(len(best)), key=lambda j: (-scores[j], row_ids[best[j], 0]))[:k], np.int64
            )
            best, scores = best[rank], scores[rank]
        found.append((best, scores))
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int, folder: str, key: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows with the highest integer inner product per query.

    `vectors` is (key, v array<long>); each row that fulfils `is_query` is a query against all rows but
    itself. Repeated rows are rows of their own; shorter vectors count as ending in zeros. Pivots come
    from PIVOT_SAMPLE rows, every row is in the table. Rows and queries are dealt into blocks of about
    ROWS and QUERIES, each pair of blocks is a task's work and leaves k rows per query.
    """
    spark = vectors.sparkSession
    rows = written(vectors.withColumn("_row", F.monotonically_increasing_id()), f"{folder}/rows")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(square), F.lit(0.0)).alias("longest"),
        F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width"), F.count(F.when(is_query, 1)).alias("queries"),
    ).first()
    width, longest = facts["width"], facts["longest"]
    sample = rows.orderBy(F.xxhash64("_row")).limit(PIVOT_SAMPLE).select("v").collect()
    plain = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        plain[i, : len(r["v"])] = r["v"]
    lift = np.sqrt(np.maximum(0, longest - (plain**2).sum(axis=1)))
    pivots = choose_pivots(np.column_stack((plain, lift)), PIVOTS)

    def distances(v: np.ndarray, lifted: bool) -> np.ndarray:
        x = v.astype(np.float64)
        squares = (x * x).sum(axis=1)
        last = np.sqrt(np.maximum(0, longest - squares)) if lifted else np.zeros(len(x))
        cross = np.column_stack((x, last)) @ pivots.T
        return np.sqrt(np.maximum(0, (longest if lifted else squares[:, None]) + (pivots**2).sum(axis=1) - 2 * cross))

    row_blocks, query_blocks = -(-facts["n"] // ROWS) or 1, -(-facts["queries"] // QUERIES) or 1
    deal = F.xxhash64("_row")
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    left = rows.where(is_query).select(
        F.col(key).alias("id"), "_row", "v", F.pmod(deal, F.lit(query_blocks)).cast("int").alias("qb"), every(row_blocks, "rb")
    )
    right = rows.select(
        F.col(key).alias("id"), "_row", "v", F.pmod(deal, F.lit(row_blocks)).cast("int").alias("rb"), every(query_blocks, "qb")
    )
    kind = dict(vectors.dtypes)[key]

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not asked.num_rows or not held.num_rows:
            return schema.empty_table()
        q, r = asked.combine_chunks().to_batches()[0], held.combine_chunks().to_batches()[0]
        qv, rv = _matrix(column_of(q, "v"), width), _matrix(column_of(r, "v"), width)
        ids = np.column_stack((column_of(r, "id").to_numpy(), column_of(r, "_row").to_numpy()))
        own = column_of(q, "_row").to_numpy()
        found = search_block(qv, rv, distances(rv, True), distances(qv, False), longest, own, ids, k)
        counts = [len(p) for p, _ in found]
        places = np.concatenate([p for p, _ in found])
        return pa.table(
            {
                "query_id": np.repeat(column_of(q, "id").to_numpy(), counts),
                "query_row": np.repeat(own, counts),
                "vec_id": ids[places, 0],
                "score": pa.array([int(x) for _, s in found for x in s], pa.int64()),
            },
            schema=schema,
        )

    out = f"query_id {kind}, query_row long, vec_id {kind}, score long"
    best = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInArrow(run, out)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for every 50th vector."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5, work_folder(spark, "topk"))


ORACLE_SQL = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
