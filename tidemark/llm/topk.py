"""Exact top-k inner products by the threshold algorithm.

Vectors are dealt into blocks of bounded size by a hash of their row.  A block keeps one sorted
list per dimension.  For a query, the lists are read from their best end (highest values where
the query is positive, lowest where it is negative) to growing depths; every vector met
is scored whole; at each depth the values last read bound what an unseen vector can reach.
The query is done with the block once its k-th score is above that bound (equal scores
go by the smaller id, so an equal bound reads on).  The best k of every block
meet per query and the best k of those are the answer.

Queries travel in blocks of bounded size too: one task holds one block of vectors and one of
queries.  Vectors that are null or hold null or non-finite components take no part; vectors are
scored against queries of the same number of components; null ids take no part.
Repeated rows are candidates (and queries) each; a query is never compared with rows of its
own id.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

BLOCK_ROWS = 4096
QUERY_ROWS = 512
BLOCK_SCHEMA = "block int, part int, dims int, ids binary, rows binary, vectors binary, lists binary"
BLOCK_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("dims", pa.int32()),
                         *((c, pa.binary()) for c in ("ids", "rows", "vectors", "lists"))])
FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, dims, v): components as floor(scale * x), for vectors without gaps."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    big = F.lit(float("inf"))
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < big))
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.select("row", "vec_id", F.size("embedding").alias("dims"),
                       F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def blocks(rows: DataFrame, n: int, sort: bool, times: int, of_queries: bool) -> DataFrame:
    """Rows gathered into n blocks, each offered to all ``times`` blocks of the other side."""
    def group(table: pa.Table) -> pa.Table:
        out = [[] for _ in BLOCK_ARROW]
        dims = table.column("dims").to_numpy()
        for d in np.unique(dims).tolist():
            part = table.filter(pa.array(dims == d))
            ids, own = part.column("vec_id").to_numpy(), part.column("row").to_numpy()
            v = part.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), d)
            order = np.argsort(ids, kind="stable")
            ids, own, v = ids[order], own[order], np.ascontiguousarray(v[order])
            lists = np.ascontiguousarray(np.argsort(v, axis=0, kind="stable").T.astype(np.uint32)) if sort else np.zeros(0)
            row = [part.column("block")[0].as_py(), 0, d, ids.tobytes(), own.tobytes(), v.tobytes(), lists.tobytes()]
            for column, x in zip(out, row, strict=True):
                column.append(x)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, BLOCK_ARROW, strict=True)], schema=BLOCK_ARROW)

    block = F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    made = rows.withColumn("block", block).groupBy("block").applyInArrow(group, BLOCK_SCHEMA)
    other = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    if of_queries:
        made = made.withColumn("part", F.col("block")).withColumn("block", other)
    else:
        made = made.withColumn("part", other)
    return made.withColumns({c: F.col(c).cast("int") for c in ("block", "part")})


def threshold_search(q: np.ndarray, own_id: int, ids: np.ndarray, v: np.ndarray, lists: np.ndarray, k: int):
    """The k best (place, score) of a block for one query; ids ascend."""
    n = len(ids)
    used = np.flatnonzero(q)
    seen = np.zeros(n, bool)
    best = np.zeros(0, np.int64)
    scores = np.zeros(0, np.int64)
    if not len(used):  # every score is 0: the lists say nothing, the smallest ids win
        best = np.flatnonzero(ids != own_id)[:k]
        return best, np.zeros(len(best), np.int64)
    walk = np.stack([lists[d][::-1] if q[d] > 0 else lists[d] for d in used])
    weight, depth, step = q[used], 0, 8
    while depth < n:
        end = min(n, depth + step)
        mask = np.zeros(n, bool)
        mask[walk[:, depth:end].ravel()] = True
        fresh = np.flatnonzero(mask & ~seen & (ids != own_id))
        seen |= mask
        best, scores = np.concatenate([best, fresh]), np.concatenate([scores, v[fresh] @ q])
        order = np.lexsort((best, -scores))[:k]
        best, scores = best[order], scores[order]
        bound = int((v[walk[:, end - 1], used] * weight).sum())
        if seen.all() or len(best) == k and scores[-1] > bound:
            break
        depth, step = end, step * 2
    return best, scores


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) for vectors (vec_id, embedding, ...)."""
    rows = scaled(vectors, scale)
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    # counts only: sizes of the deal, for any input
    count, asked = rows.agg(F.count("*"), F.count(F.when(F.pmod("vec_id", F.lit(every)) == 0, 1))).first()
    n, m = max(1, -(-count // BLOCK_ROWS)), max(1, -(-asked // QUERY_ROWS))

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros((0, 4), np.int64)]
        of = lambda t, c, i: np.frombuffer(t.column(c)[i].as_py(), np.int64)
        for i in range(left.num_rows):
            d = left.column("dims")[i].as_py()
            ids = of(left, "ids", i)
            v = of(left, "vectors", i).reshape(len(ids), d)
            lists = np.frombuffer(left.column("lists")[i].as_py(), np.uint32).reshape(d, len(ids))
            for j in range(right.num_rows):
                if right.column("dims")[j].as_py() != d:
                    continue
                names = of(right, "ids", j)
                asked = of(right, "vectors", j).reshape(len(names), d)
                for query_id, row, q in zip(names.tolist(), of(right, "rows", j).tolist(), asked, strict=True):
                    best, scores = threshold_search(q, query_id, ids, v, lists, k)
                    out.append(np.column_stack([np.full(len(best), row), np.full(len(best), query_id), ids[best], scores]))
        table = np.concatenate(out)
        return pa.table([pa.array(table[:, c]) for c in range(4)], schema=FOUND)

    left, right = blocks(rows, n, True, m, False), blocks(queries, m, False, n, True)
    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
        task, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark, sf_dir) -> DataFrame:
    """op3: 5 best for every 50th vector."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
