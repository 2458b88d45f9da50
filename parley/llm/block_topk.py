"""Exact top-k search over integer vectors with block bounds.

A component is a term, its value the term's impact (negative ones allowed).
Documents are ordered by their strongest term and id and cut into ranges of
``BLOCK`` documents. A block carries a forward index (all its impacts) and for
each term the largest and smallest impact. For one query the sum over terms of
weight times the better extreme bounds every score in the block. Blocks are
taken per query in the order of these bounds, in waves of doubling length,
until the next bound falls below the query's k-th best score; a bound equal to
it still counts if the block may hold a smaller id.

Queries (groups of ``GROUP``) and blocks (shards of ``SHARD`` blocks) meet in a
grid of cells, each of bounded size, whatever the number of equal vectors; a
cell returns at most k rows per query, and these are merged. Scores are whole
numbers: they are computed in doubles where these are exact, else in unbounded
integers, and clipped to 64 bits.

Vectors that are null or hold a null, NaN or infinite component, vectors of
another number of components than most (of equally many the greater), and rows without id take no part. Of rows with
equal ids the smallest vector counts. An empty table gives no rows; fewer
candidates than k give all of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import small_batches, table
from parley.staging import stage

BLOCK, SHARD, GROUP = 256, 64, 512
_LIMIT = 2**63 - 1

RESULT = "query_id long, rank int, vec_id long, score long"


def _matrix(parts, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.int64).reshape(-1, width)


def _product(queries: np.ndarray, docs: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products, exact; as doubles or as Python integers."""
    if exact:
        return queries.astype(float) @ docs.T.astype(float)
    return queries.astype(object) @ docs.T.astype(object)


def pack_blocks(vectors: DataFrame, shards: int) -> DataFrame:
    """``shard, ids, impacts, top, bottom``: one row per block; ``vectors`` holds ``id`` and ``impacts`` (array of long)."""

    def pack(batches):
        from pyspark import TaskContext

        shard, ids, rows = TaskContext.get().partitionId(), [], []

        def block(n):
            m = np.array(rows[:n], dtype=np.int64)
            out = (shard, np.array(ids[:n], np.int64).tobytes(), m.tobytes(), m.max(axis=0).tobytes(), m.min(axis=0).tobytes())
            del ids[:n], rows[:n]
            return out

        for batch in batches:
            ids.extend(batch["id"])
            rows.extend(batch["impacts"])
            full = [block(BLOCK) for _ in range(len(ids) // BLOCK)]
            yield pd.DataFrame(full, columns=["shard", "ids", "impacts", "top", "bottom"])
        if ids:
            yield pd.DataFrame([block(len(ids))], columns=["shard", "ids", "impacts", "top", "bottom"])

    strength = F.transform("impacts", lambda x: F.abs(x))
    strongest = F.array_position(strength, F.array_max(strength))
    ordered = (
        vectors.withColumn("_axis", strongest * F.signum(F.element_at("impacts", F.greatest(strongest, F.lit(1)).cast("int"))))
        .repartitionByRange(shards, "_axis", "id").sortWithinPartitions("_axis", "id")
    )
    return ordered.select("id", "impacts").mapInPandas(pack, "shard int, ids binary, impacts binary, top binary, bottom binary")


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.query = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.score = np.empty(0, object)
        self.least = np.full(n, -np.inf, object)  # k-th best score
        self.last = np.full(n, _LIMIT)  # its id

    def add(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        query, ids, score = (np.concatenate(x) for x in zip((self.query, self.id, self.score), *found))
        if score.dtype == object and all(abs(s) < 2**53 for s in score):
            score = score.astype(float)
        order = np.lexsort((ids, -score, query)) if score.dtype != object else np.array(
            sorted(range(len(score)), key=lambda i: (query[i], -score[i], ids[i])), dtype=np.int64)
        query, ids, score = query[order], ids[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        self.query, self.id, self.score = query[keep], ids[keep], score[keep]
        kth = place == self.k - 1
        self.least[query[kth]] = score[kth]
        self.last[query[kth]] = ids[kth]


def search_cell(query_ids: np.ndarray, queries: np.ndarray, blocks: list[tuple], k: int) -> Best:
    """Best documents of one group of queries among one shard's blocks (ids, impacts, top, bottom)."""
    width = queries.shape[1]
    largest = max((int(np.abs(queries.astype(object)).max(initial=0)), 1))
    tops, bottoms = _matrix([b[2] for b in blocks], width), _matrix([b[3] for b in blocks], width)
    peak = max(int(np.abs(tops.astype(object)).max(initial=0)), int(np.abs(bottoms.astype(object)).max(initial=0)))
    exact = largest * peak * width < 2**53
    bounds = _product(np.maximum(queries, 0), tops, exact) + _product(np.minimum(queries, 0), bottoms, exact)
    order = np.argsort(-bounds, axis=1, kind="stable")
    smallest = np.array([np.frombuffer(b[0], np.int64).min() for b in blocks])
    best = Best(len(query_ids), k)
    start, length = 0, 1
    rows = np.arange(len(query_ids))
    open_queries = rows
    while start < len(blocks) and len(open_queries):
        wave = order[open_queries, start : start + length]
        bound = bounds[open_queries[:, None], wave]
        least, last = best.least[open_queries, None], best.last[open_queries, None]
        wanted = (bound > least) | ((bound == least) & (smallest[wave] < last))
        found = []
        who, where = np.nonzero(wanted)
        by_block = np.argsort(wave[who, where], kind="stable")
        who, where = who[by_block], where[by_block]
        blocks_met, first = np.unique(wave[who, where], return_index=True)
        for b, chosen in zip(blocks_met, np.split(open_queries[who], first[1:])):
            ids = np.frombuffer(blocks[b][0], np.int64)
            score = _product(queries[chosen], _matrix([blocks[b][1]], width), exact)
            limit, limit_id = best.least[chosen, None], best.last[chosen, None]
            if exact:
                limit = limit.astype(float)
            good = (score > limit) | ((score == limit) & (ids[None] < limit_id))
            good &= ids[None] != query_ids[chosen, None]
            i, j = np.nonzero(good)
            found.append((chosen[i], ids[j], score[i, j]))
        if found:
            best.add(found)
        start, length = start + length, 2 * length
        if start < len(blocks):
            following = bounds[open_queries, order[open_queries, start]]
            # Bounds only fall from here; on equality a smaller id may still come.
            open_queries = open_queries[following >= best.least[open_queries]]
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` (``id``, ``impacts``) that are queries."""
    small_batches(vectors.sparkSession, 2048)
    rows = vectors.filter(F.col("id").isNotNull() & F.col("impacts").isNotNull() & ~F.exists("impacts", lambda x: x.isNull()))
    rows = stage(rows.groupBy("id").agg(F.min("impacts").alias("impacts")), "topk-vectors")
    widths = rows.groupBy(F.size("impacts").alias("width")).agg(F.count("*").alias("n"), F.coalesce(F.sum(is_query.cast("long")), F.lit(0)).alias("queries"))
    usual = widths.filter("width > 0").orderBy(F.desc("n"), F.desc("width")).first()
    if usual is None or not usual.queries:
        return vectors.sparkSession.createDataFrame([], RESULT)
    n, n_queries, width = usual.n, usual.queries, usual.width
    rows = rows.filter(F.size("impacts") == width)
    shards, groups = -(-n // (BLOCK * SHARD)), -(-n_queries // GROUP)
    blocks = stage(pack_blocks(rows, shards), "topk-blocks")
    queries = rows.filter(is_query).withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))

    def cell(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        ids = left["id"].to_numpy(np.int64)
        found = search_cell(
            ids, np.array(left["impacts"].tolist(), np.int64), list(right[["ids", "impacts", "top", "bottom"]].itertuples(index=False, name=None)), k)
        return pd.DataFrame({"query_id": ids[found.query], "vec_id": found.id, "score": [max(-_LIMIT - 1, min(_LIMIT, int(s))) for s in found.score]})

    left = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    cells = left.groupBy("group", "shard").cogroup(right.groupBy("group", "shard")).applyInPandas(cell, "query_id long, vec_id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = cells.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def whole(x: Column) -> Column:
    """floor(64 x) of a component, x as double; null if it is not finite."""
    scaled = F.floor(x.cast("double") * 64)
    return F.when(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), scaled.cast("long"))


def op1_exact_topk(spark, sf_dir):
    """The 20 highest integer inner products of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", whole).alias("impacts"))
    return top_k(vectors, F.col("id") % 20 == 0, 20)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.w, d.w) AS BIGINT) AS score
  FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
