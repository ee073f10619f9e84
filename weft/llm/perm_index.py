"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order.  The vectors of a shard are posted, with the pivot's rank, in
the inverted file of each of these pivots.  A query walks the inverted files of its own pivots and adds up footrule
distances (rank differences; a pivot missing from one list counts as ranked behind it).  The nearest share by footrule
is reranked by the exact cosine of the original vectors, in double precision.

Shards hold a bounded number of vectors and meet bounded blocks of queries; their best are merged.  Equal vectors are
indexed once, with as many of their smallest ids as any answer can use.

Every query meets every shard: on vectors without clusters a query's nearest lie in most of the inverted files, so
leaving files out costs recall before it saves much (README has figures).  Large shards and query blocks keep down how
often a vector or a query is sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed
from .ego_join import unit_rows, usable

PIVOTS = 256  # the vectors with the lowest hashes of their ids
LISTED = 96  # nearest pivots a vector is posted under
SHARD = 32_768
QUERY_BLOCK = 16_384
SHARE, MORE = 0.06, 100  # of a shard and besides, reranked after the footrule ranking


def nearest_pivots(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The LISTED nearest pivots of each unit vector, nearest first, ties to the earlier pivot."""
    return np.argsort(-(units @ pivots.T), axis=1, kind="stable")[:, :LISTED].astype(np.int16)


class Shard:
    """Inverted files of some vectors: for each pivot the vectors that list it and its rank there."""

    def __init__(self, units: np.ndarray, pivots: np.ndarray):
        self.units, self.pivots = units, pivots
        lists = nearest_pivots(units, pivots)
        flat = lists.ravel()
        order = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[order], np.arange(len(pivots) + 1))
        who, rank = order // lists.shape[1], (order % lists.shape[1]).astype(np.int32)
        self.files = [(who[s:e], rank[s:e]) for s, e in zip(ends[:-1], ends[1:], strict=True)]
        self.listed = lists.shape[1]

    def candidates(self, listed: np.ndarray, least: int) -> np.ndarray:
        """The share of the shard, and MORE, nearest by footrule to a query's list of pivots; ``least`` at least."""
        n = len(self.units)
        keep = min(n, max(least, MORE + int(np.ceil(SHARE * n))))
        # of a shared pivot: |rank - rank'| instead of the two distances to the end of the lists
        saved = np.zeros(n, np.int32)
        for rank, pivot in enumerate(listed):
            who, ranks = self.files[pivot]
            saved[who] += 2 * self.listed - rank - ranks - np.abs(rank - ranks)
        return np.argpartition(-saved, keep - 1)[:keep]


def hashes() -> list[Column]:
    """128 bits that tell vectors apart."""
    return [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(9), "vector").alias("h2")]


def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one dimension as rows."""
    whole = vectors.combine_chunks()
    whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
    return np.asarray(whole.flatten().to_numpy(zero_copy_only=False), float).reshape(len(whole), -1)


def class_ids(rows: DataFrame, most: int, id_col: str, vector_col: str) -> DataFrame:
    """(h1, h2, ids, vector): each distinct usable vector once, with its ``most`` smallest ids.

    The ids are cut by a ranking, which Spark cuts per partition before the shuffle, so a vector that a third of all
    rows share sends few rows.  An answer of most - 1 neighbours can't hold more ids of one vector.
    """
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    v = v.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    v = v.select("*", *hashes())
    by_id = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = v.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= most)
    return few.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector"))


def search(
    rows: DataFrame, is_query: Column, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k nearest other rows found, by cosine.

    ``is_query`` is a condition on ``vec_id``.  Ties go to the smaller vec_id; with fewer candidates all are returned.
    Vectors that are null, zero or hold null or non-finite components, and rows without id, take no part; vectors of
    another dimension than the query's are no candidates.  Rows that repeat a vector are candidates each, but for the
    query's own row.  Rows that repeat an id with other vectors are queries of their own, with an answer each; rows that
    repeat both are one query.  No rows give no rows; other columns are not read.
    """
    spark = rows.sparkSession
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    queries = v.where(is_query & usable(F.col("vector")) & F.col("vec_id").isNotNull())
    queries = queries.select("vec_id", *hashes(), "vector").dropDuplicates(["vec_id", "h1", "h2"])
    classes = checkpointed(class_ids(rows, k + 1, id_col, vector_col).withColumn("dim", F.size("vector")))
    sizes = {r.dim: r["count"] for r in classes.groupBy("dim").count().collect()}  # one row a dimension
    n_queries = queries.count()
    pivots = {}
    for dim in sizes:
        low = classes.where(F.col("dim") == dim).orderBy(F.xxhash64(F.lit(2), F.element_at("ids", 1)), F.element_at("ids", 1))
        pivots[dim] = unit_rows(np.array([r.vector for r in low.limit(PIVOTS).select("vector").collect()], float))
    shards = {d: -(-n // shard) for d, n in sizes.items()}
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    count = F.coalesce(F.create_map(*[F.lit(x) for p in shards.items() for x in p])[F.col("dim")], F.lit(1)) if shards else F.lit(1)
    deal = lambda n, seed, c: F.pmod(F.xxhash64(F.lit(seed), c), n).cast("long")
    posted = (
        classes.withColumn("shard", deal(count, 3, F.col("h1")))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        .select("dim", "shard", "block", "h1", "h2", "ids", "vector")
    )
    asked = (
        queries.withColumn("dim", F.size("vector")).withColumn("block", deal(F.lit(blocks), 4, F.col("vec_id")))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), (count - 1).cast("long"))))
        .select("dim", "shard", "block", "h1", "h2", "vec_id", "vector")
    )

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = []
        if left.num_rows and right.num_rows:
            units = unit_rows(matrix(left["vector"]))
            ids = left["ids"].to_pylist()
            keys = list(zip(left["h1"].to_pylist(), left["h2"].to_pylist(), strict=True))
            asked_units = unit_rows(matrix(right["vector"]))
            index = Shard(units, pivots[units.shape[1]])
            lists = nearest_pivots(asked_units, index.pivots)
            for q, (query_id, *key) in enumerate(zip(*(right[c].to_pylist() for c in ("vec_id", "h1", "h2")), strict=True)):
                near = index.candidates(lists[q], k + 1)
                score = units[near] @ asked_units[q]
                # k + 1 classes hold the answer, as each has a row other than the query's but perhaps one; ties are kept
                cut = np.partition(score, max(0, len(score) - k - 1))[max(0, len(score) - k - 1)]
                best = []
                for c, s in zip(near[score >= cut], score[score >= cut], strict=True):
                    others = list(ids[c])
                    if keys[c] == tuple(key) and query_id in others:
                        others.remove(query_id)  # the query's own row
                    best += [(-s, i) for i in others]
                out += [(query_id, *key, i, -s) for s, i in sorted(best)[:k]]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query_id", "h1", "h2", "vec_id", "score"])

    cell_key = ("dim", "shard", "block")
    found = posted.groupBy(*cell_key).cogroup(asked.groupBy(*cell_key)).applyInArrow(cell, "query_id long, h1 long, h2 long, vec_id long, score double")
    best = Window.partitionBy("query_id", "h1", "h2").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
