"""Exact top-k inner products of sparse integer vectors by exhaustive term-at-a-time accumulation.

Candidates are dealt into groups of about ``GROUP_ROWS`` by a hash of id and vector, queries into groups likewise; a cell is one group of each. In a cell every
dimension has its postings: the candidates with a weight there, and the weights. A query goes through its own non-zero
dimensions and adds query weight times posting weight into a dense array of scores, one per candidate. The k best are found by partition
selection, and the lists of all cells of a query are merged by a window that keeps k per query.

Every candidate meets every query, so results are exact. Ties go to the smaller id. Rows repeated with the same id and vector count once;
other rows with a query's id count as the query's own and are no candidates for it. Rows with a null id, and vectors that are null or hold null or non-finite
components, take no part; vectors may differ in length, missing dimensions being zero.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.llm.shared import shipped, width

GROUP_ROWS = 8192
PAIRS = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null unless all are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def sparse(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """Usable rows as (vec_id, dims, weights), non-zero components only; exact repeats once."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(vector), scale).alias("v")).where("vec_id is not null and v is not null")
    parts = rows.distinct().withColumn("nz", F.filter(F.transform("v", lambda x, i: F.struct(i.alias("d"), x.alias("w"))), lambda e: e["w"] != 0))
    return parts.select("vec_id", F.col("nz.d").alias("dims"), F.col("nz.w").alias("weights"))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids, by partition selection."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        level = np.flatnonzero(scores == least)
        room = k - len(above)
        if len(level) > room:
            level = level[np.argpartition(ids[level], room - 1)[:room]] if room else level[:0]
        return np.concatenate([above, level])
    return np.arange(len(scores))


def _cell(k: int):
    def run(cell, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        ids = candidates["vec_id"].to_numpy(np.int64)
        n = len(ids)
        if not n or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        row = np.repeat(np.arange(n), candidates["dims"].map(len))
        dims = np.concatenate(candidates["dims"].to_list()).astype(np.int64)
        weights = np.concatenate(candidates["weights"].to_list()).astype(np.int64)
        order = np.argsort(dims, kind="stable")
        row, dims, weights = row[order], dims[order], weights[order]
        terms = np.unique(dims)
        starts = np.searchsorted(dims, terms)
        ends = np.append(starts[1:], len(dims))
        postings = {t: (row[a:b], weights[a:b]) for t, a, b in zip(terms.tolist(), starts, ends)}
        found = []
        for query, q_dims, q_weights in zip(queries["vec_id"], queries["dims"], queries["weights"]):
            scores = np.zeros(n, np.int64)
            for d, w in zip(q_dims, q_weights):
                listed = postings.get(d)
                if listed is not None:
                    scores[listed[0]] += w * listed[1]  # a candidate is listed once per dimension
            others = np.flatnonzero(ids != query)
            best = others[_best(scores[others], ids[others], k)]
            found.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": scores[best]}))
        return pd.concat(found)
    return run


def search(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) from frames of (vec_id, dims, weights)."""
    spark = queries.sparkSession
    shipped(spark)
    n, m = candidates.count(), queries.count()
    across = max(min(width(spark), math.ceil(n / 64)), math.ceil(n / GROUP_ROWS), 1)
    down = max(1, math.ceil(m / GROUP_ROWS))
    dealt = F.pmod(F.xxhash64("vec_id", "weights"), F.lit(across))
    group = F.pmod(F.xxhash64("vec_id", "weights", F.lit(1)), F.lit(down))
    left = queries.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(across - 1)), lambda c: c + group * across)))
    right = candidates.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(down - 1)), lambda g: g * across + dealt)))
    pairs = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInPandas(_cell(k), PAIRS).distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Top k of every row whose id is divisible by ``every`` against all other rows."""
    rows = sparse(vectors, vec_id, vector, scale)
    return search(rows.where(F.col("vec_id") % every == 0), rows, k)
