"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

1. Codes of ``BITS`` bits are learned on a sample of at most ``SAMPLE`` vectors: unit vectors are centred, projected on their principal directions,
   and turned by rotations fitted so that signs lose least (iterative quantisation); as many rotations from different starts as ``BITS`` takes. Every vector
   gets a code, the sample only sets the rotations and the radius.
2. The radius is the Hamming distance within which the share ``RECALL`` of the true nearest neighbours of sampled vectors lies.
3. Candidates are dealt into cells of about ``CELL_ROWS``. A cell cuts codes into substrings of 8 bits and indexes each. By the pigeonhole principle a code within the radius
   is within a small radius of a query's in one substring at least, so probing each index with all substrings that near retrieves every code within the radius.
   The full distance is then checked, and the rest ranked by cosine on the original vectors in double precision. The best k of each cell are merged.
4. Queries with fewer than k neighbours within the radius are asked again with the radius of all bits, which finds all.

Vectors that are null, zero or hold null or non-finite components, and rows without an id, take no part. Missing dimensions of shorter vectors are zero. Rows repeated with id and
vector count once; other rows with a query's id are no candidates for it, and a candidate id with several vectors counts with its nearest. Ties go to the smaller id. Of equal vectors only
the k + 1 smallest ids can be among the k nearest, so only these are dealt to the cells; the result is the same.
"""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.llm.shared import shipped, stored, width

BITS = 256
SAMPLE = 8192
ASKED = 512
ROUNDS = 25
RECALL = 0.98
CELL_ROWS = 16_384
CELL_BYTES = 64 << 20
FOUND = "query_id long, vec_id long, score double"

_bytes_apart = np.array([i.bit_count() for i in range(256)], np.uint8)


@dataclass(frozen=True)
class Codes:
    """Learned centre and directions (dimensions x bits), and the radius."""

    centre: np.ndarray
    directions: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Packed codes of the rows, one byte per substring."""
        signs = (units(padded(vectors, len(self.centre))) - self.centre) @ self.directions > 0
        return np.packbits(signs, axis=1)


def padded(vectors: np.ndarray, size: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, size - vectors.shape[1]))) if vectors.shape[1] < size else vectors


def units(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def matrix(column, size: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros; far too large or small ones scaled by a power of two, which leaves their cosines as they are."""
    out = np.zeros((len(column), size))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    largest = np.abs(out).max(axis=1)
    odd = (largest > 1e100) | (largest < 1e-100)
    out[odd] = np.ldexp(out[odd], -np.frexp(largest[odd])[1][:, None])
    return out


def learn(sample: np.ndarray, k: int, bits: int = BITS, seed: int = 11) -> Codes:
    """Rotations and radius from sampled vectors."""
    rng = np.random.default_rng(seed)
    x = units(sample)
    centre = x.mean(axis=0)
    x = x - centre
    _, _, axes = np.linalg.svd(x.T @ x)
    axes = axes[:min(bits, len(axes))].T
    projected, turned = x @ axes, []
    for _ in range(math.ceil(bits / axes.shape[1])):
        rotation = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.sign(projected @ rotation).T @ projected)
            rotation = (u @ v).T
        turned.append(axes @ rotation)
    directions = np.concatenate(turned, axis=1)[:, :bits]
    codes = Codes(centre, directions, bits)
    return Codes(centre, directions, _radius(sample, codes, k, bits))


def _radius(sample: np.ndarray, codes: Codes, k: int, bits: int) -> int:
    """Distance within which the wanted share of the true nearest lies; all bits where the sample is too small to tell."""
    if len(sample) <= 4 * k:
        return bits
    x, packed = units(sample), codes.of(sample)
    apart = []
    for i in range(min(ASKED, len(x))):
        cosine = x @ x[i]
        cosine[i] = -2
        nearest = np.argpartition(-cosine, k)[:k]
        apart.append(_bytes_apart[packed[nearest] ^ packed[i]].sum(axis=1))
    return int(np.ceil(np.quantile(np.concatenate(apart), RECALL)))


class Substrings:
    """One index per byte of the codes: postings by value; ``within`` retrieves all codes within a radius."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        n, self.width = codes.shape
        self.postings = np.argsort(codes, axis=0, kind="stable").T.astype(np.int32).ravel()
        counts = np.array([np.bincount(codes[:, j], minlength=256) for j in range(self.width)])
        first = np.arange(self.width)[:, None] * n
        self.ends = first + np.cumsum(counts, axis=1)
        self.starts = self.ends - counts

    def probes(self, radius: int) -> list[np.ndarray]:
        """For each substring the differences to try: if all were further away, the whole would be beyond the radius."""
        share, more = divmod(radius, self.width)
        return [np.flatnonzero(_bytes_apart <= (share if j <= more else share - 1)) for j in range(self.width)]

    def within(self, code: np.ndarray, radius: int, probes: list[np.ndarray]) -> np.ndarray:
        """Places of all codes within the radius."""
        if radius >= 8 * self.width:
            return np.arange(len(self.codes))
        starts = np.concatenate([self.starts[j, code[j] ^ p] for j, p in enumerate(probes)])
        ends = np.concatenate([self.ends[j, code[j] ^ p] for j, p in enumerate(probes)])
        sizes = ends - starts
        places = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        met = np.zeros(len(self.codes), bool)
        met[self.postings[places]] = True
        near = np.flatnonzero(met)
        return near[_bytes_apart[self.codes[near] ^ code].sum(axis=1, dtype=np.int64) <= radius]


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row and the query; sums go row by row, so equal rows have equal results."""
    return (vectors * query).sum(axis=1) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best ids, each once with its best score; ties to smaller ids."""
    order = np.lexsort((ids, -scores))
    first = np.sort(np.unique(ids[order], return_index=True)[1])
    return order[first[:k]]


def _cell(shared, k: int, size: int, radius: int):
    def run(cell, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(queries) and len(candidates):
            asked, vectors = matrix(queries["vector"], size), matrix(candidates["vector"], size)
            ids = candidates["vec_id"].to_numpy(np.int64)
            index = Substrings(shared.value.of(vectors))
            probes = index.probes(radius)
            for query, vector, code in zip(queries["vec_id"], asked, shared.value.of(asked)):
                near = index.within(code, radius, probes)
                near = near[ids[near] != query]
                scores = cosines(vectors[near], vector)
                best = best_of(ids[near], scores, k)
                found.append((np.full(len(best), query), ids[near][best], scores[best]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))
    return run


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, repeated ones once."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0)
    kept = F.col(vector) if dict(vectors.dtypes)[vector] == "array<float>" else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), kept.alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).distinct()


def sampled(rows: DataFrame, total: int, most: int) -> DataFrame:
    """About ``most`` rows, those with the smallest hashes of vector and id."""
    share = F.pmod(F.xxhash64("vector", "vec_id", F.lit(7)), F.lit(1 << 30)) / F.lit(1 << 30)
    near = rows.where(share <= min(1.0, 1.2 * most / max(total, 1) + 1e-6))
    return near.orderBy(share, "vec_id").limit(most).select("vector")


def search(queries: DataFrame, candidates: DataFrame, codes, k: int, size: int, radius: int, total: int) -> DataFrame:
    """(query_id, vec_id, score): the k nearest candidates within the radius; ``codes`` is the broadcast of ``Codes``."""
    most = max(1, min(CELL_ROWS, CELL_BYTES // (8 * size)))
    across = max(1, min(width(candidates.sparkSession), math.ceil(total / 256)), math.ceil(total / most))
    down = max(1, math.ceil(queries.count() / most))
    own = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(across))
    group = F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(down))
    left = queries.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(across - 1)), lambda c: c + group * across)))
    right = candidates.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(down - 1)), lambda g: g * across + own)))
    pairs = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInPandas(_cell(codes, k, size, radius), FOUND)
    # a query id or candidate id may have several vectors
    nearest = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return nearest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by ``every``, among all other rows."""
    spark = vectors.sparkSession
    shipped(spark)
    rows = stored(usable(vectors, vec_id, vector), "vectors")
    row = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("size")).first()
    total, size = row["n"], row["size"] or 1
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    same = W.partitionBy("vector").orderBy("vec_id")
    candidates = stored(rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n"), "candidates")
    codes = learn(matrix(sampled(candidates, total, SAMPLE).toPandas()["vector"], size), k)
    shared = spark.sparkContext.broadcast(codes)
    queries = rows.where(F.col("vec_id") % every == 0)
    found = stored(search(queries, candidates, shared, k, size, codes.radius, total), "nearest").select("query_id", "rank", "vec_id", "score")
    enough = found.groupBy(F.col("query_id").alias("vec_id")).count().where(F.col("count") >= k)
    few = stored(queries.join(enough, "vec_id", "left_anti"), "few")
    if few.isEmpty():
        return found
    again = search(few, candidates, shared, k, size, BITS, total).select(*found.columns)
    return found.join(few.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
