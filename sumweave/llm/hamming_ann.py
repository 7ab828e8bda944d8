"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A bounded sample fits rotations (iterative quantisation of the principal axes) whose signs are a
vector's code. Codes are cut into substrings, and each substring is an index of its own. Codes
within a Hamming radius agree on some substring up to the radius over their number (pigeonhole), so
probing each index with all values that near retrieves every code within the radius. These are then
ranked by distance of the original vectors.

Vectors are dealt to blocks of bounded size, and so are queries; a task indexes one block of vectors
and answers one block of queries. A block where a query finds fewer than it asked for is searched
again with a wider radius.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sumweave.llm.exchange import saved

#: Bits of a code and of a substring.
BITS, SUBSTRING = 128, 16
#: Vectors that fit the rotations and the radius; so large a part of their own neighbours must lie within the radius.
SAMPLE, WITHIN = 4000, 0.985
#: Vectors and queries of a task.
BLOCK, QUERIES = 4096, 1024

_COUNT = np.array([bin(i).count("1") for i in range(1 << SUBSTRING)], dtype=np.uint8)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): one vector per id. Left out are null ids, and vectors that are null, zero, hold null or non-finite
    components, or have another length than most (the greater length, if two are as frequent). Of several vectors of one
    id the least counts."""
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = df.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0))
    size = df.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return df.where(F.size("v") == (size["d"] if size else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


class Coder:
    """Signs along learned axes, as substrings."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, rounds: int = 25):
        rng = np.random.default_rng(7)
        d = sample.shape[1]
        self.mean = sample.mean(axis=0)
        x = sample - self.mean
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :bits]
        found, left = [], bits
        while left > 0:
            p = x @ axes
            turn = np.linalg.qr(rng.normal(size=(p.shape[1], p.shape[1])))[0]
            for _ in range(rounds):
                u, _, vt = np.linalg.svd(np.sign(p @ turn).T @ p)
                turn = (u @ vt).T
            found.append((axes @ turn)[:, :left])
            left -= found[-1].shape[1]
        self.axes = np.concatenate(found, axis=1)
        assert self.axes.shape == (d, bits)

    def codes(self, v: np.ndarray) -> np.ndarray:
        """rows x substrings of SUBSTRING bits."""
        bits = ((v - self.mean) @ self.axes > 0).astype(np.uint8)
        return np.packbits(bits.reshape(len(v), -1, SUBSTRING), axis=2).view(">u2")[:, :, 0].astype(np.uint16)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _COUNT[a ^ b].sum(axis=-1, dtype=np.int64)


def fit(vectors: DataFrame, k: int, sample: int = SAMPLE, within: float = WITHIN) -> tuple[Coder, int]:
    """The coder, and a radius that holds that part of the k nearest neighbours within the sample.

    The whole table is denser than the sample, so that its neighbours are nearer still.
    """
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    x = np.array([r["v"] for r in rows], dtype=np.float64)
    coder = Coder(x)
    codes, norms, far = coder.codes(x), (x ** 2).sum(axis=1), []
    for i in range(0, len(x), max(1, len(x) // 400)):
        d = norms - 2 * x @ x[i]
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(x) - 1)]
        far.extend(hamming(codes[near], codes[i]).tolist())
    return coder, int(np.quantile(far, within)) if far else BITS


class MultiIndex:
    """One index per substring over the codes of a block."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            keys, start = np.unique(codes[order, j], return_index=True)
            self.tables.append((keys, np.append(start, len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows whose code is within the radius, each once."""
        m = len(self.tables)
        hit = np.zeros(len(self.codes), dtype=bool)
        for j, (keys, start, order) in enumerate(self.tables):
            # If no substring up to here is near enough, the rest have less to share out.
            near = np.flatnonzero(_COUNT[keys ^ code[j]] <= radius // m - (1 if j > radius % m else 0))
            if len(near):
                size = start[near + 1] - start[near]
                at = np.repeat(start[near] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                hit[order[at]] = True
        rows = np.flatnonzero(hit)
        return rows[hamming(self.codes[rows], code) <= radius]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10,
            sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query (vec_id, v), its own id left out, by Euclidean
    distance, ties to the smaller id. vectors and queries come from usable(); empty ones give an empty table, and where
    there are fewer than k candidates all are found."""
    out = "query_id long, vec_id long, score double"
    n, asked = vectors.count(), queries.count()
    if not n or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    coder, radius = fit(vectors, k, sample)
    blocks, askings = -(-n // block), -(-asked // QUERIES)
    spot = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    # Every block of queries meets every block of vectors.
    left = vectors.select(spot.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(askings - 1))).alias("asking"), "vec_id", "v")
    right = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(askings)).cast("int").alias("asking"), "vec_id", "v")

    def answer(key: tuple, here: pa.Table, there: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if here.num_rows and there.num_rows:
            ids, v = here.column("vec_id").to_numpy(), _matrix(here.column("v"))
            index = MultiIndex(coder.codes(v))
            q_ids, q = there.column("vec_id").to_numpy(), _matrix(there.column("v"))
            for i, code in enumerate(coder.codes(q)):
                reach = radius
                while True:
                    rows = index.within(code, reach)
                    rows = rows[ids[rows] != q_ids[i]]
                    if len(rows) >= k or reach >= BITS:
                        break
                    reach = min(BITS, reach + BITS // 16)
                score = np.sqrt(((v[rows] - q[i]) ** 2).sum(axis=1))
                best = np.lexsort((ids[rows], score))[:k]
                found.append((np.full(len(best), q_ids[i]), ids[rows[best]], score[best]))
        if not found:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        a, b, c = (np.concatenate(x) for x in zip(*found))
        return pa.table({"query_id": a, "vec_id": b, "score": c})

    keys = ["block", "asking"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(answer, out)
    # At most k rows come from a block, of which the k least of all remain.
    best = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def search(spark: SparkSession, embeddings: DataFrame, every: int = 100, k: int = 10, block: int = BLOCK) -> DataFrame:
    """The k nearest of every vector whose id is divisible by so much."""
    vectors = saved(spark, usable(embeddings), "vectors")
    return nearest(spark, vectors, vectors.where(F.col("vec_id") % every == 0), k, block=block)
