"""Document quality: kernel ridge regression on document statistics by random Fourier features.

Each text is described once by a few statistics of its characters, words and lines (STATISTICS),
whatever its language. Random cosines of the standardised statistics approximate a Gaussian kernel,
so that ridge regression in their space needs only its normal equations, a matrix of fixed size that
each partition sums over its labelled rows. The scores are calibrated by isotonic regression against
scores from outside a row's own half of the training data.

All labelled rows train: nothing is sampled. The driver sees sums of fixed size only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumweave.llm.exchange import saved
from sumweave.llm.toxicity import held_out
from sumweave.llm.words import hashed_words, run_hashes

#: Random features, width of the kernel in standard deviations, weight of the ridge per row, and the seed of the features.
FEATURES, WIDTH, RIDGE, SEED = 256, 5.0, 1e-4, 11
#: Standardised statistics are held within so many standard deviations.
CLIP = 6.0
#: Cells of the scores that isotonic calibration works on, over the range -0.5 to 1.5.
CELLS = 512
#: A document is called good from this score on.
GOOD = 0.3
#: Rows turned into features at once, and tasks that add the sums of partitions.
ROWS, ADDERS = 2048, 32
#: Bytes of text described at once.
GROUP_BYTES = 1 << 20

STATISTICS = ["log characters", "log words", "mean word length", "word length spread", "lower-case share", "upper-case share", "digit share",
              "sentence mark share", "other mark share", "non-ASCII share", "log mean line length", "share of the longest line",
              "repeated line share", "distinct word share", "share of the most common word", "share of words like the one before",
              "distinct word pairs' share", "distinct run-of-four share", "words ending in a mark", "words without a letter", "longest run of one byte",
              "byte entropy"]

_KIND = np.full(256, 5, dtype=np.uint8)  # 0 lower, 1 upper, 2 digit, 3 sentence mark, 4 other mark, 5 white space and controls, 6 and 7 non-ASCII
_KIND[33:127] = 4
_KIND[97:123] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[np.frombuffer(b".,;:'\"?()-", np.uint8)] = 3
_KIND[0x80:0xC0] = 7
_KIND[0xC0:] = 6


def _distinct_share(hashes: np.ndarray) -> float:
    return len(np.unique(hashes)) / len(hashes) if len(hashes) else 1.0


def _one(data: bytes, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[float]:
    """The statistics of a text that has words."""
    view = np.frombuffer(data, np.uint8)
    count = np.bincount(view, minlength=256)
    kinds = np.bincount(_KIND, weights=count, minlength=8)
    chars = len(view) - kinds[7]
    lengths = ends - starts
    kind = _KIND[view]
    letters = np.flatnonzero((kind < 2) | (kind >= 6))
    held = np.searchsorted(letters, ends) - np.searchsorted(letters, starts)
    lines = data.split(b"\n")
    filled = [x for x in lines if x]
    times = np.unique(words, return_counts=True)[1]
    changes = np.flatnonzero(view[1:] != view[:-1])
    run = np.diff(np.concatenate([[-1], changes, [len(view) - 1]])).max()
    share = count[count > 0] / len(view)
    return [np.log1p(chars), np.log1p(len(words)), lengths.mean(), lengths.std(), *(kinds[:5] / chars), kinds[6] / chars,
            np.log1p(len(data) / len(lines)), max(map(len, lines)) / len(data), 1 - len(set(filled)) / len(filled),
            len(times) / len(words), times.max() / len(words), float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0,
            _distinct_share(run_hashes(words, 2)), _distinct_share(run_hashes(words, 4)),
            float((kind[ends - 1] == 4).mean()), float((held == 0).mean()), np.log1p(run), float(-(share * np.log2(share)).sum())]


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """One row of STATISTICS for each text; a text without words (null, empty or blank) has only zeros."""
    out = np.zeros((len(texts), len(STATISTICS)))
    words, starts, ends, first = hashed_words(texts)
    for i, text in enumerate(texts):
        a, b = first[i], first[i + 1]
        if b > a:
            out[i] = _one(text, words[a:b], starts[a:b], ends[a:b])
    return out


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats): the statistics of every row as packed 32-bit floats. Other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            edges = np.cumsum([0, *sizes], dtype=np.int64) // GROUP_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(edges[:-1])) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                rows = statistics(batch.column(1).slice(low, high - low).to_pylist()).astype("<f4")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array([r.tobytes() for r in rows], pa.binary())],
                                                 ["doc_id", "stats"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, stats binary")


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(len(column), -1).astype(np.float64)


def summed(rows: DataFrame, make: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of make(batch), a vector of `size` numbers, over all rows. Partitions add up their rows, ADDERS tasks
    the partitions' sums, and one task those, so that one vector reaches the driver."""
    def total(vectors: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(size)
        for vector in vectors:
            whole += vector
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([whole.tobytes()], pa.binary())], ["task", "sums"])

    def partial(batches):
        return total(make(batch.slice(low, ROWS)) for batch in batches for low in range(0, batch.num_rows, ROWS))

    def again(batches):
        return total(np.frombuffer(x.as_py()) for batch in batches for x in batch.column(1))

    shape = "task long, sums binary"
    parts = rows.mapInArrow(partial, shape).repartition(ADDERS, "task").mapInArrow(again, shape).coalesce(1).mapInArrow(again, shape)
    got = parts.collect()
    return sum((np.frombuffer(r["sums"]) for r in got), np.zeros(size))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centres, values) of the blocks of the non-decreasing step function nearest to y, by pooling adjacent violators. x is rising."""
    blocks: list[list[float]] = []  # weight, weight * x, weight * y
    for block in zip(weight.tolist(), (weight * x).tolist(), (weight * y).tolist()):
        blocks.append(list(block))
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    w, wx, wy = np.array(blocks).T
    return wx / w, wy / w


@dataclass
class Model:
    """Statistics to a score from 0 to 1. Without random features (nothing to learn from) every score is `base`."""

    base: float
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random cosines of the standardised statistics, and a constant."""
        rng = np.random.default_rng(SEED)
        turn = rng.standard_normal((stats.shape[1], FEATURES)) / WIDTH
        shift = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.centre) / self.spread, -CLIP, CLIP)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ turn + shift), np.ones((len(stats), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.base)
        return np.interp(self.features(stats) @ self.weights, self.knots, self.values)


def _solve(matrix: np.ndarray, right: np.ndarray, rows: float) -> np.ndarray:
    ridge = np.full(len(right), RIDGE * max(rows, 1.0))
    ridge[-1] *= 1e-3  # the constant is hardly held back
    return np.linalg.solve(matrix + np.diag(ridge), right)


def training_rows(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(stats, y, half): all labelled rows that are not held out. An id that is labelled twice takes the higher label; each
    row of a repeated id counts. The halves part by a hash of the id."""
    known = labels.select("doc_id", F.col(label).alias("y")).where("doc_id is not null and y is not null")
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg((F.max("y") > 0).cast("int").alias("y"))
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2)).cast("int").alias("half")
    return stats.join(known, "doc_id").select("stats", "y", half)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """The model; without labels every score is 0.5, with labels of one kind that kind."""
    rows = saved(stats.sparkSession, training_rows(stats, labels, label), "quality_training")
    k, d = len(STATISTICS), FEATURES + 1

    def moments(batch):
        x, y = _unpacked(batch.column(0)), batch.column(1).to_numpy()
        return np.concatenate([[len(x), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    n, good, *rest = summed(rows, moments, 2 + 2 * k)
    if n == 0:
        return Model(0.5)
    if good in (0, n):
        return Model(float(good / n))
    centre = np.array(rest[:k]) / n
    spread = np.sqrt(np.maximum(np.array(rest[k:]) / n - centre ** 2, 0))
    model = Model(float(good / n), centre, np.where(spread > 1e-6, spread, 1.0))

    def equations(batch):
        z, y, half = model.features(_unpacked(batch.column(0))), batch.column(1).to_numpy().astype(float), batch.column(2).to_numpy()
        out = []
        for own in (half == 0, half == 1):
            out.extend([[own.sum()], (z[own].T @ z[own]).ravel(), z[own].T @ y[own]])
        return np.concatenate(out)

    sums = summed(rows, equations, 2 * (1 + d * d + d)).reshape(2, -1)
    whole = sums.sum(axis=0)
    model.weights = _solve(whole[1:1 + d * d].reshape(d, d), whole[1 + d * d:], whole[0])
    # A row's calibration score comes from the half it is not in, or from all where that half is empty.
    other = [_solve(s[1:1 + d * d].reshape(d, d), s[1 + d * d:], s[0]) if s[0] else model.weights for s in sums[::-1]]

    def cells(batch):
        z, y, half = model.features(_unpacked(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        raw = np.where(half == 0, z @ other[0], z @ other[1])
        cell = np.clip(((raw + 0.5) / 2 * CELLS).astype(int), 0, CELLS - 1)
        return np.concatenate([np.bincount(cell, weights=w, minlength=CELLS) for w in (np.ones(len(raw)), y, raw)])

    count, positive, raw = summed(rows, cells, 3 * CELLS).reshape(3, -1)
    used = count > 0
    model.knots, model.values = isotonic(raw[used] / count[used], positive[used] / count[used], count[used])
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of described()."""
    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(_unpacked(part.column(1))))], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")


def judged(docs: DataFrame, labels: DataFrame, label: str = "quality", good: float = GOOD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs; predicted is 1 from the score `good` on.

    Texts alone decide a score: null, empty and blank texts have the same one, equal texts have equal ones.
    A null id is not held out and never labelled. Texts are read once; their statistics, about a hundred
    bytes each, are written to the shared folder, trained on and scored.
    """
    stats = saved(docs.sparkSession, described(docs), "statistics")
    return score(stats, fit(stats, labels, label)).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= good).cast("int").alias("predicted"))
