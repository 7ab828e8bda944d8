"""Toxicity by weak supervision.

Voters are small lexicons and patterns. Their terms are words, and word stems that are dense in a
text (several different words with that stem, together a certain share of the text). The terms are
picked from a bounded number of labelled rows; how far each voter can be trusted is not: a generative model with a hidden class is
fitted to the votes alone by expectation maximisation, with voters that still agree beyond what the
class explains (correlated ones) sharing their weight. Its posterior labels train a linear
classifier over the presence of terms, which scores every document.

Counting and scoring run in Spark over whole texts. The driver sees a fixed number of terms, and for
at most SAMPLE rows one bit per term.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumweave.llm.exchange import saved

#: At most so many labelled rows train the model; which ones is decided by a hash of their id.
SAMPLE = 20_000
#: Terms of the lexicon, lexicon terms per voter, and terms the classifier sees.
LEXICON, PER_VOTER, VOCABULARY = 96, 3, 256
#: A term enters the lexicon if so many labelled toxic rows hold it and so large a part of its rows is toxic.
SUPPORT, PURITY = 4, 0.8
#: Letters of a stem; the least share of a text's words, in hundredths, and different words, where it is dense.
STEM, DENSE, DIFFERENT = range(4, 8), 1, 2
#: Every fifth id is held out from all learning.
FOLDS = 5

_WORD = re.compile(r"[^\W_]+")


def words(data: bytes | None) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return _WORD.findall((data or b"").decode("utf-8", "replace").lower())


def terms(data: bytes | None, stems: set[str] | None = None) -> set[str]:
    """The words of a text, and its dense stems, written ``stem*``; stems: only these are looked for."""
    counts = Counter(words(data))
    most, n = Counter(), sum(counts.values())
    different = Counter()
    for word, times in counts.items():
        for size in STEM:
            if len(word) < size:
                break
            stem = word[:size]
            if stems is None or stem in stems:
                most[stem] += times
                different[stem] += 1
    return {*counts, *(f"{stem}*" for stem, d in different.items() if d >= DIFFERENT and 100 * most[stem] >= DENSE * n)}


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0


@dataclass
class Model:
    """Weights by term, and a bias."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0
    accuracy: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.stems = {t[:-1] for t in self.weights if t.endswith("*")}

    def score(self, data: bytes | None) -> float:
        z = self.bias + sum(sorted(self.weights[t] for t in terms(data, self.stems) if t in self.weights))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic): labelled rows that are not held out, at most so many."""
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
    # An id that is labelled twice takes the higher label; one text stands for an id.
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    # The chosen ids are at most `sample` rows, so the documents need not be shuffled.
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def term_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, n): rows of each label that hold the term."""
    def run(batches):
        for batch in batches:
            out, marks = [], []
            for data, toxic in zip(batch.column(0), batch.column(1)):
                found = terms(data.as_py())
                out.extend(found)
                marks.extend([toxic.as_py()] * len(found))
                if len(out) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(marks, pa.int32())], ["word", "toxic"])
                    out, marks = [], []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(marks, pa.int32())], ["word", "toxic"])

    return rows.select("text", "toxic").mapInArrow(run, "word string, toxic int").groupBy("word", "toxic").agg(
        F.count(F.lit(1)).alias("n"))


def voters(lexicon: list[str]) -> list[tuple[str, set[str], int]]:
    """(name, words, least distinct hits) of each voter: lexicons of a few words, and density patterns."""
    out = [(f"lexicon {i // PER_VOTER}", set(lexicon[i:i + PER_VOTER]), 1) for i in range(0, len(lexicon), PER_VOTER)]
    half = len(lexicon) // 2
    # Patterns: any of the surest, several different ones at once.
    return [*out, ("any of the surest", set(lexicon[:max(1, half)]), 1), ("two at once", set(lexicon), 2), ("three at once", set(lexicon), 3)]


def label_model(votes: np.ndarray, prior: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(posterior, accuracy) from votes alone: rows x voters, 1 for toxic, 0 for abstaining.

    Voters are first taken as independent given the class. Where two agree beyond that (correlation
    of what the posterior leaves over above 0.2), both count for less, and the model is fitted anew.
    """
    rows, n = votes.shape
    weight = np.ones(n)
    posterior = np.where(votes.any(axis=1), 0.9, 0.02)
    rates = np.zeros((2, n))
    for step in range(2):
        for _ in range(rounds):
            before = posterior
            share = np.clip(posterior.mean(), 1e-4, 1 - 1e-4)
            rates[1] = (posterior @ votes + 0.5) / (posterior.sum() + 1)
            rates[0] = ((1 - posterior) @ votes + 0.01) / ((1 - posterior).sum() + 1)
            yes = np.log(rates[1] / rates[0])
            no = np.log((1 - rates[1]) / (1 - rates[0]))
            z = np.log(share / (1 - share)) + (votes * (weight * yes) + (1 - votes) * (weight * no)).sum(axis=1)
            posterior = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            if np.abs(posterior - before).max() < 1e-6:
                break
        if step == 0 and rows > 1:
            expected = posterior[:, None] * rates[1] + (1 - posterior)[:, None] * rates[0]
            rest = votes - expected
            spread = np.sqrt((rest ** 2).mean(axis=0)) + 1e-9
            correlation = np.abs((rest.T @ rest) / rows / spread[:, None] / spread[None, :])
            np.fill_diagonal(correlation, 0)
            weight = 1 / (1 + np.where(correlation > 0.2, correlation, 0).sum(axis=1))
    # The share of a voter's toxic votes that are right.
    right = (posterior @ votes + 1e-9) / (votes.sum(axis=0) + 1e-9)
    return posterior, right


def linear_classifier(x: np.ndarray, target: np.ndarray, rounds: int = 400, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes of equal weight, by accelerated gradient steps."""
    w, b, mw, mb = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    each = target / max(target.sum(), 1e-9) + (1 - target) / max((1 - target).sum(), 1e-9)
    each = (each / each.sum()).astype(np.float32)
    # A step that the loss's curvature allows.
    rate = 4 / max(1.0, float(np.max(x.sum(axis=1)) + 1) / 8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -30, 30)))
        error = each * (p - target)
        mw = 0.9 * mw + x.T @ error.astype(np.float32) + ridge * w / 10
        mb = 0.9 * mb + error.sum()
        w, b = w - rate * mw, b - rate * mb
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model; without toxic training rows one that calls nothing toxic."""
    rows = saved(docs.sparkSession, training_rows(docs, labels, sample), "training")
    counts = term_counts(rows).groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("all"))
    # A fixed number of rows reaches the driver: the terms surest to be toxic.
    purity = F.col("bad") / (F.col("all") + 0.5)
    vocabulary = [r["word"] for r in counts.where((F.col("bad") >= SUPPORT) & (purity >= PURITY)).orderBy(
        F.desc(F.round(purity, 2) * F.log1p("bad")), "word").limit(VOCABULARY).collect()]
    if not vocabulary:
        return Model()
    lexicon = vocabulary[:LEXICON]
    stems = {t[:-1] for t in vocabulary if t.endswith("*")}
    place = {w: i for i, w in enumerate(vocabulary)}

    def presence(batches):
        for batch in batches:
            out = []
            for data in batch.column(0):
                bits = np.zeros(len(place), dtype=np.uint8)
                bits[[place[t] for t in terms(data.as_py(), stems) if t in place]] = 1
                out.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["bits"])

    packed = rows.select("text").mapInArrow(presence, "bits binary").collect()
    if not packed:
        return Model()
    x = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in packed]), axis=1)[:, :len(vocabulary)].astype(np.float32)
    named = voters(lexicon)
    votes = np.stack([(x[:, [place[w] for w in sorted(own)]].sum(axis=1) >= least) for _, own, least in named], axis=1).astype(float)
    posterior, right = label_model(votes, float(votes.any(axis=1).mean()))
    w, b = linear_classifier(x, posterior)
    return Model({v: float(c) for v, c in zip(vocabulary, w)}, b, {name: float(r) for (name, _, _), r in zip(named, right)})


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; empty and null texts get the score of a text without known terms."""
    def run(batches):
        for batch in batches:
            out = [model.score(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs. A null id is not held out; texts only decide the score."""
    return score(docs, fit(docs, labels, sample)).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that are not called toxic, all columns as they are. Rows are judged in one pass over the table."""
    model = fit(docs, labels, sample)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            yield batch.filter(pa.array([model.score(x.as_py()) < 0.5 for x in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
