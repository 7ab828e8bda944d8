"""Phrase collocations by marginalising the counts of the longest windows.

Only one kind of n-gram is counted from the text: the window of the longest length that starts at a
word, padded where its piece ends. The words after the first come as lead columns of the same row. As
every word starts exactly one window, ROLLUP over the window's columns gives the counts of all shorter
phrases, and of all words, as sums of windows with the same beginning.

Most windows of a large corpus come once. A phrase that comes often holds only pairs, and triples, that
come often, so a window is cut (and padded) where its beginning stops to do so. Which do is found
beforehand, by counts of hashes, level by level: a run of k words is only looked at if both runs of k - 1
words in it are left. This takes no occurrence from any phrase that is frequent enough: the hash, and the
bitmaps of fixed size that tell the tasks what is frequent, can only keep too much. All counts in the
result are those of windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sumweave.llm.exchange import saved
from sumweave.llm.words import _powers, mix

#: Words of the longest phrase, its least count, phrases a language returns, and how large a part of a
#: phrase's occurrences a longer one takes so that the phrase is dropped, in hundredths.
LONGEST, LEAST, TOP, TAKEN = 4, 30, 2000, 80
#: The best score there is.
SCALE = 2_000_000
#: The language of texts without one.
NO_LANG = "und"
#: Bytes of text a task handles at once; a longer run of words without a break is handled whole.
CHUNK_BYTES = 2 << 20
#: Bits of a run's hash that are counted, and of the bitmap of frequent runs of one length (2**27 bits are 16 MB).
KEY_BITS, MAP_BITS = 44, 27
#: The best phrases of a language are picked from those of so many parts of it.
PARTS = 32

# Lower-cased A-Z, breaks as newline, separators as blank.
_PLAIN = bytearray(range(256))
_PLAIN[65:91] = range(97, 123)
for _byte in b".,;:!?\x0a\x0b\x0c\x0d":
    _PLAIN[_byte] = 10
_PLAIN[9] = 32
_PLAIN = bytes(_PLAIN)
_BLANKS = re.compile(rb" {2,}")

_BYTE, _LEFT, _RIGHT = (np.uint64(int.from_bytes(hashlib.sha256(x).digest()[:8], "little") | 1) for x in (b"phrase byte", b"left", b"right"))


def plain(text: bytes | None) -> bytes:
    """A text as pieces between newlines, words between single blanks."""
    out = (text or b"").translate(_PLAIN)
    return _BLANKS.sub(b" ", out) if b"  " in out else out


class Chunk:
    """The words of some plain text of one language: byte spans, hashes, and which words have a neighbour in their piece."""

    def __init__(self, lang: str, data: bytes):
        self.data = data
        view = np.frombuffer(data, np.uint8)
        inside = (view != 32) & (view != 10)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
        self.starts, self.ends = edges[0::2], edges[1::2]
        power, inverse = _powers(_BYTE, len(view) + 1)
        sums = np.zeros(len(view) + 1, dtype=np.uint64)
        np.cumsum((view.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64, out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64) * _LEFT)
        breaks = np.flatnonzero(view == 10)
        #: Which piece each word stands in.
        self.piece = np.searchsorted(breaks, self.starts)
        self.salt = np.uint64(int.from_bytes(hashlib.sha256(lang.encode()).digest()[:8], "little"))

    def keys(self, size: int) -> np.ndarray:
        """The key of the run of so many words from each word on, piece borders not regarded."""
        n = max(0, len(self.hashes) - size + 1)
        key = np.full(n, self.salt, dtype=np.uint64)
        for k in range(size):
            key = mix(key * _LEFT + self.hashes[k:k + n] * _RIGHT)
        return key >> np.uint64(64 - KEY_BITS)

    def looked_at(self, size: int, maps: list[np.ndarray]) -> np.ndarray:
        """Where runs of `size` words start that lie in one piece and whose inner runs are all frequent.

        maps: the bitmaps of the runs of 2, 3, ... words; the last that counts is that of size - 1."""
        left = np.arange(max(0, len(self.hashes) - 1))
        left = left[self.piece[left] == self.piece[left + 1]]
        for length in range(2, size):
            keys = self.keys(length)[left]
            own = left[is_set(maps[length - 2], keys)]
            # Runs of one more word: the next one must start at the next word.
            left = own[:-1][own[1:] == own[:-1] + 1]
        return left

    def reach(self, longest: int, maps: list[np.ndarray]) -> np.ndarray:
        """How many words of its window each word keeps."""
        out = np.ones(len(self.hashes), dtype=np.int8)
        for size in range(2, longest + 1):
            at = self.looked_at(size, maps)
            if size < longest:
                at = at[is_set(maps[size - 2], self.keys(size)[at])]
            out[at] = size
        return out

    def runs(self, longest: int, maps: list[np.ndarray]) -> tuple[list[bytes], list[bytes | None], list[int]]:
        """Runs of words, the reach of each word of a run (None: a single word), and how often the run is given.

        A window never passes its run's end, and every word is in one run."""
        n = len(self.starts)
        if not n:
            return [], [], []
        reach = self.reach(longest, maps)
        covered = np.maximum.accumulate(np.arange(n) + reach)  # the first word after all windows so far
        first = np.flatnonzero(np.concatenate([[True], np.arange(1, n) >= covered[:-1]]))
        last = np.concatenate([first[1:] - 1, [n - 1]])
        single = first == last
        # Words that stand alone are counted here.
        _, place, times = np.unique(self.hashes[first[single]], return_index=True, return_counts=True)
        alone = first[single][place]
        low, high = first[~single].tolist(), last[~single].tolist()
        words = [self.data[a:b] for a, b in zip(self.starts[alone].tolist(), self.ends[alone].tolist())]
        words += [self.data[a:b] for a, b in zip(self.starts[first[~single]].tolist(), self.ends[last[~single]].tolist())]
        packed = reach.tobytes()
        return words, [None] * len(alone) + [packed[a:b + 1] for a, b in zip(low, high)], times.tolist() + [1] * len(low)


def is_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys >> np.uint64(max(0, KEY_BITS - MAP_BITS))
    return ((bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _pieces(data: bytes) -> Iterator[bytes]:
    """A plain text in parts that end at breaks, of about CHUNK_BYTES."""
    start = 0
    while len(data) - start > CHUNK_BYTES:
        stop = data.rfind(b"\n", start, start + CHUNK_BYTES) + 1 or data.find(b"\n", start + CHUNK_BYTES) + 1 or len(data)
        yield data[start:stop]
        start = stop
    yield data[start:]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(lang, plain text) of (lang, text) batches: texts of one language together, a break between them."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in _pieces(plain(text.as_py())):
                held.setdefault(lang, []).append(part)
                size += len(part) + 1
                if size >= CHUNK_BYTES:
                    yield from ((k, b"\n".join(v)) for k, v in held.items())
                    held, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in held.items())


def frequent_runs(texts: DataFrame, size: int, least: int, maps: list[np.ndarray]) -> np.ndarray:
    """A bitmap of the runs of `size` words that come `least` times, among those whose inner runs do.

    2**MAP_BITS bits are what the driver and each task hold at most; the driver gets 64 of them a row."""
    sent = texts.sparkSession.sparkContext.broadcast(maps)

    def run(batches):
        for lang, data in chunks(batches):
            c = Chunk(lang, data)
            keys, times = np.unique(c.keys(size)[c.looked_at(size, sent.value)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(times.astype(np.int64))], ["run", "n"])

    counted = texts.mapInArrow(run, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    slot = F.shiftright("run", max(0, KEY_BITS - MAP_BITS))
    words = counted.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))).alias("bits"))
    found = words.toArrow()
    bitmap = np.zeros(1 << (MAP_BITS - 6), dtype="<i8")
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bitmap.view(np.uint8)


def windows(texts: DataFrame, longest: int, maps: list[np.ndarray]) -> DataFrame:
    """(lang, w1 .. w<longest>, n): how often each window comes; '' where it is padded."""
    sent = texts.sparkSession.sparkContext.broadcast(maps)

    def run(batches):
        for lang, data in chunks(batches):
            runs, reach, times = Chunk(lang, data).runs(longest, sent.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(runs), pa.string()), pa.array(runs, pa.binary()).cast(pa.string()),
                 pa.array([None if r is None else np.frombuffer(r, np.int8) for r in reach], pa.list_(pa.int8())),
                 pa.array(times, pa.int64())], ["lang", "run", "reach", "n"])

    runs = texts.mapInArrow(run, "lang string, run string, reach array<tinyint>, n long").select(
        "lang", F.split("run", " ").alias("words"), "reach", "n")
    first = runs.select("lang", "words", "reach", "n", F.posexplode("words").alias("at", "w1"))
    kept = F.coalesce(F.get("reach", F.col("at")), F.lit(1))
    lead = [F.when(kept > k, F.get("words", F.col("at") + k)).otherwise("").alias(f"w{k + 1}") for k in range(1, longest)]
    columns = [f"w{k + 1}" for k in range(longest)]
    return first.select("lang", "w1", *lead, "n").groupBy("lang", *columns).agg(F.sum("n").alias("n"))


def marginals(counted: DataFrame, least: int) -> DataFrame:
    """(lang, size, phrase, n) of all phrases that come `least` times, by ROLLUP; size 0: all words of a language."""
    columns = [c for c in counted.columns if c not in ("lang", "n")]
    level = F.grouping_id()
    sums = counted.rollup("lang", *columns).agg(F.sum("n").alias("n"), level.alias("level")).where("lang is not null")
    # One bit of the level for each column that is summed over, the last column lowest.
    size = F.lit(len(columns)) - F.bit_count("level").cast("int")
    last = F.get(F.array(F.lit("-"), *columns), F.col("size"))
    return sums.select("lang", size.alias("size"), *columns, "n").where((F.col("size") == 0) | (F.col("n") >= least)).where(
        last != "").select("lang", "size", F.concat_ws(" ", *columns).alias("phrase"), "n")


def _exact(column) -> F.Column:
    return F.col(column).cast("decimal(20,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of every phrase of two words and more, by its lowest-scoring cut."""
    totals = counts.where("size = 0").select("lang", F.col("n").alias("total"))
    phrases = counts.where("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"))
    words = F.split("phrase", " ")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    known = counts.where("size >= 1").select("lang", "phrase", "n")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    # Whole-number division of decimals: no product is rounded or passes its type.
    score = F.expr(f"cast(a as decimal(20,0)) * {SCALE} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.join(totals, "lang").select("lang", "phrase", "size", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")


def without_taken(candidates: DataFrame, taken: int, longest: int) -> DataFrame:
    """The candidates of which no longer candidate holds so large a part of their occurrences, in hundredths."""
    words = F.split("phrase", " ")
    longer = candidates.where("size > 2").select("lang", "size", words.alias("words"), F.col("a").alias("more"))
    parts = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("at"))
    parts = parts.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("phrase")).agg(F.max("more").alias("more"))
    held = candidates.join(parts, ["lang", "phrase"], "left")
    return held.where(F.col("more").isNull() | (_exact("more") * 100 < _exact("a") * taken)).drop("more")


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, taken: int = TAKEN,
         text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    Words are told apart as in `plain`: A-Z lower-cased, pieces between ``. , ; : ! ?`` and line breaks,
    words between blanks and tabs. A phrase of 2 to `longest` words that comes a >= `least` times scores
    floor(2000000 * a / (l + r)) by its lowest-scoring cut (ties: the earliest), l and r being the counts of
    both sides. It is dropped if a longer such phrase holds it in `taken` hundredths of its occurrences.
    Ties of the score go to the higher a, then to the phrase's bytes. A null language is NO_LANG, a null
    text is empty; repeated rows count each time; other columns are not read; without phrases, no rows.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    maps: list[np.ndarray] = []
    for size in range(2, longest):
        maps.append(frequent_runs(texts, size, least, maps))
    counted = windows(texts, longest, maps)
    counts = saved(docs.sparkSession, marginals(counted, least), "phrases")
    kept = without_taken(scored(counts), taken, longest)
    order = (F.desc("score"), F.desc("a"), "phrase")
    # The best of each part of a language first, so that the task that ranks a language gets a fixed number of rows at most.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    kept = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    order = Window.partitionBy("lang").orderBy(*order)
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
