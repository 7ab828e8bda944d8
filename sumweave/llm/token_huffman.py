"""Token ids in a binary file format: canonical, length-limited Huffman codes over global counts.

A folder holds Parquet part files with one row per block. A block holds whole documents in ascending
order of their id and can be read alone: document ids and lengths, the bit stream, and a checkpoint
of the bit offset at every STRIDE-th id. Reading follows all checkpoints of a block at once, one
table look-up per id; the table is rebuilt from the code lengths, which are a small file beside the
blocks.
"""

from __future__ import annotations

import math
import os
import string
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from sumweave.llm.exchange import saved

#: Ids of a block, about (a longer document is a block), and ids between checkpoints.
BLOCK, STRIDE = 1 << 18, 64
#: Bytes of text cut together, bytes tokenized together, and words whose ids a worker remembers.
PIECE_BYTES, CHUNK_BYTES, REMEMBERED = 1 << 20, 16 << 20, 1_000_000
#: Words of a line handed to the tokenizer, words held as Python objects at once, and bytes of the longest word worth remembering.
LINE_WORDS, BATCH_WORDS, LONGEST = 200, 50_000, 64

#: Marks that end a word without being part of a contraction.
_TAIL = string.punctuation.replace("'", "")

_WHITE = b" \t\n\v\f\r"
#: Bytes by what they say about cuts: 0 white space, 1 ASCII letters, 2 marks, 4 all others. Only 1 and 2 have the sum 3.
_KINDS = bytes(0 if b in _WHITE else 1 if chr(b) in string.ascii_letters else 2 if chr(b) in _TAIL else 4 for b in range(256))


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple[Tokenizer, Tokenizer, Tokenizer, np.ndarray]:
    """The tokenizer, the same without the steps that leave words of composed letters as they are, the same without those that
    leave words of a to z as they are, and which ids end a word."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker per core
    tokenizer, simple, bare = (Tokenizer.from_file(path) for _ in range(3))
    simple.normalizer = normalizers.Lowercase()
    simple.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    bare.normalizer, bare.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
    ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    for token, i in tokenizer.get_vocab().items():
        ends[i] = token.endswith("</w>")
    return tokenizer, simple, bare, ends


def _lasting(words: pa.Array) -> pa.Array:
    """Letters that stay the same letters when composed, and letters when lower-cased."""
    return pa.array([w.isalpha() and unicodedata.is_normalized("NFC", w) and w.lower().isalpha() for w in words.to_pylist()], pa.bool_())


def _groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbours of about so much together."""
    edges = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // most)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(sizes)]) if len(sizes) else iter(())


class WordCache:
    """Ids of texts by their words: for a tokenizer that composes, lower-cases, drops white space and joins nothing over it or
    over the border of letters and other characters.

    Texts are cut at white space and between ASCII letters and marks, as columns. Each distinct word of
    a chunk that is not remembered is encoded once. Words of letters go to the tokenizer many at once
    and are told apart by their last ids, which is only trusted if there are as many of these as words.
    """

    def __init__(self, path: str):
        self.tokenizer, self.simple, self.bare, self.ends = _tokenizer(path)
        self.kind = np.dtype("<u2" if len(self.ends) <= 1 << 16 else "<u4")
        self.added = sorted({t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()})
        # Remembered words, their ids, and in how many chunks each came.
        self.words, self.ids, self.uses = pa.array([], pa.string()), pa.array([], pa.binary()), np.zeros(0, np.uint32)

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words of all texts, and how many there are before each text and in all."""
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(pc.binary_length(texts).to_numpy(), out=bounds[1:])
        if not bounds[-1]:
            return pa.array([], pa.string()), bounds
        low, special = pc.ascii_lower(texts), np.zeros(len(texts), dtype=bool)
        # Added tokens are found as they are written, before anything else is done to a text.
        for token in self.added:
            if token in _bytes(low):
                special |= pc.match_substring(low, token).to_numpy(zero_copy_only=False)
        # Lower-cased where the tokenizer, which composes first, surely sees the same.
        data = _bytes(pc.if_else(pc.and_not(pc.string_is_ascii(texts), pa.array(special)), low, texts))
        kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
        kept = kinds != 0
        starts = kept.copy()
        starts[1:] &= (kinds[:-1] == 0) | (kinds[:-1] + kinds[1:] == 3)
        for t in np.flatnonzero(special).tolist():
            own = kept[bounds[t]:bounds[t + 1]]
            starts[bounds[t] + 1:bounds[t + 1]] = own[1:] & ~own[:-1]
        heads = bounds[:-1][bounds[:-1] < bounds[1:]]
        starts[heads] = kept[heads]
        places, at = np.cumsum(kept, dtype=np.int32), np.flatnonzero(starts)
        offsets = np.append(places[at] - 1, places[-1]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data.translate(None, _WHITE)))
        return words, np.searchsorted(at, bounds)

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(x.ids, dtype=self.kind).tobytes() for low in range(0, len(texts), LINE_WORDS)
                for x in self.tokenizer.encode_batch_fast(texts[low:low + LINE_WORDS], add_special_tokens=False)]

    def _letters(self, words: pa.Array, tokenizer: Tokenizer) -> pa.Array:
        """Ids of words of letters."""
        out = []
        for low in range(0, len(words), LINE_WORDS):
            part = words.slice(low, LINE_WORDS)
            line = pc.binary_join(pa.ListArray.from_arrays([0, len(part)], part), " ")[0].as_py()
            ids = np.asarray(tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, dtype=self.kind)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or stops[-1] != len(ids):
                out.append(pa.array(self._each(part.to_pylist()), pa.binary()))
                continue
            bounds = np.append(0, stops).astype(np.int32) * np.int32(self.kind.itemsize)
            out.append(pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(bounds), pa.py_buffer(ids)]))
        return pa.concat_arrays([pa.array([], pa.binary()), *out])

    def _learned(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words."""
        def split(at: np.ndarray, which: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            which = which.to_numpy(zero_copy_only=False)
            return at[which], at[~which]

        plain, rest = split(np.arange(len(words)), pc.ascii_is_alpha(words))
        composed, rest = split(rest, _lasting(words.take(rest)))
        # Other letters with closing marks are encoded as the two; those of ASCII are cut from theirs.
        marked, rest = split(rest, _lasting(pc.utf8_rtrim(words.take(rest), characters=_TAIL)))
        bases = pc.utf8_rtrim(words.take(marked), characters=_TAIL).dictionary_encode()
        tails = [word[len(base):] for word, base in zip(words.take(marked).to_pylist(), bases.to_pylist())]
        known = dict(zip(different := sorted(set(tails)), self._each(different)))
        based = self._letters(bases.dictionary, self.simple).take(bases.indices).to_pylist()
        ids = pa.concat_arrays([
            self._letters(pc.ascii_lower(words.take(plain)), self.bare), self._letters(words.take(composed), self.simple),
            pa.array([base + known[tail] for base, tail in zip(based, tails)], pa.binary()),
            pa.array(self._each(words.take(rest).to_pylist()), pa.binary())])
        return ids.take(np.argsort(np.concatenate([plain, composed, marked, rest])))

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the distinct words are among the remembered ones, now that all are."""
        if max(len(self.words), self.words.nbytes // 32) > REMEMBERED:  # keep what came in most chunks, the later of equals
            short = np.flatnonzero(pc.binary_length(self.words).to_numpy() <= LONGEST)
            best = np.sort(short[np.argsort(self.uses[short], kind="stable")[-(REMEMBERED // 2 + 1):]])
            self.words, self.ids, self.uses = self.words.take(best), self.ids.take(best), self.uses[best] >> 1
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(found.is_null())
        places = found.fill_null(-1).to_numpy().copy()
        if len(new):
            places[places < 0] = np.arange(len(self.words), len(self.words) + len(new))
            ids = [self._learned(new.slice(low, BATCH_WORDS)) for low in range(0, len(new), BATCH_WORDS)]
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, *ids])
            self.uses = np.append(self.uses, np.zeros(len(new), np.uint32))
        self.uses[places] += 1
        return places

    def encode_column(self, texts: pa.Array, end: bytes = b"") -> Iterator[pa.Array]:
        """The packed ids of each text, with end behind them, in some arrays."""
        if not len(texts):
            return
        cut = [self._cut(texts.slice(low, high - low)) for low, high in _groups(pc.binary_length(texts).to_numpy().astype(np.int64), PIECE_BYTES)]
        coded = pa.chunked_array([words for words, _ in cut], pa.string()).dictionary_encode()
        places = self._places(coded.chunk(0).dictionary if coded.num_chunks else pa.array([], pa.string()))
        ids = pa.concat_arrays([self.ids.take(places), pa.array([end], pa.binary())])
        codes = iter(coded.chunks)  # none for pieces without words
        for words, before in cut:
            own = next(codes).indices.to_numpy() if len(words) else np.zeros(0, np.int32)
            got = ids.take(np.insert(own, before[1:], len(places)))
            _, offsets, data = got.buffers()
            bounds = np.frombuffer(offsets, np.int32)[before + np.arange(len(before))]
            yield pa.BinaryArray.from_buffers(pa.binary(), len(before) - 1, [None, pa.py_buffer(bounds), data])

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids for part in self.encode_column(pa.array(texts, pa.string())) for ids in part.to_pylist()]


@lru_cache(maxsize=1)
def word_cache(path: str) -> WordCache:
    """The cache of this worker, kept from task to task."""
    return WordCache(path)


def _bytes(texts: pa.Array) -> bytes:
    """The bytes of all texts in a row."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)
    return data[int(bounds[texts.offset]):int(bounds[texts.offset + len(texts)])].to_pybytes()


def readable(texts: pa.Array) -> pa.Array:
    """Texts of bytes: none is empty, and what is not UTF-8 is replaced."""
    try:
        return texts.cast(pa.string()).fill_null("")
    except pa.ArrowInvalid:
        return pa.array([(t or b"").decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


def encoded(docs: DataFrame, path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids packed as little-endian integers of two bytes (four if the vocabulary needs them),
    with end_id behind each text. A null or empty text has the end id only. Other columns are not read."""
    def run(batches):
        cache = word_cache(path)
        end = b"" if end_id is None else np.array([end_id], dtype=cache.kind).tobytes()
        for batch in batches:
            for low, high in _groups(pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64), CHUNK_BYTES):
                for out in cache.encode_column(readable(batch.column(1).slice(low, high - low)), end):
                    n = pc.divide(pc.binary_length(out), cache.kind.itemsize).cast(pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(out)), n, out], ["doc_id", "n_tokens", "ids"])
                    low += len(out)

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids binary")


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol's code, by package-merge: least total, none above the limit; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of this length")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, kinds = leaves, [np.ones(len(leaves), dtype=bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        level = both[at]
        kinds.append(at < len(leaves))
    take, bits = 2 * len(leaves) - 2, np.zeros(len(leaves), dtype=np.int64)
    for kind in reversed(kinds):
        own = int(kind[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    lengths[order] = bits
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if not len(order):
        return codes
    widths = lengths[order].astype(np.int64)
    most = int(widths.max())
    # A code is the sum of the shares of all before it, cut to its own width.
    share = np.int64(1) << (most - widths)
    codes[order] = (np.cumsum(share) - share) >> (most - widths)
    return codes


def limit_for(symbols: int) -> int:
    return min(24, max(12, math.ceil(math.log2(max(2, symbols))) + 2))


def write_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, stride: int) -> tuple[bytes, bytes]:
    """(bit stream, checkpoints): high bits first; checkpoints are the bits of each stride, as 16 or 32-bit integers."""
    widths = lengths[ids].astype(np.int64)
    ends = np.cumsum(widths)
    total = int(ends[-1]) if len(ids) else 0
    starts = ends - widths
    # Each code falls into two neighbouring 32-bit words at most; sums of disjoint bits stand for their union.
    wide = codes[ids].astype(np.uint64) << (np.uint64(64) - (starts & 31).astype(np.uint64) - widths.astype(np.uint64))
    word = starts >> 5
    n = (total >> 5) + 2
    high = np.bincount(word, weights=(wide >> np.uint64(32)).astype(np.float64), minlength=n)
    low = np.bincount(word + 1, weights=(wide & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)
    stream = (high[:n] + low[:n]).astype(np.uint64).astype(">u4").tobytes()[: (total + 7) // 8]
    marks = np.append(starts[::stride], total)
    return stream, np.diff(marks).astype("<u4").tobytes()


class Reader:
    """Table-driven decoding."""

    def __init__(self, lengths: np.ndarray):
        self.most = int(lengths.max()) if len(lengths) else 0
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = np.int64(1) << (self.most - lengths[order].astype(np.int64))
        self.symbol = np.repeat(order.astype(np.uint32), span)
        self.width = np.repeat(lengths[order].astype(np.int64), span)
        if len(order) == 1:  # a lone symbol has the code 0; any bit reads as it
            self.symbol, self.width = np.repeat(self.symbol, 2), np.repeat(self.width, 2)

    def ids(self, stream: bytes, checkpoints: bytes, n: int, stride: int) -> np.ndarray:
        """The n ids of a block: step by step, the next id after every checkpoint."""
        if not n:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(stream + b"\0" * 8, np.uint8).astype(np.uint32)
        four = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        bits = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        at = np.cumsum(bits) - bits
        out = np.zeros((stride, len(at)), dtype=np.uint32)
        mask, shift = np.uint32((1 << self.most) - 1), 32 - self.most
        last = n - (len(at) - 1) * stride  # ids of the last, shorter lane
        for step in range(min(stride, n)):
            if step == last:
                at = at[:-1]
            got = (four[at >> 3] >> (shift - (at & 7)).astype(np.uint32)) & mask
            out[step, :len(at)] = self.symbol[got]
            at = at + self.width[got]
        return out.T.ravel()[:n]


def write_files(spark: SparkSession, ids: DataFrame, folder: str, kind: str, block: int = BLOCK, stride: int = STRIDE) -> None:
    """Writes (doc_id, n_tokens, ids) below the folder: ``lengths`` (code lengths by id) and ``blocks``.

    Documents are in ascending id (a null id first; equal ids by length and content). The counts that
    reach the driver are one row per vocabulary entry.
    """
    def count(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                got = np.bincount(np.frombuffer(b"".join(batch.column(0).slice(low, 1000).to_pylist()), kind))
                if len(got) > len(total):
                    total, got = got.astype(np.int64), total
                total[:len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    counted = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=-1) + 1, dtype=np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, limit_for(len(counted)))
    codes = canonical(lengths)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{folder}/lengths")

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        own_ids, own, size = [], [], 0

        def done():
            flat = np.frombuffer(b"".join(own), kind)
            stream, marks = write_bits(flat, codes, lengths, stride)
            sizes = [len(x) // np.dtype(kind).itemsize for x in own]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([own_ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([stream], pa.binary()), pa.array([marks], pa.binary())],
                ["part", "block", "doc_ids", "sizes", "stream", "checkpoints"])

        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                own_ids.append(d)
                own.append(x.as_py())
                size += len(own[-1]) // np.dtype(kind).itemsize
                if size >= block:
                    yield done()
                    own_ids, own, size, number = [], [], 0, number + 1
        if own:
            yield done()

    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "n_tokens", "ids").select(F.col("doc_id").cast("long"), "ids")
    ordered.mapInArrow(run, "part int, block long, doc_ids array<long>, sizes array<long>, stream binary, checkpoints binary").write.option(
        "compression", "none").parquet(f"{folder}/blocks")


def read_files(spark: SparkSession, folder: str, stride: int = STRIDE) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, from the decoded ids.

    start counts the ids of all documents before it in the order of the files.
    """
    lengths = np.frombuffer(spark.read.parquet(f"{folder}/lengths").first()["lengths"], np.uint8)
    blocks = spark.read.parquet(f"{folder}/blocks")

    def run(batches):
        reader = Reader(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, docs, sizes, stream, marks = (batch.column(i)[row].as_py() for i in range(6))
                data = memoryview(reader.ids(stream, marks, sum(sizes), stride).astype("<u4").tobytes())
                bounds = np.cumsum([0, *sizes])
                crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int64()), pa.array(docs, pa.int64()),
                     pa.array(bounds[:-1], pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "block", "doc_id", "inner", "n_tokens", "ids_crc32"])

    read = blocks.mapInArrow(run, "part int, block long, doc_id long, inner long, n_tokens long, ids_crc32 long")
    # Where each block starts: sums within a part, and over parts, of which there are as many as tasks wrote.
    sizes = blocks.select("part", "block", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    inner = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("before"))
    places = sizes.select("part", "block", F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("within")).join(parts, "part").select(
        "part", "block", (F.col("before") + F.col("within")).alias("base"))
    return read.join(places, ["part", "block"]).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def through_files(spark: SparkSession, docs: DataFrame, path: str, end_id: int | None, folder: str) -> DataFrame:
    """Encodes docs, writes the files below the folder, and reads them back."""
    ids = saved(spark, encoded(docs, path, end_id), "ids")
    write_files(spark, ids, folder, WordCache(path).kind.str)
    return read_files(spark, folder)
