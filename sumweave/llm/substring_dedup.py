"""Repeated passages by fixed-block anchors.

A passage of ``window`` words holds, wherever it starts, a whole block of ``block`` words that
begins at a multiple of ``block`` in its own document (2 * block <= window + 1). So every document's
blocks are indexed, all rolling windows of that length probe them, and a block is an anchor if a
probe meets it elsewhere. Each anchor is extended over the passages that hold it, which are compared
whole (96 bits and more, from two hashes of every word) and counted; the union of those that repeat is the maximal repeat.

Work is linear: blocks and passages are counted per value, never paired, so a group of copies costs
what its rows cost. Chunks of documents ask, buckets of hash values answer (see ``exchange``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sumweave.llm import exchange as X
from sumweave.llm.words import hashed_words, inside, run_hashes

#: Words of a passage.
WINDOW = 35

_ASKED = "bucket long, chunk long, bits binary, more binary, flags binary"
_TOLD = "chunk long, bucket long, answer binary"


def _asked(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("bucket", "chunk", "bits", "more", "flags"), columns, kinds)})


def _told(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 3
    kinds = (pa.int64(), pa.int64(), pa.binary())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("chunk", "bucket", "answer"), columns, kinds)})


class _Chunk:
    """Words, blocks and probes of the documents of one chunk."""

    def __init__(self, texts: list[bytes | None], block: int, buckets: int):
        self.words, self.starts, self.ends, self.first, self.more = hashed_words(texts, both=True)
        n = len(self.words)
        self.block, self.buckets = block, buckets
        self.at = np.arange(n) - np.repeat(self.first[:-1], np.diff(self.first))
        keys = X.keys_of(run_hashes(self.words, block), buckets)
        whole = inside(self.first, block)[:len(keys)]
        #: Word positions of aligned blocks, and all distinct probes with the number of their places.
        self.blocks = np.flatnonzero(whole & (self.at[:len(keys)] % block == 0))
        self.block_keys = keys[self.blocks]
        self.probes, self.counts = np.unique(keys[whole], return_counts=True)
        self.indexed = np.zeros(len(self.probes), dtype=bool)
        self.indexed[np.searchsorted(self.probes, self.block_keys)] = True

    def passages(self, window: int, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the passages that hold an anchor, and two hashes of each. anchors: by distinct block key."""
        hit = anchors[np.searchsorted(self.probes[self.indexed], self.block_keys)] if len(self.blocks) else np.zeros(0, bool)
        n = len(self.words)
        held = np.zeros(n + self.block, dtype=np.int64)
        # A passage from s holds the block at p if p - (window - block) <= s <= p and both are in one text.
        places = self.blocks[hit]
        lows = np.maximum(places - (window - self.block), places - self.at[places])
        np.add.at(held, lows, 1)
        np.add.at(held, places + 1, -1)
        where = np.flatnonzero((np.cumsum(held)[:n] > 0) & inside(self.first, window))
        h = run_hashes(self.words, window)[where]
        g = run_hashes(self.more, window)[where]
        return where, X.keys_of(h, self.buckets), g


def _distinct(keys: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, more) in order, how often each came, and for each input row its number."""
    order = np.lexsort((more, keys))
    k, m = keys[order], more[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    number = np.empty(len(k), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return k[at], m[at], np.diff([*at, len(k)]), number


def _anchors(told: pa.Table, n: int) -> np.ndarray:
    """The answers about distinct block keys, bucket after bucket."""
    rows = sorted(zip(told.column("bucket").to_pylist(), told.column("answer").to_pylist()))
    parts = [X.unpack(a, np.uint8).astype(bool) for b, a in rows if b >= 0]
    return np.concatenate(parts) if parts else np.zeros(n, dtype=bool)


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The rows of docs with every word cut that a repeated passage covers, and n_words, n_removed.

    A passage repeats if its word sequence also starts anywhere else, in the same document or
    another, judged on the input. White space around a cut stays, and a text without a cut stays as
    it is. Null texts stay null and have no words; texts shorter than a passage lose nothing;
    repeated rows are documents that repeat each other; an empty table gives an empty table. All
    columns are kept, but columns called n_words or n_removed are replaced.
    """
    block = (window + 1) // 2
    if block < 1:
        raise ValueError("a passage has at least one word")
    chunks, buckets = X.sizes(docs, text_col)
    fields = [f for f in docs.schema.fields if f.name not in ("n_words", "n_removed")]
    # Positional names, so that no column of the documents can clash with those used here.
    plain = docs.select([F.col(f"`{f.name}`").cast("binary").alias(f"c{i}") if f.name == text_col
                         else F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)])
    text = f"c{[f.name for f in fields].index(text_col)}"
    chunk = F.pmod(F.xxhash64(*plain.columns), F.lit(chunks)).alias("chunk") if _hashable(plain.schema) \
        else F.pmod(F.xxhash64(text), F.lit(chunks)).alias("chunk")
    # One way of parting for all steps: Spark shuffles the documents once and reads that again.
    parted = plain.select(chunk, "*").groupBy("chunk")
    names, kinds = plain.columns, [plain.schema[n].dataType for n in plain.columns]

    def index(key: tuple, table: pa.Table) -> pa.Table:
        c = _Chunk(table.column(text).to_pylist(), block, buckets)
        flags = c.indexed.astype(np.uint8) + 2 * (c.counts > 1).astype(np.uint8)
        return _asked([(b, key[0].as_py(), X.pack(X.low_bits(c.probes[s])), None, X.pack(flags[s]))
                       for b, s in X.slices(c.probes)])

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        """Tells each chunk which of its blocks some probe meets elsewhere."""
        bits = [X.unpack(x, np.uint32) for x in table.column("bits").to_pylist()]
        flags = np.concatenate([X.unpack(x, np.uint8) for x in table.column("flags").to_pylist()])
        values, number, count = np.unique(np.concatenate(bits), return_inverse=True, return_counts=True)
        often = count > 1
        often[number[flags >= 2]] = True
        met = often[number]
        rows, low = [], 0
        for who, part in zip(table.column("chunk").to_pylist(), bits):
            own = slice(low, low + len(part))
            asked = (flags[own] & 1).astype(bool)
            if asked.any():
                rows.append((who, key[0].as_py(), X.pack(met[own][asked].astype(np.uint8))))
            low += len(part)
        return _told(rows)

    def extend(key: tuple, left: pa.Table, told: pa.Table) -> pa.Table:
        if not left.num_rows or not told.num_rows:
            return _asked([])
        c = _Chunk(left.column(text).to_pylist(), block, buckets)
        anchors = _anchors(told, int(c.indexed.sum()))
        _, keys, more = c.passages(window, anchors)
        if not len(keys):
            return _asked([])
        k, m, count, _ = _distinct(keys, more)
        who = key[0].as_py() if key[0].as_py() is not None else left.column("chunk")[0].as_py()
        rows = [(b, who, X.pack(X.low_bits(k[s])), X.pack(m[s]), X.pack((count[s] > 1).astype(np.uint8)))
                for b, s in X.slices(k)]
        # The chunk's anchors travel on with its questions, so that the last step need not ask again.
        return _asked([*rows, (rows[0][0], who, None, None, X.pack(anchors.astype(np.uint8)))])

    def count(key: tuple, table: pa.Table) -> pa.Table:
        """Tells each chunk which of its passages came more than once."""
        rows, who, bits, more, flags = [], [], [], [], []
        for w, b, m, f in zip(*(table.column(n).to_pylist() for n in ("chunk", "bits", "more", "flags"))):
            if b is None:
                rows.append((w, -1, f))
            else:
                who.append(w)
                bits.append(X.unpack(b, np.uint32))
                more.append(X.unpack(m, np.uint64))
                flags.append(X.unpack(f, np.uint8))
        if who:
            _, _, times, number = _distinct(np.concatenate(bits), np.concatenate(more))
            often = times > 1
            often[number[np.concatenate(flags) > 0]] = True
            low = 0
            for w, part in zip(who, bits):
                rows.append((w, key[0].as_py(), X.pack(often[number[low:low + len(part)]].astype(np.uint8))))
                low += len(part)
        return _told(rows)

    def cut(key: tuple, left: pa.Table, told: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({n: left.column(n) for n in names}
                            | {"n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64())})
        texts = left.column(text).to_pylist()
        words, starts, ends, first = hashed_words(texts)
        n = len(words)
        gone = np.zeros(n, dtype=bool)
        state = [a for b, a in zip(told.column("bucket").to_pylist(), told.column("answer").to_pylist()) if b < 0]
        if state:
            c = _Chunk(texts, block, buckets)
            where, keys, more = c.passages(window, X.unpack(state[0], np.uint8).astype(bool))
            _, _, _, number = _distinct(keys, more)
            repeats = where[_anchors(told, 0)[number]]
            edge = np.bincount(repeats, minlength=n + 1) - np.bincount(repeats + window, minlength=n + 1)[:n + 1]
            gone = np.cumsum(edge)[:n] > 0
        kept, removed = [], np.add.reduceat(np.concatenate([gone, [False]]).astype(np.int64), first[:-1])
        removed[np.diff(first) == 0] = 0
        for i, data in enumerate(texts):
            if not removed[i]:
                kept.append(data)
                continue
            a, b = first[i], first[i + 1]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
            parts, last = [], 0
            for low, high in zip(edges[0::2], edges[1::2]):
                parts.append(data[last:starts[a + low]])
                last = ends[a + high - 1]
            kept.append(b"".join([*parts, data[last:]]))
        columns = {n: pa.array(kept, pa.binary()) if n == text else left.column(n) for n in names}
        return pa.table(columns | {"n_words": pa.array(np.diff(first), pa.int64()), "n_removed": pa.array(removed, pa.int64())})

    asked = parted.applyInArrow(index, _ASKED)
    told = asked.groupBy("bucket").applyInArrow(meet, _TOLD)
    asked = parted.cogroup(told.groupBy("chunk")).applyInArrow(extend, _ASKED)
    told = asked.groupBy("bucket").applyInArrow(count, _TOLD)
    shape = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]
                         + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    done = parted.cogroup(told.groupBy("chunk")).applyInArrow(cut, shape)
    return done.select([F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(fields)] + ["n_words", "n_removed"])


def _hashable(schema: T.StructType) -> bool:
    return not any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in schema.fields)


def digests(cleaned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words joined by one space."""
    def run(batches):
        for batch in batches:
            sha = [hashlib.sha256(b" ".join((x.as_py() or b"").split())).hexdigest() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sha, pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])

    source = cleaned.select("doc_id", "n_words", "n_removed", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {cleaned.schema['doc_id'].dataType.simpleString()}, n_words long, "
                                  "n_removed long, kept_sha256 string")
