"""Byte-level BPE by a tree reduction over halves of a text.

An encoded piece of text is an element of a monoid: joining two neighbours keeps the tokens of both
that provably cannot change and encodes only a window around the seam anew. A position whose
character is a blank or newline and whose predecessor is not white space is the start of a match of
the splitting pattern in any context: no match holds white space after anything else, and scanning
from a match start looks at nothing before it. So the window grows, left and right, to the nearest
such position, and the tokens outside it stay as they are. A long run of white space is cut out
before: all of it but the last character is one match, whatever surrounds it, and goes to the merges
without a scan. This holds for the splitting pattern SPLIT; texts for any other go to the library whole.
Decoding joins blocks of bytes pairwise.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces of at most so many characters are encoded at once.
LEAF_CHARS = 2048
#: A block of ids decoded at once.
LEAF_IDS = 4096
#: Rows handed back to Spark at once hold about so many bytes.
BATCH_BYTES = 4 << 20

# The splitting pattern the seams hold for, and the white space of its \s.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space of so many characters is cut out.
LONG_RUN = 1024

_SEAM = re.compile(r"\S[ \n]")
_RUN = re.compile(f"[{SPACE}]{{{LONG_RUN},}}")


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The vocabulary, read once per worker."""
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _seam_before(text: str, low: int, end: int) -> int:
    """The last sure match start in (low, end], or low."""
    width = 64
    while True:
        start = max(low, end - width)
        found = [m.start() + 1 for m in _SEAM.finditer(text, start, min(len(text), end + 1))]
        if found:
            return found[-1]
        if start == low:
            return low
        width *= 4


def _seam_after(text: str, start: int, high: int) -> int:
    """The first sure match start in [start, high), or high."""
    found = _SEAM.search(text, max(0, start - 1), high)
    return found.start() + 1 if found else high


def encode_text(enc: tiktoken.Encoding, text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
    """Ids of a whole text, as one scan over it would give them."""
    def tree(low: int, high: int) -> np.ndarray:
        if high - low <= leaf:
            return np.asarray(enc.encode_ordinary(text[low:high]), dtype=np.uint32)
        middle = (low + high) // 2
        left, right = tree(low, middle), tree(middle, high)
        start, stop = _seam_before(text, low, middle), _seam_after(text, middle, high)
        # A seam at the very middle leaves nothing to encode anew.
        gone = len(enc.encode_ordinary(text[start:middle]))
        skip = len(enc.encode_ordinary(text[middle:stop]))
        again = np.asarray(enc.encode_ordinary(text[start:stop]), dtype=np.uint32)
        return np.concatenate([left[:len(left) - gone], again, right[skip:]])

    if enc._pat_str != SPLIT:
        return np.asarray(enc.encode_ordinary(text), dtype=np.uint32)
    parts, start = [], 0
    for run in _RUN.finditer(text):
        # The last character before more text begins the next match; at the end of the text there is none.
        stop = run.end() - (run.end() < len(text))
        parts += [tree(start, run.start()), np.asarray(enc._encode_single_piece(text[run.start():stop].encode()), dtype=np.uint32)]
        start = stop
    return np.concatenate([*parts, tree(start, len(text))])


def decode_ids(enc: tiktoken.Encoding, ids: np.ndarray, leaf: int = LEAF_IDS) -> bytes:
    if len(ids) <= leaf:
        return enc.decode_bytes(ids.tolist())
    half = len(ids) // 2
    return decode_ids(enc, ids[:half], leaf) + decode_ids(enc, ids[half:], leaf)


def _rows(batches: Iterator[pa.RecordBatch], make, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Applies make(bytes or None) -> bytes to the second column, in batches of bounded size."""
    for batch in batches:
        ids, values = batch.column(0), batch.column(1)
        first, out, size = 0, [], 0
        for row in range(batch.num_rows):
            out.append(make(values[row].as_py()))
            size += len(out[-1])
            if size >= BATCH_BYTES or row == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(out)), pa.array(out, pa.binary())], names)
                first, out, size = row + 1, [], 0


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           leaf: int = LEAF_CHARS) -> DataFrame:
    """(id, ids): the ids of every whole text as packed little-endian unsigned 32-bit integers.

    A null or empty text has no ids; every input row, repeated ones too, gives one row. Other
    columns are not read. Bytes that are not UTF-8 are read as U+FFFD.
    """
    def run(batches):
        enc = encoding(ranks_path, pattern)

        def make(data):
            return encode_text(enc, (data or b"").decode("utf-8", "replace"), leaf).astype("<u4").tobytes()
        return _rows(batches, make, ["doc_id", "ids"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, leaf: int = LEAF_IDS) -> DataFrame:
    """(doc_id, data): the bytes that packed ids stand for; no ids, or null, give no bytes."""
    def run(batches):
        enc = encoding(ranks_path, pattern)
        return _rows(batches, lambda data: decode_ids(enc, np.frombuffer(data or b"", "<u4"), leaf), ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, data): encoded, and decoded from the ids, in one pass over the documents."""
    def run(batches):
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            data = _rows([batch], lambda ids: decode_ids(enc, np.frombuffer(ids or b"", "<u4")), ["doc_id", "data"])
            first = 0
            for part in data:
                ids = batch.slice(first, part.num_rows)
                first += part.num_rows
                yield pa.RecordBatch.from_arrays([ids.column(0), ids.column(1), part.column(1)], ["doc_id", "ids", "data"])

    encoded = encode(docs, ranks_path, pattern)
    return encoded.mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids binary, data binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: n_tokens, and SHA-256 of the packed ids and of the decoded bytes."""
    return round_trip(docs, ranks_path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def checked(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, same): packed ids, and whether they decode to the bytes of the text (of an empty one, for null)."""
    def run(batches):
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            first = 0
            for part in _rows([batch], lambda data: encode_text(enc, (data or b"").decode("utf-8", "replace")).astype("<u4").tobytes(),
                              ["doc_id", "ids"]):
                texts = batch.column(1).slice(first, part.num_rows)
                first += part.num_rows
                same = [decode_ids(enc, np.frombuffer(ids.as_py(), "<u4")) == (text.as_py() or b"") for ids, text in zip(part.column(1), texts)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(same, pa.bool_())], ["doc_id", "ids", "same"])

    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, same boolean")
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "same")
