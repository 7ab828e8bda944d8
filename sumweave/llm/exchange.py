"""Questions about hashes between chunks of documents and buckets of hash values.

A chunk asks about each of its distinct hashes once. A bucket holds the hashes of one stretch of
values and needs only 32 further bits of each, so the bits kept grow with the number of buckets,
which grows with the data. Sorted, their high bytes compress well. The answers are arrays in the
order of the questions, which the chunk can rebuild from its texts at any time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sumweave.session import shared_dir

#: Bytes of text in a chunk, and words' hashes in a bucket, about.
CHUNK_BYTES, BUCKET_WORDS = 2 << 20, 1 << 20
#: At least so many chunks and buckets.
LEAST = 64


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, and safe from lost executors."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sizes(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Numbers of chunks and of buckets for the bytes of text there are."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    # A word and the space after it take about six bytes.
    return max(LEAST, total // CHUNK_BYTES), max(LEAST, total // 6 // BUCKET_WORDS)


def keys_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket number in the high half, 32 further bits in the low half."""
    n = np.uint64(buckets)
    return ((((h >> np.uint64(32)) * n) >> np.uint64(32)) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def pack(a: np.ndarray) -> bytes:
    """Compressed, bytes of equal weight together."""
    width = a.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, width).T.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def slices(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(bucket, where) of sorted keys, for each bucket that has some."""
    bucket = keys >> np.uint64(32)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
        if high > low:
            yield int(bucket[low]), slice(low, high)


def low_bits(keys: np.ndarray) -> np.ndarray:
    return keys.astype(np.uint32)
