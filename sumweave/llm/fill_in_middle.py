"""Fill-in-the-middle texts, cut by a learned rank index.

A text's token boundaries are a rising sequence of offsets. Straight segments are fitted to it so
that every boundary lies within ERROR of its segment, and what each prediction lacks is stored as one
byte. A cut at a token rank is then a prediction from the segment that holds the rank, put right
exactly by the stored residual; the offsets themselves are not kept, so an index takes about one byte
a token. Texts are indexed piece by piece, so the memory for a long text grows by that byte alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A boundary lies at most so far from its segment; rounding adds one, which a signed byte still holds.
ERROR = 120
#: Bytes of text indexed at once.
PIECE = 1 << 20
#: Rows handed back to Spark at once hold about so many bytes.
BATCH_BYTES = 4 << 20
#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def token_starts(data: np.ndarray, after_letter: bool = False) -> np.ndarray:
    """Where tokens start in UTF-8 bytes: a run of A-Z and a-z is one token, any other character is one.
    after_letter: whether the bytes follow a letter."""
    letter = _LETTER[data]
    inner = np.empty(len(data), dtype=bool)
    inner[:1] = after_letter
    inner[1:] = letter[:-1]
    return np.flatnonzero(((data & 0xC0) != 0x80) & ~(letter & inner))


def _segment(offsets: np.ndarray, first: int, error: int) -> tuple[int, float]:
    """(end, slope) of the longest segment through offsets[first] that stays within error of all it covers."""
    low, high, at, width = -np.inf, np.inf, first + 1, 256
    while at < len(offsets):
        part = offsets[at:at + width] - offsets[first]
        steps = np.arange(at - first, at - first + len(part))
        lows = np.maximum.accumulate(np.maximum((part - error) / steps, low))
        highs = np.minimum.accumulate(np.minimum((part + error) / steps, high))
        outside = np.flatnonzero(lows > highs)
        fits = int(outside[0]) if len(outside) else len(part)
        if fits:
            low, high = lows[fits - 1], highs[fits - 1]
        at += fits
        if len(outside):
            break
        width *= 2
    return at, (low + high) / 2 if at > first + 1 else 0.0


class RankIndex:
    """From the rank of a token boundary to its byte offset, exactly. Rank 0 is the start of the text, the last one its end."""

    def __init__(self, data: bytes, error: int = ERROR):
        if not 0 < error <= ERROR:
            raise ValueError(f"error is from 1 to {ERROR}")
        view = np.frombuffer(data, np.uint8)
        firsts, bases, slopes, residuals = [], [], [], []
        rank = 0
        for low in range(0, max(1, len(view)), PIECE):
            offsets = token_starts(view[low:low + PIECE], low > 0 and bool(_LETTER[view[low - 1]])) + low
            if low + PIECE >= len(view):
                offsets = np.append(offsets, len(view))
            at = 0
            while at < len(offsets):
                end, slope = _segment(offsets, at, error)
                line = offsets[at] + np.rint(slope * np.arange(end - at)).astype(np.int64)
                firsts.append(rank + at)
                bases.append(offsets[at])
                slopes.append(slope)
                residuals.append((offsets[at:end] - line).astype(np.int8))
                at = end
            rank += len(offsets)
        self.tokens = rank - 1
        self.firsts, self.bases, self.slopes = np.array(firsts, dtype=np.int64), np.array(bases, dtype=np.int64), np.array(slopes)
        self.residuals = np.concatenate(residuals)

    def offset(self, rank: int) -> int:
        s = int(np.searchsorted(self.firsts, rank, side="right")) - 1
        return int(self.bases[s]) + int(np.rint(self.slopes[s] * (rank - self.firsts[s]))) + int(self.residuals[rank])


def _chars(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def rearranged(data: bytes, draws: tuple[int, int, int, int], rate: int, spm: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(tokens, form, characters of prefix and of middle, output) of one text."""
    index = RankIndex(data)
    n = index.tokens
    if not data or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or draws[2] % 100 >= rate:
        return n, "plain", None, None, data
    low, high = sorted((index.offset(draws[0] % (n + 1)), index.offset(draws[1] % (n + 1))))
    prefix, middle, suffix = data[:low], data[low:high], data[high:]
    if draws[3] % 100 < spm:
        form, output = "spm", b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    else:
        form, output = "psm", b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    return n, form, _chars(prefix), _chars(middle), output


def original(output: bytes, form: str) -> bytes:
    """The text that an output was made from. The parts hold no mark, so the first of each kind ends a part."""
    if form == "plain":
        return output
    if form == "psm":
        prefix, _, rest = output[len(PREFIX):].partition(SUFFIX)
        suffix, _, middle = rest.partition(MIDDLE)
    else:
        suffix, _, rest = output[len(SUFFIX):].partition(PREFIX)
        prefix, _, middle = rest.partition(MIDDLE)
    return prefix + middle + suffix


def _bounded(batches: Iterator[pa.RecordBatch], make, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Applies make(row values) -> (row, its bytes) and hands rows back in batches of bounded size."""
    for batch in batches:
        rows, size = [], 0
        for values in zip(*batch.columns):
            row, added = make(*(v.as_py() for v in values))
            rows.append(row)
            size += added
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def draws(doc_id, seed: int) -> list[F.Column]:
    """Four unsigned 32-bit numbers from the digest of ``seed:id``; a null id is written as nothing."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"draw_{i}") for i in range(4)]


def transform(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row; output as bytes.

    Of a hundred texts about `rate` are cut, and of a hundred cut ones `spm` have the suffix first. The
    cuts depend on seed and id only, so repeated rows give equal rows. A null text is an empty one;
    empty texts, and texts that hold a mark, stay plain. Other columns are not read; an empty table
    gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fields = [("form", pa.string()), ("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]

    def run(batches):
        for batch in batches:
            ids, first = batch.column(0), 0

            def make(data, *numbers):
                n, form, before, within, output = rearranged(data or b"", numbers, rate, spm)
                return (form, n, before, within, output), len(output)
            body = pa.RecordBatch.from_arrays(batch.columns[1:], names=batch.schema.names[1:])
            for part in _bounded([body], make, pa.schema(fields)):
                yield pa.RecordBatch.from_arrays([ids.slice(first, part.num_rows), *part.columns], ["doc_id", *part.schema.names])
                first += part.num_rows

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *draws(id_col, seed))
    done = source.mapInArrow(run, f"doc_id {kind}, form string, n long, prefix_chars long, middle_chars long, output binary")
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def restored(cut: DataFrame) -> DataFrame:
    """The rows of transform() with the text rebuilt from output and form, as bytes, in a column `restored`."""
    names = cut.columns
    at, how = names.index("output"), names.index("form")

    def run(batches):
        for batch in batches:
            first = 0
            forms = batch.column(how)
            body = pa.RecordBatch.from_arrays([batch.column(at), forms], ["output", "form"])
            for part in _bounded([body], lambda data, form: ((back := original(data, form),), len(back)), pa.schema([("restored", pa.binary())])):
                yield pa.RecordBatch.from_arrays([*(c.slice(first, part.num_rows) for c in batch.columns), part.column(0)], [*names, "restored"])
                first += part.num_rows

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    return cut.mapInArrow(run, f"{shape}, restored binary")


def digests(docs: DataFrame) -> DataFrame:
    """Per document: n, form, prefix_chars, middle_chars, and SHA-256 of the output and of the text rebuilt from it."""
    return restored(transform(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
