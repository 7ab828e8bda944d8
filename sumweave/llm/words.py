"""Hashes of words and of runs of words, for many documents at once.

Words are maximal runs of bytes other than the six ASCII white-space bytes. A word's hash takes in its
bytes eight at a time, each time mixed with multiplications and shifts, which no pattern of letters
undoes (a plain polynomial modulo 2**64 of long words would be); very long words go through BLAKE2. The
second hash of a word comes from its bytes, too, not from the first one. A run's hash is a polynomial
of word hashes modulo 2**64 from prefix sums, mixed at the end; it is for runs of some tens of words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

#: The bytes between words.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text handled at once; a document above this is cut between words.
PIECE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _odd(name: str) -> int:
    return int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "little") | 1


_RUN, _MIX_A, _MIX_B, _SECOND = (np.uint64(_odd(x)) for x in ("run", "mix a", "mix b", "second"))
#: For each of a word's two hashes the constants of its beginning and its mixing.
_WORD = tuple(tuple(np.uint64(_odd(f"{x} {i}")) for x in ("length", "first", "then")) for i in range(2))
#: Words of more bytes are hashed one by one.
LONG_WORD = 128
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n."""
    got = _POWERS.get(int(base))
    if got is None or len(got[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        both = []
        for factor in (base, inverse):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        got = both[0], both[1]
        if size <= 4 * PIECE:
            _POWERS[int(base)] = got
    return got[0][:n], got[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX_A
    h = (h ^ (h >> np.uint64(29))) * _MIX_B
    return h ^ (h >> np.uint64(32))


def second(h: np.ndarray) -> np.ndarray:
    """Another hash of the same values."""
    return mix(h * _SECOND + _MIX_B)


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, dtype=np.uint64, out=out[1:])
    return out


def _take_in(h: np.ndarray, block: np.ndarray, first: np.uint64, then: np.uint64) -> np.ndarray:
    h = (h ^ block) * first
    h = (h ^ (h >> np.uint64(32))) * then
    h = (h ^ (h >> np.uint64(29))) * first
    return h ^ (h >> np.uint64(32))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, both: bool) -> list[np.ndarray]:
    """The first, or both, 64-bit hashes of the words of one piece."""
    lengths = ends - starts
    kinds = _WORD if both else _WORD[:1]
    out = [mix(lengths.astype(np.uint64) * k[0]) for k in kinds]
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[:len(data)] = data
    # Eight bytes from every byte on.
    eights = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    at = np.flatnonzero(lengths <= LONG_WORD)
    step = 0
    while len(at):
        left = lengths[at] - step
        block = eights[starts[at] + step]
        short = left < 8
        block[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        for h, k in zip(out, kinds):
            h[at] = _take_in(h[at], block, k[1], k[2])
        at = at[left > 8]
        step += 8
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        digest = np.frombuffer(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=16).digest(), "<u8")
        for h, value in zip(out, digest):
            h[i] = value
    return out


def _piece(data: np.ndarray, lower: bool, both: bool) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start, end and hashes of each word of one piece."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], WHITE[data], [True]])))
    starts, ends = edges[0::2], edges[1::2]
    return starts, ends, _word_hashes(_LOWER[data] if lower else data, starts, ends, both)


def _cut(data: bytes) -> Iterator[tuple[int, int]]:
    """Spans of a long text that end between words."""
    start, view = 0, np.frombuffer(data, np.uint8)
    while len(data) - start > PIECE:
        stop, back = start + PIECE, 256
        while True:
            blank = np.flatnonzero(WHITE[view[max(start, stop - back):stop]])
            if len(blank):
                stop = max(start, stop - back) + int(blank[-1]) + 1
                break
            if back >= PIECE:  # one word longer than a piece: to its end
                ahead = 1 << 16
                while stop < len(data) and not len(blank := np.flatnonzero(WHITE[view[stop:stop + ahead]])):
                    stop += ahead
                stop = min(len(data), stop + int(blank[0]) + 1) if len(blank) else len(data)
                break
            back *= 16
        yield start, stop
        start = stop
    yield start, len(data)


def hashed_words(texts: Iterable[bytes | None], lower: bool = False, both: bool = False) -> tuple[np.ndarray, ...]:
    """(hashes, starts, ends, first): the words of all texts one after another, their byte spans within
    their text, and where each text's words begin (one more entry at the end). None has no words.
    With both, a second hash of each word comes last."""
    hashes, starts, ends, counts = [], [], [], []

    def flush(group: list[bytes]) -> None:
        joined = np.frombuffer(b"\n".join(group), np.uint8)
        offset = np.cumsum([0, *(len(x) + 1 for x in group)])
        s, e, h = _piece(joined, lower, both)
        owner = np.searchsorted(s, offset)
        n = np.diff(owner)
        shift = np.repeat(offset[:-1], n)
        counts.extend(n.tolist())
        hashes.append(h)
        starts.append(s - shift)
        ends.append(e - shift)

    group: list[bytes] = []
    size = 0
    for text in texts:
        text = text or b""
        if size + len(text) > PIECE and group:
            flush(group)
            group, size = [], 0
        if len(text) <= PIECE:
            group.append(text)
            size += len(text) + 1
            continue
        total = 0
        for low, high in _cut(text):
            s, e, h = _piece(np.frombuffer(text, np.uint8)[low:high], lower, both)
            hashes.append(h)
            starts.append(s + low)
            ends.append(e + low)
            total += len(s)
        counts.append(total)
    if group:
        flush(group)
    first = np.cumsum([0, *counts])
    none = [np.zeros(0, np.uint64)] * (1 + both)
    columns = [np.concatenate(c) for c in zip(none, *hashes)]
    spans = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (starts, ends)]
    return columns[0], *spans, first, *columns[1:]


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of so many words, text borders not regarded."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, dtype=np.uint64)
    step = PIECE
    for low in range(0, n, step):
        part = words[low:low + step + length - 1]
        power, inverse = _powers(_RUN, len(part))
        sums = _sums(part * power)
        m = len(part) - length + 1
        out[low:low + m] = mix((sums[length:] - sums[:m]) * inverse[:m] + np.uint64(length * int(_MIX_A) % (1 << 64)))
    return out


def inside(first: np.ndarray, length: int) -> np.ndarray:
    """Whether the run that starts at each word stays within that word's text."""
    n = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return left >= length
