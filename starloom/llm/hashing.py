"""Hashes of words, shingles and chunks of many texts at once, on the bytes of an Arrow column.

A run of bytes is hashed as the sum of a random number per byte times a power of an odd number by
place, modulo 2 ** 64, and then mixed; equal runs have equal hashes wherever they stand. Work is
done on slices of whole texts of about ``SLICE`` bytes; a longer text is a slice by itself and needs
about 30 bytes of memory per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20_240_229).integers(1, 2**63, 256, dtype=np.uint64) * 2 + 1
_powers = np.ones(1, np.uint64)

#: Words are runs of other bytes than these.
_SPACES = np.frombuffer(b"\x20\x09\x0a\x0b\x0c\x0d", np.uint8)
_IN_WORD = np.ones(256, bool)
_IN_WORD[_SPACES] = False
_WORD_BYTES = _BYTES.copy()
_WORD_BYTES[ord("A") : ord("Z") + 1] = _WORD_BYTES[ord("a") : ord("z") + 1]
_WORD_BYTES[_SPACES] = 0


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the odd number."""
    global _powers
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _ODD)]))
    return _powers[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each row begins (and the last ends)."""
    wide = column.cast(pa.large_string())
    _, places, data = wide.buffers()
    offsets = np.frombuffer(places, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE (or ``size``) bytes."""
    first, last = 0, len(offsets) - 1
    while first < last:
        end = int(np.searchsorted(offsets, offsets[first] + (size or SLICE), "right")) - 1
        end = min(last, max(end, first + 1))
        yield first, end
        first = end


def run_hashes(data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The hash of each run of ``data`` from one start to the next, the last one to the end."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = starts[0]
    data, starts = data[first:], starts - first
    sizes = np.diff(starts, append=len(data))
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    values = table[data] * powers(int(sizes.max()))[place]
    return mixed(np.add.reduceat(values, starts))


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text its set of hashed shingles of ``width`` words, sorted: all words as one shingle
    if they are fewer, nothing if there are none. A-Z are lower-cased."""
    data, offsets = column_bytes(column)
    for first, end in slices(offsets):
        piece = data[offsets[first] : offsets[end]]
        bounds = offsets[first : end + 1] - offsets[first]
        inside = _IN_WORD[piece]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = bounds[:-1][bounds[:-1] < len(piece)]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        words = run_hashes(piece, starts, _WORD_BYTES)
        joined = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            joined += words[k : k + len(joined)] * powers(width + 1)[k + 1]
        joined = mixed(joined)
        at = np.searchsorted(starts, bounds)
        for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
            if high - low >= width:
                yield np.unique(joined[low : high - width + 1])
            elif high > low:
                few = (words[low:high] * powers(width + 1)[1 : high - low + 1]).sum(dtype=np.uint64)
                yield mixed(np.array([few + np.uint64(high - low)]))
            else:
                yield np.zeros(0, np.uint64)


def chunks(
    column: pa.Array, rate: int = 10, least: int = 10
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text the starts, ends and digests of its content-defined chunks.

    A gear hash rolls over the last 32 bytes. A byte whose hash is in the lowest of ``rate`` equal
    parts ends a chunk, unless one of the ``least`` - 1 bytes before it has such a hash too. A border
    inside a character moves behind it. So a border depends on the 32 + ``least`` bytes before it and
    the rest of a character, and on nothing else.
    """
    gear = (_BYTES >> np.uint64(16)).astype(np.uint32)
    limit = np.uint32(2**32 // rate)
    data, offsets = column_bytes(column)
    for first, end in slices(offsets):
        for row in range(first, end):
            piece = data[offsets[row] : offsets[row + 1]]
            rolled = gear[piece]
            for step in (1, 2, 4, 8, 16):
                if step < len(rolled):
                    later = rolled.copy()
                    later[step:] += rolled[:-step] << np.uint32(step)
                    rolled = later
            marks = np.flatnonzero(rolled < limit)
            marks = marks[np.diff(marks, prepend=-least) >= least]
            starts = np.concatenate([[0], marks + 1]) if len(piece) else np.zeros(0, np.int64)
            starts = starts[starts < len(piece)]
            for _ in range(3):
                starts = starts + ((piece[starts] & 0xC0) == 0x80)
                starts = starts[starts < len(piece)]
            ends = np.concatenate([starts[1:], [len(piece)]]) if len(piece) else starts
            digests = mixed(run_hashes(piece, starts, _BYTES) + (ends - starts).astype(np.uint64))
            yield starts, ends, digests
