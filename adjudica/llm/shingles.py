"""Word shingles of a text as 64-bit numbers, for the operators that compare texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

ROWS = 512  # texts of one result batch
CHUNK = 1 << 20  # numbers a task gathers before it sends them
BUCKET = 1 << 20  # numbers of a bucket, about
LEAST_BUCKETS = 32
BUCKETED = "bucket long, data binary"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)


class Words:
    """64-bit numbers of words, hashed each time: rare words are too many for a dictionary of bounded size to be faster."""

    def numbers(self, text: str | None) -> np.ndarray:
        """The words of a text (runs without ASCII white space, A-Z lower-cased)."""
        words = (text or "").encode().lower().split()
        return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)


def mixed(numbers: np.ndarray, length: int) -> np.ndarray:
    """One number for every run of ``length`` words.

    A run's number is a polynomial in _MULTIPLIER, put together from its two halves.
    """
    return _finished(_runs(numbers, length), length)


def mixed_with_halves(numbers: np.ndarray, length: int) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """``mixed`` of every run of ``length`` words, and of runs twice as long where it is asked for."""
    half = _runs(numbers, length)
    return _finished(half, length), lambda at: _finished(half[at] * _power(length) + half[at + length], 2 * length)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_MULTIPLIER), n, 1 << 64))


def _runs(numbers: np.ndarray, n: int) -> np.ndarray:
    if n == 1:
        return numbers
    half = _runs(numbers, n // 2)
    even = half[: len(numbers) - n // 2 * 2 + 1] * _power(n // 2) + half[n // 2 :]
    return even[:-1] * _MULTIPLIER + numbers[n - 1 :] if n % 2 else even


def _finished(runs: np.ndarray, length: int) -> np.ndarray:
    found = runs + np.uint64(length * int(_power(length)) % (1 << 64))
    found ^= found >> np.uint64(29)
    found *= _FINAL
    return found ^ found >> np.uint64(32)


def shingles(numbers: np.ndarray, length: int) -> np.ndarray:
    """The sorted distinct shingles; of fewer words, the whole sequence as one."""
    if not len(numbers):
        return np.empty(0, np.int64)
    return np.unique(mixed(numbers, min(length, len(numbers))).view(np.int64))


def lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list column of 64-bit numbers."""
    offsets = np.cumsum([0] + [len(a) for a in arrays])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def held(found: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which numbers stand among sorted ones, however many these are."""
    if not len(among):
        return np.zeros(len(found), bool)
    return among[np.minimum(np.searchsorted(among, found), len(among) - 1)] == found


def packed(numbers: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted unsigned numbers as differences, other columns as distances from their least,
    byte by byte, so that the high bytes, mostly 0, stand together."""
    least = [int(c.min(initial=(1 << 63) - 1)) for c in columns]
    wide = np.concatenate([np.diff(numbers, prepend=np.uint64(0)), *((c - n).view(np.uint64) for c, n in zip(columns, least))])
    planes = np.ascontiguousarray(wide.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    head = np.array([len(numbers), len(columns), *least], "<i8").tobytes()
    return head + zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked(data: bytes) -> list[np.ndarray]:
    size, count = np.frombuffer(data, "<i8", 2).tolist()
    least = np.frombuffer(data, "<i8", count, 16)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[16 + 8 * count :]), np.uint8)
    wide = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").reshape(count + 1, size)
    return [np.cumsum(wide[0], dtype=np.uint64), *(wide[n + 1].view(np.int64) + least[n] for n in range(count))]


def bucket_ends(numbers: int) -> np.ndarray:
    """Where the buckets of 64-bit numbers end, as many as keep one to about BUCKET of them."""
    buckets = max(LEAST_BUCKETS, numbers // BUCKET + 1)
    return np.array([(1 << 64) * n // buckets for n in range(1, buckets)], np.uint64)


def bucketed(ends: np.ndarray, numbers: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """(bucket, data): sorted numbers with their columns, packed bucket by bucket."""
    cuts = np.concatenate([[0], np.searchsorted(numbers, ends), [len(numbers)]]).tolist()
    made = [(n, packed(numbers[x:y], *(c[x:y] for c in columns))) for n, (x, y) in enumerate(zip(cuts, cuts[1:])) if x < y]
    return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.binary())], names=["bucket", "data"])
