"""Words and their hashes, in numpy, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

#: Words, as all operators of this package take them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Distinct words whose hashes a worker keeps; beyond it, the half met first stays (speed only).
CACHED_WORDS = 150_000

#: Text that is hashed at once.
PIECE_BYTES = 4_000_000

_FACTOR = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            first = dict(islice(self.items(), CACHED_WORDS // 2))
            self.clear()
            self.update(first)
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _WordHashes()


def split_words(text: str | None) -> list[bytes]:
    """The words of a text. ``bytes.split`` cuts at exactly the six ASCII white-space characters."""
    return text.encode().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit over the word (finalizer of a multiply-xorshift hash)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive words; empty if there are fewer words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total = total * np.uint64(_FACTOR) + hashes[i : i + count]
    return mix(total)


_INVERSE = pow(_FACTOR, -1, 1 << 64)


class LongGrams:
    """Hashes of long runs from running sums: any length at the cost of one subtraction."""

    def __init__(self, hashes: np.ndarray) -> None:
        powers = np.full(len(hashes) + 1, _INVERSE, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        up = np.full(len(hashes) + 1, _FACTOR, np.uint64)
        up[0] = 1
        self._up = np.multiply.accumulate(up)
        self._sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * powers[:-1], out=self._sums[1:])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the words from each start up to each end; equal runs of words give equal hashes."""
        with np.errstate(over="ignore"):
            span = (self._sums[ends] - self._sums[starts]) * self._up[starts]
            return mix(span ^ (np.asarray(ends - starts, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
