"""Whole Arrow batches of text as flat byte buffers, for vectorised numpy work.

A batch of strings is one ``uint8`` buffer plus offsets.  Everything here works
on that pair, so a task touches each byte a constant number of times and never
makes a Python object per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Odd multiplier of the polynomial hashes (invertible modulo 2**64).
BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that hash order looks random."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(29)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(32)
    return h


#: A random 64-bit value for every byte.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * U64(0x632BE59BD9B4E019))

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i below n; kept per process and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, base & _MASK, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        _powers[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Prefix:
    """Prefix sums of a polynomial hash; ``span`` hashes any substring in O(1)."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        self.base = base
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers(base, len(values)), out=self.sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        back = powers(inverse(self.base), len(self.sums))
        return (self.sums[end] - self.sums[start]) * back[start]


def release() -> None:
    """Give freed memory back to the system; workers outlive a task and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def tidy(run):
    """A map over batches that releases memory when its input ends."""

    def wrapped(batches):
        yield from run(batches)
        release()

    return wrapped


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the int64 offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets * 0
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return buf, offsets - offsets[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of each block has about ``most`` bytes; a longer text is a block of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = flat(batch.column(batch.schema.names.index(text)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offs, offs[at] + most, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def gathered(batches: Iterable[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Blocks as above, after small batches are put together."""
    held, size = [], 0
    for block in blocks(batches, text, most):
        held.append(block)
        size += int(flat(block.column(block.schema.names.index(text)))[1][-1])
        if size >= most * 3 // 4:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


#: ASCII capitals to small letters; other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of a word in ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of a word in ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing): digits, a-z and all of UTF-8 beyond ASCII.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[0x30:0x3A] = True
WORD_BYTE[0x61:0x7B] = True
WORD_BYTE[0x80:] = True


def words(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of member bytes, and the row it is in; runs end where a row ends."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    is_in = member[buf]
    edge = np.empty(n, dtype=bool)
    edge[0] = is_in[0]
    np.greater(is_in[1:], is_in[:-1], out=edge[1:])
    first = offsets[:-1][offsets[:-1] < offsets[1:]]  # of rows that aren't empty
    edge[first] = is_in[first]
    starts = np.flatnonzero(edge)
    edge[:] = False
    edge[-1] = is_in[-1]
    edge[:-1] = is_in[:-1] & ~is_in[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    edge[last] = is_in[last]
    ends = np.flatnonzero(edge) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every batch."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    h = Prefix(BYTE_VALUE[buf]).span(starts, ends)
    return mix64(h + (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def chunk_word_hashes(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray, chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words() and their hashes, hashing about ``chunk`` bytes at a time, so that a long text needs no long table of powers."""
    starts, ends, rows = words(buf, offsets, member)
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(starts, starts[at] + chunk)), at + 1)
        lo, hi = int(starts[at]), int(ends[to - 1])
        out[at:to] = word_hashes(buf[lo:hi], starts[at:to] - lo, ends[at:to] - lo)
        at = to
    return starts, ends, rows, out
