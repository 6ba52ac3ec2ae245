"""Arrow and numpy helpers shared by the text operators: byte buffers, words, rolling hashes, ragged gathers."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the two polynomial hashes modulo 2**64 (fixed values).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # another C library
    _trim = None


def release() -> None:
    """Hand freed memory back to the system: Python workers stay alive between tasks, beside an executor that needs it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def id_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, valid) of an integer id column; nulls carry the value 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = np.asarray(column.is_valid())
    return np.asarray(column.cast(pa.int64()).fill_null(0), dtype=np.int64), valid


def text_slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices of at most ``most`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        _, offsets = byte_column(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
            yield batch.slice(start, end - start)
            start = end
    release()


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every range, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(counts) - counts
    return np.repeat(starts - firsts, counts) + np.arange(total)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def cut_words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per text): maximal runs of member bytes (a table of 256 flags) within each text."""
    inside = member[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    first = offsets[:-1][np.diff(offsets) > 0]
    before[first] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[: len(data)] = inside
    after[first] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def sort_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of unsigned keys. Key and place are sorted as one number, which is several times faster than an argsort.

    Where both have more than 64 bits, the keys' lowest ones are left out, and put back into order by
    an argsort if any keys differ in those alone.
    """
    n = len(keys)
    if n < 2:
        return np.arange(n)
    places = (n - 1).bit_length()
    left_out = max(0, int(keys.max()).bit_length() + places - 64)
    if left_out > MOST_LEFT_OUT:
        return np.argsort(keys, kind="stable")
    packed = ((keys.astype(U64, copy=False) >> U64(left_out)) << U64(places)) | np.arange(n, dtype=U64)
    packed.sort()
    order = (packed & U64((1 << places) - 1)).astype(np.int64)
    if left_out:
        now = keys[order]
        if (now[1:] < now[:-1]).any():
            return np.argsort(keys, kind="stable")
    return order


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    z = values.astype(U64, copy=True)
    z ^= z >> U64(30)
    z *= U64(0xBF58476D1CE4E5B9)
    z ^= z >> U64(27)
    z *= U64(0x94D049BB133111EB)
    z ^= z >> U64(31)
    return z


#: Lowest bits of keys that ``sort_order`` leaves out at most: of hashes, so few that hardly any two differ in them alone.
MOST_LEFT_OUT = 8

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i up to n; kept up to 16 MB per base and worker process."""
    up, down = _powers.get(base, (None, None))
    if up is None or len(up) <= n:
        size = max(n + 1, 1 << 16)
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        if size <= 1 << 20:
            _powers[base] = (up, down)
    return up, down


class Rolling:
    """Polynomial hashes modulo 2**64 of any span of a symbol sequence, from one prefix sum.

    Powers of an odd base are invertible, so the prefix sum of symbol * base**-i, scaled by
    base**start, depends on the span's content alone.
    """

    def __init__(self, symbols: np.ndarray, base: int = BASES[0]):
        n = len(symbols)
        self.up, down = _powers_of(base, n)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum((symbols.astype(U64) + U64(1)) * down[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.up[starts])

    def every(self, length: int) -> np.ndarray:
        """Hash of the span of that length at every start."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.up[:n]) if n > 0 else np.zeros(0, U64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0], most: int = 1 << 17) -> np.ndarray:
    """``Rolling(data, base).spans(starts, ends)`` of ascending spans that don't overlap, over slices that the powers are kept for."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + most, side="right")))
        first = starts[i]
        out[i:j] = Rolling(data[first : ends[j - 1]], base).spans(starts[i:j] - first, ends[i:j] - first)
        i = j
    return out
