"""CRC-32 of many spans of a byte buffer at once, by a table of positions.

The checksum is linear: what a byte adds depends on the byte and on its distance from the span's
end alone. A table holds that for every byte and distance below ``REACH``; the contributions of a
span are combined by exclusive or, and a constant for its length makes up for the initial value.
A longer span is cut into blocks of ``REACH`` bytes from its end; each block's sum is moved on by
as many bytes as follow it, by powers of two, and the blocks are combined in the same way.

Defined cases: an empty span has checksum 0; no spans give an empty array.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np

#: Bytes from a span's end that the table reaches; a power of two.
REACH = 64
#: Bytes whose contributions are looked up at once.
AT_ONCE = 1 << 19


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """What a byte adds, at ``distance * 256 + byte``."""
    zero = zlib.crc32(b"\0")
    rows = [np.array([zlib.crc32(bytes([b])) ^ zero for b in range(256)], np.uint32)]
    for _ in range(REACH - 1):
        last = rows[-1]
        rows.append((last >> np.uint32(8)) ^ rows[0][last & np.uint32(255)])
    return np.concatenate(rows)


def _moved(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sums ``values`` once the operator's number of bytes has followed them."""
    out = operator[0][values & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ operator[k][(values >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@lru_cache(maxsize=64)
def _operator(power: int) -> np.ndarray:
    """Moves a sum on by ``2 ** power`` bytes."""
    if power == 0:
        every = np.arange(256, dtype=np.uint32)
        one = [every << np.uint32(8 * k) for k in range(4)]
        return np.stack([(x >> np.uint32(8)) ^ position_table()[x & np.uint32(255)] for x in one])
    half = _operator(power - 1)
    return np.stack([_moved(half, x) for x in half])


def _moved_by(values: np.ndarray, steps: np.ndarray, least: int = 0) -> np.ndarray:
    """Each sum moved on by ``steps * 2 ** least`` bytes."""
    out = values.copy()
    for k in range(int(steps.max(initial=0)).bit_length()):
        at = np.flatnonzero((steps >> k) & 1)
        out[at] = _moved(_operator(least + k), out[at])
    return out


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """The checksum of so many zero bytes."""
    ones = np.full(len(lengths), 0xFFFFFFFF, np.uint32)
    return _moved_by(ones, lengths.astype(np.int64)) ^ np.uint32(0xFFFFFFFF)


@lru_cache(maxsize=1)
def _short_constants() -> np.ndarray:
    return length_constants(np.arange(REACH + 1))


def _sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Combined contributions of spans of 1 to ``REACH`` bytes."""
    table, lengths = position_table(), ends - starts
    out = np.empty(len(starts), np.uint32)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + AT_ONCE, "right")) - 1)
        begins = (bounds[first:last] - bounds[first]).astype(np.int32)
        size = int(bounds[last] - bounds[first])
        n, run = lengths[first:last], np.arange(size, dtype=np.int32)
        where = np.repeat(starts[first:last] - begins, n) + run
        distance = np.repeat((begins + n - 1).astype(np.int32), n) - run
        out[first:last] = np.bitwise_xor.reduceat(table[(distance << 8) | data[where]], begins)
        first = last
    return out


def span_crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 (unsigned) of ``data[starts[i]:ends[i]]`` for every i; spans may overlap."""
    starts, ends = starts.astype(np.int64), ends.astype(np.int64)
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero((lengths > 0) & (lengths <= REACH))
    if len(short):
        out[short] = _sums(data, starts[short], ends[short]) ^ _short_constants()[lengths[short]]
    long = np.flatnonzero(lengths > REACH)
    if len(long):
        blocks = -(-lengths[long] // REACH)
        begins = np.cumsum(blocks) - blocks
        after = np.repeat(begins + blocks - 1, blocks) - np.arange(blocks.sum())
        stop = np.repeat(ends[long], blocks) - after * REACH
        start = np.maximum(stop - REACH, np.repeat(starts[long], blocks))
        moved = _moved_by(_sums(data, start, stop), after, REACH.bit_length() - 1)
        out[long] = np.bitwise_xor.reduceat(moved, begins) ^ length_constants(lengths[long])
    return out
