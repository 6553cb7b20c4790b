"""Array work on Arrow text columns inside tasks: words, rolling hashes, sliding minima. All loops are in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Two independent polynomial hashes modulo 2**64: odd bases and a random value for each byte.
_RANDOM = np.random.default_rng(20240229)
BASES = [int(x) | 1 for x in _RANDOM.integers(1 << 61, 1 << 63, 2, dtype=np.uint64)]
BYTE_VALUES = [_RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64) for _ in BASES]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the rows' offsets in them; null counts as empty. Nothing is copied."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the offsets of the rows in these lists."""
    inside = ~spaces[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    y = x >> np.uint64(33)  # large arrays are made as seldom as can be
    y ^= x
    y *= np.uint64(0xFF51AFD7ED558CCD)
    y ^= y >> np.uint64(33)
    y *= np.uint64(0xC4CEB9FE1A85EC53)
    y ^= y >> np.uint64(33)
    return y


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _POWERS.get(which, (np.zeros(0, np.uint64),) * 2)
    if len(up) < n:
        size = max(n, 1 << 16)
        base, inverse = BASES[which], pow(BASES[which], -1, 1 << 64)
        up, down = (np.full(size, x, np.uint64) for x in (base, inverse))
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        _POWERS[which] = up, down
    return up[:n], down[:n]


class Rolling:
    """Hashes of any ranges of ``values`` (uint64), which may be byte values or word hashes."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.up, self.down = _powers(which, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hash of each range of ``width`` values."""
        n = max(0, len(self.sums) - width)
        return mixed((self.sums[width:] - self.sums[:n]) * self.down[:n])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return Rolling(BYTE_VALUES[which][data], which).ranges(starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each range of ``width`` values, in three passes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def pieces(offsets: np.ndarray, width: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cut rows of symbols into groups of about ``most`` symbols: arrays of rows, starts and ends.

    A row longer than ``most`` windows becomes several pieces that overlap by ``width - 1``, so each window of ``width``
    symbols lies in exactly one piece.
    """
    lengths = np.diff(offsets)
    row, n = 0, len(lengths)
    while row < n:
        if lengths[row] > most + width:
            for a in range(0, int(lengths[row]) - width + 1, most):
                end = min(a + most + width - 1, int(lengths[row]))
                yield np.array([row]), np.array([offsets[row] + a]), np.array([offsets[row] + end])
            row += 1
            continue
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        over = np.flatnonzero(lengths[row:last] > most + width)
        last = row + int(over[0]) if len(over) else last
        yield np.arange(row, last), offsets[row:last], offsets[row + 1 : last + 1]
        row = last


def anchored_runs(hashes: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of windows of ``width`` symbols that share their anchor, the leftmost smallest of their ``gram``-grams.

    ``hashes`` are the gram hashes of at most 2**24 symbols, ``offsets`` the rows in them. Equal windows have equal
    anchors at equal places. Returned: row, first window, number of windows, place of the anchor.
    """
    total = int(offsets[-1])
    bits = np.uint64((1 << 24) - 1)
    ranked = (hashes & ~bits) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min(ranked, width - gram + 1) & bits).astype(np.int64)
    n = max(0, total - width + 1)
    at = at[:n]
    long = np.flatnonzero(np.diff(offsets) >= width)
    change = np.zeros(n + 1, np.int8)
    np.add.at(change, offsets[long], 1)
    np.add.at(change, offsets[long + 1] - width + 1, -1)
    valid = np.cumsum(change[:n]).astype(bool)
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    starts = np.flatnonzero(first)
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | (at[1:] != at[:-1])
    counts = np.flatnonzero(stop) + 1 - starts
    return np.searchsorted(offsets, starts, side="right") - 1, starts, counts, at[starts]


def union_ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges merged."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(new)
    return starts[first], ends[np.append(first[1:], len(starts)) - 1] if len(first) else ends
