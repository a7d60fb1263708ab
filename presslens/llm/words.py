"""Words and fingerprints of many texts at once: numpy over the byte buffer of an Arrow column.

Fingerprints are polynomial in a fixed odd base modulo 2^64 over a fixed random table of the 256
byte values, so that the value of any segment comes from two prefix values. Prefixes are formed
block by block and kept only where they are asked for: memory does not grow with a long text.
Powers of an odd base agree modulo 2^64 for some long strings that are each other's complement, so a
segment longer than `PIECE` bytes is the sum of its pieces, each spread together with its number.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
#: Bytes that one polynomial covers; complementary strings first agree at 1,024.
PIECE = 288
U = np.uint64
BASE, GOLDEN = 0x9E3779B97F4A7C13, U(0x9E3779B97F4A7C15)


def give_back() -> None:
    """Return freed memory to the system: Python workers are kept for later tasks, and so is what they hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # other C libraries have no such call
        pass


def tidy(run):
    """`run`, a function over an iterator of batches, that leaves no memory behind in its worker."""

    def inside(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return inside


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x + GOLDEN
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Fingerprint:
    """Fingerprints of segments of a byte buffer; `salt` gives independent ones."""

    def __init__(self, salt: int = 0, base: int = BASE):
        with np.errstate(over="ignore"):
            self.table = mix(np.arange(256, dtype=U) + U(salt * 1000 + 1))
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up, self.down = _powers(base, BLOCK), _powers(self.inverse, BLOCK)

    def prefixes(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Prefix values before each of the ascending positions `at`."""
        out, carry = np.zeros(len(at), U), np.zeros(1, U)
        for lo in range(0, len(data), BLOCK):
            scale = np.array([pow(self.base, lo, 2**64)], U)
            sums = np.cumsum(self.table[data[lo : lo + BLOCK]] * self.up[: min(BLOCK, len(data) - lo)], dtype=U)
            i, j = np.searchsorted(at, (lo + 1, lo + len(sums) + 1))
            out[i:j] = carry + scale * sums[at[i:j] - lo - 1]
            carry = carry + scale * sums[-1:]
        return out

    def shift(self, at: np.ndarray) -> np.ndarray:
        """The base to the power of minus each position."""
        block = at // BLOCK
        far = np.array([pow(self.inverse, int(b) * BLOCK, 2**64) for b in range(int(block.max()) + 1)] if len(at) else [1], U)
        return self.down[at % BLOCK] * far[block]

    def segments(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Fingerprints of data[first:last]; both arrays ascend."""
        out = mix((self.prefixes(data, last) - self.prefixes(data, first)) * self.shift(first) + (last - first).astype(U))
        long = np.flatnonzero(last - first > PIECE)
        if len(long):
            out[long] = self.pieced(data, first[long], last[long])
        return out

    def pieced(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Fingerprints of long segments from those of their pieces."""
        count = -(-(last - first) // PIECE)
        starts = np.cumsum(count) - count
        number = np.arange(count.sum()) - np.repeat(starts, count)
        lo = np.repeat(first, count) + PIECE * number
        hi = np.minimum(lo + PIECE, np.repeat(last, count))
        marks = np.unique(np.concatenate((lo, hi)))
        values = self.prefixes(data, marks)
        part = (values[np.searchsorted(marks, hi)] - values[np.searchsorted(marks, lo)]) * self.shift(lo) + (hi - lo).astype(U)
        part = mix(mix(part) ^ mix(number.astype(U)))
        return mix(np.add.reduceat(part, starts) + (last - first).astype(U))


def byte_class(keep: str) -> np.ndarray:
    """256 flags from a set of characters (ASCII)."""
    flags = np.zeros(256, bool)
    flags[list(keep.encode())] = True
    return flags


#: Words end at these bytes: space and tab to carriage return.
NOT_SPACE = ~byte_class(" \t\n\x0b\x0c\r")
#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters a-z, digits, and every byte beyond ASCII.
ALNUM = byte_class("abcdefghijklmnopqrstuvwxyz0123456789") | (np.arange(256) >= 128)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without copying; the text of row i is bytes[offsets[i]:offsets[i+1]]."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, size: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row, row after, bytes, offsets) of runs of rows with about `size` bytes, at least one row each."""
    data, offsets = buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def spans(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, row) of the maximal runs of flagged bytes inside each row."""
    begin, end = flags.copy(), flags.copy()
    begin[1:] &= ~flags[:-1]
    end[:-1] &= ~flags[1:]
    inner = offsets[(offsets > 0) & (offsets < len(flags))]
    begin[inner] = flags[inner]
    end[inner - 1] = flags[inner - 1]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return first, last, np.searchsorted(offsets, first, "right") - 1


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flagged bytes each row has."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def chained(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, fingerprint) of all runs of n words inside one row."""
    at = np.flatnonzero(row[n - 1 :] == row[: len(row) - n + 1]) if len(row) >= n else np.zeros(0, np.int64)
    out = np.zeros(len(at), U)
    for k in range(n):
        out = mix(out * U(3) + hashes[at + k])
    return at, out


def repeats(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur more than once."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    flags = np.zeros(len(keys), bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return flags
