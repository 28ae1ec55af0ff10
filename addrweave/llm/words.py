"""Words of whole Arrow batches as 64-bit hashes, without a Python object per word.

A word is a longest run of bytes other than space and 0x09-0x0D. Blocks of texts are split and hashed with numpy; a text may be
longer than a block. Hashes depend on the bytes only, so every task and every run gives the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256)
LOWER[65:91] += 32
BLOCK = 1 << 20
_MULTIPLIER = 0xD6E8FEB86659FD93


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_OF_BYTE = {False: mix(np.arange(256, dtype=np.uint64)), True: mix(LOWER.astype(np.uint64))}
_powers = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("n", 0) < n:
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 2**64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of some texts: place in ``buf``, index of the text, first word of each text (one entry more than texts)."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        return hash_spans(self.buf, self.starts, self.ends, lower)


def split(buf: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~SPACE[buf]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(buf))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    return Words(buf, starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each span (ascending, disjoint): a polynomial in the bytes from one running sum per block."""
    out, lo = np.empty(len(starts), np.uint64), 0
    with np.errstate(over="ignore"):
        while lo < len(starts):
            base = starts[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
            piece = buf[base : ends[hi - 1]]
            up, down = _power(max(len(piece) + 1, 1 << 16))
            total = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_OF_BYTE[lower][piece] * up[: len(piece)], out=total[1:])
            s, e = starts[lo:hi] - base, ends[lo:hi] - base
            out[lo:hi] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            lo = hi
    return out


def windows(h: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Ordered hash of each run of ``size`` values, by doubling."""
    if len(h) < size:
        return np.empty(0, np.uint64)
    base, out, n = mix(h, salt + 7), mix(h, salt + 7), 1
    with np.errstate(over="ignore"):
        for bit in bin(size)[3:]:
            out = out[: len(out) - n] * np.uint64(pow(_MULTIPLIER, n, 2**64)) + out[n:]
            n *= 2
            if bit == "1":
                out = out[: len(base) - n] * np.uint64(_MULTIPLIER) + base[n:]
                n += 1
    return mix(out + np.uint64(size), salt)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a string or binary column, and where each begins (null: empty)."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str = "text", size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with about ``size`` bytes of text (one row at least): first row, end row, bytes, offsets."""
    if not batch.num_rows:
        return
    buf, offsets = bytes_of(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = min(batch.num_rows, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1))
        yield lo, hi, buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's lower-cased ``size``-word shingles; the whole sequence where it is shorter."""
    w = split(buf, offsets)
    h = w.hashes(lower=True)
    runs, out = windows(h, size), []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        out.append(np.unique(runs[a : b - size + 1]) if b - a >= size else windows(h[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out
