"""Simple-8b coding of token ids, with numpy.

A 64-bit word has a selector in its upper four bits and 60 bits of ids, the first id lowest. Selectors 0 and 1 stand for long runs of zeros;
selector 15 is the escape: one id of up to 60 bits. Packing starts anew every ``SPAN`` ids, and the place of each span's first word is kept, so
that spans decode apart and whole arrays at once. The last word of a span may hold fewer ids than its selector says.

A block in bytes (little-endian): ``S8B1``, documents (u32), ids (u64), words (u64); ids of the documents (i64 each) and their null
marks (u8 each); number of ids of each (u64); first word of each span (u64); words (u64).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
SPAN = 4096
_HEAD = struct.Struct("<4sIQQ")
_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)  # bits of small ids


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the place of each span's first word. Ids are below 2**60.

    All spans are packed side by side, as rows of a matrix padded with zeros: what lies beyond a span's end needs no bits. For every place the selector that
    takes most ids is found at once; then all spans advance together, a word a step (``_starts``).
    """
    n, most = len(ids), int(COUNTS[0])
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    if int(ids.max()) >> 60:
        raise ValueError("an id needs more than 60 bits")
    spans = -(-n // SPAN)
    padded = np.zeros((spans, SPAN + most), np.uint64)
    full = np.zeros(spans * SPAN, np.uint64)
    full[:n] = ids
    padded[:, :SPAN] = full.reshape(spans, SPAN)
    width = _BITS[padded] if int(ids.max()) < len(_BITS) else np.frexp(padded.astype(np.float64))[1].astype(np.uint8)
    selector, size, reach = np.full((spans, SPAN), 15, np.uint8), 1, {1: width}
    for s in range(14, -1, -1):
        k = int(COUNTS[s])
        half = 1 << k.bit_length() - 1
        while size < half:  # widest of the next 2, 4, ... ids, as far as they are asked for
            further = reach[size].copy()
            np.maximum(further[:, :-size], reach[size][:, size:], out=further[:, :-size])
            size *= 2
            reach[size] = further
        fits = np.maximum(reach[half][:, :SPAN], reach[half][:, k - half : k - half + SPAN]) <= np.uint8(WIDTHS[s])  # compared as bytes
        if s < 13 and not fits.any():
            break
        selector -= fits.view(np.uint8)  # what fits a selector fits all above it
    starts = _starts(selector, n)
    chosen, span = selector.ravel()[starts], starts // SPAN
    words, source = chosen.astype(np.uint64) << np.uint64(60), padded.ravel()
    begin = starts + span * most  # in the padded matrix
    for s in np.unique(chosen[chosen > 1]):
        mine = np.flatnonzero(chosen == s)
        word = np.zeros(len(mine), np.uint64)
        for k in range(int(COUNTS[s])):
            word |= source[begin[mine] + k] << np.uint64(k * int(WIDTHS[s]))
        words[mine] |= word
    return words, np.searchsorted(starts, np.arange(spans) * SPAN).astype(np.uint64)


def _starts(selector: np.ndarray, n: int) -> np.ndarray:
    """Places of the ids that begin a word, ascending.

    All spans go on side by side eight words a step, and the words between are filled in. A place past a span's ids leads to itself, so that no span need be taken out.
    """
    spans = len(selector)
    length = np.full(spans, SPAN)
    length[-1] = n - (spans - 1) * SPAN
    one = np.arange(spans * (SPAN + 1)).reshape(spans, SPAN + 1)
    at = one[:, 0].copy()
    ends = at + length
    one[:, :SPAN] += COUNTS.take(selector)
    np.minimum(one, ends[:, None], out=one)
    one = one.ravel()
    two = one.take(one)
    four = two.take(two)
    eight, steps = four.take(four), []
    while (at < ends).any():
        steps.append(at)
        at = eight.take(at)
    starts = np.array(steps).T
    for further in (four, two, one):
        starts = np.stack([starts, further.take(starts)], 2).reshape(spans, -1)
    starts = starts[starts < ends[:, None]]  # by span, and ascending in it
    return starts - starts // (SPAN + 1)


def decode(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of all spans at once: spans are rows of a matrix wide enough for what the last word of one says too much."""
    if not n:
        return np.zeros(0, np.uint64)
    spans, most = len(first), int(COUNTS[0])
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    start = np.cumsum(counts) - counts
    span = np.zeros(len(words), np.int64)
    span[first[1:].astype(np.int64)] = 1
    span = np.cumsum(span)
    start += span * (SPAN + most) - start[first.astype(np.int64)][span]
    out = np.zeros(spans * (SPAN + most), np.uint64)
    for s in np.unique(selector[selector > 1]).tolist():
        mine, width = np.flatnonzero(selector == s), int(WIDTHS[s])
        word, place, mask = words[mine], start[mine], np.uint64((1 << width) - 1)
        for k in range(int(COUNTS[s])):
            out[place + k] = (word >> np.uint64(k * width)) & mask
    return out.reshape(spans, SPAN + most)[:, :SPAN].ravel()[:n]


@dataclass
class Block:
    doc_ids: list[int | None]
    sizes: np.ndarray
    ids: np.ndarray

    def dumps(self) -> bytes:
        words, first = encode(self.ids)
        known = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        nulls = np.array([d is None for d in self.doc_ids], "u1")
        return b"".join([_HEAD.pack(b"S8B1", len(known), len(self.ids), len(words)), known.tobytes(), nulls.tobytes(), self.sizes.astype("<u8").tobytes(), first.astype("<u8").tobytes(), words.astype("<u8").tobytes()])

    @classmethod
    def loads(cls, raw: bytes) -> Block:
        magic, docs, n, count = _HEAD.unpack_from(raw)
        if magic != b"S8B1":
            raise ValueError("not a block of this format")
        at, parts = _HEAD.size, []
        for kind, size in (("<i8", docs), ("u1", docs), ("<u8", docs), ("<u8", -(-n // SPAN)), ("<u8", count)):
            parts.append(np.frombuffer(raw, kind, size, at))
            at += parts[-1].nbytes
        known, nulls, sizes, first, words = parts
        return cls([None if z else d for d, z in zip(known.tolist(), nulls.tolist(), strict=True)], sizes.astype(np.int64), decode(words, first, n))
