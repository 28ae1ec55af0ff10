"""Removal of repeated passages by difference-cover anchors.

Two equal runs of ``WINDOW`` words, at any two places, have an offset below ``PERIOD`` at which both places are cover positions, since every
difference modulo ``PERIOD`` lies between two members of ``COVER``. So only runs of ``ANCHOR`` words at cover positions are hashed and looked up over
the corpus (4 of 13 positions). Windows around an anchor that occurs again anywhere are then extended to their full length: their 128-bit hashes are
looked up in turn, and a window is a repetition where its sequence starts earlier in the order of ``doc_id`` and place.

Chunks follow the order of documents, so a chunk need only be told, for each of its distinct windows, whether an earlier chunk has it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from addrweave.llm.chunks import ASKED, answer, bucket_count, chunked, each, questions, told, with_answers
from addrweave.llm.words import blocks, bytes_of, split, windows

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


class _Chunk:
    """Words of a chunk's documents and what is derived from them."""

    def __init__(self, docs: pa.RecordBatch) -> None:
        self.docs = docs
        hashes, sizes, self.bytes = [], [], []
        for _, _, buf, offsets in blocks(docs):
            w = split(buf, offsets)
            hashes.append(w.hashes())
            sizes.append(np.diff(w.first))
        self.h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.h)) - np.repeat(self.first, self.sizes)
        self.left = np.repeat(self.first + self.sizes, self.sizes) - np.arange(len(self.h))  # words to the end of the document

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of cover anchors in documents long enough for a window, and their hashes."""
        long = np.repeat(self.sizes >= WINDOW, self.sizes)
        at = np.flatnonzero(_IN_COVER[self.place % PERIOD] & (self.left >= ANCHOR) & long)
        return at, windows(self.h, ANCHOR)[at] if len(at) else np.empty(0, np.uint64)

    def candidates(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows with an anchor that occurs elsewhere or twice here: starts and both halves of their hashes."""
        at, keys = self.anchors()
        if not len(at):
            return at, keys, keys
        _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        hit = np.zeros(len(self.h) + 1, np.int64)
        hit[at[(times[which] > 1) | shared[which]] + 1] = 1
        hit = np.cumsum(hit)
        starts = np.flatnonzero(self.left >= WINDOW)
        starts = starts[hit[starts + PERIOD] > hit[starts]]
        return starts, windows(self.h, WINDOW)[starts], windows(self.h, WINDOW, 11)[starts]

    def repeated(self, shared: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """Whether each word is covered by a window that starts earlier."""
        starts, high, low = self.candidates(shared)
        cover = np.zeros(len(self.h) + 1, np.int64)
        if len(starts):
            order, one = _sorted(high, low)
            again = np.ones(len(starts), bool)
            again[order[one]] = False  # the first of each sequence in this chunk, unless an earlier chunk has it
            again[order] |= earlier[np.cumsum(one) - 1]
            cover[starts[again]] += 1
            np.subtract.at(cover, starts[again] + WINDOW, 1)
        return np.cumsum(cover)[:-1] > 0


def _sorted(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash and then place, and where each distinct hash begins in it."""
    order = np.lexsort((low, high))
    one = np.ones(len(order), bool)
    one[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    return order, one


def _shared_rule(keys, which, chunks, extra):
    _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    return times[place] > 1, []


def _earlier_rule(keys, which, chunks, extra):
    order = np.lexsort((which, extra, keys))
    begins = np.ones(len(order), bool)
    begins[1:] = (keys[order][1:] != keys[order][:-1]) | (extra[order][1:] != extra[order][:-1])
    out = np.empty(len(keys), bool)
    out[order] = ~begins
    return out, []


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _written_out(chunk: _Chunk, gone: np.ndarray, with_text: bool) -> pa.Table:
    """Rows of the chunk's documents: kept words joined by a space."""
    counts, digests, kept = np.add.reduceat(np.append(gone, False), np.minimum(chunk.first, len(gone))) if len(chunk.first) else [], [], []
    counts = np.where(chunk.sizes > 0, counts, 0) if len(chunk.sizes) else []
    buf, offsets = bytes_of(chunk.docs.column("text"))
    raw = buf.tobytes()
    for k, (a, n) in enumerate(zip(chunk.first.tolist(), chunk.sizes.tolist(), strict=True)):
        words = raw[offsets[k] : offsets[k + 1]].split()
        if counts[k]:
            words = [w for w, g in zip(words, gone[a : a + n].tolist(), strict=True) if not g]
        text = b" ".join(words)
        digests.append(hashlib.sha256(text).hexdigest())
        kept.append(text.decode() if with_text else None)
    return pa.table([chunk.docs.column("doc_id"), pa.array(chunk.sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def without_repetitions(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Each document's words without those covered by a 20-word window whose sequence also starts earlier.

    Earlier: in a document with a smaller ``doc_id``, or in the same one before. Windows are judged on the input. Returns ``doc_id``,
    ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept`` (the words joined by a space; null without ``with_text``).

    Null, empty and wordless texts and texts of fewer than 20 words lose nothing. Rows of one ``doc_id`` follow each other in the order
    of their texts, so of equal rows the first keeps its words; null ids come first. An empty table gives an empty result.
    """
    table = chunked(docs, ordered=True)
    buckets = bucket_count(table, len(COVER) / PERIOD / 6)
    ask = each(table, lambda chunk, rows: questions(chunk, np.unique(_Chunk(rows).anchors()[1]), None, buckets), ASKED)
    shared = answer(ask, _shared_rule)
    wide = bucket_count(table, 1 / 12)

    def extend(number, rows, answers):
        starts, high, low = _Chunk(rows).candidates(told(answers, 0, "bool"))
        order, one = _sorted(high, low)
        return questions(number, high[order][one], low[order][one], wide)

    earlier = answer(with_answers(table, [shared], extend, ASKED), _earlier_rule, "u8")

    def finish(number, rows, answers):
        chunk = _Chunk(rows)
        return _written_out(chunk, chunk.repeated(told(answers, 0, "bool"), told(answers, 1, "bool")), with_text)

    return with_answers(table, [shared, earlier], finish, _RESULT)
