"""Language-model scores by a weighted backoff automaton over the whole corpus.

States are histories of one word (and the start of a text). A state has an arc for every bigram seen in training, with its smoothed probability, and a
failure arc with the backoff weight to the state without history, whose arcs are the words:

    P(w | h) = (1 - b) * c(h, w) / c(h) + b * P(w),    P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1))

The backoff weight b depends on how often h occurs (by powers of the square root of two): it is the share of training tokens after such histories whose bigram occurs
once, that is, which would be unseen if they were left out. A text is read once from left to right; the state carries on and log-probabilities add up.

Counts cover all training documents. The automaton grows with the corpus and is never gathered: each chunk of documents asks for the counts of
its own distinct words, then of its bigrams, and so holds the part of the automaton that its texts pass through.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from addrweave.llm.chunks import ASKED, answer, bucket_count, chunked, each, questions, told, totals, with_answers
from addrweave.llm.words import blocks, mix, split

BINS = 64
_END, _START = (int(x) for x in mix(np.array([1, 2], np.uint64), 99))


def _bin(count: np.ndarray) -> np.ndarray:
    return np.minimum(2 * np.log2(np.maximum(count, 1)), BINS - 1).astype(np.int64)


def _pair(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(history, 21) * np.uint64(3) + word, 22)


class _Chunk:
    """Tokens of a chunk: words and one end a document, each with the token before it."""

    def __init__(self, docs: pa.RecordBatch) -> None:
        hashes, sizes = [], []
        for _, _, buf, offsets in blocks(docs.select(["text"])):
            w = split(buf, offsets)
            hashes.append(w.hashes(lower=True))
            sizes.append(np.diff(w.first))
        words, self.sizes = np.concatenate(hashes), np.concatenate(sizes) + 1
        ends = np.cumsum(self.sizes) - 1
        self.first = ends - self.sizes + 1
        self.token = np.full(len(words) + len(ends), _END, np.uint64)
        inner = np.ones(len(self.token), bool)
        inner[ends] = False
        self.token[inner] = words
        self.before = np.empty_like(self.token)
        self.before[1:] = self.token[:-1]
        self.before[self.first] = _START
        train = np.array([x is True for x in docs.column("train").to_pylist()])
        self.train = np.repeat(train, self.sizes)
        # start counts as a history once for every training document
        self.keys, place = np.unique(np.concatenate([self.token, np.array([_START], np.uint64)]), return_inverse=True)
        self.place, self.start = place[:-1], place[-1]
        self.count = np.bincount(self.place[self.train], minlength=len(self.keys))
        self.count[self.start] = train.sum()
        self.history = np.where(self.before == np.uint64(_START), self.start, np.concatenate([[0], self.place[:-1]]))

    def pairs(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens whose bigram may occur in training, and distinct bigrams: keys, place of each token, count here, bin of the history."""
        at = np.flatnonzero((counts[self.history] > 0) & (counts[self.place] > 0))
        keys, one, place = np.unique(_pair(self.before[at], self.token[at]), return_index=True, return_inverse=True)
        return at, keys, place, np.stack([np.bincount(place[self.train[at]], minlength=len(keys)), _bin(counts[self.history[at]][one])], axis=1).astype("<u4")


def _count_rule(keys, which, chunks, extra):
    distinct, place = np.unique(keys, return_inverse=True)
    count = np.bincount(place, weights=extra).astype(np.int64)
    inner = ~np.isin(distinct, np.array([_START, _END], np.uint64))
    end = count[distinct == np.uint64(_END)].sum()
    return count[place].astype("<u8"), [count[inner].sum(), (count[inner] > 0).sum(), end]


def _pair_rule(keys, which, chunks, extra):
    extra = extra.reshape(-1, 2)
    distinct, one, place = np.unique(keys, return_index=True, return_inverse=True)
    count = np.bincount(place, weights=extra[:, 0]).astype(np.int64)
    bins = extra[one, 1]
    sums = np.concatenate([np.bincount(bins, weights=count, minlength=BINS), np.bincount(bins, weights=count == 1, minlength=BINS)])
    return count[place].astype("<u4"), sums


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, folds: int = 5, fold: int = 1) -> DataFrame:
    """Log10 probabilities of all texts: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from documents whose crc32 of the id does not leave ``fold`` when divided by ``folds``; ``n_tokens`` counts the end of the text, ``n_known`` the
    tokens seen in training. ``base_score`` uses words alone.

    Null, empty and wordless texts are one end. Null ids are scored but not learned from (``held_out`` null). Repeated rows count as often
    as they occur. Without training text every token has a probability of 1 by the formula. An empty table gives an empty result.
    """
    table = chunked(docs, ordered=False)

    def marked(rows: pa.RecordBatch) -> pa.RecordBatch:
        train = [None if d is None else zlib.crc32(str(d).encode()) % folds != fold for d in rows.column("doc_id").to_pylist()]
        return rows.append_column("train", pa.array(train, pa.bool_()))

    def ask_words(number, rows):
        c = _Chunk(marked(rows))
        return questions(number, c.keys, c.count.astype("<u4"), buckets)

    buckets = bucket_count(table, 1 / 25)
    words = answer(each(table, ask_words, ASKED), _count_rule, "<u4", 3)
    known, kinds, ends = totals(words, 3)
    n, v = known + ends, kinds + (ends > 0)

    wide = bucket_count(table, 1 / 9)

    def ask_pairs(number, rows, answers):
        _, keys, _, extra = _Chunk(marked(rows)).pairs(told(answers, 0, "<u8"))
        return questions(number, keys, extra, wide)

    pairs = answer(with_answers(table, [words], ask_pairs, ASKED), _pair_rule, "<u4", 2 * BINS)
    sums = totals(pairs, 2 * BINS)
    tokens, once = np.cumsum(sums[:BINS][::-1])[::-1], np.cumsum(sums[BINS:][::-1])[::-1]
    backoff = np.where(sums[:BINS] > 0, sums[BINS:] / np.maximum(sums[:BINS], 1), once / np.maximum(tokens, 1)).clip(0.001, 0.999)

    def traverse(number, rows, answers):
        rows = marked(rows)
        c, counts = _Chunk(rows), told(answers, 0, "<u8").astype(np.float64)
        alone = (counts[c.place] + 0.5) / (n + 0.5 * (v + 1))
        at, _, place, _ = c.pairs(counts)
        follows = np.zeros(len(c.token))
        follows[at] = told(answers, 1, "<u4")[place]
        past = counts[c.history]
        weight = np.where(past > 0, backoff[_bin(past)], 1.0)  # failure arc of the state before the token
        arc = (1 - weight) * follows / np.maximum(past, 1) + weight * alone
        add = lambda x: np.add.reduceat(x, c.first)
        train = rows.column("train")
        return pa.table([rows.column("doc_id"), pa.array([None if t is None else not t for t in train.to_pylist()], pa.bool_()), pa.array(c.sizes), pa.array(add((counts[c.place] > 0).astype(np.int64))), pa.array(np.full(len(c.sizes), int(n))), pa.array(add(np.log10(alone))), pa.array(add(np.log10(arc)))],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return with_answers(table, [words, pairs], traverse, _RESULT)
