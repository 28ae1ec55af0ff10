"""Token counts under a unigram segmentation, by one dynamic programme over the trie of distinct pre-tokens.

The pieces are those of a public byte-level vocabulary; a piece of rank r has probability 1 / ((r + 1) * H), H making the sum 1 (Zipf's law over the
vocabulary's order), since tokenizers aren't trained here. A pre-token counts the pieces of its most probable segmentation (fewest pieces, where
two are equal). Each batch's new distinct pre-tokens enter a trie; forward scores are computed once for every trie node, that is for every
shared prefix, and the count is stored at the terminal node. Terminal counts are remembered between batches in a bounded table.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from addrweave.llm.store import texts
from addrweave.llm.tokens import slices

REMEMBERED = 400_000  #: terminal counts kept; the table is emptied when it is full
LONGEST = 64  #: longer pre-tokens (in characters) are counted but not remembered


class Unigram:
    def __init__(self, ranks_path: str, pattern: str) -> None:
        import regex

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines)}
        total = np.log(np.sum(1.0 / (np.array(list(ranks.values())) + 1)))
        self.score = {piece: float(-np.log(rank + 1) - total) for piece, rank in ranks.items()}
        self.longest = max(map(len, self.score))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, float]] = {}

    def count(self, words: list[bytes]) -> list[tuple[int, float]]:
        """Pieces and log-probability of each word of a sorted list.

        The list is the trie in depth-first order: ``forward`` holds the scores along the path to the present node, and a word goes on from
        the deepest node that it shares with the one before.
        """
        forward, last, out = [(0.0, 0)], b"", []
        score, longest = self.score, self.longest
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del forward[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best, fewest = -np.inf, 0
                for start in range(max(0, end - longest), end):
                    s = score.get(word[start:end])
                    if s is not None:
                        before, pieces = forward[start]
                        if before + s > best or before + s == best and pieces + 1 < fewest:
                            best, fewest = before + s, pieces + 1
                forward.append((best, fewest))
            out.append((forward[-1][1], forward[-1][0]))
            last = word
        return out

    def learn(self, words: set[str]) -> dict[str, tuple[int, float]]:
        """Terminal counts of all ``words``; those not met before go through a trie."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = sorted((w.encode(), w) for w in words if w not in self.known)
        found = dict(zip((w for _, w in new), self.count([b for b, _ in new]), strict=True))
        self.known.update((w, c) for w, c in found.items() if len(w) <= LONGEST)
        return {w: self.known[w] if w in self.known else found[w] for w in words}


@lru_cache(1)
def _unigram(ranks_path: str, pattern: str) -> Unigram:
    return Unigram(ranks_path, pattern)


def _count(ranks_path: str, pattern: str) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unigram(ranks_path, pattern)
        for batch in batches:
            for part, strings in slices(batch):
                words = [model.split(t) for t in strings]
                known = model.learn(set().union(*words))
                pairs = [[known[w] for w in one] for one in words]
                columns = [[len(p) for p in pairs], [sum(n for n, _ in p) for p in pairs]]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), pa.array([float(sum(s for _, s in p)) for p in pairs], pa.float64())], ["doc_id", "n_pretokens", "n_tokens", "log_probability"])

    return count


def token_counts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_pretokens``, ``n_tokens`` and ``log_probability`` (natural logarithm) of every whole text.

    ``ranks_path`` is a file of base64 pieces and ranks that holds every single byte; ``pattern`` cuts texts into pre-tokens. Null and
    empty texts count 0 and have a log-probability of 0. One row per input row, repeated and null ids included; nothing is shuffled.
    """
    return texts(docs).mapInArrow(_count(ranks_path, pattern), "doc_id long, n_pretokens long, n_tokens long, log_probability double")
