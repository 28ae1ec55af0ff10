"""Benchmark decontamination: a BM25 inverted index of test items, queried by every training passage with block-max WAND bounds.

Items are filed as segments of at most ``SEGMENT`` words; a passage is ``2 * SEGMENT`` words of a document, every ``SEGMENT`` words, so a
segment that occurs whole lies in one passage. A segment's BM25 impacts are divided by its score for itself: one that occurs whole scores
1, and all passages with a score of ``THRESHOLD`` or more are retrieved. As in block-max WAND, a passage is given up when the
sum of its terms' list maxima stays below the threshold; then a block of segments is, when the sum of block maxima does; only blocks
left over are scored. The tests run on all passages of a batch at once.

Retrieved items are verified on the whole document: the share of the item's distinct five-word shingles that occur there, for the question
and for the answer (shingles that touch the last quarter of the words) apart. An answer of few shingles loses most of them by one changed word, so
with ``whole`` (the query, ``clean`` and the pipeline give ``WHOLE``) an item with that share of all its shingles in the document counts too,
retrieved or not: one rare word can be most of a short item's BM25 score. Such pairs are found by looking up all shingles of the documents.

Item words are counted first; the index is built in shards of at most ``SHARD_WORDS`` words (about 100 bytes a word), each broadcast for its own
pass over the documents. Document frequencies and lengths are those of all items.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.store import texts, written
from addrweave.llm.words import blocks, split, windows

SEGMENT, SHINGLE = 64, 5
THRESHOLD, QUESTION, ANSWER, WHOLE = 0.6, 0.75, 0.5, 0.75
K1, B = 1.2, 0.75
BLOCK_SEGMENTS = 16
SHARD_WORDS = 500_000


def _parts(h: np.ndarray) -> list[np.ndarray]:
    """Question and answer shingles of an item's word hashes."""
    if not len(h):
        return [np.empty(0, np.uint64)] * 2
    if len(h) < 2 * SHINGLE:
        whole = np.unique(windows(h, min(SHINGLE, len(h))))
        return [whole, whole]
    runs, cut = windows(h, SHINGLE), -(-len(h) * 3 // 4) - SHINGLE + 1  # an answer shingle touches the last quarter
    return [np.unique(runs[:cut]), np.unique(runs[cut:])]


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the index: kind 0: a segment's term, its count and the segment's length; 1, 2: a shingle of question or answer."""
    names = ["entry", "kind", "segment", "hash", "n", "size"]
    for batch in batches:
        entries = np.asarray(batch.column("entry"))
        for lo, _, buf, offsets in blocks(batch):
            w = split(buf, offsets)
            h = w.hashes(lower=True)
            for k in range(len(offsets) - 1):
                mine, out = h[w.first[k] : w.first[k + 1]], []
                for s in range(0, len(mine), SEGMENT):
                    term, n = np.unique(mine[s : s + SEGMENT], return_counts=True)
                    out.append((0, s // SEGMENT, term, n, len(mine[s : s + SEGMENT])))
                out += [(kind, 0, x, np.ones(len(x), np.int64), len(x)) for kind, x in enumerate(_parts(mine), 1)]
                for kind, s, x, n, size in out:
                    full = lambda v, m=len(x): pa.array(np.full(m, v, np.int64))
                    yield pa.RecordBatch.from_arrays([full(entries[lo + k]), full(kind), full(s), pa.array(x.astype(np.int64)), pa.array(n.astype(np.int64)), full(size)], names)


def _csr(keys: np.ndarray, count: int) -> np.ndarray:
    """Where each of ``count`` keys begins in the sorted ``keys``."""
    return np.searchsorted(keys, np.arange(count + 1))


def _expand(first: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of ``of``, all places of its list: index into ``of``, place."""
    n = first[of + 1] - first[of]
    at = np.repeat(np.arange(len(of)), n)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[of], n)


@dataclass
class Index:
    items: np.ndarray  #: item id of each entry
    terms: np.ndarray  #: sorted term hashes
    highest: np.ndarray  #: list maximum of each term
    first: np.ndarray  #: postings of each term: segment, impact; sorted by segment
    segment: np.ndarray
    impact: np.ndarray
    block_first: np.ndarray  #: block maxima of each term
    block: np.ndarray
    block_high: np.ndarray
    entry_of: np.ndarray  #: entry of each segment
    per_block: int
    shingles: np.ndarray  #: sorted distinct shingle hashes, and (shingle, entry * 2 + answer) for each use
    use_first: np.ndarray
    use: np.ndarray
    needed: np.ndarray  #: number of shingles by entry * 2 + answer
    fresh: np.ndarray  #: whether a use is the first of its shingle and entry
    whole: np.ndarray  #: number of distinct shingles by entry

    @classmethod
    def of(cls, rows: pa.Table, segments: int, mean: float) -> Index:
        col = {c: rows.column(c).to_numpy() for c in rows.column_names}
        entries, entry = np.unique(col["entry"], return_inverse=True)
        items = np.zeros(len(entries), np.int64)
        items[entry] = col["item_id"]
        post = col["kind"] == 0
        uid, segment = np.unique(entry[post] * np.int64(1 << 32) + col["segment"][post], return_inverse=True)
        idf = np.log1p((segments - col["df"][post] + 0.5) / (col["df"][post] + 0.5))
        n = col["n"][post]
        impact = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * col["size"][post] / mean))
        impact /= np.bincount(segment, weights=impact)[segment]
        terms, term = np.unique(col["hash"][post].astype(np.uint64), return_inverse=True)
        order = np.lexsort((segment, term))
        segment, impact, term = segment[order], impact[order], term[order]
        key, start = np.unique(term * np.int64(len(uid) // BLOCK_SEGMENTS + 1) + segment // BLOCK_SEGMENTS, return_index=True)
        highest = np.zeros(len(terms))
        np.maximum.at(highest, term, impact)
        used = ~post
        shingles, which = np.unique(col["hash"][used].astype(np.uint64), return_inverse=True)
        use = entry[used] * 2 + col["kind"][used] - 1
        by = np.lexsort((use, which))
        fresh = np.ones(len(by), bool)
        fresh[1:] = (np.diff(which[by]) != 0) | (np.diff(use[by] // 2) != 0)
        return cls(items, terms, highest, _csr(term, len(terms)), segment, impact, _csr(term[start], len(terms)), key % (len(uid) // BLOCK_SEGMENTS + 1), np.maximum.reduceat(impact, start) if len(start) else impact,
                   uid >> 32, BLOCK_SEGMENTS, shingles, _csr(which[by], len(shingles)), use[by], np.bincount(use, minlength=2 * len(entries)), fresh, np.bincount(use[by][fresh] // 2, minlength=len(entries)))

    def retrieve(self, h: np.ndarray, text: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], float]:
        """Best score of every (text, entry) with a passage at or above the threshold."""
        if not len(self.terms) or not len(h):
            return {}
        place = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[place] == h)
        place, text, at = place[known], text[known], known - first[text[known]]
        # a half is SEGMENT words; passage p of a text is its halves p and p + 1
        halves = -(-np.diff(first) // SEGMENT)
        start = np.cumsum(halves) - halves
        half = start[text] + at // SEGMENT
        last = np.zeros(halves.sum(), bool)
        last[(start + halves - 1)[halves > 0]] = True
        pair = np.unique(half * np.int64(len(self.terms)) + place)
        half, term = pair // len(self.terms), pair % len(self.terms)
        bound = np.bincount(half, weights=self.highest[term], minlength=len(last))
        bound[:-1] += np.where(last[:-1], 0, bound[1:])
        alive = np.flatnonzero(bound >= THRESHOLD - 1e-9)
        if not len(alive):
            return {}
        of_half = _csr(half, len(last))
        one, places = _expand(of_half, np.concatenate([alive, alive[~last[alive]] + 1]))
        passage = np.concatenate([alive, alive[~last[alive]]])[one]
        pair = np.unique(passage * np.int64(len(self.terms)) + term[places])
        passage, term = pair // len(self.terms), pair % len(self.terms)
        one, places = _expand(self.block_first, term)
        block_count = len(self.entry_of) // self.per_block + 1
        key, which = np.unique(passage[one] * np.int64(block_count) + self.block[places], return_inverse=True)
        high = np.bincount(which, weights=self.block_high[places])
        key = key[high >= THRESHOLD - 1e-9]
        keep = np.isin(passage, key // block_count)
        passage, term = passage[keep], term[keep]
        one, places = _expand(self.first, term)
        mine = passage[one] * np.int64(block_count) + self.segment[places] // self.per_block
        left = np.isin(mine, key)
        segments = np.int64(len(self.entry_of))
        key, which = np.unique(passage[one][left] * segments + self.segment[places][left], return_inverse=True)
        score = np.bincount(which, weights=self.impact[places][left], minlength=len(key))
        out: dict[tuple[int, int], float] = {}
        for k in np.flatnonzero(score >= THRESHOLD - 1e-9):
            pair = int(np.searchsorted(start, key[k] // segments, "right")) - 1, int(self.entry_of[key[k] % segments])
            out[pair] = max(out.get(pair, 0.0), float(score[k]))
        return out

    def held(self, h: np.ndarray, text: np.ndarray, first: np.ndarray, least: float) -> set[tuple[int, int]]:
        """Every (text, entry) where the text has the share ``least`` of all the entry's shingles."""
        out: set[tuple[int, int]] = set()
        for size in range(1, SHINGLE + 1) if len(self.shingles) else ():
            runs = windows(h, size)
            place = np.minimum(np.searchsorted(self.shingles, runs), len(self.shingles) - 1)
            known = np.flatnonzero(self.shingles[place] == runs)
            known = known[known + size <= first[text[known] + 1]]
            pair = np.unique(text[known] * np.int64(len(self.shingles)) + place[known])
            one, places = _expand(self.use_first, pair % len(self.shingles))
            one, places = one[self.fresh[places]], places[self.fresh[places]]
            entries = np.int64(len(self.whole))
            key, n = np.unique(pair[one] // len(self.shingles) * entries + self.use[places] // 2, return_counts=True)
            enough = n >= least * self.whole[key % entries] - 1e-9  # an entry's shingles are of one size
            out.update(zip((key[enough] // entries).tolist(), (key[enough] % entries).tolist(), strict=True))
        return out

    def score(self, h: np.ndarray, entry: int) -> float:
        """Best score of an entry over the passages of one text."""
        best = 0.0
        for p in range(0, len(h), SEGMENT):
            seen = np.unique(h[p : p + 2 * SEGMENT])
            place = np.minimum(np.searchsorted(self.terms, seen), len(self.terms) - 1)
            _, places = _expand(self.first, place[self.terms[place] == seen])
            places = places[self.entry_of[self.segment[places]] == entry]
            if len(places):
                best = max(best, float(np.bincount(self.segment[places], weights=self.impact[places]).max()))
        return best

    def overlap(self, runs: np.ndarray) -> np.ndarray:
        """Share of each entry's question and answer shingles among ``runs``."""
        found = np.intersect1d(self.shingles, runs, assume_unique=False)
        _, places = _expand(self.use_first, np.searchsorted(self.shingles, found))
        return np.bincount(self.use[places], minlength=len(self.needed)) / np.maximum(self.needed, 1)


def _query(shared, least: float | None) -> Callable:
    def query(batches):
        index: Index = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, _, buf, offsets in blocks(batch):
                w = split(buf, offsets)
                h = w.hashes(lower=True)
                rows, shares = [], {}
                pairs = index.retrieve(h, w.text, w.first)
                held = set() if least is None else index.held(h, w.text, w.first, least)
                for t, e in held - pairs.keys():
                    pairs[t, e] = index.score(h[w.first[t] : w.first[t + 1]], e)
                for (t, e), score in sorted(pairs.items()):
                    if t not in shares:
                        mine = h[w.first[t] : w.first[t + 1]]
                        sizes = {SHINGLE} | set(range(1, min(SHINGLE, len(mine) + 1)))
                        shares[t] = index.overlap(np.concatenate([windows(mine, s) for s in sizes]))
                    question, answer = shares[t][2 * e], shares[t][2 * e + 1]
                    if (question >= QUESTION and answer >= ANSWER) or (t, e) in held:
                        rows.append((ids[lo + t].as_py(), int(index.items[e]), score, float(question), float(answer)))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64() if k < 2 else pa.float64()) for k in range(5)], ["doc_id", "item_id", "score", "question", "answer"])

    return query


RESULT = "doc_id long, item_id long, score double, question double, answer double"


def contaminated(docs: DataFrame, benchmark: DataFrame, whole: float | None = None) -> DataFrame:
    """Pairs of a document and a benchmark item it contains: ``doc_id``, ``item_id``, ``score`` (best passage), ``question`` and ``answer`` overlap.

    ``whole``: share of all shingles of an item that is enough by itself; None: question and answer decide alone.
    Null, empty or wordless texts and items match nothing; documents with a null id are checked, items with one are left out. Repeated documents give repeated rows; equal benchmark rows count
    once; different texts under one ``item_id`` are checked apart. Items under ten words are question and answer at once; under five
    words they are one shingle. Passages of one document are not cut off: texts of any length are read whole.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null and item_id is not null").distinct()
    items = items.withColumn("entry", F.xxhash64("item_id", "text"))
    rows = written(items.select("entry", "text").mapInArrow(_index_rows, "entry long, kind long, segment long, hash long, n long, size long").join(items.select("entry", "item_id"), "entry"), "item-index")
    terms = rows.where("kind = 0")
    total = terms.agg(F.countDistinct("entry", "segment").alias("segments"), F.sum("n").alias("words")).first()
    if not total.segments:
        return spark.createDataFrame([], RESULT)
    rows = rows.join(terms.groupBy("hash").agg(F.count("*").alias("df")), "hash", "left")
    shards, out = -(-total.words // SHARD_WORDS), None
    for k in range(shards):
        shard = rows.where(F.pmod(F.xxhash64("entry"), F.lit(shards)) == k).toArrow().combine_chunks()
        if shard.num_rows:
            shared = spark.sparkContext.broadcast(Index.of(shard, total.segments, total.words / total.segments))
            found = texts(docs).mapInArrow(_query(shared, whole), RESULT)
            out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; null ids stay."""
    return docs.join(contaminated(docs, benchmark, WHOLE).select(F.col("doc_id").alias("doc_id")).distinct(), "doc_id", "left_anti").select(docs.columns)
