"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

Each class (toxic, ordinary) has a model of order ``ORDER``: interpolated with an absolute discount, it backs off to lower orders whose
continuation counts are shared by both classes, so that expressions rare in either class are smoothed alike. A document's score comes from
the length-normalised difference of its two log-likelihoods. Where neither class has seen a whole n-gram, the shared part cancels and the difference
is that of the two backoff weights; so scoring needs two look-ups a byte of each distinct word.

The n-gram counts of a sample (about ``SAMPLE_ROWS`` labelled rows per class and use, by a hash of ``doc_id``; all where there are fewer)
are summed by Spark and the model, no larger than the sample, is broadcast. The sample's ids, bounded alike, are broadcast to pick its texts. Labelled rows of crc32 remainder 0 and 3 give the counts, those
of remainder 1 the calibration, those of remainder 2 nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.store import texts
from addrweave.llm.words import LOWER, blocks, split

ORDER = 5
DISCOUNT = 0.75
SAMPLE_ROWS = 10_000
CUT = 0.3
STEADY, POWER = 30, 0.7  #: a difference is divided by (words + STEADY) ** POWER: short texts weigh less, long ones with few such words more
_GAP = b" " * (ORDER - 1)
_LOWER = LOWER.astype(np.uint8)


def _grams(words: list[bytes], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-gram ending at every byte of every word and at its end, and the index of the word."""
    raw = np.frombuffer(_GAP + (b" " + _GAP).join(words) + b" ", np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    code = np.zeros(len(raw) - ORDER + 1, np.uint64)
    for k in range(ORDER):
        code = code << np.uint64(8) | raw[k : len(raw) - ORDER + 1 + k]
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(word)) + word * (ORDER - 1)
    return code[place], word


def _distinct(buf: np.ndarray, offsets: np.ndarray):
    """Words of some texts, lower-cased: distinct ones, their number for each word, and the split."""
    w = split(_LOWER[buf], offsets)
    _, one, at = np.unique(w.hashes(), return_index=True, return_inverse=True)
    raw = w.buf.tobytes()
    return [raw[a:b] for a, b in zip(w.starts[one].tolist(), w.ends[one].tolist(), strict=True)], at, w


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = np.asarray(batch.column("toxic"))
        for lo, hi, buf, offsets in blocks(batch):
            words, at, w = _distinct(buf, offsets)
            if not words:
                continue
            code, word = _grams(words)
            for c in (0, 1):
                times = np.bincount(at[toxic[lo:hi][w.text] == c], minlength=len(words))[word]
                gram, place = np.unique(code[times > 0], return_inverse=True)
                n = np.bincount(place, weights=times[times > 0]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), c, np.int32)), pa.array(gram.astype(np.int64)), pa.array(n, pa.int64())], ["toxic", "gram", "n"])


@dataclass
class Model:
    """Log-likelihood difference (toxic less ordinary) of seen n-grams and of the backoff from seen contexts; calibration."""

    grams: np.ndarray
    gram_value: np.ndarray
    contexts: np.ndarray
    context_value: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def words(self, words: list[bytes]) -> np.ndarray:
        code, word = _grams(words)
        value = np.zeros(len(code))
        for keys, values, wanted in ((self.contexts, self.context_value, code >> np.uint64(8)), (self.grams, self.gram_value, code)):
            if len(keys):
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                found = keys[place] == wanted
                value[found] = values[place[found]]
        return np.bincount(word, weights=value, minlength=len(words))

    def differences(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Length-normalised log-likelihood difference of each text's distinct words (a word said often counts once); 0 without words."""
        words, at, w = _distinct(buf, offsets)
        if not words:
            return np.zeros(len(offsets) - 1)
        pair = np.unique(w.text * np.int64(len(words)) + at)
        text = pair // len(words)
        total = np.bincount(text, weights=self.words(words)[pair % len(words)], minlength=len(offsets) - 1)
        return total / (np.bincount(text, minlength=len(offsets) - 1) + STEADY) ** POWER

    def score(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.shift, -60, 60)))


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, at = np.unique(keys, return_inverse=True)
    return out, np.bincount(at, weights=weights, minlength=len(out))


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], default)


def fit(gram: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray) -> Model:
    """The model of the counts of each distinct (sorted) n-gram in the two classes."""
    if not toxic.any() or not ordinary.any():
        return Model(*[np.empty(0, t) for t in (np.uint64, float, np.uint64, float)])
    low8 = np.uint64(8)

    def tail(n: int) -> np.ndarray:  # the last n bytes
        return gram & np.uint64((1 << 8 * n) - 1)

    shared = np.full(len(gram), 1 / 256)
    for n in range(1, ORDER):  # continuation: in how many longer n-grams of either class this one ends
        kind, kinds = np.unique(tail(n + 1)), None
        end = kind & np.uint64((1 << 8 * n) - 1)
        kinds, times = _sums(end, np.ones(len(end)))
        context, total = _sums(kinds >> low8, times)
        _, types = _sums(kinds >> low8, np.ones(len(kinds)))
        mine, c = tail(n), tail(n) >> low8
        all_, types = _at(context, total, c, 1), _at(context, types, c, 0)
        shared = (_at(kinds, times, mine, 0) - DISCOUNT).clip(0) / all_ + DISCOUNT * types / all_ * shared
    contexts, logs, backoff = np.unique(gram >> low8), [], []
    for n in (toxic, ordinary):
        context, total = _sums(gram >> low8, n)
        _, types = _sums(gram >> low8, (n > 0).astype(float))
        weight = np.where(total > 0, DISCOUNT * types / np.maximum(total, 1), 1.0)
        place = np.searchsorted(context, gram >> low8)
        logs.append(np.log((n - DISCOUNT).clip(0) / np.maximum(total[place], 1) + weight[place] * shared))
        backoff.append(np.log(weight))
    return Model(gram, logs[0] - logs[1], contexts, backoff[0] - backoff[1])


def calibrate(model: Model, difference: np.ndarray, label: np.ndarray) -> Model:
    """Sets slope and shift: a logistic curve through the cut that has the best F1 on labelled rows, where the score is ``CUT``."""
    if not len(label) or label.all() or not label.any():
        return model
    order = np.argsort(-difference, kind="stable")
    d, hits = difference[order], np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(d) + 1) + label.sum())
    f1[:-1][d[:-1] == d[1:]] = 0
    best = int(f1.argmax())
    cut = (d[best] + d[best + 1]) / 2 if best + 1 < len(d) else d[best] - 1e-6
    spread = max(float(np.median(difference[label == 1]) - np.median(difference[label == 0])), 1e-6)
    model.slope = 6 / spread
    model.shift = np.log(CUT / (1 - CUT)) - model.slope * cut
    return model


def _crc(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("fold", F.pmod(_crc("doc_id"), F.lit(4))).where("fold != 2")
    marked = marked.withColumn("calibration", F.col("fold") == 1)
    share = F.lit(1.0)
    for r in marked.groupBy("toxic", "calibration").count().collect():
        share = F.when((F.col("toxic") == r.toxic) & (F.col("calibration") == r.calibration), F.lit(min(1.0, SAMPLE_ROWS / r["count"]))).otherwise(share)
    rows = texts(docs).join(F.broadcast(marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)).select("doc_id", "toxic", "calibration")), "doc_id")
    counted = rows.where("not calibration").select("text", "toxic").mapInArrow(_count, "toxic int, gram long, n long").groupBy("gram").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("ordinary"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))
    table = counted.toArrow()
    gram = np.asarray(table.column("gram").combine_chunks() if table.num_rows else [], np.int64).astype(np.uint64)
    order = np.argsort(gram)
    model = fit(gram[order], *(np.asarray(table.column(c).combine_chunks() if table.num_rows else [], float)[order] for c in ("ordinary", "toxic")))

    def measure(batches):
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch):
                yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(lo, hi - lo), pa.array(model.differences(buf, offsets))], ["toxic", "difference"])

    held = rows.where("calibration").select("text", "toxic").mapInArrow(measure, "toxic int, difference double").toPandas()
    return calibrate(model, held.difference.to_numpy(), held.toxic.to_numpy())


def _scorer(shared) -> Callable:
    def score(batches):
        model = shared.value
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch):
                s = model.score(model.differences(buf, offsets))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(s)], ["doc_id", "score"])

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores every text: ``doc_id``, ``held_out`` (crc32 of the id leaves 2 when divided by 4), ``score`` in [0, 1], ``predicted`` (1 from 0.3 on).

    One row per input row. Null or wordless text has a difference of 0 and the score that belongs to it. Null ids are scored
    (``held_out`` null). Of repeated labels the larger counts; labels other than 0 and 1, and those of unknown rows, count for nothing.
    Without labels of both classes nothing is learned: the score is 0.5 throughout. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    out = texts(docs).mapInArrow(_scorer(shared), "doc_id long, score double")
    return out.select("doc_id", (F.pmod(_crc("doc_id"), F.lit(4)) == 2).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic, in one pass over them once the model is fitted; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def keep(batches):
        model = shared.value
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch):
                yield batch.slice(lo, hi - lo).filter(pa.array(model.score(model.differences(buf, offsets)) < CUT))

    return docs.mapInArrow(keep, docs.schema)
