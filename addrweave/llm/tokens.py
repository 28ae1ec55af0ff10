"""Token ids of whole texts by the tokenizers library, with each distinct segment encoded once.

A byte-level pre-tokenizer of GPT-2's kind splits texts by one pattern. Texts are cut where that pattern ends a piece in any case, as two or three neighbouring
bytes tell (``_PAIR``): before white space that follows a visible character or comes before one, after white space other than a space, and between letters,
digits and marks. Only ASCII and some Latin letters count as known; nothing is cut next to any other character, save at a space. A segment is
whole pieces, and the pattern looks ahead only past white space, by one character; no cut lies where that would change the piece before it. A batch's distinct segments are
found by Arrow and remembered, with their ids, in a bounded table of arrays; but for odd ones, no segment becomes a Python object. A text with a special token's
string is one segment, and so is any text where the tokenizer's file asks for something else than such a pre-tokenizer. The ids are those of
``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 12 << 20  #: bytes of segments and ids kept, in two tables of half that size: the newer and the one before
GROUP = 256
LONG = 256  #: bytes of a segment beyond which it is not remembered

_SPACE, _WHITE, _LETTER, _DIGIT, _MARK, _QUOTE, _LEAD = range(1, 8)  # 0: any other byte
_VISIBLE = (_LETTER, _DIGIT, _MARK, _QUOTE)
_BREAKS = ((_VISIBLE, (_SPACE, _WHITE)), ((_WHITE,), (*_VISIBLE, _LEAD)), ((_LETTER,), (_DIGIT, _MARK, _QUOTE)), ((_DIGIT,), (_LETTER, _MARK, _QUOTE)), ((_MARK,), (_LETTER, _DIGIT)))


def _kinds() -> bytes:
    out = np.zeros(256, np.uint8)
    out[33:127] = _MARK
    out[[*range(65, 91), *range(97, 123)]], out[48:58], out[39] = _LETTER, _DIGIT, _QUOTE
    out[32], out[9:14] = _SPACE, _WHITE
    out[0xC3:0xF5] = _LEAD  # first byte of a character that is no white space
    out[[0xE1, 0xE2, 0xE3]] = 0
    return out.tobytes()


def _pairs() -> bytes:
    """For kinds a and b of neighbours at 8 * a + b: 1, a cut between the two; 2, a cut before the first."""
    out = np.zeros((32, 8), np.uint8)
    for one, other in _BREAKS:
        out[np.ix_(one, other)] = 1
    out[np.ix_((_SPACE, _WHITE), (*_VISIBLE, _LEAD))] |= 2
    return out.tobytes()


_KIND, _PAIR = _kinds(), _pairs()


def cuts(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Where segments of the texts in ``data`` (UTF-8) begin, besides its first byte; ``starts``: where texts begin, in (0, len)."""
    kind, raw = np.frombuffer(bytearray(data.translate(_KIND)), np.uint8), np.frombuffer(data, np.uint8)
    latin = np.flatnonzero(raw[:-1] - np.uint8(0xC3) <= 2) + 1  # U+00C0 to U+017F: letters but for two signs
    kind[latin[(raw[latin - 1] != 0xC3) | (raw[latin] & 0xDF != 0x97)]] = _LETTER
    pair = kind[:-1] << 3 | kind[1:]
    pair[starts - 1] = 0
    pair = np.frombuffer(pair.tobytes().translate(_PAIR), np.uint8)
    cut = pair & 1
    cut[:-1] |= pair[1:] >> 1
    cut[starts - 1] = 1
    return np.flatnonzero(cut.view(bool)) + 1


def _offsets(strings: pa.Array) -> np.ndarray:
    return np.frombuffer(strings.buffers()[1], np.int32, len(strings) + 1, 4 * strings.offset) if len(strings) else np.zeros(1, np.int32)


class Table(Mapping):
    """Distinct segments and their ids, in arrays. Keys: a string, what follows a space; bytes, a segment that begins otherwise."""

    def __init__(self, segments: pa.Array, pool: np.ndarray, sizes: np.ndarray) -> None:
        self.segments, self.pool, self.sizes = segments, pool, sizes  # the ids of all segments one after another, and how many each has

    @classmethod
    def empty(cls) -> Table:
        return cls(pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def __len__(self) -> int:
        return len(self.segments)

    def __iter__(self) -> Iterator[str | bytes]:
        return (s[1:] if s[:1] == " " else s.encode() for s in self.segments.to_pylist())

    def __getitem__(self, key: str | bytes) -> bytes:
        row = pc.index(self.segments, f" {key}" if isinstance(key, str) else key.decode()).as_py()
        if row < 0:
            raise KeyError(key)
        return self.spread(np.array([row])).tobytes()

    def __add__(self, other: Table) -> Table:
        return Table(pa.concat_arrays([self.segments, other.segments]), np.concatenate([self.pool, other.pool]), np.concatenate([self.sizes, other.sizes]))

    @property
    def nbytes(self) -> int:
        return self.segments.nbytes + self.pool.nbytes + self.sizes.nbytes

    def spread(self, rows: np.ndarray) -> np.ndarray:
        """The ids of the rows one after another."""
        counts = self.sizes[rows]
        ends = np.cumsum(counts)
        place = np.arange(ends[-1] if len(ends) else 0)
        place += np.repeat((np.cumsum(self.sizes) - self.sizes)[rows] - ends + counts, counts)
        return self.pool[place]

    def take(self, rows: np.ndarray) -> Table:
        return Table(self.segments.take(pa.array(rows)), self.spread(rows), self.sizes[rows])

    def rows(self, segments: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Each segment's row, counted on in the second result for those not in the table: these, distinct."""
        if not len(segments):
            return np.zeros(0, np.int32), segments
        both = pa.chunked_array([self.segments, segments]).dictionary_encode()
        mine = both.chunk(both.num_chunks - 1)
        return mine.indices.to_numpy(), mine.dictionary.slice(len(self))


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        says = json.loads(self.library.to_str())
        before = says["pre_tokenizer"] or {}
        gpt2 = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
        self.cut = gpt2 and not any(says[k] for k in ("normalizer", "truncation", "padding")) and not any(c.isspace() for s in self.special for c in s)
        vocabulary = self.library.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each id: a letter a byte in this alphabet
        self.lengths[list(vocabulary.values())] = [len(piece) for piece in vocabulary]
        self.known, self.old = Table.empty(), Table.empty()

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _alone(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw = self.whole(chunks.to_pylist())
        return np.frombuffer(b"".join(raw), "<u4"), np.fromiter(map(len, raw), np.int64, len(raw)) // 4

    def _joined(self, chunks: pa.Array, lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that, but for a space before, neither begin nor end with white space, some at a time: the library's cost lies mostly in the call.

        A group's chunks, each after ``lead``, are one text, and its ids are cut where the lengths of the ids' bytes reach the chunks' ends. A space belongs to
        the chunk; a line feed is a piece of its own, and its id is left out. Where the ids' bytes do not fit a group's chunks, these are encoded one by one.
        """
        led = chunks if lead == " " else pc.binary_join_element_wise(lead, chunks, "")
        offsets = _offsets(led).astype(np.int64)
        first = np.append(np.arange(0, len(led), GROUP), len(led))
        data, at = memoryview(led.buffers()[2]), offsets[first].tolist()
        parts = [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast([str(data[i:j], "utf-8") for i, j in zip(at, at[1:])], add_special_tokens=False)]
        ids, ends = np.concatenate(parts), offsets[1:] - offsets[0]
        size = self.lengths[ids]
        reached = np.cumsum(size)
        stop = np.searchsorted(reached, ends) + 1
        begin = np.concatenate([[0], stop[:-1]])
        fits = np.array_equal(stop[first[1:] - 1], np.cumsum(list(map(len, parts)))) and np.array_equal(reached[stop - 1], ends)
        if not fits or lead == "\n" and (size[begin] != 1).any():
            if len(chunks) <= GROUP:
                return self._alone(chunks)
            pools, sizes = zip(*(self._joined(chunks.slice(k, GROUP), lead) for k in range(0, len(chunks), GROUP)), strict=True)
            return np.concatenate(pools), np.concatenate(sizes)
        return (ids, stop - begin) if lead == " " else (np.delete(ids, begin), stop - begin - 1)

    def _encoded(self, segments: pa.Array) -> Table:
        """The segments and their ids, from the library."""
        length, offsets = np.diff(_offsets(segments)), _offsets(segments)[:-1]
        lead = length > 0
        lead[lead] = np.frombuffer(segments.buffers()[2], np.uint8)[offsets[lead]] == 32
        inner = (length <= LONG) & (length > lead) & (pc.binary_length(pc.utf8_trim_whitespace(segments)).to_numpy() == length - lead) & self.cut
        order, parts = [], []
        for how, kind in ((" ", inner & lead), ("\n", inner & ~lead), ("", ~inner)):
            if kind.any():
                some = segments.filter(pa.array(kind))
                order.append(np.flatnonzero(kind))
                parts.append(self._joined(some, how) if how else self._alone(some))
        pool, sizes = map(np.concatenate, zip(*parts, strict=True))
        back = np.argsort(np.concatenate(order), kind="stable")
        return Table(segments, Table(segments, pool, sizes).spread(back), sizes[back])

    def _ids(self, segments: pa.Array) -> tuple[Table, np.ndarray]:
        """A table, and the row of each segment in it; a full table becomes the old one.

        Segments of the old table that come again are taken over; so frequent ones are never forgotten.
        """
        if self.known.nbytes > REMEMBERED // 2:
            self.old, self.known = self.known, Table.empty()
        index, new = self.known.rows(segments)
        if not len(new):
            return self.known, index
        row, unknown = self.old.rows(new)
        table = self.known + (self.old + self._encoded(unknown) if len(unknown) else self.old).take(row)
        self.known, short = table, np.diff(_offsets(table.segments)) <= LONG
        if not short.all():
            self.known = table.take(np.flatnonzero(short))
        return table, index

    def _learn(self, chunks: Iterable[str | bytes]) -> Table:
        """A table with the ids of all ``chunks``: strings, each after a space, and bytes as they are."""
        return self._ids(pa.array([f" {c}" if isinstance(c, str) else c.decode() for c in chunks], pa.string()))[0]

    def _segments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The texts' segments, and how many of them lie before each text and in all."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
        n = int(offsets[-1] - offsets[0])
        buffer = texts.buffers()[2].slice(int(offsets[0]), n) if n else pa.py_buffer(b"")
        bounds = (offsets - offsets[0]).astype(np.int64)
        starts = np.unique(bounds[(bounds > 0) & (bounds < n)])
        special = np.zeros(len(texts), bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if not n:
            ends = np.zeros(1, np.int64)
        elif not self.cut:
            ends = np.concatenate([[0], starts, [n]])
        else:
            inside = cuts(buffer.to_pybytes(), starts)
            if special.any():
                inside = inside[~special[np.searchsorted(bounds, inside, "right") - 1] | np.isin(inside, starts)]
            ends = np.concatenate([[0], inside, [n]])
        segments = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), buffer)
        return segments, np.searchsorted(ends, bounds)

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another (unsigned 32-bit), and their number in each text. No text is null."""
        segments, before = self._segments(texts)
        table, row = self._ids(segments)
        ends = np.concatenate([[0], np.cumsum(table.sizes[row])])
        return table.spread(row), np.diff(ends[before])

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not texts:
            return []
        ids, sizes = self.flat(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[i:j] for i, j in zip([0, *ends], ends)]


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One encoder a worker process, kept between tasks."""
    return Encoder(path)


def encoded(path: str, batch: pa.RecordBatch, end: int, size: int = 4 << 20) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``doc_id``, number of ids and the ids of rows with about ``size`` bytes of text (one row at least), ``end`` after each; null is empty."""
    texts = pc.fill_null(batch.column("text").cast(pa.string()), "")
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = int(total[lo - 1]) if lo else 0
        hi = min(batch.num_rows, int(np.searchsorted(total, before + size)) + 1)
        ids, sizes = encoder(path).flat(texts.slice(lo, hi - lo))
        yield batch.column("doc_id").slice(lo, hi - lo), sizes + 1, np.insert(ids, np.cumsum(sizes), end)
        lo = hi


def slices(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Row ranges with about ``size`` characters of text (one row at least) and their texts; null is empty."""
    rows, lo, total = batch.column("text"), 0, 0
    texts: list[str] = []
    for k, text in enumerate(rows):
        text = text.as_py() or ""
        texts.append(text)
        total += len(text)
        if total >= size or k + 1 == batch.num_rows:
            yield batch.slice(lo, k + 1 - lo), texts
            lo, total, texts = k + 1, 0, []


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
