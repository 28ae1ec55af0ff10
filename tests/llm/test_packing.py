"""Packing: pieces against the tokenizers library, whole and gapless sequences, number of sequences near the bound."""

import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from addrweave.llm import packing
from addrweave.llm.packing import pack, packed
from addrweave.llm.tokens import Encoder, vocabulary


def check(rows, capacity):
    """Sequences are whole, gapless and within capacity; returns their number."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_encoder_equals_the_library():
    rng = random.Random(0)
    parts = ["a", " ", "  ", "\n", "é", "'s", "don't", "<|endoftext|>", "123", "!!", "\t", "\x1c", "\x85", "日本", "<|"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    library = Tokenizer.from_file(vocabulary())
    assert Encoder(vocabulary())(texts) == [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def test_pieces_of_documents(spark):
    library = Tokenizer.from_file(vocabulary())
    rows = [(1, None), (2, ""), (3, "some words here"), (3, "some words here"), (None, "x y"), (4, "long word " * 3000)]
    got = packed(spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, length int"), vocabulary()).collect()
    check(got, 2048)
    want = []
    for d, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        want += [(d or 0, k, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert packed(spark.createDataFrame([], "doc_id long, text string"), vocabulary()).collect() == []


def test_shards_and_rounds_stay_near_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 200)
    rng = random.Random(4)
    rows = [(d, 0, 0, rng.choice([1, 64, 64, rng.randint(1, 2048), rng.randint(1, 300)]), d) for d in range(1500)]
    got = pack(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(d, n) for d, _, _, n, _ in rows]
    assert check(got, 2048) <= -(-sum(r[3] for r in rows) // 2048) * 1.02 + 1


def test_crossover_keeps_every_piece_once():
    rng = random.Random(1)
    p = packing.Packer([rng.randint(1, 100) for _ in range(300)], 100, 0)
    a, b = p.first(0.0), p.first(0.5)
    child = p.cross(a, b)
    assert sorted(k for one in child for k in one) == list(range(300)) and all(p.load(one) <= 100 for one in child)
    assert len(p.evolve([])[0]) <= len(a)


def test_grouped_chunks_equal_single_ones():
    rng = random.Random(3)
    parts = ["a", "é", "\n", "'s", "don't", "123", "!!", " ", "日本", "ing", "\n\n", "x" * 70]
    chunks = list({"".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(3000)})
    e = Encoder(vocabulary())
    found = e._learn({*chunks, ""})
    assert all(found[c] == e.whole([f" {c}"])[0] for c in [*chunks, ""])


def test_segments_equal_the_library():
    rng = random.Random(6)
    parts = ["a", "Ab", "é", "ÿ", "×", "÷", "ŉ", "Ɓ", "ª", "я", "日", "٣", "9", "12", "'", "'s", "'LL", ",", "_", "(", "—", "\u0301", "\x00", "\x1c", "\x7f", "\x85", "\xa0", "\u2028", "\u3000", "\u200b"]
    parts += [" ", "  ", " ", "\n", "\n\n", "\r\n", "\t", "\v", "\f", "😀", "<|endoftext|>", "<|endoftext", "|>"]
    texts = ["", " ", *(a + b for a in parts for b in parts), *("".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(20_000)), "x" * 700, " " * 700]
    e = Encoder(vocabulary())
    got, library = e(texts), Tokenizer.from_file(vocabulary())
    for text, ids, want in zip(texts, got, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text


def test_a_word_is_encoded_once_whatever_surrounds_it():
    e = Encoder(vocabulary())
    e(["one lorem, lorem. lorem; lorem\nNext lorem's lorem! lorem"])
    assert {c for c in e.known if "lorem" in str(c)} == {"lorem"}


def test_other_tokenizers_get_whole_texts(tmp_path):
    library = Tokenizer.from_file(vocabulary())
    library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    library.save(path := str(tmp_path / "other.json"))
    texts = ["word", "two, words", "", "a\nb  c"]
    assert Encoder(path)(texts) == [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def test_islands_are_for_shards_that_miss_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 100)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    hard, evolve = [(d, 0, 0, 1025, d) for d in range(50)], packing._epoch
    runs = []
    monkeypatch.setattr(packing, "_epoch", lambda *a: runs.append(a) or evolve(*a))
    assert check(pack(spark.createDataFrame([(d, 0, 0, 512, d) for d in range(400)], schema)).collect(), 2048) <= 104 and not runs
    assert check(pack(spark.createDataFrame(hard, schema)).collect(), 2048) == 50 and len(runs) == packing.EPOCHS
