"""Token files: exact round trips of the coding, files against the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from addrweave.llm.simple8b import Block, decode, encode
from addrweave.llm.token_files import read_tokens, write_tokens
from addrweave.llm.tokens import vocabulary

runs = st.lists(st.tuples(st.integers(0, 300), st.integers(0, 2**60 - 1)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(runs, st.integers(0, 60))
def test_round_trip(parts, bits):
    ids = np.array([v & ((1 << bits) - 1) for n, v in parts for _ in range(n)] + [v for _, v in parts], np.uint64)
    words, first = encode(ids)
    assert (decode(words, first, len(ids)) == ids).all()


def test_long_arrays_and_density():
    rng = np.random.default_rng(0)
    for high in (1, 2, 1000, 50257, 2**32):
        ids = rng.integers(0, high, 50_001).astype(np.uint64)
        words, first = encode(ids)
        assert (decode(words, first, len(ids)) == ids).all()
    assert len(encode(np.zeros(4096, np.uint64))[0]) == 18 and len(encode(np.full(4000, 1000, np.uint64))[0]) == 667


def test_escape_and_limits():
    ids = np.array([1, 2**59, 3, 2**45, 0], np.uint64)
    words, first = encode(ids)
    assert (words >> np.uint64(60) == 15).sum() >= 2 and (decode(words, first, 5) == ids).all()
    with pytest.raises(ValueError):
        encode(np.array([2**60], np.uint64))
    back = Block.loads(Block([5, None], np.array([2, 3]), ids).dumps())
    assert back.doc_ids == [5, None] and (back.ids == ids).all() and back.sizes.tolist() == [2, 3]


def test_files(spark):
    library = Tokenizer.from_file(vocabulary())
    rows = [(9, "b  c"), (3, None), (3, "again"), (7, ""), (None, "x y"), (1, "long word " * 70000), (8, "é\n")]
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, start int").repartition(3)
    got = read_tokens(write_tokens(df, vocabulary())).collect()
    want, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] or -1, r[1] or "")):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((d or -1, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.doc_id or -1, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert read_tokens(write_tokens(df.limit(0), vocabulary())).collect() == []


def test_chunks_survive_a_full_table(monkeypatch):
    from addrweave.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 400)
    e, plain = tokens.Encoder(tokens.vocabulary()), tokens.Encoder(tokens.vocabulary())
    texts = [f"often word{k} word{k // 2} often and{k}" for k in range(60)]
    for t in texts:
        assert e([t]) == plain.whole([t])
    assert len(e.known) + len(e.old) < 60 and "often" in e.known


def test_spans_of_all_lengths():
    import numpy as np

    from addrweave.llm import simple8b as S

    rng = np.random.default_rng(8)
    for n in (0, 1, 239, 240, 241, S.SPAN - 1, S.SPAN, S.SPAN + 1, 3 * S.SPAN + 77):
        for ids in (np.zeros(n, np.uint64), rng.integers(0, 2, n), rng.integers(0, 50_000, n), rng.integers(0, 2**59, n) >> rng.integers(0, 60, n)):
            words, first = S.encode(ids.astype(np.uint64))
            assert (S.decode(words, first, n) == ids).all() and len(first) == -(-n // S.SPAN)


def test_words_reach_the_library_once():
    from addrweave.llm import tokens

    e, asked = tokens.Encoder(vocabulary()), []
    library = e.library

    class Counting:
        def encode_batch_fast(self, texts, **how):
            asked.extend(map(len, texts))
            return library.encode_batch_fast(texts, **how)

    e.library = Counting()
    words = [f"{a}o{b}i" for a in "bcdfg" for b in "klmnp"]
    e([f"x {one}, {other}.\n{one}; {other}\n" for one in words for other in words])
    assert sum(asked) < 1000 and e([]) == []


def test_blocks_end_with_the_document_that_fills_them(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa

    from addrweave.llm import token_files

    monkeypatch.setattr(token_files, "BLOCK_IDS", 100)
    monkeypatch.setattr(token_files, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    texts = ["one two " * (k * 7 % 23) for k in range(60)] + [None, "word " * 500, ""]
    batch = pa.table({"doc_id": pa.array([*range(len(texts) - 1), None], pa.int64()), "text": pa.array(texts, pa.string())}).to_batches()[0]
    parts = [batch.slice(0, 17), batch.slice(17, 0), batch.slice(17)]
    rows = [r for b in token_files._write(vocabulary(), 2)(iter(parts)) for r in b.to_pylist()]
    blocks, start = [Block.loads(r["payload"]) for r in rows], 0
    for k, (row, block) in enumerate(zip(rows, blocks, strict=True)):
        assert (row["part"], row["block"], row["start"], row["n_ids"]) == (3, k, start, len(block.ids)) and len(block.ids) == block.sizes.sum()
        assert k == len(rows) - 1 or len(block.ids) >= 100 > len(block.ids) - block.sizes[-1]
        start += len(block.ids)
    library = Tokenizer.from_file(vocabulary())
    assert [d for b in blocks for d in b.doc_ids] == batch.column("doc_id").to_pylist()
    assert [i for b in blocks for i in b.ids.tolist()] == [i for t in texts for i in [*library.encode(t or "", add_special_tokens=False).ids, 2]]


def test_starts_of_words_equal_a_plain_walk():
    from addrweave.llm import simple8b as S

    rng = np.random.default_rng(3)
    for n in (1, S.SPAN, S.SPAN + 5, 3 * S.SPAN - 1):
        selector = rng.integers(0, 16, (-(-n // S.SPAN), S.SPAN)).astype(np.uint8)
        want = []
        for span, row in enumerate(selector):
            at, length = 0, min(S.SPAN, n - span * S.SPAN)
            while at < length:
                want.append(span * S.SPAN + at)
                at += int(S.COUNTS[row[at]])
        assert S._starts(selector, n).tolist() == want


def test_tables_take_the_memory_they_count(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from addrweave.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 1 << 20)
    e = tokens.Encoder(vocabulary())
    e(["some words first"])
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for k in range(40):
        e.flat(pa.array([" ".join(f"w{chr(97 + k % 26)}{n:x}q" for n in range(k * 3000, k * 3000 + 3000))]))
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(e.known) + len(e.old) > 3000 and held < 3 << 20


def test_no_python_call_a_segment():
    import cProfile
    import pstats

    import pyarrow as pa

    from addrweave.llm import tokens

    e = tokens.Encoder(vocabulary())
    words = [f"{a}{b}{c}{d}" for a in "bcdfgklm" for b in "aeiou" for c in "nprstvwz" for d in "aeioulmn"]
    texts = pa.array([" ".join(words), ".".join(words)])
    with cProfile.Profile() as profile:
        ids, sizes = e.flat(texts)
    library = Tokenizer.from_file(vocabulary())
    assert ids.tolist() == [i for t in texts.to_pylist() for i in library.encode(t, add_special_tokens=False).ids] and sizes.sum() == len(ids)
    assert pstats.Stats(profile).total_calls < len(words)


def test_small_tables_and_groups_equal_the_library(monkeypatch):
    import random

    from addrweave.llm import tokens

    rng = random.Random(4)
    parts = ["a", "é", "Ab", "日本", "x" * 9, "'s", "12", "--", " ", "  ", "\n", "　", "\xa0", "\x1c", "<|endoftext|>"]
    library = Tokenizer.from_file(vocabulary())
    for remembered, group, long in ((0, 1, 1), (300, 3, 8), (3000, 7, 300)):
        for name, value in (("REMEMBERED", remembered), ("GROUP", group), ("LONG", long)):
            monkeypatch.setattr(tokens, name, value)
        e = tokens.Encoder(vocabulary())
        for _ in range(60):
            texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 8))]
            assert [np.frombuffer(ids, "<u4").tolist() for ids in e(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_that_do_not_fit_are_encoded_alone(tmp_path, monkeypatch):
    from tokenizers import AddedToken, models, pre_tokenizers

    from addrweave.llm import tokens

    small = Tokenizer(models.BPE({"a": 0, "b": 1, "Ġ": 2, "Ċ": 3, "ab": 4, "Ġab": 5}, [("a", "b"), ("Ġ", "ab")]))  # other bytes have no id
    small.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    eager = Tokenizer.from_file(vocabulary())
    eager.add_special_tokens([AddedToken("<|eats|>", lstrip=True, rstrip=True)])
    texts = ["ab c ab", "c", "", "ab\nab c", " ab ba", "x <|eats|>  y\n<|eats|>", "word <|eats|> word", "word, word"]
    for k, library in enumerate((small, eager)):
        library.save(path := str(tmp_path / f"{k}.json"))
        for group in (1, 2, 256):
            monkeypatch.setattr(tokens, "GROUP", group)
            e = tokens.Encoder(path)
            assert e.cut
            assert [np.frombuffer(ids, "<u4").tolist() for ids in e(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
