"""Token counts against all segmentations of short words, and against the tokenizers library's unigram model."""

import base64
import random

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer, models, pre_tokenizers

from addrweave.llm.token_counts import Unigram, token_counts
from addrweave.llm.tokens import vocabulary

RANKS = vocabulary("byte_bpe_50k.tiktoken")


def segmentations(word, pieces):
    if not word:
        yield 0.0, 0
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for s, n in segmentations(word[k:], pieces):
                yield pieces[word[:k]] + s, n + 1


def test_all_segmentations_of_short_words(tmp_path):
    rng = random.Random(3)
    pieces = [bytes([b]) for b in b"abc"] + [b"ab", b"bc", b"abc", b"ca", b"cab", b"bb"]
    (tmp_path / "ranks").write_bytes(b"".join(base64.b64encode(p) + f" {k}\n".encode() for k, p in enumerate(pieces)))
    model = Unigram(str(tmp_path / "ranks"), r"\S+")
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    found = model.learn(words)
    for w in words:
        best = max(segmentations(w.encode(), model.score), key=lambda x: (round(x[0], 9), -x[1]))
        assert found[w][1] == pytest.approx(best[0]) and found[w][0] == best[1]


@pytest.fixture(scope="module")
def library():
    """The same pieces and scores in the tokenizers library."""
    letters = {b: c for b, c in zip(range(256), _letters(), strict=True)}
    model = Unigram(RANKS, public_tokenizers.PATTERN)
    pieces = ["".join(letters[b] for b in p) for p in model.score]
    t = Tokenizer(models.Unigram([("<unk>", -1000.0), *zip(pieces, model.score.values(), strict=True)], unk_id=0))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    return t


def _letters():
    """The byte-level alphabet: printable bytes stand for themselves, others for letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def test_documents_equal_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in token_counts(docs, RANKS, public_tokenizers.PATTERN).collect()}
    score = Unigram(RANKS, public_tokenizers.PATTERN).score
    place = {c: b for b, c in enumerate(_letters())}
    for r in docs.collect():
        pieces = library.encode(r.text).tokens
        assert got[r.doc_id].n_pretokens == len(regex.findall(public_tokenizers.PATTERN, r.text))
        total = sum(score[bytes(place[c] for c in p)] for p in pieces)
        assert got[r.doc_id].log_probability == pytest.approx(total) and abs(got[r.doc_id].n_tokens - len(pieces)) <= 2  # ties


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "x" * 3000), (2, "a b")]
    df = spark.createDataFrame([(d, t, "n") for d, t in rows], "doc_id long, text string, n_tokens string")
    got = sorted((r.doc_id or 0, r.n_pretokens, r.n_tokens) for r in token_counts(df, RANKS, public_tokenizers.PATTERN).collect())
    assert got[:3] == [(0, 2, 2), (1, 0, 0), (1, 0, 0)] and got[3][:2] == (2, 1) and got[4] == (2, 2, 2)
    assert token_counts(df.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []
