"""Repeated byte strings against a plain reading of the rule."""

import hashlib
import random
from collections import Counter

from addrweave.llm.suffixes import ANCHOR, COVER, LENGTH, LONG, PERIOD, without_repeated_bytes


def brute(rows):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + LENGTH] for _, b in raw for i in range(len(b) - LENGTH + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - LENGTH + 1):
            if seen[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        spans, i = [], 0
        while (i := gone.find(1, i)) >= 0:
            j = gone.find(0, i)
            j = len(b) if j < 0 else j
            spans.append((i, j))
            i = j
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept))
    return sorted(map(str, out))


def test_cover():
    assert all(any((i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER for d in range(PERIOD)) for i in range(PERIOD) for j in range(PERIOD))
    assert PERIOD - 1 + ANCHOR == LENGTH and LONG == LENGTH + PERIOD - 1


SCHEMA = "doc_id long, text string, kept string, home int"


def result(df):
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, [(s.start, s.end) for s in r.spans], bytes(r.kept))) for r in without_repeated_bytes(df).collect())


def test_equals_brute_force(spark):
    rng = random.Random(6)
    fresh = lambda n: "".join(rng.choice("abcdefgh éЖ") for _ in range(n))
    passages = [fresh(n) for n in (150, 199, 200, 201, 230, 300, 420, 900, 3000)]
    rows = []
    for d in range(90):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)  # parts of passages: edges of one repeat lie inside another
            parts.append(rng.choice([p, p[a:], p[: len(p) - a], p[a:-1], fresh(rng.randint(1, 400))]))
        rows.append((d, "".join(parts)))
    near = fresh(2500)
    for d in range(100, 130):
        i = rng.randint(0, 2400)
        rows.append((d, near[:i] + rng.choice(["", "x", "yy"]) + near[i + 1 :]))
    rows += [(200, "ab" * 700), (201, "z" * 205), (202, None), (203, ""), (204, fresh(LENGTH)), (None, passages[6]), (3, rows[3][1]), (205, "q" * LENGTH)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    assert result(df.repartition(6)) == brute(rows)
    assert result(df.coalesce(1)) == brute(rows)


def test_empty(spark):
    assert without_repeated_bytes(spark.createDataFrame([], SCHEMA)).collect() == []
    assert result(spark.createDataFrame([(1, None, "k", 1), (2, "", "k", 1)], SCHEMA)) == brute([(1, None), (2, "")])
