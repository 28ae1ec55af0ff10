"""Roots and proofs against a plain reading of the rule, and the layout against its definition."""

import hashlib
import zlib

from addrweave.llm import manifest as M


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def up(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(levels, i):
    out = []
    for level in levels[:-1]:
        lo = i // 16 * 16
        out.append(("".join(level[lo:i]), "".join(level[i + 1 : lo + 16])))
        i //= 16
    return out


def brute(rows):
    out, groups = [], {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = up([leaf(r) for r in groups[s]])
    top = up([trees[s][-1][0] for s in names])
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps = path(trees[s], i) + path(top, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if r[4] is not None else None
            h = leaf((*r[:4], lowered)) if bad else leaf(r)
            for a, b in steps:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), trees[s][-1][0], sha("".join(a + b for a, b in steps)), h, top[-1][0], h == top[-1][0]))
    return sorted(map(str, out))


def test_layout():
    for leaves, height in [(1, 0), (1, 3), (2, 1), (16, 1), (17, 2), (256, 2), (300, 3), (4096, 3), (4095, 3), (20, 4)]:
        places = M.addresses(leaves, height)
        assert [len(p) for p in places] == M.widths(leaves, height)
        assert sorted(a for p in places for a in p.tolist()) == list(range(sum(map(len, places))))
    places = M.addresses(300, 3)  # half of four levels: the root and its children first, then each lower tree in one piece
    assert places[3].tolist() == [0] and places[2].tolist() == [1, 2]
    assert places[1].tolist()[:2] == [3, 20] and places[0].tolist()[:17] == [*range(4, 20), 21]


def test_block_round_trip():
    for n in (1, 2, 15, 16, 17, 255, 257, 700):
        leaves = [sha(str(i)) for i in range(n)]
        levels = up(leaves)
        height = M.levels_of(n)
        nodes = M.build(leaves, height)
        assert M.root_of(nodes, n, height) == levels[-1][0]
        assert M.siblings(nodes, n, height) == [path(levels, i) for i in range(n)]
        assert all(M.fold(leaves[i], p) == levels[-1][0] for i, p in enumerate(M.siblings(nodes, n, height)))


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, leaf string"


def test_equals_brute_force(spark):
    rows = [(i * 7 % 1009, "big", "sr" if i % 3 else None, i, f"Text Č {i} A" * (i % 4)) for i in range(700)]
    rows += [(2000 + i, f"s{i}", "en", None, "ABC") for i in range(40)] + [(1, None, None, None, None), (None, None, "x", 1, ""), (None, "big", "x", 1, "Q"), (3, "é", "x", 1, "z" * 300_000)]
    rows += [rows[5]] * 3 + [(rows[5][0], "big", "other", 1, "A")]
    df = spark.createDataFrame([(*r, "k", "k") for r in rows], SCHEMA).repartition(6)
    got = sorted(str((r.doc_id, r.leaf, r.subroot, r.proof_sha256, r.folded_root, r.root, r.verified)) for r in M.proved(df, height=1).collect())  # several levels of blocks, also over the sources
    assert got == brute(rows)


def test_one_row_and_none(spark):
    rows = [(5, "a", "b", 1, "Aa")]
    r = M.proved(spark.createDataFrame([(*rows[0], "k", "k")], SCHEMA)).collect()[0]
    assert [str((r.doc_id, r.leaf, r.subroot, r.proof_sha256, r.folded_root, r.root, r.verified))] == brute(rows)
    assert M.proved(spark.createDataFrame([], SCHEMA)).collect() == []
