"""Name, number and match scores.

The name score is ``2 * LCS / (len a + len b)``. Spark's own ``levenshtein`` counts a substitution as one edit, so it cannot give it, and
higher-order functions need some 50 microseconds per pair. An Arrow UDF works on the distinct name pairs of each batch instead: rows from
one cell share few street pairs, and equal names never reach it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from addrweave.functions.text import _col


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by the bit-vector recurrence, one step per letter of ``b``."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for letter in b:
        hit = row & places.get(letter, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


@lru_cache(maxsize=100_000)
def _ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 2.0 * lcs_length(a, b) / total if total else 1.0


@F.pandas_udf(DoubleType())
def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    ca, ua = pd.factorize(a)
    cb, ub = pd.factorize(b)
    pair = np.where((ca < 0) | (cb < 0), -1, ca.astype(np.int64) * max(len(ub), 1) + cb)
    distinct, back = np.unique(pair, return_inverse=True)
    values = [None if p < 0 else _ratio(ua[p // len(ub)], ub[p % len(ub)]) for p in distinct]
    return pd.Series(np.array(values, dtype=float)[back])


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    """``2*LCS/(len a + len b)``; 1 for two empty names, null where a name is null."""
    a, b = _col(a), _col(b)
    differ = a != b
    return F.when(a == b, F.lit(1.0)).when(differ, _ratios(F.when(differ, a), F.when(differ, b)))


def number_parts(c: Column | str, prefix: str) -> dict[str, Column]:
    """``{prefix}_digits`` as a number and ``{prefix}_letters`` of a house number: what F12 compares, so a join can make them once a row, not once a pair."""
    c = _col(c)
    digits = F.coalesce(F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit("")).try_cast("double"), F.lit(0.0))
    return {f"{prefix}_digits": digits, f"{prefix}_letters": F.regexp_replace(c, "[0-9]", "")}


def number_parts_similarity(register: dict[str, Column], on_map: dict[str, Column]) -> Column:
    """F12 from the digits and letters of both sides, in this order; the letters of no number are null."""
    (rd, rl), (md, ml) = register.values(), on_map.values()
    near = F.greatest(F.lit(0.0), (5.0 - F.abs(rd - md)) / 5.0)
    return F.when(ml.isNull(), F.lit(0.0)).otherwise(0.9 * near + F.lit(0.1) * F.when(rl == ml, 1.0).otherwise(0.0))


def house_number_similarity(register: Column | str, on_map: Column | str) -> Column:
    """0.9 for near numbers (0 from 5 apart on), 0.1 for equal letters; 0 where the map has no number."""
    return number_parts_similarity(number_parts(register, "r"), number_parts(on_map, "m"))


def match_score(name_score: Column, number_score: Column, distance: Column) -> Column:
    """equal thirds of name, number and squared closeness within 500 m."""
    near = (500.0 - F.greatest(F.lit(0.0), F.least(F.lit(500.0), distance))) / 500.0
    return (0.33 * F.coalesce(name_score, F.lit(0.0)) + 0.33 * number_score + 0.33 * F.coalesce(near * near, F.lit(0.0)))
