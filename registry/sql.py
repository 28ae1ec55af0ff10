"""DuckDB text for scalar functions, written apart from the Spark expressions they check."""

from __future__ import annotations


def NORM(c: str) -> str:
    body = f"translate(lower(replace(replace(replace({c}, ' ', ''), '.', ''), '-', '')), 'абвгдежзијклмнопрстћуфхцчшčćžš', 'abvgdezzijklmnoprstcufhccscczs')"
    for a, b in (("љ", "lj"), ("њ", "nj"), ("џ", "dz"), ("ђ", "dj"), ("đ", "dj")):
        body = f"replace({body}, '{a}', '{b}')"
    return body


def NORM_LATIN(c: str) -> str:
    body = f"translate(lower(replace(replace(replace({c}, ' ', ''), '.', ''), '-', '')), 'абвгдежзијклмнопрстћуфхцчшђ', 'abvgdežzijklmnoprstćufhcčšđ')"
    for a, b in (("љ", "lj"), ("њ", "nj"), ("џ", "dž")):
        body = f"replace({body}, '{a}', '{b}')"
    return body


def CYR2LAT(c: str, small: bool = False) -> str:
    body = (f"translate({c}, 'абвгдежзијклмнопрстћуфхцчшђАБВГДЕЖЗИЈКЛМНОПРСТЋУФХЦЧШЂ', "
            "'abvgdežzijklmnoprstćufhcčšđABVGDEŽZIJKLMNOPRSTĆUFHCČŠĐ')")
    caps = (("Љ", "Lj"), ("Њ", "Nj"), ("Џ", "Dž")) if small else (("Љ", "LJ"), ("Њ", "NJ"), ("Џ", "DŽ"))
    for a, b in (("љ", "lj"), ("њ", "nj"), ("џ", "dž"), *caps):
        body = f"replace({body}, '{a}', '{b}')"
    return body


def INTNAME(c: str) -> str:
    body = (f"translate({c}, 'абвгдежзијклмнопрстћуфхцчшАБВГДЕЖЗИЈКЛМНОПРСТЋУФХЦЧШ', "
            "'abvgdezzijklmnoprstcufhccsABVGDEZZIJKLMNOPRSTCUFHCCS')")
    for a, b in (("љ", "lj"), ("њ", "nj"), ("џ", "dz"), ("ђ", "dj"), ("Љ", "Lj"), ("Њ", "Nj"), ("Џ", "Dz"), ("Ђ", "Dj")):
        body = f"replace({body}, '{a}', '{b}')"
    return body


def lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence by the row table, as nested list folds over one-element lists (a fold keeps one type)."""
    zeros = f"list_transform(range(0, length({b}) + 1), lambda t_z: cast(0 AS bigint))"
    over_b = f"list_prepend([cast(0 AS bigint)], list_transform(range(1, length({b}) + 1), lambda t_x: [t_x]))"
    over_a = f"list_prepend({zeros}, list_transform(range(1, length({a}) + 1), lambda t_x: [t_x]))"
    cell = (f"CASE WHEN substr({b}, cast(t_j[1] AS int), 1) = substr({a}, cast(t_i[1] AS int), 1) THEN t_prev[t_j[1]] + 1 "
            "ELSE greatest(t_out[-1], t_prev[t_j[1] + 1]) END")
    return f"list_extract(list_reduce({over_a}, lambda t_prev, t_i: list_reduce({over_b}, lambda t_out, t_j: list_append(t_out, {cell}))), -1)"


def number_similarity_sql(a: str, b: str) -> str:
    def digits(c):
        return f"coalesce(try_cast(nullif(regexp_replace({c}, '[^0-9]', '', 'g'), '') AS double), 0.0)"

    def letters(c):
        return f"regexp_replace({c}, '[0-9]', '', 'g')"
    return (f"CASE WHEN {b} IS NULL THEN 0.0 ELSE 0.9 * greatest(0.0, (5.0 - abs({digits(a)} - {digits(b)})) / 5.0) "
            f"+ 0.1 * CASE WHEN {letters(a)} = {letters(b)} THEN 1.0 ELSE 0.0 END END")


def _dst(body: str) -> str:
    """Point to segment distance, for the text DST(px, py, x1, y1, x2, y2)."""
    while "DST(" in body:
        i = body.index("DST(")
        j, depth = i + 4, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(body[j], 0)
            j += 1
        px, py, x1, y1, x2, y2 = [p.strip() for p in body[i + 4:j - 1].split(",")]
        t = (f"greatest(0.0, least(1.0, cast(({px}-{x1})*({x2}-{x1})+({py}-{y1})*({y2}-{y1}) AS double) / cast(({x2}-{x1})*({x2}-{x1})+({y2}-{y1})*({y2}-{y1}) AS double)))")
        sx, sy = f"({px}-({x1}+{t}*({x2}-{x1})))", f"({py}-({y1}+{t}*({y2}-{y1})))"
        body = body[:i] + f"sqrt({sx}*{sx}+{sy}*{sy})" + body[j:]
    return body
