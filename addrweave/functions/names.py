"""Name-quality rules on street entities."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import similarity as S
from addrweave.functions import text as T

# Ordinal words of each number with its Roman numeral, in rule order (longer numbers first).
ORDINALS = """
21 XXI: двадесет прва, двадесет прве, двадесет први, двадесет првог
22 XXII: двадесет друга, двадесет друге, двадесет други, двадесет другог
23 XXIII: двадесет трећа, двадесет треће, двадесет трећи, двадесет трећег
24 XXIV: двадесет четврта, двадесет четврте, двадесет четврти, двадесет четвртог
25 XXV: двадесет пета, двадесет пете, двадесет пети, двадесет петог
26 XXVI: двадесет шеста, двадесет шесте, двадесет шести, двадесет шестог
27 XXVII: двадесет седма, двадесет седме, двадесет седми, двадесет седмог
28 XXVIII: двадесет осма, двадесет осме, двадесет осми, двадесет осмог
29 XXIX: двадесет девета
11 XI: једанаести, једанаеста, једанаесте, једанаесто
12 XII: дванаести, дванаеста, дванаесте, дванаесто
13 XIII: тринаести, тринаеста, тринаесте, тринаесто
15 XV: петнаести, петнаеста, петнаесте, петнаесто
16 XVI: шеснаести, шеснаеста, шеснаесте, шеснаесто
17 XVII: седамнаести, седамнаеста, седамнаесте, седамнаесто
18 XVIII: осамнаести, осамнаеста, осамнаесте, осамнаесто
19 XIX: деветнаести, деветнаеста, деветнаесте, деветнаесто
1 I: први, прва, прве, прво
2 II: други, друга, друге, друго
3 III: трећи, трећа, треће
4 IV: четврти, четврта, четврте, четврто
5 V: пети, пета, пете, пето
6 VI: шести, шеста, шесте, шесто
7 VII: седми, седма, седме, седмо
8 VIII: осми, осма, осме, осмо
9 IX: девети, девета, девете, девето
10 X: десети, десета, десете, десето
"""
# Genitives of ordinals in rulers' titles.
TITLES = """
1 I: првог, првога
2 II: другог, другога
3 III: трећег, трећега
4 IV: четвртог, четвртога
5 V: петог, петога
6 VI: шестог, шестога
7 VII: седмог, седмога
8 VIII: осмог, осмога
9 IX: деветог, деветога
10 X: десетог, десетога
"""
# Cardinal words, and tens that make a following unit part of a larger number.
CARDINALS = ["један", "два", "три", "четири", "пет", "шест", "седам", "осам", "девет", "десет"]
TENS = ["двадесет", "тридесет", "четрдесет", "педесет", "шестдесет", "седамдесет", "осамдесет", "деведесет"]
DOCTOR, DOCTOR_SHORT, PRINCESS, PRINCESS_FIXED = "доктора", "др", "књегиње", "Кнегиње"


def _rules(table: str) -> list[tuple[str, int, str]]:
    """(word, number, Roman numeral) of a table's lines, in their order."""
    out = []
    for number, roman, words in re.findall(r"(\d+) (\w+): (.+)", table):
        out += [(word, int(number), roman) for word in words.split(", ")]
    return out


def _ordinals() -> list[tuple[str, int, str]]:
    return _rules(ORDINALS)


def _titles() -> list[tuple[str, int, str]]:
    return _rules(TITLES)


def _latin(word: str) -> str:
    one = dict(zip(T.CYR_LOWER + T.CYR_UPPER, T.LAT_LOWER + T.LAT_UPPER)) | T.DIGRAPHS_LOWER | T.DIGRAPHS_TITLE
    return "".join(one.get(c, c) for c in word)


def _given(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def _reference(proper: Column, name: Column) -> Column:
    return F.coalesce(F.nullif(proper, F.lit("")), F.nullif(name, F.lit("")))


def _no_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def wrong_name(proper: Column, name: Column) -> Column:
    """N1"""
    return _no_null(_given(proper) & _given(name) & (proper != name))


def missing_name(proper: Column, name: Column) -> Column:
    """N2"""
    return _given(proper) & _blank(name)


def wrong_name_sr(proper: Column, name: Column, name_sr: Column) -> Column:
    """N3"""
    return _no_null(_given(name_sr) & (_reference(proper, name) != name_sr))


def missing_name_sr(name: Column, name_sr: Column) -> Column:
    """An empty name still asks for ``name:sr``."""
    return name.isNotNull() & _blank(name_sr)


def wrong_name_sr_latn(proper: Column, name: Column, latn: Column) -> Column:
    """N5"""
    return _no_null(_given(latn) & (T.cyr2lat_small(_reference(proper, name)) != latn))


def missing_name_sr_latn(name: Column, latn: Column) -> Column:
    """N6"""
    return _given(name) & _blank(latn)


def _english_ratios(name: Column, name_en: Column) -> tuple[Column, Column]:
    ok = _given(name) & _given(name_en)
    return (S.indel_ratio(F.when(ok, T.cyr2lat_small(name)), name_en), S.indel_ratio(F.when(ok, T.cyr2intname(name)), name_en))


def suspicious_name_en(name: Column, name_en: Column) -> Column:
    """Far from both Latin forms of the name."""
    return _no_null(F.least(*_english_ratios(name, name_en)) < 0.7)


def unneeded_name_en(name: Column, name_en: Column) -> Column:
    """Nearly a Latin form of the name."""
    return _no_null(F.greatest(*_english_ratios(name, name_en)) > 0.9)


def wrong_int_name(proper: Column, name: Column, int_name: Column) -> Column:
    """N9"""
    return _no_null(_given(int_name) & (T.cyr2intname(_reference(proper, name)) != int_name))


def missing_int_name(proper: Column, name: Column, int_name: Column) -> Column:
    """Absent although the name has letters that differ internationally."""
    return _blank(int_name) & _no_null(_reference(proper, name).rlike("[шчћжђШЧЋЖЂ]"))


def _rule_map(rules: list[tuple[str, int, str]], write: str, base: int) -> dict[str, tuple[int, str, str]]:
    return {w: (base + i, f"{n}." if write == "ordinal" else roman if write == "roman" else str(n), roman) for i, (w, n, roman) in enumerate(rules)}


def check_alt_names(df: DataFrame, proper: Column, name: Column, alt: Column, latin: bool = False, prefix: str = "") -> DataFrame:
    """Adds ``{prefix}missing, wrong, suggestion, partial``.

    The name is cut into words; words and word pairs are looked up in the rule map (ordinals, then king-style genitives, then cardinals), so
    work is per word and not per rule. The rule that comes first wins, inside before start before end of the name. Names with digits are
    offered in written form (marked ``~~``, partial), then the doctor and princess spellings.

    Each step is computed once a row: a filter on the results would else be pushed down to ``df`` with every step written out in it, as often as a
    later one uses it. So the results leave through a generator of one row, which no filter passes.
    """
    tr = _latin if latin else (lambda w: w)
    kinds = [("ordinal", _ordinals(), 0), ("roman", _titles(), 1000), ("cardinal", [(w, i + 1, "") for i, w in enumerate(CARDINALS)], 2000)]
    rules = [(tr(w), *v) for kind, words, base in kinds for w, v in _rule_map(words, kind, base).items()]
    entries = (f"'{w}', array({', '.join(f"named_struct('order', {o}, 'out', '{out}', 'roman', '{rom}', 'words', {len(w.split())})" for n, o, out, rom in rules if n == w)})"
               for w in dict.fromkeys(r[0] for r in rules))
    table = F.expr(f"map({', '.join(entries)})")
    p = {k: f"_n_{k}" for k in ("ref", "low", "words", "alt", "month", "cands", "best", "num", "dot", "wrote")}
    c = {k: F.col(v) for k, v in p.items()}
    d = df.withColumns({p["ref"]: _reference(proper, name), p["alt"]: F.nullif(alt, F.lit(""))})
    d = d.withColumns({p["low"]: F.lower(c["ref"]), p["words"]: F.split(c["ref"], " ", -1)})
    size = F.size(c["words"])
    lows = F.split(c["low"], " ", -1)

    def found(i: Column, key: Column) -> Column:
        return F.transform(F.coalesce(F.try_element_at(table, key), F.expr("array()").cast("array<struct<order:int,out:string,roman:string,words:int>>")),
                           lambda r: F.struct(r["order"].alias("order"), F.when(i == 0, 1).when(i + r["words"] == size, 2).otherwise(0).alias("place"),
                                              i.alias("at"), r["words"].alias("words"), r["out"].alias("out"), r["roman"].alias("roman")))

    ones = F.flatten(F.transform(lows, lambda w, i: found(i, w)))
    twos = F.flatten(F.transform(F.slice(F.arrays_zip(lows.alias("a"), F.slice(lows, F.lit(2), F.greatest(size, F.lit(1))).alias("b")), F.lit(1), F.greatest(size - 1, F.lit(0))),
                                 lambda z, i: found(i, F.concat(z[F.lit("a")], F.lit(" "), z[F.lit("b")]))))
    d = d.withColumn(p["cands"], F.when(c["ref"].isNotNull() & (size > 1), F.filter(F.concat(ones, twos), lambda r: r["words"] < size)))
    d = d.withColumn(p["month"], T.has_month(c["low"]))
    tens = "|".join(tr(w) for w in TENS)
    missing = c["alt"].isNull()

    def proposal(r: Column) -> Column:
        return F.array_join(F.concat(F.slice(c["words"], F.lit(1), r["at"]), F.array(r["out"]),
                                     F.slice(c["words"], r["at"] + r["words"] + 1, F.greatest(size, F.lit(1)))), " ")

    def seen(r: Column) -> Column:  # ordinals drop out where the alternative holds the numeral; kings' numerals are not dates
        skip = (r["order"] < 1000) & _no_null(c["alt"].contains(F.lower(r["roman"])))
        return ~skip & ~((r["order"] >= 1000) & (r["order"] < 2000) & c["month"])

    def usable(r: Column) -> Column:
        before = F.lower(F.array_join(F.slice(c["words"], F.lit(1), r["at"]), " "))
        part_of_tens = ((r["order"] < 1000) | (r["order"] >= 2000)) & (r["place"] != 1) & before.rlike(tens)
        return ~part_of_tens & (missing | (c["alt"] != proposal(r)))

    d = d.withColumn(p["cands"], F.filter(c["cands"], seen))
    d = d.withColumns({p["best"]: F.try_element_at(F.array_sort(F.filter(c["cands"], usable)), F.lit(1)),
                       p["wrote"]: F.coalesce(F.size(c["cands"]) > 0, F.lit(False)),
                       p["num"]: T.first_number(c["low"])[0], p["dot"]: T.first_number(c["low"])[1]})

    written, romans = {}, {}
    for w, n, roman in _ordinals():
        written.setdefault(f"{n}.", []).append(tr(w))
    for w, n, roman in _titles():
        romans[n] = roman
        if n < 10:
            written.setdefault(f"{n}.", []).append(tr(w))
    for i, w in enumerate(CARDINALS):
        written[str(i + 1)] = [tr(w)]
    forms = F.expr("map(" + ", ".join(f"'{k}', array({', '.join(map(repr, ws))})" for k, ws in written.items()) + ")")
    roman_of = F.expr("map(" + ", ".join(f"{n}L, '{r}'" for n, r in romans.items()) + ")")
    shown = F.concat(c["num"].cast("string"), F.when(c["dot"], ".").otherwise(""))
    options = F.try_element_at(forms, shown)
    has_roman = _no_null(c["alt"].contains(F.try_element_at(roman_of, c["num"])))
    said = _no_null(F.exists(options, lambda w: F.lower(c["alt"]).contains(w)))
    ask_written = _no_null(~c["wrote"] & c["num"].isNotNull() & ~has_roman & options.isNotNull() & ~said)
    at = F.instr(c["low"], shown)
    partial = F.concat(F.substring(c["ref"], F.lit(1), at - 1), F.lit("~~"), options[0], F.lit("~~"),
                       F.substring(c["ref"], at + F.length(shown), F.length(c["ref"])))

    doctor, short, lady, lady_ok = (tr(w) for w in (DOCTOR, DOCTOR_SHORT, PRINCESS, PRINCESS_FIXED))
    tail = F.substring(c["ref"], F.lit(len(doctor) + 2), F.length(c["ref"]))
    spellings = [
        (c["low"].contains(f" {doctor} "), F.regexp_replace(c["ref"], f"(?iu)^(.*?) {doctor} ", f"$1 {short} ")),
        (c["low"].startswith(doctor + " "), F.concat(F.lit(short.capitalize() + " "), tail)),
        (c["low"].endswith(" " + doctor), F.concat(F.substring(c["ref"], F.lit(1), F.length(c["ref"]) - len(doctor)), F.lit(short))),
        (c["low"].startswith(lady + " "), F.concat(F.lit(lady_ok + " "), F.substring(c["ref"], F.lit(len(lady) + 2), F.length(c["ref"])))),
    ]
    spelled = F.coalesce(*[F.when(hit & c["num"].isNull() & (missing | (c["alt"] != fix)), fix) for hit, fix in spellings])
    suggestion = F.when(c["best"].isNotNull(), proposal(c["best"])).when(ask_written, partial).otherwise(spelled)
    out = d.withColumn("_n_out", suggestion)
    hit = F.col("_n_out").isNotNull()
    checks = {"missing": hit & missing, "wrong": hit & ~missing, "suggestion": F.coalesce("_n_out", F.lit("")), "partial": hit & c["best"].isNull() & ask_written}
    return out.select(*df.columns, F.inline(F.array(F.struct(*[v.alias(f"{prefix}{k}") for k, v in checks.items()]))))
