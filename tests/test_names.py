import pytest
from pyspark.sql import functions as F

from addrweave.functions import names as N

SAME = (False, False, "", False)
CASES = [  # proper, alternative, latin, expected (missing, wrong, suggestion, partial)
    ("Осма", "8.", False, SAME), ("Двадесет пета", "25.", False, SAME), ("Тридесет четири липе", "34. липе", False, SAME),
    ("Двадесет прве чете", "21. чете", False, SAME), ("Dvadeset prve čete", "21. čete", True, SAME), ("28. батерије", "Двадесет осме батерије", False, SAME),
    ("Седме приморске 2. пролаз", "7. приморске 2. пролаз", False, SAME), ("Трећег марта други пролаз", "Трећег марта 2. пролаз", False, SAME),
    ("4. крајишке чете", "Четврте крајишке чете", False, SAME), ("Др Ане Радић", "qq", False, SAME),
    ("12. априла", None, False, (True, False, "~~дванаести~~ априла", True)), ("Двадесет пете чете", None, False, (True, False, "25. чете", False)),
    ("Краља Стефана Другог", None, False, (True, False, "Краља Стефана II", False)), ("Краља Стефана Другог", "Краља Стефана II", False, SAME),
    ("Трећег марта", None, False, SAME), ("Улица доктора Марка", None, False, (True, False, "Улица др Марка", False)),
    ("Доктора Марка", "x", False, (False, True, "Др Марка", False)), ("Књегиње Јелене", None, False, (True, False, "Кнегиње Јелене", False)),
    ("Улица шест мостова", None, False, (True, False, "Улица 6 мостова", False)), ("Шест мостова", "6 мостова", False, SAME),
    ("Сквер 4 липе", None, False, (True, False, "Сквер ~~четири~~ липе", True)), ("Двадесет девета чета", None, False, (True, False, "29. чета", False)), (None, None, False, SAME),
]


def test_alternative_names(spark):
    for latin in (False, True):
        rows = [(i, c[0], c[1]) for i, c in enumerate(CASES) if c[2] == latin]
        df = spark.createDataFrame(rows, "i int, proper string, alt string").repartition(1)
        out = N.check_alt_names(df, F.col("proper"), F.lit(None).cast("string"), F.col("alt"), latin)
        for r in out.collect():
            assert (r["missing"], r["wrong"], r["suggestion"], r["partial"]) == CASES[r["i"]][3], CASES[r["i"]]


def test_rule_tables():
    ordinals = {w: n for w, n, _ in N._ordinals()}
    assert ordinals["двадесет трећег"] == 23 and ordinals["двадесет девета"] == 29 and ordinals["десето"] == 10 and "трећо" not in ordinals
    assert dict((w, r) for w, _, r in N._titles())["трећега"] == "III"
    assert N._latin("двадесет љуте") == "dvadeset ljute"


@pytest.mark.parametrize("rule,args,want", [
    (N.wrong_name, ("А", "Б"), True), (N.wrong_name, ("А", None), False), (N.missing_name, ("А", ""), True), (N.missing_name, (None, None), False),
    (N.wrong_name_sr, (None, "А", "Б"), True), (N.wrong_name_sr, (None, None, "Б"), False), (N.missing_name_sr, ("", None), True), (N.missing_name_sr_latn, ("", None), False),
    (N.wrong_name_sr_latn, ("Љубе", None, "Ljube"), False), (N.wrong_name_sr_latn, ("Љубе", None, "LJube"), True), (N.suspicious_name_en, ("Главна", "Main Street"), True),
    (N.unneeded_name_en, ("Главна", "Glavna"), True), (N.unneeded_name_en, ("Главна", None), False), (N.wrong_int_name, ("Шума", None, "Suma"), False),
    (N.missing_int_name, ("Шума", None, None), True), (N.missing_int_name, ("Вода", None, None), False)])
def test_name_rules(spark, rule, args, want):
    df = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} string" for i in range(len(args)))).repartition(1)
    assert df.select(rule(*[F.col(c) for c in df.columns])).collect()[0][0] is want


def test_a_filter_on_checks_repeats_no_step(spark):
    """Filters are pushed down with what their columns are made of: the check would be computed many times a row."""
    df = spark.range(3).selectExpr("id", "concat('Трећег марта ', id) AS proper", "CAST(NULL AS string) AS alt")
    out = N.check_alt_names(df, F.col("proper"), F.col("proper"), F.col("alt"))
    plan = out.where("missing OR wrong")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert filters and not any("lambda" in line for line in filters)
