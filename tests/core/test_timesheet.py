"""The invented form, its variants and the scalar rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orolog.functions import exprs as X
from orolog.operators import timesheet as S
from tests.core.golden import DAYS, PAIRS, TEXT, TOTALS


def hours(token: str) -> float:
    h, _, m = token.partition(".")
    return int(h) + int(m.ljust(2, "0")) / 60 if m else float(h)


@pytest.fixture(scope="module")
def variants(spark):
    cut = lambda *drop: "\n".join(x for x in TEXT.splitlines() if not any(d in x for d in drop))
    texts = {
        "golden": TEXT,
        "no header": cut("RIEPILOGO"),
        "odd month": TEXT.replace("LUGLIO", "LUGLIOX"),
        "no days": cut(*(f"{d:02d} " for d in range(1, 32)), "U 15:00"),
        "bad time": TEXT.replace("E 06:45", "E 25:00"),
        "bad minute": TEXT.replace("E 06:45", "E 12:60"),
        "past midnight": TEXT.replace("E 06:45", "E 24:30"),
        "no such day": TEXT.replace("LUGLIO", "GIUGNO"),
        "no such day, no events": TEXT.replace("LUGLIO", "GIUGNO").replace("31 DO E 20:16 U(24:00)", "31 DO"),
        "bad time, no month": cut("RIEPILOGO").replace("E 06:45", "E 25:00"),
        "no total": cut("ORE LAVORATE"),
        "two off": TEXT.replace("45.59", "45.57"),
        "four off": TEXT.replace("45.59", "45.55"),
        "again": "01 VE E 08:00\n02 SA E 09:00 U 10:00\n01 VE U 11:00 1 2 3\n02 SA 1 2 3",
        "no events": "01 VE 1.00 2.00 3.00",
        "accents": "PERÙ ANNA - 12345\n01 VE 1.00 2.00 3.00",
        "breaks": "01 VE E 08:00 1.00 2.00 3.00\r\n02 SA 1 2 3\x0b03 DO 1 2 3\u202804 LU 1 2 3\n",
        "indented": "    07 GI 1.00 2.00",
        "empty": "",
        "null": None,
    }
    rows = S.parse_documents(spark.createDataFrame(list(texts.items()), "doc_id string, text string")).collect()
    assert len(rows) == len(texts)
    return {r["doc_id"]: r for r in rows}


def test_golden_days_and_header(variants):
    r = variants["golden"]
    assert r["status"] == "success" and r["error"] is None
    m = r["meta"]
    assert (m["employee_name"], m["employee_id"], m["month_name"], m["month"], m["year"], m["unit"], m["turno"], m["qualifica"]) == ("ROSSI D'ARCO", "99999", "LUGLIO", 7, 2022, None, None, None)
    got = [(d["day"], [d["mo_f"], d["mo_t"], d["mo_lav"]]) for d in r["days"]]
    assert got == [(d, [pytest.approx(hours(t)) for t in line.split()]) for d, line in DAYS]
    assert r["days"][0]["raw"] == TEXT.splitlines()[3] and r["days"][0]["dow"] == "VE"


def test_golden_pairs(variants):
    show = lambda t: t and t.strftime("%m-%d %H:%M")
    got = [(p["day"], p["pair_index"], show(p["entry_ts"]), show(p["exit_ts"]), p["duration_hhmm"], p["turno"]) for p in variants["golden"]["pairs"]]
    assert got == PAIRS
    p = variants["golden"]["pairs"][4]
    assert p["entry_raw"] == p["exit_raw"] == TEXT.splitlines()[7] and variants["golden"]["pairs"][6]["exit_raw"] == "U 15:00"


def test_golden_totals_and_validation(variants):
    assert variants["golden"]["totals"] == {k: pytest.approx(v) for k, v in TOTALS.items()}
    v = variants["golden"]["validation"]
    assert v["is_ok"] and v["ore_lavorate_diff"] == pytest.approx(0) and v["ore_lavorate_row_sum"] == pytest.approx(2759 / 60)


def test_variants(variants):
    v = variants
    assert v["no header"]["meta"]["year"] is None and all(p["entry_ts"] is None and p["turno"] is None for p in v["no header"]["pairs"]) and len(v["no header"]["pairs"]) == 14
    assert (v["odd month"]["meta"]["month"], v["odd month"]["meta"]["year"], v["odd month"]["pairs"][0]["entry_ts"]) == (None, 2022, None)
    for name in ("no days", "empty", "null"):
        assert (v[name]["status"], v[name]["error"], v[name]["days"], v[name]["pairs"], v[name]["totals"]) == ("failed", S.NO_DAYS, [], [], None)
    for name in ("bad time", "bad minute", "past midnight", "no such day"):
        assert (v[name]["status"], v[name]["error"], v[name]["days"]) == ("failed", S.BAD_TIME, [])
    assert v["no such day, no events"]["status"] == v["bad time, no month"]["status"] == "success"
    assert v["no total"]["validation"]["ore_lavorate_diff"] is None and not v["no total"]["validation"]["is_ok"]
    assert "ore_lavorate" not in v["no total"]["totals"]
    assert v["two off"]["validation"]["is_ok"] and not v["four off"]["validation"]["is_ok"]
    assert [(p["day"], p["run"], p["pair_index"]) for p in v["again"]["pairs"]] == [(1, 1, 0), (2, 2, 0), (1, 3, 0)]
    assert v["no events"]["pairs"] == [] and v["accents"]["meta"]["employee_name"] is None
    assert [d["day"] for d in v["breaks"]["days"]] == [1, 2, 3, 4]
    # the head's length is counted on the stripped line: the day itself is read as a number
    assert [(d["mo_f"], d["mo_t"], d["mo_lav"]) for d in v["indented"]["days"]] in ([], [(7.0, 1.0, 2.0)])


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("given", "want"), [(7.75, 8.25), (7.5, 7 + 50 / 60), (-1.3, -1.5), (0.0, 0.0), (-0.16, -16 / 60), (24.0, 24.0)])
def test_hours(spark, given, want):
    assert value(spark, X.hhmm_hours(F.lit(given))) == pytest.approx(want)
    assert value(spark, X.hhmm_minutes(F.lit(given))) == round(want * 60)


def test_shift_is_the_nearest_middle(spark):
    rows = spark.range(1440).select("id", X.shift(F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,cast(id as int),0)")).alias("s")).collect()
    for r in rows:
        assert r["s"] == min(X.SHIFTS.items(), key=lambda x: abs(r["id"] - x[1]))[0]


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: X.normal_term(F.lit("  Buste__Paga- ")), "buste paga"),
        (lambda: X.normal_name(F.lit(None).cast("string")), "unknown"),
        (lambda: X.normal_name(F.lit("  ")), ""),
        (lambda: X.normal_name(F.lit(" Ada \u00A0 LOVE ")), "ada love"),
        (lambda: X.person_key(F.lit(""), F.lit("A  B")), "name:a b"),
        (lambda: X.person_key(F.lit("7"), F.lit("A")), "id:7"),
        (lambda: X.safe_name(F.lit('a/b:c*d?"e<f>g|h\\i')), "a_b_c_d__e_f_g_h_i"),
        (lambda: X.safe_name(F.lit("   ")), "unnamed"),
        (lambda: X.safe_name(F.lit("x" * 300)), "x" * 120),
        (lambda: X.file_tag(F.lit("July.PDF"), F.lit("0123456789")), "July__01234567"),
        (lambda: X.file_tag(F.lit("July"), F.lit("01")), "July__01"),
        (lambda: X.file_tag(F.lit("a.b.pdf"), F.lit("01")), "a.b__01"),
        (lambda: X.shown_name(F.lit(""), F.lit(None).cast("string")), "unknown.pdf"),
        (lambda: X.first_term(F.lit("Propaganda.pdf"), ["cedolino", "busta", "paga"]), "paga"),
        (lambda: X.first_term(F.lit("Busta paga"), ["busta", "paga", "busta paga"]), "busta"),
        (lambda: X.first_term(F.lit("x"), ["busta"]), None),
        (lambda: X.numeric_tokens(F.lit("1 +2.5 -3. 4:5 x 6.70 7e1")), ["1", "+2.5", "6.70"]),
        (lambda: X.lines(F.lit("a\r\nb\x0bc\u2028d\x85\n")), ["a", "b", "c", "d", ""]),
        (lambda: X.lines(F.lit("")), []),
        (lambda: X.month_number(F.lit("MARZO")), 3),
        (lambda: X.month_number(F.lit("MARS")), None),
        (lambda: X.hhmm_text(F.lit(1440)), "24:00"),
    ],
)
def test_scalar_rules(spark, column, want):
    assert value(spark, column()) == want


def test_no_exchange_in_the_parse(spark):
    df = S.pairs_table(S.parse_documents(spark.createDataFrame([("a", TEXT)], "doc_id string, text string")))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_row_forms_of_runs_and_pairs(spark):
    rows = [("d", i, k) for i, k in enumerate("EEUUEUUE")]
    df = spark.createDataFrame(rows, "doc string, t int, kind string")
    got = S.pair_events(df, ["doc"], ["t"], "kind", "t").orderBy("pair_index").collect()
    assert [(r["entry_ts"], r["exit_ts"]) for r in got] == [(0, None), (1, 2), (None, 3), (4, 5), (None, 6), (7, None)]
    runs = S.segment_runs(df, ["doc"], ["t"], ["kind"]).orderBy("t").collect()
    assert [r["run_id"] for r in runs] == [1, 1, 2, 2, 3, 4, 4, 5]
    plan = S.pair_events(df, ["doc"], ["t"], "kind", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_one_document(spark):
    assert len(S.parse_one(spark, TEXT)["days"]) == len(DAYS)
    for text in (None, "", "nothing"):
        with pytest.raises(S.ParseError, match=S.NO_DAYS):
            S.parse_one(spark, text)
