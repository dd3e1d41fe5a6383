import datetime as dt

import pytest
from pyspark.sql import functions as F

from casewright.functions import links
from casewright.functions import text as X
from casewright.functions import values as V


def apply(spark, data, schema, expr):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


@pytest.mark.parametrize("raw,want", [
    ("  a \t b  ", "a b"), ("", None), ("   ", None), (None, None), ("x", "x"), (" a b ", "a b"),
])
def test_clean_text(spark, raw, want):
    assert apply(spark, [(raw,)], "c string", X.clean_text(F.col("c"))) == [want]


def test_cells_are_cleaned_as_by_the_plain_patterns(spark):
    """The cheaper looks at plain cells change no result; cells of every white sign, and a very long one."""
    signs = [*X.BLANKS, "\x00", "\x1c", "\x7f", "\x85", "\xa0", "\u200b", "a", "!", "~", "é"]
    cells = [(None,), ("",), ("a b " * 50_000,), *[(a + b + c,) for a in signs for b in (" ", "", "x", "\n") for c in signs]]
    df = spark.createDataFrame(cells, "c string")
    plain = F.nullif(F.trim(F.regexp_replace("c", r"(?U)\s+", " ")), F.lit(""))
    blank = F.when(~F.col("c").rlike(r"(?U)^\s*$"), F.col("c"))
    cleaned, kept = X.clean_text(F.col("c")), X.blank_to_null(F.col("c"))
    assert df.filter(~cleaned.eqNullSafe(plain) | ~kept.eqNullSafe(blank)).count() == 0
    assert df.filter(cleaned.isNotNull()).count() > 1000 and df.filter(kept.isNull()).count() > 1000


@pytest.mark.parametrize("raw,want", [
    ("Café-Au_Lait (R).", "café-au_lait r"), ("A.B..", "ab"), ("  two   words ", "two words"), (None, None),
    ("dot. ", "dot"), ("50%/ML", "50ml"),
])
def test_clean_drugname(spark, raw, want):
    assert apply(spark, [(raw,)], "c string", X.clean_drugname(F.col("c"))) == [want]


@pytest.mark.parametrize("raw,want", [
    ('a"b', 'a\\"b'), ('a\\"b', 'a\\"b'), ("x\x00y\r\n", "xy"), ('""', '\\"\\"'),
])
def test_clean_line(spark, raw, want):
    assert apply(spark, [(raw,)], "c string", X.clean_line(F.col("c"))) == [want]


@pytest.mark.parametrize("raw,want", [
    ("DEMO18Q1.txt", "2018Q1"), ("demo99q4.TXT", "1999Q4"), ("x/2018q1/ascii", "2018Q1"), ("DEMO50Q2.txt", "2050Q2"),
    ("DEMO51Q2.txt", "1951Q2"), ("readme.txt", None), ("DEMO18Q5.txt", None),
])
def test_quarter_label(spark, raw, want):
    assert apply(spark, [(raw,)], "c string", X.quarter_label(F.col("c"))) == [want]


@pytest.mark.parametrize("raw,want", [("2023q1", True), ("2023Q4", True), ("2003q4", False), ("2023q5", False), ("23q1", False)])
def test_valid_quarter(spark, raw, want):
    assert apply(spark, [(raw,)], "c string", X.valid_quarter(F.col("c"))) == [want]


def test_era_prefix(spark):
    assert apply(spark, [(2012,), (2013,)], "y int", X.era_prefix(F.col("y"), "old", "new")) == ["old", "new"]


@pytest.mark.parametrize("age,unit,days,years", [
    ("-08", "YR", 2920.0, 8.0), ("1,00", "YR", 36500.0, 100.0), ("4.5.6", "YR", None, None), ("", "YR", None, None),
    ("2", "MON", 61.0, 0.0), ("3", "WK", 21.0, 0.0), ("10", "HR", 0.0, 0.0), ("123", "YR", None, None),
    ("122", "YR", 44530.0, 122.0), ("45", "DEC", 45.0, 0.0), ("4", "DEC", 14600.0, 40.0), ("9", None, 3285.0, 9.0),
    ("9", "", 3285.0, 9.0), ("9", "UNK", None, None), (None, "YR", None, None), ("2.5", "DY", 2.0, 0.0), (".", "YR", None, None),
])
def test_age(spark, age, unit, days, years):
    d = V.age_in_days(F.col("a"), F.col("u"))
    found = spark.createDataFrame([(age, unit)], "a string, u string").select(d, V.age_in_years(d)).first()
    assert tuple(found) == (days, years)


@pytest.mark.parametrize("days,years,want", [
    (27.0, 0.0, "N"), (28.0, 0.0, "I"), (600.0, 2.0, "C"), (4380.0, 12.0, "T"), (6570.0, 18.0, "A"), (23725.0, 65.0, "E"), (None, None, None),
])
def test_age_group(spark, days, years, want):
    assert apply(spark, [(days, years)], "d double, y double", V.age_group(F.col("d"), F.col("y"))) == [want]


@pytest.mark.parametrize("wt,unit,want", [
    ("70 kg", "KG", 70.0), ("100", "LBS", 45.0), ("100", "IB", 45.0), ("70000", "GMS", 70.0), ("635", None, 635.0), ("636", "KG", None),
    ("2.5", "", 2.0), ("3.5", "KGS", 4.0), ("5", "STONE", None), ("-60", "KG", 60.0), ("1000000", "MG", 1.0),
])
def test_weight(spark, wt, unit, want):
    assert apply(spark, [(wt, unit)], "w string, u string", V.weight_in_kg(F.col("w"), F.col("u"))) == [want]


def test_codes(spark):
    sex = apply(spark, [(x,) for x in ("f", " M ", "UNK", None, "")], "c string", V.std_sex(F.col("c")))
    assert sex == ["F", "M", None, None, None]
    assert apply(spark, [("MD",), ("md",), ("SALES",)], "c string", V.std_occupation(F.col("c"))) == ["MD", None, None]
    assert apply(spark, [("DE",), ("XX",)], "c string", V.outcome_name(F.col("c"))) == ["Death", None]
    ranks = apply(spark, [("C",), ("PS",), ("ZZ",), (None,)], "c string", V.order_rank(F.col("c"), ["C", "I", "SS", "PS"]))
    assert ranks == [1, 4, None, None]


@pytest.mark.parametrize("raw,want", [
    ("20220105", dt.date(2022, 1, 5)), ("2022-01-05", dt.date(2022, 1, 5)), ("05/01/2022", dt.date(2022, 1, 5)),
    ("20221301", None), ("202201", None), (None, None), ("x", None),
])
def test_parse_date(spark, raw, want):
    assert apply(spark, [(raw,)], "c string", V.parse_date(F.col("c"))) == [want]


@pytest.mark.parametrize("value,unit,want", [
    ("70", "KG", 70.0), ("500", "g", 0.5), ("5000000", "MG", 5.0), ("5", "lb", 5.0), ("x", "kg", None), ("5", None, 5.0),
])
def test_std_numeric(spark, value, unit, want):
    assert apply(spark, [(value, unit)], "v string, u string", V.std_numeric(F.col("v"), F.col("u"))) == [want]


def test_success_rate(spark):
    assert apply(spark, [(1, 4), (0, 0)], "p int, t int", V.success_rate(F.col("p"), F.col("t"))) == [25.0, 0.0]


def test_archive_quarter(spark):
    hrefs = ["/x/rep_ascii_2013Q2.ZIP", "/x/rep_xml_2013q2.zip", "/x/rep_ascii_2013q5.zip", "/x/other_ascii_2004q1.zip"]
    got = apply(spark, [(h,) for h in hrefs], "h string", links.archive_quarter(F.col("h")))
    assert got == ["2013q2", None, None, "2004q1"]
    only = apply(spark, [(h,) for h in hrefs], "h string", links.archive_quarter(F.col("h"), ["rep"]))
    assert only == ["2013q2", None, None, None]
