"""Scalar expressions on hand-made cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartloom.functions import culture_rules, numeric, text, time

D = dt.datetime


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("wall, utc", [
    ("2023-03-12 01:59:00", "2023-03-12 06:59:00"),
    ("2023-03-12 02:30:00", "2023-03-12 07:00:00"),  # skipped hour: first instant after it
    ("2023-03-12 03:00:00", "2023-03-12 07:00:00"),
    ("2023-07-01 12:00:00", "2023-07-01 16:00:00"),
    ("2023-11-05 00:59:00", "2023-11-05 04:59:00"),
    ("2023-11-05 01:00:00", None),  # repeated hour
    ("2023-11-05 01:59:59", None),
    ("2023-11-05 02:00:00", "2023-11-05 07:00:00"),
])
def test_local_to_utc(spark, wall, utc):
    got = one(spark, time.local_to_utc(F.lit(wall).cast("timestamp")).cast("timestamp_ntz").cast("string"))
    assert got == utc


@pytest.mark.parametrize("dst, utc", [(True, "2150-07-01 16:00:00"), (False, "2150-07-01 17:00:00")])
def test_local_to_utc_far_future(spark, dst, utc):
    col = time.local_to_utc(F.lit("2150-07-01 12:00:00").cast("timestamp"), dst_after_2037=dst)
    assert one(spark, col.cast("timestamp_ntz").cast("string")) == utc


@pytest.mark.parametrize("comment, number", [
    ("UNABLE TO REPORT.", None),
    ("NOT DONE.", None),
    ("GREATER THAN 300.  LOW RISK <1.0, AVERAGE RISK 1.0-3.0", 300.0),
    ("LESS THAN 0.01.  > 0.10 NG/ML", 0.01),
    ("<5.", 5.0),
    ("ND .  Not Done, WBC <=0.1.", None),
    ("UNABLE TO REPORT. PTT < 20.", 20.0),
    ("no digits", None),
    (None, None),
])
def test_parse_comment_number(spark, comment, number):
    assert one(spark, text.parse_comment_number(F.lit(comment).cast("string"))) == number


@pytest.mark.parametrize("value, fraction", [
    (100.0, 1.0), (20.0, 0.2), (19.9, None), (1.5, None), (1.0, 1.0), (0.21, 0.21), (0.2, None), (0.0, None), (150.0, None),
])
def test_clean_fraction(spark, value, fraction):
    assert one(spark, numeric.clean_fraction(F.lit(value))) == fraction


@pytest.mark.parametrize("f, c", [(98.6, 37.0), (102.8, 39.3), (32.0, 0.0)])
def test_f_to_c(spark, f, c):
    assert one(spark, numeric.f_to_c(F.lit(f))) == c


def test_convert_when_null_decision_keeps_value(spark):
    number, kept = numeric.convert_when(F.lit(None).cast("boolean"), F.lit(2.0), F.lit(5.0), F.lit("t"))
    assert (one(spark, number), one(spark, kept)) == (5.0, "t")


@pytest.mark.parametrize("now, before, total", [
    ((6, 0, 4), (None, None, None), 15),
    ((6, None, 4), (5, 0, 3), 15),
    ((5, 4, None), (1, 0, 1), 13),  # after an intubated reading: completed with normal
    ((5, None, 3), (1, 2, 1), 10),  # carried from the previous reading
    ((None, None, None), (None, None, None), 15),
])
def test_coma_total(spark, now, before, total):
    cols = [F.lit(v).cast("double") for v in (*now, *before)]
    assert one(spark, numeric.coma_total(*cols)) == total


@pytest.mark.parametrize("answers, result", [
    (("Yes", "Yes", "Yes", None), "Positive"), (("Yes", "Yes", None, "Yes"), "Positive"), (("No", None, None, None), "Negative"),
    (("Yes", "Yes", "No", "No"), "Negative"), (("Yes", "Yes", "No", None), None), ((None, None, None, None), None),
])
def test_three_valued_delirium(spark, answers, result):
    cols = [F.lit(v).cast("string") for v in answers]
    assert one(spark, text.three_valued_delirium(*cols)) == result


@pytest.mark.parametrize("code, system", [
    ("12345", "CPT"), ("1234F", "CPT"), ("1234T", "CPT"), ("A1234", "HCPCS"), ("W1234", None), ("123456", None), ("", None),
])
def test_classify_code(spark, code, system):
    assert one(spark, text.classify_code(F.lit(code))) == system


@pytest.mark.parametrize("fluid, order, method, category", [
    ("right EYE swab", None, None, "eyes"),
    ("eyebrow", None, None, "other unspecified"),
    ("blood, brain", None, None, "brain"),
    ("blood", "wound swab", None, "woundsite"),
    ("blood", "wound swab", "culture, CSF", "meninges and csf"),
    ("synovial", "x", "x", "joints"),
    (None, None, None, "other unspecified"),
])
def test_fluid_category(spark, fluid, order, method, category):
    cols = [F.lit(v).cast("string") for v in (fluid, order, method)]
    assert one(spark, culture_rules.fluid_category(*cols)) == category


@pytest.mark.parametrize("pattern", [p for p, _ in culture_rules.FLUID_NAME_RULES])
def test_first_match_equals_plain_regex(spark, pattern):
    """Lower-cased text with plain patterns must give what the regex that ignores case gives."""
    words = [w.strip("\\b") for w in pattern.split("|")]
    samples = [s for w in words for s in (w, w.upper(), f"x{w}y", f" {w},", w[:-1])] + ["", "zzz"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select(
        text.first_match("s", [(pattern, "hit")], ignore_case=True).isNotNull().alias("a"),
        F.col("s").rlike("(?i)" + pattern).alias("b"),
    )
    assert got.filter("a <> b").count() == 0


@pytest.mark.parametrize("pattern, left", [
    ("larynx|epiglottis", []),
    (r"sputum|\btip\b|tip of", [r"\btip\b"]),
    ("knee fluid|joint (synovial) fluid|neph. tube", ["joint (synovial) fluid|neph. tube"]),
    (r"\bgb\|pancreas|bile", [r"\bgb\|pancreas"]),
    ("a(b|c)d|e", ["a(b|c)d|e"]), ("(?i)A|b", ["(?i)A|b"]), ("[a|b]c|d", ["[a|b]c|d"]), (r"\)(a|b\()", [r"\)(a|b\()"]),
])
def test_plain_words_need_no_regex(spark, pattern, left):
    """A long list of words in one Java expression costs time in proportion to the list at every place of a text."""
    samples = ["larynx", "xepiglottisy", "a tip", "tips", "tip off", "joint synovial fluid", "neph-tube", "nephtube", "gb|pancreas", "xgb|pancreas",
               "gb", "abd", "acd", "ad", "A", "B", "e", "ac", "|c", "ab", "d", ")a", ")b(", "b(", "bi\nle", "bile", "", None]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select("s", text.found_in(F.col("s"), pattern).alias("a"), F.col("s").rlike(pattern).alias("b"))
    assert got.filter("NOT a <=> b").collect() == []
    hit = text.first_match("s", [(pattern, "hit")])
    plan = df.select(hit.alias("a"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("RLIKE") == len(left) and all(f", {p})" in plan for p in left)


def test_words_and_maps(spark):
    assert one(spark, text.text_to_ordinal(F.lit("b"), ["a", "b"])) == 2
    assert one(spark, text.text_to_ordinal(F.lit("z"), ["a", "b"])) is None
    assert one(spark, text.strict_sum(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, text.case_map(F.lit("q"), {"a": "b"}, "rest")) == "rest"
    assert one(spark, text.join_present(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "a; b"
    assert one(spark, text.prefix_number(F.lit("-5 Unarousable"))) == -5.0
    assert one(spark, text.prefix_number(F.lit(" 0  Alert"))) == 0.0
    assert one(spark, text.normalise_whitespace(F.lit("  a \n b "))) == "a b"


def test_age_counts_year_boundaries(spark):
    col = time.age_at_event(F.lit(60), F.lit(2150), F.lit("2152-01-01 00:00:00").cast("timestamp"))
    assert one(spark, col) == 62
