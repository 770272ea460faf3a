"""Edge values of the column expressions."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom import functions as fn
from tallyloom.functions.text import WHITESPACE, other_spelled_out, windows_text


def values(spark, function, inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [row[1] for row in rows.select("i", function("v")).orderBy("i").collect()]


CASES = [
    (
        fn.strict_id,
        {None: None, "  ": None, " 123 ": "000000123", "9123456789": "123456789", "\t12\n": "000000012", "\u00a07\u3000": "000000007"},
    ),
    (fn.lenient_id, {"1234567890": "1234567890", " 12 ": "000000012", "": "000000000", None: None, "123456789": "123456789"}),
    (
        fn.strict_term,
        {"2235": "2235", " 2235 ": "2235", "223": None, "22350": None, "22A5": None, None: None, "2235\n": "2235", "22\n35": None},
    ),
    (fn.lenient_term, {"2235": "2235", " 5 ": "0005", "22350": "22350", "ABCD": "ABCD", None: None}),
    (fn.term_is_invalid, {"2235": "N", "x": "Y", None: "Y", "": "Y"}),
    (
        fn.is_selected,
        {None: False, " ": False, "0": False, "n": False, "No": False, " none ": False, "Y": True, "FALSE": True, "0.0": True, "x": True, "": False},
    ),
    (fn.option_picked, {None: False, " ": False, "N": False, "No": False, "NO": True, "n": True, "0": True, "a@b.c": True, " N ": False}),
    (
        fn.yes_no,
        {" yes ": "Y", "t": "Y", "1": "Y", "TRUE": "Y", "no": "N", "F": "N", "0": "N", "maybe": "M", "2": "2", "": None, None: None, "  ": None},
    ),
    (fn.count_or_null, {"2": 2, "2.9": None, "": None, "x": None, None: None, " 2 ": 2, "-1": -1}),
    (
        fn.count_truncated,
        {"2.9": 2, " 2 ": 2, "-1": -1, "x": None, "": None, "nan": None, "inf": None, None: None, "2d": None, "1e2": 100, "-2.9": -2, "9000000000": 9000000000},
    ),
    (fn.count_whole, {"2": 2, "2.0": 2, "x": None, None: None, "2.5": None, "1e1": 10}),
    (fn.semesters, {"2": 2, " 2 ": 2, "2.0": None, "x": None, None: None}),
    (fn.amount, {"12.5": 12.5, "$12": None, "1,200": None, "": None, " 7 ": 7.0, "0x1p3": None, "5f": None, ".5": 0.5, "nan": None}),
    (lambda c: fn.left_nonblank(c, 2), {"USA": "US", " Can": "Ca", "  ": None, None: None, "F": "F"}),
    (lambda c: fn.clip(c, 3), {"abcd": "abc", None: "", " a": " a"}),
    (
        fn.season_label,
        {
            "Delivery_202324SP_11_5_25.csv": "2023-24 Spring",
            "x_201920fa.csv": "2019-20 Fall",
            "nope.csv": None,
            "/202021SU/a_202122WN.csv": "2021-22 Winter",
            None: None,
            "C:\\in\\202021su.csv": "2020-21 Summer",
        },
    ),
    (fn.parse_term, {"2235": 2235, " 2235\t": 2235, "02235": 2235, "ABCD": None, "": None, None: None}),
]


@pytest.mark.parametrize("function,expected", CASES)
def test_edge_values(spark, function, expected):
    assert values(spark, function, list(expected)) == list(expected.values())


def test_academic_year_examples(spark):
    terms = [2135, 2138, 2141, 2145, 2148, 2151, 2235, 2238, 2241]
    assert values(spark, fn.academic_year, terms, "int") == [2013] * 3 + [2014] * 3 + [2023] * 3
    # rounding goes down, also below zero
    assert values(spark, fn.academic_year, [-3], "int") == [1799]


def test_numeric_answers(spark):
    numbers = [None, 0.0, 1.0, float("nan"), -2.5]
    assert values(spark, fn.is_selected_number, numbers, "double") == [False, False, True, False, True]
    assert values(spark, fn.yes_no_number, numbers, "double") == [None, "N", "Y", None, "Y"]
    assert values(spark, fn.is_selected_number, [True, False, None], "boolean") == [True, False, False]
    assert values(spark, fn.nan_to_null, numbers, "double") == [None, 0.0, 1.0, None, -2.5]


def test_checked_count_fails_on_text(spark):
    assert values(spark, fn.count_checked, ["2", "", None]) == [2, None, None]
    with pytest.raises(PySparkException, match="not a whole number: 2.9"):
        values(spark, fn.count_checked, ["2", "2.9"])


def test_labels(spark):
    rows = spark.createDataFrame(
        [(1, " Text ", " more "), (2, "  ", None), (3, None, " "), (4, "Other", None), (5, "Other", "x"), (6, "other", "x")],
        "i int, d string, o string",
    )
    found = (
        rows.select(
            "i",
            fn.label_or("d", F.lit("Label")).alias("a"),
            fn.with_other_text(F.lit("Label"), "o").alias("b"),
            other_spelled_out("d", "o").alias("c"),
        )
        .orderBy("i")
        .collect()
    )
    assert [row.a for row in found] == ["Text", "Label", "Label", "Other", "Other", "other"]
    assert [row.b for row in found] == ["Label: more", "Label", "Label", "Label", "Label: x", "Label: x"]
    assert [row.c for row in found] == [" Text ", "  ", None, "Other - Unknown", "Other - x", "other"]


def test_strip_matches_python(spark):
    texts = [f"{space}a{space}b{space}" for space in WHITESPACE]
    assert values(spark, fn.strip, texts) == [text.strip() for text in texts]


def test_strip_with_and_without_the_short_cut(spark):
    ends = ["", "!", "~", "a", "~~", "\x7f", "\x00", "\u00e9", "\u212a", "\U0001f600", *WHITESPACE]
    texts = [f"{first}{middle}{last}" for first in ends for middle in ("", " ", "x y") for last in ends]
    assert values(spark, fn.strip, texts) == [text.strip(WHITESPACE) for text in texts]
    wanted = [(text.strip(WHITESPACE)[-9:].rjust(9, "0") if text.strip(WHITESPACE) else None) for text in texts]
    assert values(spark, fn.strict_id, texts) == wanted


def test_ids_are_not_searched_for_white_space_again_and_again(spark):
    stripped = spark.range(1).select(F.col("id").cast("string").alias("v")).select(fn.strict_id("v").alias("id"))
    optimized = stripped._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= optimized.lower().count("trim(") <= 2
    # text without outer white space does not come to the search at all
    assert "CASE WHEN" in optimized


def test_windows_text(spark):
    raw = bytes(b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    assert values(spark, lambda c: windows_text(F.col(c)), [raw.decode("latin-1")]) == [raw.decode("cp1252")]
