from datetime import date

import pytest

from laborlake.functions import cleaning


def run(spark, values, make):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").selectExpr("i", f"{make('v')} AS r")
    return [r.r for r in rows.orderBy("i").collect()]


def check(spark, vectors, make):
    assert run(spark, list(vectors), make) == list(vectors.values())


def test_strings(spark):
    vectors = {
        "  PESSOA  ": "PESSOA", "\tA B\xa0": "A B", "\x1cX\x1f": "X", "\x85Y ": "Y", "JOSÉ": "JOSÉ", "   ": "",
        "a\tb": "a\tb", "　Z": "Z", "": "", None: None,
    }
    check(spark, vectors, lambda c: cleaning.cast_text(c, "str"))
    two_steps = lambda c: cleaning.strip_rest(cleaning.only_plain_blanks([c]), f"trim({c})")
    check(spark, vectors, two_steps)


def test_trimmed_characters_are_the_unicode_blanks():
    assert set(cleaning.BLANKS) == {chr(i) for i in range(0x10000) if chr(i).isspace()}


def test_ints(spark):
    check(
        spark,
        {
            "44": 44, "08": 8, "": None, "000000007": 7, "000000000": 0, "407": 407, "9.5e108": None,
            "-99999999999": None, "3.92": None, "3.0": 3, "1e3": 1000, "+5": 5, " 12 ": 12, "2147483647": 2147483647,
            "2147483648": None, "-2147483648": -2147483648, "1d": None, "0x1p3": None, "0x1F": None, "1_000": None,
            "1,0": None, "NaN": None, "inf": None, "abc": None, "1 2": None, None: None,
        },
        lambda c: cleaning.cast_text(c, "int"),
    )


def test_doubles(spark):
    check(
        spark,
        {
            "0000001125,29": 1125.29, "0001125,29": 1125.29, "": None, "1125.29": 1125.29, " 5,9 ": 5.9, "1e3": 1000.0,
            "+5": 5.0, ".5": 0.5, "5.": 5.0, "-0,5": -0.5, "1.125,29": None, "1d": None, "1f": None, "1D": None,
            "0x1p3": None, "1_000": None, "inf": None, "-Infinity": None, "nan": None, "1e400": None, "e5": None,
            None: None,
        },
        lambda c: cleaning.cast_text(c, "double"),
    )


def test_dates(spark):
    check(
        spark,
        {
            "02062014": date(2014, 6, 2), "31051965": date(1965, 5, 31), "02/06/2024": date(2024, 6, 2),
            "2/6/2024": date(2024, 6, 2), " 31/05/1965 ": date(1965, 5, 31), "29022000": date(2000, 2, 29),
            "29021900": None, "00000000": None, "0": None, "": None, "   ": None, "99999999": None, "1062014": None,
            "30022014": None, "31120000": None, "31/12/0000": None, "31/05/65": None, "2014-06-02": None,
            "+2062014": None, "-2062014": None, "2 062014": None, "1T062014": None, "02/06/2024 10:00": None,
            "31/04/2020": None, None: None,
        },
        lambda c: cleaning.cast_text(c, "date"),
    )


def test_states(spark):
    check(
        spark,
        {
            "120040": "12", "355030": "35", "000000": "00", "": "00", "0": "00", "  120040  ": "12", "12": "12",
            "5": "00", "AB1": "AB", "010000": "01", None: "00",
        },
        cleaning.state_code,
    )


def test_missing_tokens_match_before_trimming(spark):
    assert run(spark, cleaning.NA_TOKENS, cleaning.na_to_null) == [None] * 19
    kept = [" NA", "NaN ", "na", "-", "0", "   "]
    assert run(spark, kept, cleaning.na_to_null) == kept


def test_unknown_type_is_left_alone(spark):
    assert run(spark, [" x "], lambda c: cleaning.cast_text(c, "other")) == [" x "]


@pytest.mark.parametrize(
    ("value", "expected"),
    [(1.005, 1.0), (0.285, 0.28), (2.675, 2.68), (-1.005, -1.0), (-2.5, -2.5), (0.0, 0.0), (1234.567, 1234.57)],
)
def test_rounding_to_cents(spark, value, expected):
    assert spark.range(1).selectExpr(f"{cleaning.round_cents(f'{value}D')} AS r").first().r == expected


def test_formats(spark):
    assert spark.range(1).selectExpr(f"{cleaning.gigabytes('72000000', 2)} AS gb").first().gb == 0.07
