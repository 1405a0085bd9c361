"""Rules that turn dirty source text into typed values; bad text becomes NULL, never an error.

Each rule takes and returns SQL text, to be used in ``selectExpr`` or ``expr``. A fifty-column projection is
then one call into the engine, where building it from column objects would take thousands.
"""

from __future__ import annotations

# Text a source file uses for "missing", matched before trimming.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Characters trimmed at both ends of a value (Unicode blanks and the separators U+001C to U+001F).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def quoted(text: str) -> str:
    """SQL string literal; anything but printable ASCII is written by code point."""
    escaped = "".join(
        ch if " " <= ch <= "~" and ch not in "'\\" else f"\\u{ord(ch):04x}" for ch in text
    )
    return f"'{escaped}'"


_NA_LIST = ", ".join(quoted(t) for t in NA_TOKENS)
_BLANKS = quoted(BLANKS)
# Wide beyond Latin-1, so that the test stays two look-ups per character; a false alarm only costs time.
_RARE_BLANKS = quoted("[" + "".join(b for b in BLANKS if b != " " and b < "\u0100") + "\u1680-\u3000]")


def na_to_null(c: str, value: str | None = None) -> str:
    """``value``, by default the text itself, unless the text ``c`` stands for "missing"."""
    return f"CASE WHEN {c} NOT IN ({_NA_LIST}) THEN {value or c} END"


def strip(c: str) -> str:
    """Trim every kind of blank."""
    return f"btrim({c}, {_BLANKS})"


def only_plain_blanks(columns: list[str]) -> str:
    """Whether a row's values hold no blank other than the space.

    One look at the row saves the full trim, character by character, for each of its columns.
    """
    return f"NOT concat_ws('', {', '.join(columns)}) RLIKE {_RARE_BLANKS}"


def strip_rest(plain: str, t: str) -> str:
    """Finish trimming a value freed of plain spaces."""
    return f"IF({plain}, {t}, {strip(t)})"


def _number(t: str, value: str) -> str:
    """``value``, a number cast from the text ``t``, if ``t`` is written as a plain number.

    The engine's own parser also takes type suffixes, hexadecimal and spelled-out values; numbers in the
    sources end in a digit or a separator and hold no "x". What is too large for a double is missing too.
    """
    plain = f"right({t}, 1) < ':' AND NOT contains({t}, 'x') AND NOT contains({t}, 'X')"
    may_overflow = f"contains({t}, 'e') OR contains({t}, 'E') OR length({t}) > 300"
    finite = f"abs({value}) < DOUBLE('Infinity')"
    return f"CASE WHEN {plain} AND NOT ({may_overflow}) THEN {value} WHEN {plain} AND {finite} THEN {value} END"


def text_to_double(t: str) -> str:
    """Number with a decimal comma or point, from stripped text."""
    return _number(t, f"try_cast(replace({t}, ',', '.') AS DOUBLE)")


def text_to_int(t: str) -> str:
    """Whole number that fits 32 bits, however it is written ("044", "3.0", "1e3"), from stripped text."""
    number = _number(t, f"try_cast({t} AS DOUBLE)")
    whole = f"{number} BETWEEN {INT_MIN} AND {INT_MAX} AND {number} = rint({number})"
    return f"coalesce(try_cast({t} AS INT), CASE WHEN {whole} THEN CAST({number} AS INT) END)"


def text_to_date(t: str) -> str:
    """Date from stripped ``ddMMyyyy`` or ``d/M/yyyy``; zeros, impossible days and other text are missing.

    The parts are put in ISO order and cast, which is several times faster than a date pattern. Only digits
    get that far, and year 0 is no year.
    """
    digits = f"length({t}) = 8 AND {t} >= '0' AND {t} < ':' AND try_cast({t} AS INT) IS NOT NULL"
    slashes = f"{t} RLIKE '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$'"
    from_digits = f"concat(substring({t}, 5, 4), '-', substring({t}, 3, 2), '-', substring({t}, 1, 2))"
    from_parts = f"concat_ws('-', split_part({t}, '/', 3), split_part({t}, '/', 2), split_part({t}, '/', 1))"
    return (
        f"CASE WHEN endswith({t}, '0000') THEN NULL WHEN {digits} THEN try_cast({from_digits} AS DATE) "
        f"WHEN {slashes} THEN try_cast({from_parts} AS DATE) END"
    )


PARSERS = {"int": text_to_int, "double": text_to_double, "date": text_to_date}


def cast_text(c: str, dtype: str) -> str:
    """Typed value of source text; an unknown type leaves it as it is."""
    if dtype == "str":
        return strip(c)
    return PARSERS[dtype](strip(c)) if dtype in PARSERS else c


def state_of(t: str) -> str:
    """First two characters of a stripped municipality code; "00" when missing, too short or all zeros."""
    return f"CASE WHEN length({t}) >= 2 AND translate({t}, '0', '') <> '' THEN substring({t}, 1, 2) ELSE '00' END"


def state_code(c: str) -> str:
    """State of a municipality code as the source writes it."""
    return state_of(strip(c))


def round_cents(x: str) -> str:
    """Two decimals of the binary value, halves away from zero (1.005 is stored below the half: 1.00)."""
    return f"signum({x}) * floor(abs({x}) * 100 + 0.5D) / 100"


def gigabytes(size: str, digits: int) -> str:
    return f"round({size} / 1e9D, {digits})"
