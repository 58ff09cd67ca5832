"""Column expressions over text: trimming, number and boolean words, dates, casing.

Every function takes and returns a Column built from JVM-side functions, so the
expressions stay inside Catalyst and need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------
# Characters that count as white space at the ends of a value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Boolean words, compared trimmed and in lower case.
TRUE_WORDS = ("true", "yes", "y", "1")
FALSE_WORDS = ("false", "no", "n", "0")
# Words read as a missing value in delimited files.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Number syntax accepted after "$" and "," have been removed.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]{1,18}$"
# The same characters as WHITESPACE, as ranges of a pattern's character class.
WHITESPACE_CLASS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Date shapes, tried in this order, and the year-month-day order their parts are
# put in: month first, then day first when the month would exceed 12.
YEAR_FIRST = r"^([0-9]{4})(?:-([0-9]{1,2})-([0-9]{1,2})|/([0-9]{1,2})/([0-9]{1,2})|([0-9]{2})([0-9]{2}))$"
YEAR_LAST = r"^([0-9]{1,2})([-/.])([0-9]{1,2})\2([0-9]{4})$"
# Two-digit years: 00 to 68 are of this century, 69 to 99 of the last.
THIS_CENTURY = r"^([0-9]{1,2})([-/.])([0-9]{1,2})\2([0-5][0-9]|6[0-8])$"
LAST_CENTURY = r"^([0-9]{1,2})([-/.])([0-9]{1,2})\2(69|[7-9][0-9])$"
# A time of day after any date, on the clock of 24 hours or of 12.
TIME_OF_DAY = (
    r"[Tt ](?:(?:2[0-3]|[01]?[0-9]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]+)?)?(?: ?(?:[Zz]|UTC|[+-][0-9]{2}:?[0-9]{2}))?"
    r"|(?:1[0-2]|0?[1-9]):[0-5][0-9](?::[0-5][0-9])? ?[AaPp][Mm])$"
)
DATE_SHAPES = (
    (YEAR_FIRST, "$1-$2$4$6-$3$5$7"),
    (YEAR_LAST, "$4-$1-$3"),
    (YEAR_LAST, "$4-$3-$1"),
)
SHORT_SHAPES = (
    (THIS_CENTURY, "20$4-$1-$3"),
    (LAST_CENTURY, "19$4-$1-$3"),
    (THIS_CENTURY, "20$4-$3-$1"),
    (LAST_CENTURY, "19$4-$3-$1"),
)
SHORT_LENGTH = 8
# A month's name or its first three letters; only those letters are kept.
MONTH = (
    r"(?=(?:january|jan|february|feb|march|mar|april|apr|may|june|jun|july|jul|august|aug|september|sep"
    r"|october|oct|november|nov|december|dec)[ -])([a-z]{3})[a-z]*"
)
NAMED_SHAPES = (
    (rf"(?i)^{MONTH}[ -]([0-9]{{1,2}})[ -]([0-9]{{4}})$", "$3 $1 $2"),
    (rf"(?i)^([0-9]{{1,2}})[ -]{MONTH}[ -]([0-9]{{4}})$", "$3 $2 $1"),
)
NAMED_FORMAT = "yyyy MMM d"
REGION_CODE_PATTERN = r"^\p{L}{1,3}$"
# ---------------------------------------------------------------------------


def strip(value: Column) -> Column:
    """Remove white space at both ends (all of Unicode's, not only blanks)."""
    return F.btrim(value, F.lit(WHITESPACE))


# What the patterns above accept in a raw value, with padding, "$" and "," left in:
# testing a raw value with one pattern costs a third of rewriting it first.
_EDGE = f"[{WHITESPACE_CLASS}$,]*"
_DIGITS = "[0-9][0-9$,]*"
RAW_NUMBER = (
    rf"^{_EDGE}[+-]?[$,]*({_DIGITS}\.?[0-9$,]*|\.[$,]*{_DIGITS})([eE][$,]*[+-]?[$,]*{_DIGITS})?{_EDGE}$"
)
RAW_INTEGER = rf"^{_EDGE}[+-]?[$,]*([0-9][$,]*){{1,18}}{_EDGE}$"
RAW_BOOLEAN = rf"(?i)^[{WHITESPACE_CLASS}]*({'|'.join(TRUE_WORDS + FALSE_WORDS)})[{WHITESPACE_CLASS}]*$"


def is_padded(value: Column) -> Column:
    """White space at either end; looks at two characters, rewrites nothing."""
    ends = [F.contains(F.lit(WHITESPACE), F.substring(value, at, 1)) for at in (1, -1)]
    return (value != "") & (ends[0] | ends[1])


def plain_number(value: Column) -> Column:
    """Text of a number without currency sign, thousands commas and padding."""
    return strip(F.translate(strip(value), "$,", ""))


def is_number(value: Column) -> Column:
    return F.rlike(value, F.lit(RAW_NUMBER))


def is_integer(value: Column) -> Column:
    return F.rlike(value, F.lit(RAW_INTEGER))


def to_number(value: Column) -> Column:
    """The number a text stands for, NULL when it is not one.

    The pattern comes first because a bare cast also takes ``5d`` and ``nan``.
    """
    return F.when(is_number(value), plain_number(value).try_cast("double"))


def is_boolean_word(value: Column) -> Column:
    return F.rlike(value, F.lit(RAW_BOOLEAN))


def to_yes_no(value: Column) -> Column:
    word = F.lower(strip(value))
    return F.when(word.isin(*TRUE_WORDS), "Yes").when(word.isin(*FALSE_WORDS), "No").otherwise(value)


# Control character set in front of a rewritten text: it tells a match from a text
# that a pattern left alone, without matching twice.
_MARK = "\x01"


def _rewritten(value: Column, shape: str, order: str) -> Column:
    """The value's parts in a new order, empty when it has another shape."""
    return F.split_part(F.regexp_replace(value, shape, _MARK + order), F.lit(_MARK), F.lit(2))


def to_date(value: Column) -> Column:
    """The calendar date a text stands for, NULL when no listed shape fits. A time of day
    after the date is read over."""
    plain = F.translate(strip(value), "," + _MARK, "")
    plain = F.when(F.contains(plain, F.lit(":")), F.regexp_replace(plain, TIME_OF_DAY, "")).otherwise(plain)
    numbers = [_rewritten(plain, shape, order).try_cast("date") for shape, order in DATE_SHAPES]
    short = [_rewritten(plain, shape, order).try_cast("date") for shape, order in SHORT_SHAPES]
    numbers.append(F.when(F.length(plain) <= SHORT_LENGTH, F.coalesce(*short)))
    month_first, day_first = (
        F.try_to_date(_rewritten(plain, shape, order), NAMED_FORMAT) for shape, order in NAMED_SHAPES
    )
    # only one shape opens with a letter; all others open with a digit
    return F.when(F.ascii(plain) > ord("9"), month_first).otherwise(F.coalesce(*numbers, day_first))


# Private-use character that marks, with a blank, where a letter follows something
# that is neither letter nor blank.
_BREAK = "\ue000 "


def title_case(value: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` restarts after blanks only, so a blank is set before the letters
    that follow another character and taken out again. A text that holds the
    marker itself is cut into letter and non-letter runs instead.
    """
    marked = F.regexp_replace(value, r"([^\p{L} ])(?=\p{L})", "$1" + _BREAK)
    runs = F.regexp_extract_all(value, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    return F.when(
        F.contains(value, F.lit(_BREAK[0])), F.array_join(F.transform(runs, F.initcap), "")
    ).otherwise(F.replace(F.initcap(marked), F.lit(_BREAK), F.lit("")))


def normalise_text(value: Column, region: bool = False) -> Column:
    """Trim and title-case; in a region column short codes go to upper case."""
    text = strip(value)
    if not region:
        return title_case(text)
    return F.when(F.rlike(text, F.lit(REGION_CODE_PATTERN)), F.upper(text)).otherwise(title_case(text))


def contains_any(value: Column, words: tuple[str, ...]) -> Column:
    """True when one of the words occurs anywhere in the value."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(value, F.lit(word))
    return hit
