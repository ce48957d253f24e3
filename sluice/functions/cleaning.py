"""Column expressions that turn dirty text into typed values.

All of them return NULL for text they cannot read; none raises. They are Spark
expressions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a space at the ends of a text, beyond plain blanks.
SPACES = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def or_null(c: Column) -> Column:
    """Blank text as NULL. Blanks are common, and a failed parse costs far more than a test."""
    return F.nullif(F.trim(c), F.lit(""))


def whole_number(c: Column) -> Column:
    """Text as bigint; blank or unreadable is NULL."""
    return or_null(c).try_cast("bigint")


def real_number(c: Column) -> Column:
    """Text as double; blank or unreadable is NULL."""
    return or_null(c).try_cast("double")


def month_day_year(c: Column) -> Column:
    """``7/4/2019`` or ``07/04/2019`` as a date; blank or impossible is NULL."""
    return F.try_to_date(or_null(c), "M/d/yyyy")


def one_line(c: Column, literal_slash_n: bool = False) -> Column:
    """Newlines become spaces; with ``literal_slash_n`` the two characters ``/n`` do instead."""
    if literal_slash_n:
        return F.replace(c, F.lit("/n"), F.lit(" "))
    return F.regexp_replace(c, "\r\n|\r|\n", " ")


def grouped_number(c: Column) -> Column:
    """``609,513`` as 609513; numbers in text without separators pass, NaN and other text is NULL."""
    return whole_number(F.replace(c, F.lit(","), F.lit("")))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two digits, NULL when ``whole`` is zero."""
    return F.round(F.try_divide(F.lit(100) * part, whole), 2)


def ascii_only(c: Column) -> Column:
    """Drop non-ASCII characters, then make each run of two or more spaces or newlines one space."""
    return F.regexp_replace(F.regexp_replace(c, r"[^\x00-\x7F]", ""), r"[\s\x1c-\x1f]{2,}", " ")


def strip_quotes(c: Column) -> Column:
    """Outer double quotes off, spaces at the end off, then both again at the end."""
    quote, spaces = F.lit('"'), F.lit(SPACES)
    return F.rtrim(F.rtrim(F.rtrim(F.btrim(c, quote), spaces), quote), spaces)


def number_list(c: Column) -> Column:
    """``['0.1', '-0.2']`` as an array of doubles."""
    return F.transform(F.split(F.regexp_replace(c, r"[\[\]']", ""), ","), real_number)


def word_list(c: Column, keep_empty: bool = False) -> Column:
    """``['good', 'bad']`` as an array of words; ``[]`` is empty unless ``keep_empty``."""
    words = F.transform(F.split(c, ","), lambda x: F.regexp_replace(x, r"(?U)\W", ""))
    return words if keep_empty else F.array_remove(words, "")


def positional(c: Column) -> Column:
    """A number as plain digits without an exponent: the shortest that read back as the same double.

    NaN and the infinities are NULL, as is text that is no number.
    """
    shortest = r"\A(-?)(\d+)\.(\d+)(?:E(-?\d+))?\z"
    text = c.try_cast("double").cast("string")
    sign, whole, part = (F.regexp_extract(text, shortest, i) for i in (1, 2, 3))
    shift = F.coalesce(F.regexp_extract(text, shortest, 4).try_cast("int"), F.lit(0))
    digits = F.concat(whole, F.regexp_replace(part, r"0+\z", ""))
    point = F.length(whole) + shift  # where the point stands in the digits
    moved = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits), F.concat(F.rpad(digits, point, F.lit("0")), F.lit(".0")))
        .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1)))
    )
    return F.when(F.rlike(text, F.lit(shortest)), F.when(shift == 0, text).otherwise(F.concat(sign, moved)))


def header_value_record(c: Column) -> Column:
    """``[["h1","h2"],["v1","v2"]]`` as a map from header to value.

    A header that occurs again replaces the earlier one, missing values are NULL, values
    beyond the headers and headers that are null are left out, and a reply without headers is NULL.
    """
    rows = F.from_json(c, "array<array<string>>")
    headers, values = F.get(rows, F.lit(0)), F.get(rows, F.lit(1))
    entries = F.transform(headers, lambda h, i: F.struct(h.alias("h"), F.get(values, i).alias("v"), i.alias("i")))
    last = F.filter(
        entries,
        lambda e: e["h"].isNotNull()
        & ~F.coalesce(F.array_contains(F.slice(headers, e["i"] + 2, F.size(headers)), e["h"]), F.lit(False)),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["h"], e["v"])))
