"""Scalar parsing and arithmetic as plain Column expressions.

Every function takes and returns a ``Column`` built from ``pyspark.sql.functions``,
so the whole feature projection stays inside whole-stage codegen; there is no
Python UDF anywhere on the hot path.

Strict by default: under ``spark.sql.ansi.enabled`` a bad number, a clock time
without a colon, an impossible date or a zero divisor fails the job, as the
warehouse script does.  ``lenient=True`` swaps in ``try_cast`` / ``try_divide``
and yields NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DAY_MARK, LENGTH_BANDS, LONG_BAND, MONTH_MARK, URL_ID_PATTERN, YEAR_MARK

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What the warehouse's casts take; Spark's own would also read 1.5d, 0x1p3, inf, nan or the first part of a date.
_NUMBER = r"\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*"
NUMBER_TEXT = f"^{_NUMBER}$"
CLOCK_TEXT = f"^{_NUMBER}:{_NUMBER}$"
DATE_TEXT = r"^[0-9]{1,4}-[0-9]{1,2}-[0-9]{1,2}$"


def _ends_plainly(text: Column) -> Column:
    return F.right(text, F.lit(1)).between(".", "9")


def _odd_number(text: Column) -> Column:
    """True for a text that Spark may read as a double and the warehouse may not; the pattern then decides.

    Every such spelling begins or ends with something else than a plain number does, or has an x.
    """
    return ~_ends_plainly(text) | text.contains("x") | text.contains("X") | (F.ascii(text) <= 32)


def _odd_clock(text: Column, colon: Column) -> Column:
    """The same for a minutes and a seconds part around the first colon."""
    return (_odd_number(text) | ~F.substring(text, colon - 1, F.lit(1)).between(".", "9")
            | (F.ascii(F.substring(text, colon + 1, F.lit(1))) <= 32))


def _odd_date(text: Column) -> Column:
    """The same for dates: anything but four characters, a dash, and a later dash with no time after it."""
    return ((F.instr(text, "-") != 5) | (F.locate("-", text, 6) == 0) | ~F.right(text, F.lit(1)).between("0", "9")
            | text.contains("T") | text.contains(" "))


def _guarded(text: Column, value: Column, odd: Column, pattern: str, type_name: str, what: str, lenient: bool) -> Column:
    """``value`` where the text matches ``pattern``; else NULL (lenient) or an error that names the text.

    Only ``odd`` texts are held against the pattern; all others that can be cast match it.
    """
    refused = odd & ~text.rlike(pattern)
    if lenient:
        return F.when(~F.coalesce(refused, F.lit(True)), value)
    error = F.raise_error(F.concat(F.lit(f"not {what}: "), text)).cast("string").cast(type_name)
    return F.when(refused, error).otherwise(value)


def _cast(text: Column, type_name: str, lenient: bool) -> Column:
    return text.try_cast(type_name) if lenient else text.cast(type_name)


def _to_long(c: Column, lenient: bool) -> Column:
    return _cast(c, "bigint", lenient)


def _empty_to_null(c: Column) -> Column:
    # regexp_extract gives "" when nothing matches; the warehouse gives NULL.
    return F.nullif(c, F.lit(""))


# ---------------------------------------------------------------- ids / text

def extract_url_id(url: ColumnOrName) -> Column:
    """``.../race/202004040406/`` -> ``202004040406``; no trailing slash -> NULL."""
    return _empty_to_null(F.regexp_extract(_col(url), URL_ID_PATTERN, 1))


# ---------------------------------------------------------------- numbers

def to_long(c: ColumnOrName, lenient: bool = False) -> Column:
    """CAST(x AS INT64) of a text: it must be an integer (see double_to_long for doubles)."""
    c = _col(c)
    return _to_long(c, lenient)


def double_to_long(c: ColumnOrName) -> Column:
    """Round-half-away-from-zero conversion of a double, as the warehouse casts."""
    return F.round(_col(c)).cast("bigint")


def to_double(c: ColumnOrName, lenient: bool = False) -> Column:
    """CAST(x AS FLOAT64) of a text."""
    text = _col(c).cast("string")
    return _guarded(text, _cast(text, "double", lenient), _odd_number(text), NUMBER_TEXT, "double", "a number", lenient)


def safe_to_long(c: ColumnOrName) -> Column:
    """SAFE_CAST(x AS INT64): NULL for anything that is not an integer text."""
    return _col(c).try_cast("bigint")


def divide(num: Column, den: Column, lenient: bool = False) -> Column:
    """Division that fails on a zero divisor (ANSI) or gives NULL when lenient."""
    return F.try_divide(num, den) if lenient else num / den


# ---------------------------------------------------------------- clock times

def parse_clock(c: ColumnOrName, lenient: bool = False) -> Column:
    """``m:ss.s`` -> seconds as double: minutes * 60 + seconds.

    Minutes are the characters before the first colon, seconds those after it.
    Without a colon the minutes part is empty, which is a cast error when
    strict and NULL when lenient.
    """
    s = _col(c)
    colon = F.instr(s, ":")
    minutes = _cast(F.left(s, colon - 1), "double", lenient)
    seconds = _cast(F.right(s, F.length(s) - colon), "double", lenient)
    return _guarded(s, minutes * F.lit(60) + seconds, _odd_clock(s, colon), CLOCK_TEXT, "double", "a clock time", lenient)


# ---------------------------------------------------------------- dates

def _dashed(s: Column) -> Column:
    """The text with its year and month marks as dashes and without its day mark."""
    return F.translate(s, YEAR_MARK + MONTH_MARK + DAY_MARK, "--")


def _marked_date(s: Column, date: Column | None) -> Column:
    """True where ``s`` is a date of year, month and day in digits, each before its mark.

    ``date`` is what parse_held_date makes of ``s``, if that is at hand.
    """
    month = F.instr(s, MONTH_MARK)
    shape = (F.instr(s, YEAR_MARK) == 5) & ((month == 7) | (month == 8)) & s.endswith(DAY_MARK)
    date = parse_held_date(s, lenient=True) if date is None else date
    return shape & date.isNotNull()


def held_month(c: ColumnOrName, date: Column | None = None) -> Column:
    """The month with its mark, e.g. ``4月``; NULL when there is none.

    ``date``, here and below, may give what ``parse_held_date`` made of the same text; it saves patterns.
    """
    s = _col(c)
    plain = F.substring(s, F.lit(6), F.instr(s, MONTH_MARK) - 5)
    pattern = _empty_to_null(F.regexp_extract(s, r"\d+" + MONTH_MARK, 0))
    return F.when(_marked_date(s, date), plain).otherwise(pattern)


def held_date_from_parts(c: ColumnOrName, lenient: bool = False) -> Column:
    """DATE(year, month, day) from the three marked numbers of the text.

    The numbers come from one function over an array of the marks.  Spark keeps a
    projection with such a function out of the one generated method of its stage;
    with all parsing in it, that method is too long for the JVM to compile (8,000
    bytes), and runs about four times as long.
    """
    s = _col(c)

    def number(mark):
        digits = F.call_function("regexp_extract", s, F.concat(F.lit(r"(\d+)"), mark), F.lit(1))
        return _cast(_to_long(_empty_to_null(digits), lenient), "int", lenient)

    numbers = F.transform(F.array(*[F.lit(m) for m in (YEAR_MARK, MONTH_MARK, DAY_MARK)]), number)
    parts = [F.get(numbers, i) for i in range(3)]
    if lenient:
        # No try_make_date: go through a y-M-d text and try_to_date, whose years have at most four digits here.
        text = F.concat_ws("-", *[p.cast("string") for p in parts])
        return F.try_to_date(F.when(text.rlike(DATE_TEXT), text), "y-M-d")
    return F.make_date(*parts)


def held_day_of_week(c: ColumnOrName, lenient: bool = False, date: Column | None = None) -> Column:
    """Day of week of the held date, 1 = Sunday .. 7 = Saturday, as a long."""
    s = _col(c)
    from_parts = held_date_from_parts(s, lenient)
    known = parse_held_date(s, lenient=True) if date is None else date
    return F.dayofweek(F.when(_marked_date(s, date), known).otherwise(from_parts)).cast("bigint")


def parse_held_date(c: ColumnOrName, lenient: bool = False) -> Column:
    """``2020年4月4日`` -> DATE 2020-04-04 (drop the day mark, marks to dashes)."""
    dashed = _dashed(_col(c))
    return _guarded(dashed, _cast(dashed, "date", lenient), _odd_date(dashed), DATE_TEXT, "date", "a date", lenient)


# ---------------------------------------------------------------- categories

def length_band(c: ColumnOrName, bands=LENGTH_BANDS, otherwise: str = LONG_BAND) -> Column:
    """Searched CASE on the course length; NULL falls through to ``otherwise``."""
    length = _col(c)
    expr = None
    for upper, label in bands:
        cond = length < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def central_place(c: ColumnOrName, places) -> Column:
    """Predicate ``held_place IN (...)``; a NULL place is not kept."""
    return _col(c).isin(list(places))


# ---------------------------------------------------------------- ratios

def weight_ratio(jockey_weight: ColumnOrName, horse_weight: ColumnOrName, lenient: bool = False) -> Column:
    return divide(to_double(jockey_weight, lenient), to_double(horse_weight, lenient), lenient)


def avg_velocity(course_length: ColumnOrName, goal_time: ColumnOrName, lenient: bool = False) -> Column:
    return divide(to_double(course_length, lenient), parse_clock(goal_time, lenient), lenient)


def avg_half_velocity(course_length: ColumnOrName, half_time: ColumnOrName, lenient: bool = False) -> Column:
    return divide(to_double(course_length, lenient) / F.lit(2), to_double(half_time, lenient), lenient)
