"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegraph.sources.schemas import POST_TIME_FORMAT

# Fixed values that must equal the upstream application's for equal results:
# weights of the heat score (like, repost, comment) and the quarter start months.
HEAT_WEIGHTS = (1, 3, 2)
QUARTER_START_MONTHS = (1, 4, 7, 10)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(time: str | Column) -> Column:
    """``yyyy-MM`` bucket of a timestamp."""
    return F.date_format(col_(time), "yyyy-MM")


def month_of_text(time: str | Column) -> Column:
    """``yyyy-MM`` bucket of a text time: its first seven characters."""
    return F.substring(col_(time), 1, 7)


def parse_post_time(text: str | Column) -> Column:
    """Text post time ``year-month-day hour:minute`` -> timestamp; anything else becomes null (never fails).

    Lenient as calendars are: fields may have fewer or more digits than usual
    and roll over (the 30th of February is the 1st or 2nd of March, month 13 is
    January, month 0 December before, hour 25 one o'clock of the next day).
    Blanks before a field and whatever follows the minutes are ignored.  Years
    have one to four digits, other fields one to six; other text is null.
    """
    pattern = r"^[ \t]*(\d{1,4})-[ \t]*(\d{1,6})-[ \t]*(\d{1,6}) [ \t]*(\d{1,6}):[ \t]*(\d{1,6})(?!\d)"
    year, month, day, hour, minute = (
        F.regexp_extract(col_(text), pattern, g).try_cast("int")
        for g in range(1, 6))
    minutes = hour * 60 + minute
    first = F.add_months(F.make_date(F.when(year > 0, year), F.lit(1), F.lit(1)), month - 1)
    date = F.date_add(first, day - 1 + F.floor(minutes / 1440).cast("int"))
    rest = minutes % 1440
    # from the fields of the wall clock, so that a day's length does not matter
    at = F.make_timestamp(F.year(date), F.month(date), F.day(date), F.floor(rest / 60).cast("int"), rest % 60,
                          F.lit(0).cast("decimal(16,6)"))
    return F.when(F.year(date).between(1, 9999), at)


def format_post_time(time: str | Column) -> Column:
    return F.date_format(col_(time), POST_TIME_FORMAT)


def quarter_label(time: str | Column) -> Column:
    """Tumbling quarter label ``<year>_<start month>``: 1, 4, 7 or 10."""
    t = col_(time)
    return F.concat(F.year(t).cast("string"), F.lit("_"), ((F.quarter(t) - 1) * 3 + 1).cast("string"))


def strip_first_char(text: str | Column) -> Column:
    """``@name`` -> ``name`` (drops the first character whatever it is)."""
    t = col_(text)
    return t.substr(F.lit(2), F.length(t))


def heat_score(like: str | Column, repost: str | Column, comment: str | Column) -> Column:
    wl, wr, wc = HEAT_WEIGHTS
    return col_(like) * wl + col_(repost) * wr + col_(comment) * wc


def java_string_hash(text: str | Column) -> Column:
    """32-bit polynomial string hash (base 31, signed), as a JVM string hashes.

    Folded over UTF-16 units with an unsigned 32-bit mask, then mapped to the
    signed range; a character outside the Basic Multilingual Plane is two units.
    """
    t = col_(text)
    units = F.encode(t, "UTF-16BE")
    n = F.floor(F.octet_length(units) / 2)
    unit = lambda i: F.conv(F.hex(F.substring(units, (i * 2 - 1).cast("int"), 2)), 16, 10).cast("bigint")
    unsigned = F.aggregate(
        F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n)).otherwise(F.array().cast("array<bigint>")),
        F.lit(0).cast("bigint"),
        lambda h, i: (h * 31 + unit(i)) % F.lit(4294967296),
    )
    signed = F.when(unsigned >= 2147483648, unsigned - 4294967296).otherwise(unsigned).cast("int")
    return F.when(t.isNull(), F.lit(None).cast("int")).otherwise(signed)
