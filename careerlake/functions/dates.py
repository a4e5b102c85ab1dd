"""Posting dates.

Texts are read as dateutil reads them, month before day, by column expressions: numbers with dashes or slashes, ISO dates with times, months by
name in any order, weekdays and ordinals; and what can't be a date, as it holds a word that no date has, is told by its words. Only texts that are neither
go to dateutil itself: as distinct texts while they are few, else in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from careerlake.functions.text import strip
from careerlake.functions.urls import _let

#: So many distinct texts at most are read on the driver and sent to all tasks.
MOST_LEFT = 10_000
# The words that dates are written with.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
MONTH = "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
WEEKDAY = "(?:mon(?:day)?|tue(?:sday)?|wed(?:nesday)?|thu(?:rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?)"
OTHERS = "at|on|and|ad|of|st|nd|rd|th|h|hours?|m|minutes?|s|seconds?|am?|pm?|utc|gmt|[tz]"
ORDINAL, TIME = "([0-9]{1,2})(?:st|nd|rd|th)?", "(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.][0-9]{1,6})?)?"
START = f"(?i)^(?:{WEEKDAY},? +)?"
ISO = f"^([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}})(?:[Tt ]{TIME}(?:[Zz]|[+-](?:0[0-9]|1[0-3]):?[0-5][0-9])?)?$"
NUMBERS = "^([0-9]{1,2})([-/])([0-9]{1,2})\\2([0-9]{2}|[1-9][0-9]{3})$"
MONTH_DAY_YEAR = f"{START}{MONTH}[.]? +{ORDINAL},? +([0-9]{{4}})$"
DAY_MONTH_YEAR = f"{START}{ORDINAL}(?:(?: of)? +|-){MONTH}(?:[.]?,? +|-)([0-9]{{4}})$"
MONTH_YEAR = f"(?i)^{MONTH}[.]?,? +([0-9]{{4}})$"
MONTH_DAY = f"(?i)^{MONTH}[.]? +{ORDINAL}$"
DAY_MONTH = f"(?i)^{ORDINAL}(?: of)? +{MONTH}$"
#: A word that no date has: none of these, nor three to five capitals, which may name a time zone.
NO_WORD = rf"(?<!\p{{L}})(?!(?i:{MONTH}|{WEEKDAY}|{OTHERS})(?!\p{{L}}))(?![A-Z]{{3,5}}(?!\p{{L}}))\p{{L}}+"


#: Each form, and its year, month and day, of which one may be left out; "n" marks two numbers that may be the other way round.
FORMS = ((ISO, "$1|$2|$3"), (NUMBERS, "$4|$1|$3|n"), (MONTH_DAY_YEAR, "$3|$1|$2"), (DAY_MONTH_YEAR, "$3|$2|$1"), (MONTH_YEAR, "$2|$1|"), (MONTH_DAY, "|$1|$2"), (DAY_MONTH, "|$2|$1"))


def _day(y: Column, m: Column, d: Column | int) -> Column:
    """Null if there is no such day. Years before 1000 are left to the parser."""
    return F.when(y >= 1000, F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d if isinstance(d, Column) else F.lit(d)), "yyyy-MM-dd"))


def _full_year(n: Column) -> Column:
    """A two-digit year is the one within fifty years of now."""
    now = F.year(F.current_date())
    near = n + F.floor(now / 100).cast("int") * 100
    return F.when(near >= now + 50, near - 100).when(near < now - 50, near + 100).otherwise(near)


def _date(parts: Column, run_day: Column) -> Column:
    """The date of year, month (a number or a name) and day."""
    y, m, d = (parts[k] for k in range(3))
    year = F.when(y == "", F.year(run_day)).when(F.length(y) == 2, _full_year(y.cast("int"))).otherwise(y.try_cast("int"))
    named = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(m, 1, 3))).cast("int")
    fields = F.struct(year.alias("y"), F.coalesce(m.try_cast("int"), named).alias("m"), F.nullif(d, F.lit("")).cast("int").alias("d"), (F.size(parts) == 4).alias("either"))
    whole = lambda x: F.when(x.d.isNull(), F.when(run_day.isNotNull(), _day(x.y, x.m, F.least(F.dayofmonth(run_day), F.dayofmonth(F.last_day(_day(x.y, x.m, 1))))))).when(x.either & (x.m > 12) & (x.m <= 31), _day(x.y, x.d, x.m)).otherwise(_day(x.y, x.m, x.d))
    return F.date_format(_let(fields, whole), "yyyy-MM-dd")


def plain_date(text: Column, run_date: Column) -> Column:
    """yyyy-MM-dd of a stripped text by expressions alone; '' if it can't be a date, null if that isn't known here. The text is bound once, and so are its parts."""
    run_day = F.try_to_date(run_date.cast("string"), "yyyy-MM-dd")

    def of(t: Column) -> Column:
        fields = F.lit(None).cast("string")
        for form, order in reversed(FORMS):
            fields = F.when(t.rlike(form), F.regexp_replace(t, form, order)).otherwise(fields)
        return _let(fields, lambda x: F.when(x.isNotNull(), _date(F.split(x, r"\|"), run_day)).when((t == "") | t.rlike(NO_WORD), ""))

    return _let(text, of)


def read_date(text: str, run_date: str | None) -> str | None:
    """What dateutil reads, as yyyy-MM-dd; null if it can't.

    What a text leaves out is taken from the run's date, so that the same text gives the same date on every run of a day;
    without one, or if it isn't a date, only whole dates are read.
    """
    from dateutil import parser

    try:
        default = datetime.fromisoformat(run_date) if run_date else None
    except ValueError:
        default = None
    try:
        if default is not None:
            return parser.parse(text, default=default).date().isoformat()
        both = {parser.parse(text, default=d).date().isoformat() for d in (datetime(2001, 1, 1), datetime(2004, 12, 28))}
        return both.pop() if len(both) == 1 else None
    except (ValueError, OverflowError, TypeError):
        return None


@F.pandas_udf(StringType())
def lenient_date(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """read_date of two columns, each pair once while they are few."""
    known: dict[tuple[str, str | None], str | None] = {}

    def one(text: str | None, run_date: str | None) -> str | None:
        if text is None:
            return None
        key = (text, run_date)
        if key not in known:
            if len(known) > 100_000:
                known.clear()
            known[key] = read_date(*key)
        return known[key]

    for texts, days in batches:
        yield pd.Series([one(t, d) for t, d in zip(texts, days, strict=True)], dtype=object)


def _kept(c: Column, read: Column, text: Column) -> Column:
    """The date read; a text that isn't one stripped; null and '' as they are."""
    return F.when(F.coalesce(c, F.lit("")) == "", c).otherwise(F.coalesce(read, text))


def _known(plain: Column) -> Column:
    """The date of plain_date, null for what isn't one."""
    return _let(plain, lambda p: F.when(p != "", p))


def normalize_date(c: Column, run_date: str | Column | None = None) -> Column:
    """yyyy-MM-dd of a date text; a text that can't be read is stripped only; null and '' stay.

    Without run_date (a date or a column) only ISO dates and M/d/yyyy are read; with it all that dateutil reads, what expressions can't tell in Arrow batches.
    """
    text = strip(c)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd"))
    us = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.date_format(F.try_to_date(text, "M/d/yyyy"), "yyyy-MM-dd"))
    if run_date is None:
        return _kept(c, F.coalesce(iso, us), text)
    day = F.lit(run_date) if isinstance(run_date, str) else run_date
    # what is handed to the parser has no bound variables in it: an expression with a Python function can't be split off with them
    left = F.when(iso.isNull() & us.isNull() & (text != "") & ~text.rlike(NO_WORD), text)
    return _kept(c, F.coalesce(iso, us, lenient_date(left, day.cast("string"))), text)


def normalize_dates(rows: DataFrame, column: str, run_date: str | Column) -> DataFrame:
    """rows with normalize_date of a column, without Python where its texts don't need any.

    The distinct texts that expressions can't tell are looked for first, which reads that column alone. Usually there are none. Up to MOST_LEFT are read on the
    driver and joined; more, and streams, go in Arrow batches.
    """
    day = (F.lit(run_date) if isinstance(run_date, str) else run_date).cast("string")
    if rows.isStreaming:
        return rows.withColumn(column, normalize_date(F.col(column), day))
    text = strip(F.col(column))
    plain = plain_date(text, day)
    asked = rows.select(text.alias("text"), day.alias("day"), plain.alias("plain")).filter("plain is null and text is not null").select("text", "day").distinct()
    left = asked.limit(MOST_LEFT + 1).collect()
    if len(left) > MOST_LEFT:
        return rows.withColumn(column, normalize_date(F.col(column), day))
    if not left:
        return rows.withColumn(column, _let(text, lambda t: _kept(F.col(column), _known(plain_date(t, day)), t)))
    known = rows.sparkSession.createDataFrame([(r["text"], r["day"], read_date(r["text"], r["day"])) for r in left], "_text string, _day string, _read string")
    met = rows.join(F.broadcast(known), (F.col("_text") == text) & F.col("_day").eqNullSafe(day), "left")  # at most MOST_LEFT rows
    return met.withColumn(column, _kept(F.col(column), F.coalesce(_known(plain), F.col("_read")), text)).select(*[f"`{c}`" for c in rows.columns])
