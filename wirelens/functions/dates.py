"""Dates of feeds and press pages, as native columns in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_MONTH = "(" + "|".join(MONTHS) + ")"


def _day(year: Column, month: Column, day: Column) -> Column:
    """Midnight of a calendar day; null where there is no such day."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))


def _groups(text: Column, pattern: str) -> list[Column]:
    return [F.nullif(F.regexp_extract(text, pattern, i), F.lit("")) for i in (1, 2, 3)]


def _month_number(name: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(name)).cast("int")


def iso_attribute(value: Column) -> Column:
    """The datetime attribute of a time element; without a zone it is UTC."""
    fits = value.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    return F.when(fits, F.try_to_timestamp(value))


def text_date(text: Column) -> Column:
    """15 March 2024, March 15, 2024, 2024-03-15, 03.15.24 (month first): the first of these forms whose first match is a real day."""
    d, m, y = _groups(text, rf"(?i)(\d{{1,2}})\s+{_MONTH}\s+(\d{{4}})")
    first = _day(y, _month_number(m), d)
    m, d, y = _groups(text, rf"(?i){_MONTH}\s+(\d{{1,2}}),?\s+(\d{{4}})")
    second = _day(y, _month_number(m), d)
    third = _day(*_groups(text, r"(\d{4})-(\d{2})-(\d{2})"))
    m, d, y = _groups(text, r"(\d{2})\.(\d{2})\.(\d{2,4})")
    year = y.try_cast("int")
    fourth = _day(F.when(year < 100, year + 2000).otherwise(year), m, d)
    return F.coalesce(first, second, third, fourth)


def url_date(href: Column) -> Column:
    """/YYYY/MM/DD/ or /YYYY/MM/ in a link, from 2000 to 2100."""
    y, m, d = _groups(href, r"/(\d{4})/(\d{2})(?:/(\d{2}))?(?:/|$)")
    fits = y.try_cast("int").between(2000, 2100) & m.try_cast("int").between(1, 12)
    return F.when(fits, _day(y, m, F.coalesce(d, F.lit("01"))))


def date_cascade(attribute: Column, text: Column, href: Column) -> Column:
    return F.coalesce(iso_attribute(attribute), text_date(text), url_date(href))


def feed_date(c: Column) -> Column:
    """RFC 822 or ISO date of a feed entry."""
    bare = F.regexp_replace(F.trim(c), r"^[A-Za-z]+,\s*", "")
    zoned = F.regexp_replace(bare, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    forms = [F.try_to_timestamp(zoned, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy")]
    return F.coalesce(*forms, iso_attribute(F.trim(c)))


def within(published: Column, now: Column, hours: int | None) -> Column:
    """In the window: undated entries and the boundary itself are; no hours, no limit."""
    if not hours:
        return F.lit(True)
    return published.isNull() | (published >= now - F.expr(f"INTERVAL {int(hours)} HOURS"))
