"""Dates in file contents, file names and name patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_trade_date(text: Column) -> Column:
    """Date from ISO, ``d-MON-yyyy`` or ``d-MON-yy`` text (20yy); NULL when unreadable."""
    return F.coalesce(
        F.try_to_date(text, "yyyy-MM-dd"),
        F.try_to_date(text, "d-MMM-yyyy"),
        F.try_to_date(text, "d-MMM-yy"),
    )


def date_in_filename(name: Column) -> Column:
    """Trading date spelled in an exchange file name, NULL when there is none."""
    upper = F.upper(name)
    # The three ways exchange file names spell a date.
    return F.coalesce(
        F.try_to_date(F.regexp_extract(upper, r"EQ(\d{6})", 1), "ddMMyy"),
        F.try_to_date(F.regexp_extract(upper, r"CM(\d{2}[A-Z]{3}\d{4})BHAV", 1), "ddMMMyyyy"),
        F.try_to_date(F.regexp_extract(upper, r"_(\d{8})_F_", 1), "yyyyMMdd"),
    )


def render_date_pattern(pattern: Column, day: Column) -> Column:
    """Replace the date tokens of a file name or URL pattern, longest token first."""
    # Token -> date format.
    tokens = {
        "YYYYMMDD": "yyyyMMdd", "YYYY": "yyyy", "YY": "yy", "MON": "MMM", "MM": "MM", "DD": "dd",
    }
    rendered = pattern
    for token, style in tokens.items():
        rendered = F.replace(rendered, F.lit(token), F.upper(F.date_format(day, style)))
    return rendered


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def days_between(start: Column, end: Column) -> Column:
    """Array of every calendar day from ``start`` to ``end``; NULL when reversed."""
    return F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 DAY")))
