"""Column builders for dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recallspark.functions import rules as R
from recallspark.functions.text import once, strip


def parse_record_date(c: Column) -> Column:
    """``yyyyMMdd`` or, failing the 8-digit shape, an ISO date in the first ten characters.

    Texts of a fitting shape are cast, which costs a fraction of a formatter; only others are stripped.
    """
    return once(c, parse_settled_date)


def parse_settled_date(text: Column) -> Column:
    """``parse_record_date`` of a column that is there already: without ``once``, which is interpreted row by row."""
    dash = F.lit("-")

    def compact(text: Column) -> Column:
        return F.concat(F.substring(text, 1, 4), dash, F.substring(text, 5, 2), dash, F.substring(text, 7, 2)).try_cast("date")

    def stripped(text: Column) -> Column:
        iso = F.substring(text, 1, 10)
        return (F.when(text.rlike(r"^(?!0000)\d{8}$"), compact(text))
                .when(iso.rlike(r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"), iso.try_cast("date")))

    return (F.when(text.isNull(), F.lit(None).cast("date"))
            .when(text.rlike(r"^(?!0000)\d{8}\z"), compact(text))
            .when(text.rlike(r"^(?!0000)\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))
            .otherwise(once(strip(text), stripped)))


def parse_page_date(c: Column) -> Column:
    """The four date spellings of web alerts, tried in order."""
    # a formatter that fails is dear, so each is tried only on texts with its separator
    spellings = [("/", "M/d/yyyy"), (",", "MMMM d, yyyy"), (",", "MMM d, yyyy"), ("-", "yyyy-M-d")]
    return once(strip(c), lambda text: F.coalesce(
        *[F.when(F.contains(text, F.lit(mark)), F.try_to_date(text, pattern)) for mark, pattern in spellings]))


def month_of(c: Column) -> Column:
    return F.trunc(c, "month")


def season_of(c: Column) -> Column:
    chain = F
    for name, months in R.SEASONS:
        chain = chain.when(F.month(c).isin(*months), name)
    return chain


def season_order(season: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name, _ in R.SEASONS]), season)
