"""Date parsing and calendar attributes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._col import as_col, as_lit

# The date layouts the dirty sources use, tried in this order.
# They are unambiguous by separator and position.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy")


def parse_date(c, formats=DATE_FORMATS) -> Column:
    """The first format that parses wins; otherwise NULL (never raises).

    Impossible dates such as ``2020-02-30`` are NULL. Only text of a format's
    shape is parsed with it: a failed parse costs an exception a value.
    """
    s = F.trim(as_col(c).cast("string"))

    def parsed(f: str) -> Column:
        day = F.to_date(F.try_to_timestamp(s, F.lit(f)))
        digits = re.sub("yyyy|MM|dd", lambda m: rf"\d{{{len(m[0])}}}", f)
        return day if re.search("[A-Za-z]", digits.replace(r"\d", "")) else F.when(s.rlike(f"^{digits}$"), day)

    return F.coalesce(*map(parsed, formats))


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """ISO text -> timestamp, NULL when it does not parse."""
    s = as_col(c).cast("string")
    return F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)


def flag_future(c, as_of=None) -> Column:
    """The date lies after ``as_of`` (default: today)."""
    ref = F.current_date() if as_of is None else F.to_date(as_lit(as_of))
    return as_col(c) > ref


def date_key(c) -> Column:
    """``yyyyMMdd`` as int, by integer arithmetic (no string format)."""
    d = F.to_date(as_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(c) -> Column:
    """``yyyyMM`` as int."""
    d = F.to_date(as_col(c))
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_start(c) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(as_col(c)), "month")


def year_month(c) -> Column:
    """``yyyy-MM`` text."""
    return F.date_format(as_col(c), "yyyy-MM")


def calendar_attributes(c) -> list[Column]:
    """The calendar columns of a date dimension (day_of_week 1 = Sunday)."""
    d = F.to_date(as_col(c))
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.trunc(d, "month").alias("first_of_month"),
        F.last_day(d).alias("last_of_month"),
    ]


def whole_months_between(start, end) -> Column:
    """Completed calendar months from ``start`` to ``end`` (anniversary rule):
    month difference, minus one when ``end``'s day-of-month is before
    ``start``'s. Integer arithmetic only."""
    s, e = F.to_date(as_col(start)), F.to_date(as_col(end))
    diff = (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))
    return (diff - F.when(F.dayofmonth(e) < F.dayofmonth(s), 1).otherwise(0)).cast("int")


def tenure_months(c, as_of) -> Column:
    """Whole months from ``c`` to ``as_of``."""
    return whole_months_between(c, F.to_date(as_lit(as_of)))


def tenure_years(c, as_of) -> Column:
    """Whole years from ``c`` to ``as_of``."""
    return F.floor(tenure_months(c, as_of) / 12).cast("int")


def band(c, edges, labels=None, below: str | None = None) -> Column:
    """Label of the half-open band ``[edges[i], edges[i+1])``.

    ``labels`` defaults to ``"lo-hi"`` / ``"lo+"``; values under the first
    edge get ``below`` (NULL by default). Exact ``when`` ladder.
    """
    c = as_col(c)
    edges = list(edges)
    if labels is None:
        labels = [f"{lo}-{hi - 1}" if isinstance(hi, int) else f"{lo}-{hi}" for lo, hi in zip(edges, edges[1:])]
        labels.append(f"{edges[-1]}+")
    if len(labels) != len(edges):
        raise ValueError("need one label per edge")
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    out = out.when(c < edges[0], F.lit(below).cast("string"))
    for hi, label in zip(edges[1:], labels):
        out = out.when(c < hi, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))
