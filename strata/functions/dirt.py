"""Deterministic dirt (Y9-Y17) as column expressions.

Every decision depends only on a ``pick`` column (an integer in
``[0, n)``), derived either from a hash of (seed, column, row id) for
generated data, or from a key for round-trip checks. So the same row gets
the same dirt on any cluster, partitioning or retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._col import as_col, as_lit

SCALE = 10_000  # picks are drawn from [0, SCALE)


def hash_pick(seed: int, name: str, *ids, n: int = SCALE) -> Column:
    """Uniform integer in ``[0, n)`` from (seed, name, ids)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(name), *[as_col(i) for i in ids]), F.lit(n))


def hash_unit(seed: int, name: str, *ids) -> Column:
    """Uniform double in ``[0, 1)``."""
    return hash_pick(seed, name, *ids, n=1 << 30).cast("double") / float(1 << 30)


def hit(pick, rate: float, n: int = SCALE) -> Column:
    return as_col(pick) < F.lit(int(round(rate * n)))


def inject_nulls(c, pick, rate: float, n: int = SCALE) -> Column:
    """NULL for a ``rate`` share of rows."""
    return F.when(hit(pick, rate, n), F.lit(None)).otherwise(as_col(c))


def casing_variant(c, variant) -> Column:
    """Y10 shapes: 0 upper, 1 lower, 2 padded, 3 doubled inner spaces."""
    c, v = as_col(c), as_col(variant)
    return (
        F.when(v == 0, F.upper(c))
        .when(v == 1, F.lower(c))
        .when(v == 2, F.concat(F.lit("  "), c, F.lit(" ")))
        .when(v == 3, F.regexp_replace(c, " ", "  "))
        .otherwise(c)
    )


def inject_casing(c, pick, rate: float, n: int = SCALE) -> Column:
    """A ``rate`` share of rows get one of the four casing shapes."""
    return F.when(hit(pick, rate, n), casing_variant(c, F.pmod(as_col(pick), F.lit(4)))).otherwise(as_col(c))


def inject_invalid_category(c, pick, pool, rate: float, n: int = SCALE) -> Column:
    """Replace a ``rate`` share of values with one from ``pool``."""
    arr = F.array(*[F.lit(x) for x in pool])
    chosen = F.element_at(arr, (F.pmod(as_col(pick), F.lit(len(pool))) + 1).cast("int"))
    return F.when(hit(pick, rate, n), chosen).otherwise(as_col(c))


def money_text(c, variant) -> Column:
    """Y12 shapes of an amount: 0 ``$1,234.50``, 1 ``"  1234.5 "``,
    2 decimal comma ``1234,50``, 3 ``$-`` sign inside; else plain."""
    x, v = as_col(c), as_col(variant)
    two = F.format_string("%.2f", x)
    return (
        F.when(v == 0, F.concat(F.lit("$"), F.format_number(x, 2)))
        .when(v == 1, F.concat(F.lit("  "), x.cast("string"), F.lit(" ")))
        .when(v == 2, F.regexp_replace(two, r"\.", ","))
        .when(v == 3, F.concat(F.lit("$-"), F.format_number(-x, 2)))
        .otherwise(x.cast("string"))
    )


def inject_numeric_as_string(c, pick, rate: float, n: int = SCALE) -> Column:
    """A ``rate`` share of amounts written as text shapes."""
    return F.when(hit(pick, rate, n), money_text(c, F.pmod(as_col(pick), F.lit(3)))).otherwise(as_col(c).cast("string"))


def date_text(c, variant) -> Column:
    """Y13 shapes: 0 ``MM/dd/yyyy``, 1 ``dd-MM-yyyy``, 2 shifted +5 years,
    3 ``not_a_date``; else ``yyyy-MM-dd``."""
    d, v = F.to_date(as_col(c)), as_col(variant)
    return (
        F.when(v == 0, F.date_format(d, "MM/dd/yyyy"))
        .when(v == 1, F.date_format(d, "dd-MM-yyyy"))
        .when(v == 2, F.date_format(F.add_months(d, 60), "yyyy-MM-dd"))
        .when(v == 3, F.lit("not_a_date"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )


def corrupt_dates(c, pick, rate: float, n: int = SCALE) -> Column:
    """A ``rate`` share of dates in a wrong shape."""
    return F.when(hit(pick, rate, n), date_text(c, F.pmod(as_col(pick), F.lit(4)))).otherwise(
        F.date_format(F.to_date(as_col(c)), "yyyy-MM-dd"))


def inject_orphans(c, pick, rate: float, base, n: int = SCALE) -> Column:
    """Replace a ``rate`` share of foreign keys with ``base + pick``
    (ids outside the parent range)."""
    return F.when(hit(pick, rate, n), as_lit(base) + as_col(pick)).otherwise(as_col(c))


def inject_out_of_range(c, pick, rate: float, mode: str = "negate", n: int = SCALE) -> Column:
    """``negate`` flips the sign; ``over`` multiplies by 1.1-1.6;
    ``speed`` gives -x or 300-500."""
    c, p = as_col(c), as_col(pick)
    if mode == "negate":
        bad = -F.abs(c)
    elif mode == "over":
        bad = c * (F.lit(1.1) + F.pmod(p, F.lit(50)).cast("double") / 100.0)
    elif mode == "speed":
        bad = F.when(F.pmod(p, F.lit(2)) == 0, -F.abs(c)).otherwise(F.lit(300.0) + F.pmod(p, F.lit(200)).cast("double"))
    else:
        raise ValueError(mode)
    return F.when(hit(pick, rate, n), bad).otherwise(c)
