"""Changes as weighted rows, and the delta rules of joins and aggregates.

A delta holds rows with a weight: +1 a row that is there now and was not, -1
one that was and is no more (a corrected row has one of each). Sums and counts
follow by adding weighted values, so an aggregate is kept up to date by the
delta alone. For a join under an aggregate:

    (A + dA) x (B + dB) - A x B = dA x B + A x dB + dA x dB

``left_join_delta`` is this rule for a left outer join: dA meets the new B, and
the unchanged rows of A whose key dB touches are taken out with the old B and
put back with the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators._util import as_list

WEIGHT = "_w"
SUM_TYPE = "decimal(38,6)"


def keyed_delta(old: DataFrame | None, changes: DataFrame, keys, deleted: str = "_deleted", matched: bool = False) -> DataFrame:
    """Delta of a keyed table under ``changes`` (one row a key, flagged
    ``deleted`` or with the row that counts now): old rows of the keys leave,
    new ones come. ``matched``: ``old`` holds rows of these keys only."""
    keys = as_list(keys)
    new = changes.where(~F.col(deleted)).drop(deleted)
    plus = new.withColumn(WEIGHT, F.lit(1).cast("long"))
    if old is None:
        return plus
    minus = old if matched else old.join(changes.select(*keys), keys, "left_semi")
    minus = minus.select(*new.columns).withColumn(WEIGHT, F.lit(-1).cast("long"))
    return plus.unionByName(minus)


def consolidate(delta: DataFrame) -> DataFrame:
    """Rows that cancel each other leave; equal rows add up."""
    rest = [c for c in delta.columns if c != WEIGHT]
    return delta.groupBy(*rest).agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0)


def left_join_delta(a: DataFrame | None, da: DataFrame, b_old: DataFrame | None, b_new: DataFrame, touched: DataFrame, on) -> DataFrame:
    """Delta of ``A left join B`` on the columns ``on``: ``a`` before the
    change, its delta ``da``, B before and after, ``touched`` the keys at
    which B changed."""
    on = as_list(on)
    out = da.join(b_new, on, "left")
    if a is None:
        return out
    same = a.join(touched.select(*on).distinct(), on, "left_semi")
    b_cols = [c for c in b_new.columns if c not in on]
    before = same.join(b_old, on, "left") if b_old is not None else same.withColumns({c: F.lit(None).cast(b_new.schema[c].dataType) for c in b_cols})
    after = same.join(b_new, on, "left")
    moved = after.withColumn(WEIGHT, F.lit(1).cast("long")).unionByName(before.withColumn(WEIGHT, F.lit(-1).cast("long")))
    return out.unionByName(moved.select(*out.columns))


def aggregate_delta(delta: DataFrame, by, sums: dict[str, str | Column]) -> DataFrame:
    """Per group: ``rows`` (sum of weights) and exact weighted sums (NULL
    counts as zero). Groups in which nothing changes are left out."""
    total = lambda c: F.sum(F.coalesce((F.col(c) if isinstance(c, str) else c).cast(SUM_TYPE), F.lit(0).cast(SUM_TYPE)) * F.col(WEIGHT))
    out = delta.groupBy(*as_list(by)).agg(F.sum(WEIGHT).alias("rows"), *[total(c).cast(SUM_TYPE).alias(n) for n, c in sums.items()])
    moved = F.col("rows") != 0
    for n in sums:
        moved = moved | (F.col(n) != 0)
    return out.where(moved)


def merge_aggregate(state: DataFrame | None, delta: DataFrame, by) -> DataFrame:
    """The state after a delta; a group without rows leaves."""
    by = as_list(by)
    both = delta if state is None else state.unionByName(delta)
    values = [c for c in delta.columns if c not in by]
    added = both.groupBy(*by).agg(*[F.sum(c).cast(delta.schema[c].dataType).alias(c) for c in values])
    return added.where("rows <> 0")
