"""Joins (C1-C13).

Skew: every equi join relies on AQE's skew-join split
(``spark.sql.adaptive.skewJoin.enabled``); :func:`salted_join` spreads a hot
key explicitly. Lookups are broadcast only when their size is proven
(:func:`broadcast_dim`) or fixed by construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators._util import as_list, broadcast_dim, key_pairs


def _on(left: DataFrame, right: DataFrame, key) -> tuple[Column | list, bool]:
    pairs = key_pairs(key)
    if all(a == b for a, b in pairs):
        return [a for a, _ in pairs], True
    cond = reduce(lambda x, y: x & y, [left[a] == right[b] for a, b in pairs])
    return cond, False


def join_inner(child: DataFrame, parent: DataFrame, key) -> DataFrame:
    """Rows whose foreign key resolves (one row per matching pair)."""
    on, _ = _on(child, parent, key)
    return child.join(parent, on, "inner")


def lookup(df: DataFrame, ref: DataFrame, on, bounded: bool = False) -> DataFrame:
    """Left join to a lookup; unmatched rows are kept (for quarantine).

    ``bounded=True`` declares the lookup fixed-size (e.g. a 25-row nation
    list) and broadcasts it; otherwise statistics and AQE's measured sizes
    choose, with no extra job.
    """
    if bounded:
        ref = broadcast_dim(ref)
    cond, _ = _on(df, ref, on)
    return df.join(ref, cond, "left")


def orphans(child: DataFrame, parent: DataFrame, key) -> DataFrame:
    """Child rows whose foreign key has no parent (NULL keys included:
    a NULL never resolves)."""
    pairs = key_pairs(key)
    keys = parent.select(*[F.col(b).alias(f"_pk{i}") for i, (_, b) in enumerate(pairs)])
    cond = reduce(lambda x, y: x & y, [child[a] == keys[f"_pk{i}"] for i, (a, _) in enumerate(pairs)])
    return child.join(keys, cond, "left_anti")


def join_multi_key(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """C4: join on two or more columns."""
    on, _ = _on(left, right, keys)
    return left.join(right, on, how)


def fan_out(df: DataFrame, name: str, values) -> DataFrame:
    """C5 (re-aimed): repeat each row once per value of a short, fixed list
    (scenarios, calendars). Built with ``explode`` of a literal array inside
    each task: no Cartesian join, no shuffle."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def range_join_months(facts: DataFrame, start: str, end: str, month_col: str = "month") -> DataFrame:
    """Each row joined to every month start in ``[start, end]``.

    The theta join against a month spine becomes a generator: one
    ``sequence`` per row, no nested loop, no shuffle.
    """
    from strata.operators.nested import expand_months

    return expand_months(facts, start, end, month_col)


def star_join(fact: DataFrame, dims) -> DataFrame:
    """Join one fact to several dimensions.

    ``dims`` is a list of ``(dim_df, key, how)``, ``key`` as for
    :func:`join_inner`; the fact side stays on the left (fact-first order).
    """
    out = fact
    for dim, key, *rest in dims:
        how = rest[0] if rest else "left"
        on, _ = _on(out, dim, key)
        out = out.join(dim, on, how)
    return out


def aggregate_then_join(left: DataFrame, right: DataFrame, keys, how: str = "full") -> DataFrame:
    """Two facts already aggregated to one grain, joined on that grain.

    Both sides are small per key after partial aggregation; a full outer
    join keeps grains present on one side only.
    """
    return left.join(right, as_list(keys), how)


def join_current(df: DataFrame, dim: DataFrame, key, current_col: str = "is_current", how: str = "left") -> DataFrame:
    """Join to the current SCD2 version only (no fan-out over history)."""
    cur = dim.where(F.col(current_col)).drop(current_col)
    on, _ = _on(df, cur, key)
    return df.join(cur, on, how)


def changed_rows(src: DataFrame, current: DataFrame, key, hash_col: str = "_hash") -> DataFrame:
    """C11: source rows of existing keys whose change hash differs."""
    cur = current.select(*as_list(key), F.col(hash_col).alias("_cur_hash"))
    return (
        src.join(cur, as_list(key), "inner")
        .where(F.col(hash_col) != F.col("_cur_hash"))
        .drop("_cur_hash")
    )


def salted_join(big: DataFrame, small: DataFrame, key, n: int = 16, how: str = "inner",
                row_id: list | None = None) -> DataFrame:
    """Equi join with each key spread over ``n`` tasks.

    The big side gets a salt from a hash of its own columns (repeatable on a
    task retry, unlike ``rand()``; identical rows share one); the small side
    is replicated once per salt value with ``explode(sequence)``. Same rows as
    the plain join, for inner, left, semi and anti joins; right and full
    joins would repeat the unmatched rows of the replicated side and are
    rejected. The replicated side is never broadcast: plan statistics do not
    see the ``n`` copies, and a broadcast would need no salt.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"):
        raise ValueError(f"salted_join replicates the right side: a {how} join would repeat its unmatched rows")
    keys = as_list(key)
    salt_src = [F.col(c) for c in (row_id or big.columns)]
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_src), F.lit(n)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).hint("merge")
    return b.join(s, keys + ["_salt"], how).drop("_salt")


def split_fk(child: DataFrame, parent: DataFrame, key, flag: str = "_fk_ok") -> DataFrame:
    """Mark each child row valid or orphan in one pass (one join instead
    of an inner join plus an anti join). Parent keys are de-duplicated first
    so the join never multiplies child rows."""
    pairs = key_pairs(key)
    keys = (
        parent.select(*[F.col(b).alias(f"_pk{i}") for i, (_, b) in enumerate(pairs)])
        .dropDuplicates()
        .withColumn("_hit", F.lit(True))
    )
    cond = reduce(lambda x, y: x & y, [child[a] == keys[f"_pk{i}"] for i, (a, _) in enumerate(pairs)])
    out = child.join(keys, cond, "left")
    return out.withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop(
        "_hit", *[f"_pk{i}" for i in range(len(pairs))]
    )


def join_as_of(facts: DataFrame, versions: DataFrame, key, ts: str,
               valid_from: str = "effective_from", valid_to: str = "effective_to",
               attrs=None, bucket: str = "day", split: str = "bucket") -> DataFrame:
    """Each fact row with the attributes of the version in force at
    ``ts`` (``valid_from <= ts < valid_to``, NULL ``valid_to`` = open).

    Built without emitting fact x version pairs: facts and version starts are
    stacked and ordered per (key, piece) (``operators.sequence``: time
    buckets by default, or range partitions); the last version start seen is
    carried forward. A fact whose piece holds no earlier start takes the last
    version of the nearest earlier piece, found on a per-(key, piece) summary
    (one row per occupied piece), so a hot key is spread over many tasks and
    no row is replicated per piece it spans. Facts with
    no version in force, or with a NULL key, get NULL attributes (left semantics).
    """
    keys = as_list(key)
    attrs = as_list(attrs) or [c for c in versions.columns if c not in keys + [valid_from, valid_to]]
    packed = F.struct(F.col("_t").alias("vf"), F.col("_vt").alias("vt"), *[F.col(a).alias(a) for a in attrs])
    v = versions.dropna(subset=keys).select(*keys, F.col(valid_from).cast("timestamp").alias("_t"),
                        F.col(valid_to).cast("timestamp").alias("_vt"), *attrs)
    v = v.select(*keys, "_t", F.lit(0).alias("_kind"), packed.alias("_ver"))
    ver_type = v.schema["_ver"].dataType
    f = facts.withColumn("_t", F.col(ts).cast("timestamp")).withColumn("_kind", F.lit(1)) \
        .withColumn("_ver", F.lit(None).cast(ver_type))
    from strata.operators.sequence import _with_piece, split_pieces

    stacked = split_pieces(f.unionByName(v, allowMissingColumns=True), keys, ["_t", "_kind"], bucket, split)
    w = (Window.partitionBy(*keys, "_b").orderBy("_t", "_kind", F.col("_ver.vf").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = stacked.withColumn("_in", F.last("_ver", ignorenulls=True).over(w)).where(F.col("_kind") == 1)
    # newest version started in each occupied bucket, carried to later buckets
    summary = stacked.groupBy(*keys, "_b").agg(F.max_by("_ver", F.when(F.col("_kind") == 0, F.col("_t"))).alias("_bl"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, "_b", F.last("_bl", ignorenulls=True).over(wb).alias("_carry"))
    res = _with_piece(inner, summary, keys).withColumn("_cur", F.coalesce("_in", "_carry"))
    in_force = F.col("_cur.vf").isNotNull() & (F.col("_cur.vt").isNull() | (F.col("_t") < F.col("_cur.vt")))
    return res.select(
        *facts.columns,
        *[F.when(in_force, F.col(f"_cur.{a}")).alias(a) for a in attrs],
    )
