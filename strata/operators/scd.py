"""Change data: SCD1 upsert, SCD2 seed / apply / history, CDC.

There is no table format here, so every operator is a pure function that
returns the *next snapshot* of the dimension; the caller writes it to a new
directory (see ``sources.sinks.write_snapshot``). Dimension schema:
``key..., tracked..., _hash, effective_from, effective_to, is_current``
(``effective_to`` NULL = open interval).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import row_hash, surrogate_key
from strata.operators._util import as_list
from strata.operators.ranking import latest_per_key
from strata.operators.sequence import neighbors

META = ["_hash", "effective_from", "effective_to", "is_current"]


def _latest(src: DataFrame, keys, tracked, ts, tie_break=None) -> DataFrame:
    cols = keys + tracked + [ts] + [c for c in as_list(tie_break) if c not in keys + tracked + [ts]]
    latest = latest_per_key(src.select(*cols), keys, [ts], tie_break)
    return latest.withColumn("_hash", row_hash(tracked))


def scd2_seed(src: DataFrame, key, tracked, ts: str, tie_break=None) -> DataFrame:
    """First load: each key's newest row becomes version 1, open-ended."""
    keys, tracked = as_list(key), as_list(tracked)
    latest = _latest(src, keys, tracked, ts, tie_break)
    ts_type = src.schema[ts].dataType
    return latest.select(
        *keys, *tracked, "_hash",
        F.col(ts).alias("effective_from"),
        F.lit(None).cast(ts_type).alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_apply(dim: DataFrame, src: DataFrame, key, tracked, ts: str, tie_break=None) -> DataFrame:
    """Next snapshot after one batch of source rows.

    * closed versions pass through untouched;
    * a new key opens version 1;
    * a changed key whose batch row is newer than its current version closes
      it (``effective_to`` = batch time) and opens a new version;
    * unchanged keys, and stale rows (batch time <= current
      ``effective_from``, or no time), leave the current version as it is; a
      version that began at an unknown (NULL) time is older than any batch.

    Current rows and the batch's newest rows meet in one full outer join on
    the key; each joined pair emits one or two rows. Replaying a batch is a
    no-op (its rows are unchanged or stale).
    """
    keys, tracked = as_list(key), as_list(tracked)
    out_cols = keys + tracked + META
    closed = dim.where(~F.col("is_current")).select(*out_cols)
    cur = dim.where(F.col("is_current")).select(*out_cols)
    latest = _latest(src, keys, tracked, ts, tie_break)
    ts_type = dim.schema["effective_from"].dataType
    s = latest.select(*keys, F.struct(*[F.col(c) for c in tracked + ["_hash"]],
                                      F.col(ts).cast(ts_type).alias("_ts")).alias("_s"))
    c = cur.select(*keys, F.struct(*[F.col(c) for c in out_cols if c not in keys]).alias("_c"))
    j = c.join(s, keys, "full")

    def version(src_struct, frm, to, current):
        return F.struct(*[F.col(f"{src_struct}.{t}").alias(t) for t in tracked],
                        F.col(f"{src_struct}._hash").alias("_hash"),
                        frm.cast(ts_type).alias("effective_from"),
                        to.cast(ts_type).alias("effective_to"),
                        F.lit(current).alias("is_current"))

    keep_cur = version("_c", F.col("_c.effective_from"), F.col("_c.effective_to"), True)
    close_cur = version("_c", F.col("_c.effective_from"), F.col("_s._ts"), False)
    open_new = version("_s", F.col("_s._ts"), F.lit(None), True)
    newer = F.coalesce(F.col("_s._ts") > F.col("_c.effective_from"), F.col("_s._ts").isNotNull())  # NULL start: oldest
    changed = (F.col("_c._hash") != F.col("_s._hash")) & newer
    rows = (
        F.when(F.col("_c").isNull(), F.array(open_new))
        .when(F.col("_s").isNull(), F.array(keep_cur))
        .when(changed, F.array(close_cur, open_new))
        .otherwise(F.array(keep_cur))
    )
    nxt = j.select(*keys, F.explode(rows).alias("_v")).select(*keys, "_v.*")
    return closed.unionByName(nxt.select(*out_cols))


def scd2_stale(dim: DataFrame, src: DataFrame, key, tracked, ts: str, tie_break=None) -> DataFrame:
    """Batch rows ignored by :func:`scd2_apply` because they are not newer
    than the current version (trap 11: counted, never applied)."""
    keys, tracked = as_list(key), as_list(tracked)
    latest = _latest(src, keys, tracked, ts, tie_break)
    cur = dim.where(F.col("is_current")).select(*keys, F.col("effective_from").alias("_cur_from"),
                                                   F.col("_hash").alias("_cur_hash"))
    return latest.join(cur, keys).where(
        (F.col(ts) <= F.col("_cur_from")) & (F.col("_hash") != F.col("_cur_hash"))
    ).drop("_cur_from", "_cur_hash")


def scd2_history(changes: DataFrame, key, tracked, ts: str, tie_break=None, unit: str = "day", split: str = "bucket") -> DataFrame:
    """Full version history from *all* change rows, not only the newest
    per batch: rows equal to the previous row of their key are dropped, and
    each kept row is closed by the next kept row's time.

    Ordered per (key, time bucket) with a bucket-border carry (see
    ``operators.sequence``; ``split="range"`` for bursts), so one busy key is
    spread over many tasks. Changes without a time come first; a key's last
    kept row is its current version.
    """
    keys, tracked = as_list(key), as_list(tracked)
    order = [ts] + as_list(tie_break)
    base = changes.select(*dict.fromkeys(keys + tracked + order)).withColumn("_hash", row_hash(tracked))
    with_prev = neighbors(base, keys, order, ["_hash"], unit, split=split)
    kept = with_prev.where(F.col("prev__hash").isNull() | (F.col("prev__hash") != F.col("_hash"))).drop(
        "prev__hash", "next__hash")
    with_next = neighbors(kept.withColumn("_any", F.lit(True)), keys, order, [ts, "_any"], unit, prefix_next="_nx_", split=split)
    return with_next.select(
        *keys, *tracked, "_hash",
        F.col(ts).alias("effective_from"),
        F.col(f"_nx_{ts}").alias("effective_to"),
        F.col("_nx__any").isNull().alias("is_current"),
    )


def scd2_current(dim: DataFrame, key, sk_name: str = "sk") -> DataFrame:
    """Current versions only, with a stable surrogate key over the
    business key and the version start."""
    keys = as_list(key)
    cur = dim.where(F.col("is_current"))
    return cur.withColumn(sk_name, surrogate_key(keys + ["effective_from"]))


def version_at(dim: DataFrame, at) -> DataFrame:
    """The dimension as it was at time ``at`` (one version per key)."""
    ts_type = dim.schema["effective_from"].dataType
    t = F.lit(at).cast(ts_type) if not hasattr(at, "alias") else at
    return dim.where((F.col("effective_from") <= t) & (F.col("effective_to").isNull() | (t < F.col("effective_to"))))


def upsert(target: DataFrame, src: DataFrame, key, seq: str, tie_break=None) -> DataFrame:
    """SCD1 merge: a source row replaces the target row of its key when
    its ``seq`` is newer, and is inserted when the key is missing."""
    cols = target.columns
    both = target.select(*cols).withColumn("_side", F.lit(0)).unionByName(
        src.select(*cols).withColumn("_side", F.lit(1)))
    tb = as_list(tie_break) + ["_side"]
    return latest_per_key(both, key, [seq], tb).drop("_side")


@dataclass
class ChangeSpec:
    keys: list
    sequence_by: str
    scd_type: int = 1
    delete_when: object = None  # Column: the change row is a delete
    tracked: list | None = None
    tie_break: list | None = None  # order of changes with equal sequence_by


TOMBSTONE, REPEAT, TIE = "_deleted", "_repeat", "_tie"


def visible(table: DataFrame) -> DataFrame:
    """A table kept with tombstones (type 2: and with repeats), without
    what only later batches need."""
    for flag in (TOMBSTONE, REPEAT):
        table = table.where(~F.col(flag)).drop(flag) if flag in table.columns else table
    return table.drop(*[c for c in table.columns if c.startswith(TIE)])


def apply_changes(target: DataFrame | None, changes: DataFrame, spec: ChangeSpec, keep_tombstones: bool = False) -> DataFrame:
    """A CDC feed folded into a type 1 or type 2 table (batch form; a
    stream calls it from ``foreachBatch``).

    Type 1: newest change per key wins; a delete removes the key. With
    ``keep_tombstones`` the deleted keys stay as rows flagged ``_deleted``
    (see :func:`visible`): store that form when older changes may arrive in a
    later batch, so that they cannot bring a deleted key back.

    Type 2: every change opens a version; a delete closes the key's current
    version and opens none. The versions of ``target`` are extended: keys
    without a change pass through; of the others the change times are read
    back from the versions (a version's start, and its end where none follows)
    and the new changes are put in their place, also those that are older
    than the current version. A repeat of a value opens no version, and a plain
    table forgets it. With ``keep_tombstones`` every change stays as a row,
    deletes flagged ``_deleted`` and repeats ``_repeat``: store that form when
    changes may come late, and any split of the feed into batches gives the
    same versions (see :func:`visible`).

    Changes with equal ``sequence_by`` are ordered by ``tie_break``, then by a
    hash of the row, so the result does not depend on task order.
    """
    keys = as_list(spec.keys)
    seq = spec.sequence_by
    delete = F.coalesce(spec.delete_when, F.lit(False)) if spec.delete_when is not None else F.lit(False)
    ch = changes.withColumn("_is_delete", delete)
    rest = as_list(spec.tie_break)
    if spec.scd_type == 1:
        cols = changes.columns
        ch = ch.withColumn("_side", F.lit(1))
        if target is not None:
            was = F.col(TOMBSTONE) if TOMBSTONE in target.columns else F.lit(False)
            ch = target.select(*cols, was.alias("_is_delete"), F.lit(0).alias("_side")).unionByName(ch)
        ch = ch.withColumn("_h", F.xxhash64(*[F.col(c).cast("string") for c in cols]))
        latest = latest_per_key(ch, keys, [seq], rest + ["_side", "_h"]).select(*cols, F.col("_is_delete").alias(TOMBSTONE))
        return latest if keep_tombstones else visible(latest)
    tracked = as_list(spec.tracked) or [c for c in changes.columns if c not in keys + [seq] + rest]
    if keep_tombstones:
        return _all_changes(target, ch.withColumn(TOMBSTONE, F.col("_is_delete")), keys, tracked, seq, rest)
    ties = ["_side", *rest, "_h"]
    new = ch.select(*keys, *tracked, seq, F.col("_is_delete").alias(TOMBSTONE), F.lit(1).alias("_side"), *[c for c in rest if c not in tracked],
                    F.xxhash64(*[F.col(c).cast("string") for c in tracked]).alias("_h"))
    if target is None:
        return _versions(new, keys, tracked, seq, ties)
    ids = changes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    touched = target.join(ids, on, "left_semi")
    # every version began with a change; one that no other follows at its end
    # was closed by a delete
    spans = neighbors(touched.select(*keys, *tracked, "effective_from", "effective_to"), keys, ["effective_from"], ["effective_from"])
    closed = F.col("effective_to").isNotNull() & ~F.col("next_effective_from").eqNullSafe(F.col("effective_to"))
    values = [F.col(c).alias(c) for c in tracked]
    none = [F.lit(None).cast(target.schema[c].dataType).alias(c) for c in tracked]
    opened = F.struct(*values, F.col("effective_from").alias(seq), F.lit(False).alias(TOMBSTONE))
    gone = F.struct(*none, F.col("effective_to").alias(seq), F.lit(True).alias(TOMBSTONE))
    old = spans.select(*keys, F.inline(F.when(closed, F.array(opened, gone)).otherwise(F.array(opened))))
    old = old.withColumn("_side", F.lit(0)).withColumn("_h", F.lit(0).cast("long"))
    out = _versions(old.unionByName(new, allowMissingColumns=True), keys, tracked, seq, ties)
    return target.join(ids, on, "left_anti").select(*out.columns).unionByName(out)


def _all_changes(target: DataFrame | None, changes: DataFrame, keys, tracked, seq: str, rest) -> DataFrame:
    """Type 2 in the stored form: old and new changes of the touched keys
    ordered anew, every one kept; order does not depend on the batch."""
    tie_cols = [f"{TIE}{i}" for i in range(len(rest))]
    plain = [*keys, *tracked, "effective_from", TOMBSTONE, *tie_cols]
    every = changes.select(*keys, *tracked, F.col(seq).alias("effective_from"), TOMBSTONE, *[F.col(c).alias(t) for c, t in zip(rest, tie_cols)])
    rest_of_table = None
    if target is not None:
        ids = every.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
        on = F.lit(True)
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        every = every.unionByName(target.join(ids, on, "left_semi").select(*plain))
        rest_of_table = target.join(ids, on, "left_anti")
    every = every.dropDuplicates().withColumn("_hash", row_hash(tracked + [TOMBSTONE]))
    order = ["effective_from", *tie_cols, "_hash"]
    seen = neighbors(every, keys, order, ["_hash"]).withColumn(REPEAT, F.coalesce(F.col("prev__hash") == F.col("_hash"), F.lit(False)))
    seen = seen.drop("prev__hash", "next__hash")
    opened = neighbors(seen.where(~F.col(REPEAT)).withColumn("_any", F.lit(True)), keys, order, ["effective_from", "_any"], prefix_next="_nx_")
    opened = opened.withColumns({"effective_to": F.col("_nx_effective_from"), "is_current": F.col("_nx__any").isNull()})
    again = seen.where(F.col(REPEAT)).withColumns({"effective_to": F.lit(None).cast(every.schema["effective_from"].dataType), "is_current": F.lit(False)})
    cols = [*keys, *tracked, "_hash", "effective_from", "effective_to", "is_current", TOMBSTONE, REPEAT, *tie_cols]
    out = opened.select(*cols).unionByName(again.select(*cols))
    return out if rest_of_table is None else rest_of_table.select(*cols).unionByName(out)


def _versions(changes: DataFrame, keys, tracked, seq: str, ties) -> DataFrame:
    """Type 2 versions of a change feed: a delete is a change to the
    "deleted" state, whose version is dropped afterwards."""
    hist = scd2_history(changes, keys, tracked + [TOMBSTONE], seq, ties)
    return hist.where(~F.col(TOMBSTONE)).drop(TOMBSTONE)
