"""Queries: change data (J1-J9) on the events table.

Model: key ``user_id``, tracked ``event_type``, time ``ts``; the batch
before the cut seeds the dimension, the batch after it is applied.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import scd as S
from strata.plans.registry import query
from strata.session import cut_lineage

CUT = "2024-01-15 00:00:00"
AT = "2024-01-20 12:00:00"

E = "e AS (SELECT user_id, event_type, ts, event_id, sha256(coalesce(event_type, '<null>')) AS _hash FROM events)"


def _latest(where: str, name: str) -> str:
    return f"""{name} AS (SELECT user_id, event_type, ts, _hash FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM e WHERE {where}) WHERE rn = 1)"""


SEED_SQL = f"WITH {E}, {_latest('true', 'd')}\n" + \
    "SELECT user_id, event_type, _hash, ts AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current FROM d"

APPLY_SQL = f"WITH {E}, {_latest(f'ts < TIMESTAMP {CUT!r}', 'd')}, {_latest(f'ts >= TIMESTAMP {CUT!r}', 's')}," + """
j AS (SELECT d.user_id AS du, s.user_id AS su, d.event_type AS dt, d._hash AS dh, d.ts AS dts,
             s.event_type AS st, s._hash AS sh, s.ts AS sts
      FROM d FULL OUTER JOIN s ON d.user_id = s.user_id)
SELECT su AS user_id, st AS event_type, sh AS _hash, sts AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current FROM j WHERE du IS NULL
UNION ALL SELECT du, dt, dh, dts, NULL, true FROM j WHERE su IS NULL
UNION ALL SELECT du, dt, dh, dts, sts, false FROM j WHERE du IS NOT NULL AND su IS NOT NULL AND dh <> sh AND sts > dts
UNION ALL SELECT su, st, sh, sts, NULL, true FROM j WHERE du IS NOT NULL AND su IS NOT NULL AND dh <> sh AND sts > dts
UNION ALL SELECT du, dt, dh, dts, NULL, true FROM j WHERE du IS NOT NULL AND su IS NOT NULL AND NOT (dh <> sh AND sts > dts)"""

HISTORY = """
c AS (SELECT *, lag(_hash) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ph FROM e),
k AS (SELECT * FROM c WHERE ph IS NULL OR ph <> _hash),
h AS (SELECT user_id, event_type, _hash, ts AS effective_from,
             lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS effective_to FROM k)"""

HISTORY_SQL = f"WITH {E}, {HISTORY}\nSELECT *, effective_to IS NULL AS is_current FROM h"


def _events(t, where=None):
    e = t.events.select("user_id", "event_type", "ts", "event_id")
    return e if where is None else e.where(where)


def _cut():
    return F.lit(CUT).cast("timestamp_ntz")


def _seed(t):
    return S.scd2_seed(_events(t, F.col("ts") < _cut()), "user_id", ["event_type"], "ts", tie_break=["event_id"])


def _apply(t, dim):
    return S.scd2_apply(dim, _events(t, F.col("ts") >= _cut()), "user_id", ["event_type"], "ts", tie_break=["event_id"])


@query("scd2_seed", SEED_SQL)
def scd2_seed(t):
    """First load of the whole table."""
    return S.scd2_seed(_events(t), "user_id", ["event_type"], "ts", tie_break=["event_id"])


@query("scd2_apply", APPLY_SQL)
def scd2_apply(t):
    """Next snapshot after the batch after the cut."""
    return _apply(t, _seed(t))


@query("scd2_apply_replay", APPLY_SQL)
def scd2_apply_replay(t):
    """Applying the same batch twice equals applying it once."""
    return _apply(t, _apply(t, _seed(t)))


STALE_SQL = f"WITH {E}, {_latest('true', 'd')}, {_latest(f'ts < TIMESTAMP {CUT!r}', 's')}" + """
SELECT s.user_id, s.event_type, s.ts, s._hash FROM s JOIN d ON s.user_id = d.user_id
WHERE s.ts <= d.ts AND s._hash <> d._hash"""


@query("scd2_stale", STALE_SQL)
def scd2_stale(t):
    """Trap 11: an older batch applied after a newer one is ignored; its
    rows are reported here instead of opening versions."""
    dim = S.scd2_seed(_events(t), "user_id", ["event_type"], "ts", tie_break=["event_id"])
    st = S.scd2_stale(dim, _events(t, F.col("ts") < _cut()), "user_id", ["event_type"], "ts", tie_break=["event_id"])
    return st.select("user_id", "event_type", "ts", "_hash")


@query("scd2_history", HISTORY_SQL)
def scd2_history(t):
    """Full history from every change (consecutive repeats dropped)."""
    return S.scd2_history(_events(t), "user_id", ["event_type"], "ts", tie_break=["event_id"])


@query("scd2_current", f"WITH {E}, {HISTORY}\nSELECT user_id, event_type, _hash, effective_from, effective_to, true AS is_current FROM h WHERE effective_to IS NULL")
def scd2_current(t):
    """Current versions (surrogate key checked in tests)."""
    h = S.scd2_history(_events(t), "user_id", ["event_type"], "ts", tie_break=["event_id"])
    return S.scd2_current(h, "user_id").drop("sk")


@query("version_at", f"WITH {E}, {HISTORY}\nSELECT *, effective_to IS NULL AS is_current FROM h "
                     f"WHERE effective_from <= TIMESTAMP '{AT}' AND (effective_to IS NULL OR TIMESTAMP '{AT}' < effective_to)")
def version_at(t):
    """The dimension as it was at a point in time."""
    h = S.scd2_history(_events(t), "user_id", ["event_type"], "ts", tie_break=["event_id"])
    return S.version_at(h, AT)


UPSERT_SQL = f"""
WITH t AS (SELECT user_id, event_type, ts, event_id, 0 AS side FROM events WHERE ts < TIMESTAMP '{CUT}'),
s AS (SELECT user_id, event_type, ts, event_id, 1 AS side FROM events WHERE ts >= TIMESTAMP '{CUT}'),
tl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM t) WHERE rn = 1),
u AS (SELECT user_id, event_type, ts, event_id, side FROM tl UNION ALL SELECT * FROM s)
SELECT user_id, event_type, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, side DESC) rn FROM u) WHERE rn = 1"""


@query("upsert", UPSERT_SQL)
def upsert(t):
    """SCD1 merge of the later batch into the earlier table."""
    from strata.operators.ranking import latest_per_key

    e = t.events.select("user_id", "event_type", "ts", "event_id")
    target = latest_per_key(e.where(F.col("ts") < _cut()), "user_id", ["ts"], ["event_id"])
    return S.upsert(target, e.where(F.col("ts") >= _cut()), "user_id", "ts", tie_break=["event_id"])


CDC1_SQL = """
SELECT user_id, event_type, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn = 1 AND event_type <> 'error'"""


@query("apply_changes_scd1", CDC1_SQL)
def apply_changes_scd1(t):
    """J8 type 1: newest change per key, deletes (``error`` rows) remove it."""
    spec = S.ChangeSpec(keys=["user_id"], sequence_by="ts", scd_type=1, delete_when=F.col("event_type") == "error", tie_break=["event_id"])
    return S.apply_changes(None, _events(t), spec)


CDC2_SQL = """
WITH e AS (SELECT user_id, event_type, ts, event_id, event_type = 'error' AS del,
                  sha256(concat_ws('||', coalesce(event_type, '<null>'), CAST(event_type = 'error' AS VARCHAR))) AS _hash FROM events),
c AS (SELECT *, lag(_hash) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ph FROM e),
k AS (SELECT * FROM c WHERE ph IS NULL OR ph <> _hash),
h AS (SELECT user_id, event_type, del, _hash, ts AS effective_from,
             lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS effective_to FROM k)
SELECT user_id, event_type, _hash, effective_from, effective_to, effective_to IS NULL AS is_current FROM h WHERE NOT del"""


@query("apply_changes_scd2", CDC2_SQL)
def apply_changes_scd2(t):
    """J8 type 2: every change opens a version; a delete closes it."""
    spec = S.ChangeSpec(keys=["user_id"], sequence_by="ts", scd_type=2, delete_when=F.col("event_type") == "error",
                        tracked=["event_type"], tie_break=["event_id"])
    return S.apply_changes(None, _events(t), spec)


@query("apply_changes_scd2_two_batches", CDC2_SQL)
def apply_changes_scd2_two_batches(t):
    """J8 type 2 on an existing target: the feed in two halves gives the
    versions of the whole feed."""
    spec = S.ChangeSpec(keys=["user_id"], sequence_by="ts", scd_type=2, delete_when=F.col("event_type") == "error",
                        tracked=["event_type"], tie_break=["event_id"])
    first = S.apply_changes(None, _events(t, F.col("ts") < _cut()), spec)
    return S.apply_changes(first, _events(t, F.col("ts") >= _cut()), spec)


@query("apply_changes_scd2_late_repeat", CDC2_SQL)
def apply_changes_scd2_late_repeat(t):
    """J8 type 2: a third of the changes comes late, between changes that
    repeated the value before them; the stored form knows them all."""
    spec = S.ChangeSpec(keys=["user_id"], sequence_by="ts", scd_type=2, delete_when=F.col("event_type") == "error",
                        tracked=["event_type"], tie_break=["event_id"])
    late = F.col("event_id") % 3 == 1
    first = cut_lineage(S.apply_changes(None, _events(t, ~late), spec, keep_tombstones=True))
    return S.visible(S.apply_changes(first, _events(t, late), spec, keep_tombstones=True))


@query("apply_changes_scd1_late_update", CDC1_SQL)
def apply_changes_scd1_late_update(t):
    """J8 type 1: the newer half arrives first; tombstones keep the older
    half from bringing deleted keys back."""
    spec = S.ChangeSpec(keys=["user_id"], sequence_by="ts", scd_type=1, delete_when=F.col("event_type") == "error", tie_break=["event_id"])
    first = S.apply_changes(None, _events(t, F.col("ts") >= _cut()), spec, keep_tombstones=True)
    return S.apply_changes(first, _events(t, F.col("ts") < _cut()), spec)


@query("scd2_history_null_time", """
WITH e AS (SELECT CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS user_id, event_type, event_id,
                  CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts, sha256(coalesce(event_type, '<null>')) AS _hash FROM events),
c AS (SELECT *, lag(_hash) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id) AS ph FROM e),
k AS (SELECT * FROM c WHERE ph IS NULL OR ph <> _hash)
SELECT user_id, event_type, _hash, ts AS effective_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id) AS effective_to,
       lead(true) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id) IS NULL AS is_current FROM k""")
def scd2_history_null_time(t):
    """J6 with unknown times and unknown keys: they come first, or form a
    key of their own; one current version a key."""
    e = t.events.select(F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"), "event_type", "event_id",
                        F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"))
    return S.scd2_history(e, "user_id", ["event_type"], "ts", tie_break=["event_id"])


@query("scd2_customers", """
WITH e AS (SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey, sha256(coalesce(o_orderpriority, '<null>')) AS _hash FROM orders),
c AS (SELECT *, lag(_hash) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ph FROM e),
k AS (SELECT * FROM c WHERE ph IS NULL OR ph <> _hash)
SELECT o_custkey, o_orderpriority, _hash, o_orderdate AS effective_from,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS effective_to,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current
FROM k""")
def scd2_customers(t):
    """The same SCD2 operator on a second entity: each customer's
    product line (priority of the latest policy) over time, monthly
    buckets."""
    o = t.orders.select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    return S.scd2_history(o, "o_custkey", ["o_orderpriority"], "o_orderdate", tie_break=["o_orderkey"], unit="month")
