"""Incremental silver tables (L15, S8): every bronze row is read once.

A hop streams the new files of a bronze folder (``availableNow``, one
checkpoint), cleans each micro-batch, judges it against the silver tables it
refers to, and appends it as one folder of the hop's log; a commit file makes
the folder count. Rows are never rewritten. What changes later is kept beside
them:

* when rows of a parent table arrive or change, the child rows that refer to
  one of the touched keys are judged again (quarantined orphans pass when their
  parent comes late, passed rows are quarantined when it fails), and their new
  versions go to the hop's small table of amended rows;
* where only the newest row of a key counts, the view takes it from the log.

The silver table is a view of log and amended rows, equal to what one run over
all of bronze would give. A crash at any point leaves folders nobody names; the
same batch id is written again and committed once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as K
from strata.operators._util import as_list
from strata.operators.dedup import LINEAGE_COLUMNS
from strata.operators.ranking import latest_per_key
from strata.sources import sinks
from strata.sources.ingest import stream_to_table
from strata.sources.pointer import list_names, publish_once, read_text, replace_text

ROW = "_row"  # batch and place of a row in the log
BATCH = "_batch"
FLAGS = ("_dq_failed_rules", "_dq_reason")


@dataclass
class Parent:
    """A silver table that rules look up: ``key`` is the column of both (or
    child column, parent column), ``columns`` the attributes rules use. A
    found parent sets ``<found>`` to true."""

    hop: Hop
    key: str | tuple[str, str]
    found: str
    columns: tuple[str, ...] = ()

    def names(self) -> tuple[str, str]:
        return (self.key, self.key) if isinstance(self.key, str) else self.key

    def attach(self, rows: DataFrame, passed: DataFrame) -> DataFrame:
        """``rows`` with the parent's attributes; a NULL key finds nothing."""
        own, theirs = self.names()
        side = passed.select(F.col(theirs).alias("_parent"), *self.columns, F.lit(True).alias(self.found)).where("_parent IS NOT NULL")
        if not (self.hop.newest and as_list(self.hop.newest[0]) == [theirs]):
            side = side.dropDuplicates(["_parent"])
        out = rows.drop(*self.columns, self.found).join(side, F.col(own) == F.col("_parent"), "left").drop("_parent")
        return out.withColumn(self.found, F.coalesce(self.found, F.lit(False)))


@dataclass
class Hop:
    """One silver table.

    ``clean(rows, *carry)`` maps bronze rows to silver rows and passes the
    columns named in ``carry`` on; lookups that it joins are those of the time
    a row arrives. ``rules`` gives the (name, condition) pairs, which may use
    the parents' columns. With ``newest`` (key columns, order columns) only the
    newest row of a key counts; with ``distinct`` bronze rows equal to an
    earlier one are dropped. ``schema`` defaults to that of the stored bronze
    files, ``folders`` is the pattern of their folders.
    """

    name: str
    clean: Callable[..., DataFrame]
    rules: list
    schema: str | None = None
    folders: str = ""
    parents: list[Parent] = field(default_factory=list)
    newest: tuple | None = None
    distinct: bool = False
    fmt: str = "parquet"


class Silver:
    """The silver tables of one root folder."""

    def __init__(self, spark: SparkSession, bronze: str, root: str):
        self.spark, self.bronze, self.root = spark, bronze.rstrip("/"), root.rstrip("/")

    def _path(self, hop: Hop, what: str) -> str:
        return f"{self.root}/{hop.name}/{what}"

    # -- the log

    def batches(self, hop: Hop) -> list[int]:
        """Committed batches, in order."""
        return sorted(int(n.partition("-")[2]) for n in list_names(self.spark, self._path(hop, "commits")))

    def _commit(self, hop: Hop, batch: int) -> tuple[str, int]:
        """(folder, bronze rows) of a batch."""
        folder, rows = read_text(self.spark, self._path(hop, f"commits/batch-{batch:012d}")).split()
        return folder, int(rows)

    def ingested(self, hop: Hop) -> int:
        """Bronze rows taken in so far."""
        return sum(self._commit(hop, b)[1] for b in self.batches(hop))

    def log(self, hop: Hop, after: int = -1) -> DataFrame | None:
        """The stored rows of committed batches later than ``after``, as they
        were judged when they arrived."""
        folders = [self._path(hop, self._commit(hop, b)[0]) for b in self.batches(hop) if b > after]
        return self.spark.read.option("mergeSchema", True).parquet(*folders) if folders else None

    def _append(self, hop: Hop, batch: DataFrame, batch_id: int) -> None:
        if batch_id in self.batches(hop):
            return
        seen = Observation()
        rows = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        carry = []
        if hop.distinct:
            # the digest of a row is all that is read of earlier batches
            content = F.struct(*[c for c in rows.columns if c not in LINEAGE_COLUMNS])
            rows = rows.withColumn("_digest", F.sha2(F.to_json(content, {"ignoreNullFields": "false"}), 256)).dropDuplicates(["_digest"])
            earlier = self.log(hop)
            if earlier is not None:
                rows = rows.join(earlier.select("_digest"), "_digest", "left_anti")
            carry = ["_digest"]
        judged = self._judge(hop, hop.clean(rows, *carry))
        folder = f"log/batch-{batch_id:012d}-{uuid.uuid4().hex[:12]}"
        row = F.concat_ws("-", F.lit(f"{batch_id:012d}"), F.monotonically_increasing_id())
        judged.withColumn(ROW, row).withColumn(BATCH, F.lit(batch_id).cast("long")).write.parquet(self._path(hop, folder))
        publish_once(self.spark, self._path(hop, f"commits/batch-{batch_id:012d}"), f"{folder} {seen.get['rows']}")

    def _judge(self, hop: Hop, rows: DataFrame) -> DataFrame:
        for p in hop.parents:
            passed = self.passed(p.hop)
            if passed is None:  # nothing arrived yet: no key finds a parent
                passed = self._bronze(p.hop).limit(0)
                passed = p.hop.clean(passed)
            rows = p.attach(rows, passed)
        return K.flag_rules(rows, hop.rules)

    def _bronze(self, hop: Hop) -> DataFrame:
        """The bronze rows of a table that has no file yet."""
        return self.spark.createDataFrame([], hop.schema or "_none string")

    def _schema(self, hop: Hop):
        return hop.schema or self.spark.read.option("mergeSchema", True).format(hop.fmt).load(f"{self.bronze}/{hop.name}{hop.folders}").schema

    # -- the view

    def view(self, hop: Hop) -> DataFrame | None:
        """All rows that count, each with its present judgement."""
        rows = self.log(hop)
        if rows is None:
            return None
        amended = sinks.read_snapshot(self.spark, self._path(hop, "amended"))
        if amended is not None:
            rows = rows.join(amended.select(ROW), ROW, "left_anti").unionByName(amended.select(*rows.columns))
        if hop.newest:
            keys, order = hop.newest
            rows = latest_per_key(rows, as_list(keys), as_list(order))
        return rows

    def _without(self, rows: DataFrame | None, hop: Hop, *extra: str) -> DataFrame | None:
        added = [c for p in hop.parents for c in (*p.columns, p.found)]
        return None if rows is None else rows.drop(ROW, BATCH, "_digest", *added, *extra)

    def passed(self, hop: Hop) -> DataFrame | None:
        rows = self.view(hop)
        return self._without(rows.where(F.size("_dq_failed_rules") == 0), hop, *FLAGS) if rows is not None else None

    def quarantined(self, hop: Hop) -> DataFrame | None:
        rows = self.view(hop)
        return self._without(rows.where(F.size("_dq_failed_rules") > 0), hop) if rows is not None else None

    # -- one run

    def run(self, hop: Hop, max_files_per_trigger: int | None = None) -> int:
        """Take in what is new in bronze, then judge again what new parent
        rows touch; parents are run first. Returns the bronze rows read."""
        r = self.spark.readStream.schema(self._schema(hop))
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        stream = r.format(hop.fmt).load(f"{self.bronze}/{hop.name}{hop.folders}")
        q = stream_to_table(stream, "", self._path(hop, "checkpoint"), foreach_batch=lambda df, n: self._append(hop, df, n))
        self._rejudge(hop)
        return sum(p["numInputRows"] for p in q.recentProgress)

    def _rejudge(self, hop: Hop) -> None:
        """New versions of the rows whose parents changed since the last
        run. Doing it twice changes nothing."""
        if not hop.parents:
            return
        state = json.loads(read_text(self.spark, self._path(hop, "_PARENTS")) or "{}")
        now, touched = {}, []
        for p in hop.parents:
            done = self.parent_mark(p.hop)
            now[p.hop.name] = done
            keys = self._touched(p, state.get(p.hop.name, [-1, None]), done)
            if keys is not None:
                touched.append((p.names()[0], keys))
        rows = self.log(hop)
        if touched and rows is not None:
            amended = sinks.read_snapshot(self.spark, self._path(hop, "amended"))
            current = rows
            if amended is not None:
                current = rows.join(amended.select(ROW), ROW, "left_anti").unionByName(amended.select(*rows.columns))
            hit = None
            for own, keys in touched:
                part = current.join(keys, F.col(own) == F.col("_touched"), "left_semi")
                hit = part if hit is None else hit.unionByName(part)
            hit = hit if len(touched) == 1 else hit.dropDuplicates([ROW])
            again = self._judge(hop, hit.drop(*FLAGS)).select(*rows.columns)
            before = hit.select(F.col(ROW).alias("_before"), F.struct(*[c for c in rows.columns if c != ROW]).alias("_was"))
            changed = again.join(before, F.col(ROW) == F.col("_before")).where(
                ~F.struct(*[c for c in rows.columns if c != ROW]).eqNullSafe(F.col("_was"))).drop("_before", "_was")
            path = self._path(hop, f"versions/{uuid.uuid4().hex}")
            changed.write.parquet(path)  # judged once; most runs touch few rows
            changed = self.spark.read.parquet(path)
            if not changed.isEmpty():
                if amended is not None:
                    changed = amended.join(changed.select(ROW), ROW, "left_anti").unionByName(changed)
                sinks.write_snapshot(self.spark, changed, self._path(hop, "amended"))
        replace_text(self.spark, self._path(hop, "_PARENTS"), json.dumps(now))

    def parent_mark(self, hop: Hop) -> list:
        """How far a table has come: its last batch and its amended rows."""
        done = self.batches(hop)
        return [done[-1] if done else -1, sinks.current_snapshot(self.spark, self._path(hop, "amended"))]

    def _touched(self, p: Parent, before: list, now: list) -> DataFrame | None:
        """Keys of parent rows that arrived or were amended since."""
        key = F.col(p.names()[1]).alias("_touched")
        found = []
        if now[0] > before[0]:
            found.append(self.log(p.hop, before[0]).select(key))
        if now[1] != before[1]:
            newer = self.spark.read.parquet(now[1])
            if before[1]:
                was = self.spark.read.parquet(before[1])
                same = [F.col(c) for c in newer.columns]
                newer = newer.select(key, F.xxhash64(*same).alias("h"), ROW).join(was.select(F.xxhash64(*same).alias("h"), ROW), ["h", ROW], "left_anti").select("_touched")
            else:
                newer = newer.select(key)
            found.append(newer)
        if not found:
            return None
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return out.where("_touched IS NOT NULL").distinct()
