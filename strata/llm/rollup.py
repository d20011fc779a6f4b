"""Delta-maintained token-count rollups.

A batch of signed changes (insert +, delete -, revised counts both) is reduced
to additive deltas per (source, language, tokenizer version), written to a
folder of its own, and becomes visible with one atomic commit file that names
it. A batch id that has a commit file is never applied again, so a retried or
replayed batch changes nothing, and a crash before the commit leaves only an
unnamed folder. Totals are the sum of the last snapshot and the batches
committed after it; nothing that was counted is read again.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.pointer import list_names, publish_once, read_text

KEYS = ["source", "lang", "tokenizer"]
_DELTA = "source string, lang string, tokenizer string, d_docs long, d_tokens decimal(38,0)"


def signed(changes: DataFrame) -> DataFrame:
    """Changes -> additive rows. ``kind`` is insert, delete or revise; the
    counts are in source, lang, tokenizer, n_tokens and, for a revision, what
    was counted before in old_source, old_lang, old_tokenizer, old_n_tokens.
    Other kinds, also NULL, change nothing; a NULL count is 0; NULL keys are
    values of their own."""
    new = F.struct(*[F.col(k).cast("string").alias(k) for k in KEYS], F.col("n_tokens").cast("long").alias("n"), F.lit(1).alias("sign"))
    gone = new.withField("sign", F.lit(-1))
    if "old_n_tokens" in changes.columns:
        old = F.struct(*[F.col(f"old_{k}").cast("string").alias(k) for k in KEYS], F.col("old_n_tokens").cast("long").alias("n"),
                       F.lit(-1).alias("sign"))
        revised = F.array(old, new)
    else:
        revised = F.filter(F.array(new), lambda x: F.lit(False))
    kind = F.lower(F.trim("kind"))
    rows = (F.when(kind == "insert", F.array(new)).when(kind == "delete", F.array(gone)).when(kind == "revise", revised))
    flat = changes.select(F.inline(rows))
    return flat.select(*KEYS, F.col("sign").cast("long").alias("d_docs"),
                       (F.col("sign") * F.coalesce("n", F.lit(0))).cast("decimal(38,0)").alias("d_tokens"))


def _sum(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").cast("decimal(38,0)").alias("d_tokens"))


class Rollup:
    """Token totals kept in ``root`` (shared storage)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commit_file(self, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.=-]*", batch):
            raise ValueError(f"batch id {batch!r}: letters, digits, '.', '=' and '-' only")
        return f"{self.root}/commits/{batch}"

    def committed(self) -> list[str]:
        return list_names(self.spark, f"{self.root}/commits")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Count a batch once. False, and no job, if it was applied before;
        False too if another writer committed the same id meanwhile. An empty
        batch commits no rows."""
        commit = self._commit_file(batch)
        if read_text(self.spark, commit) is not None:
            return False
        folder = f"{self.root}/deltas/{uuid.uuid4().hex}"
        _sum(signed(changes)).write.parquet(folder)
        return publish_once(self.spark, commit, folder)

    def _snapshot(self) -> tuple[str | None, set[str]]:
        names = list_names(self.spark, f"{self.root}/snapshots")
        if not names:
            return None, set()
        last = json.loads(read_text(self.spark, f"{self.root}/snapshots/{names[-1]}"))
        return last["folder"], set(last["batches"])

    def _deltas(self) -> tuple[DataFrame, list[str]]:
        folder, done = self._snapshot()
        batches = self.committed()
        folders = [read_text(self.spark, self._commit_file(b)) for b in batches if b not in done]
        folders += [folder] if folder else []
        if not folders:
            return self.spark.createDataFrame([], _DELTA), batches
        return self.spark.read.schema(_DELTA).parquet(*folders), batches

    def compact(self) -> bool:
        """Fold all committed batches into one snapshot; readers switch with
        its commit file. False if another writer made the same one."""
        names = list_names(self.spark, f"{self.root}/snapshots")
        deltas, batches = self._deltas()
        folder = f"{self.root}/deltas/{uuid.uuid4().hex}"
        _sum(deltas).write.parquet(folder)
        number = int(names[-1]) + 1 if names else 1
        return publish_once(self.spark, f"{self.root}/snapshots/{number:012d}", json.dumps({"folder": folder, "batches": batches}))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups that came down
        to nothing have no row."""
        return (_sum(self._deltas()[0]).where("d_docs <> 0 OR d_tokens <> 0")
                .select(*KEYS, F.col("d_docs").alias("n_docs"), F.col("d_tokens").cast("long").alias("n_tokens")))
