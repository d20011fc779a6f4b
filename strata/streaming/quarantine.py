"""Late events kept instead of lost, in a running stream.

Spark's watermark drops late rows and only counts them. Here every micro-batch
is split: events older than the watermark (largest event time of the batches
before it, less the delay) go to a quarantine table, events whose key was kept
within the delay are duplicates, the rest is kept. Each batch leaves its
folders and one commit file with its counts and the next watermark, so

    kept + late + duplicates = sent

holds over any number of restarts, and a batch that is tried again is written
once. The memory of keys is the kept table itself, read back only as far as the
watermark reaches.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators._util import as_list
from strata.operators.ranking import latest_per_key
from strata.sources.pointer import list_names, publish_once, read_text


class LateQuarantine:
    """Tables ``kept`` and ``late`` below ``root``. ``ts`` is a timestamp
    column; events without a time count as late; a NULL key is a key."""

    def __init__(self, spark: SparkSession, root: str, ts: str, keys, delay_seconds: int):
        self.spark, self.root, self.ts, self.keys, self.delay = spark, root.rstrip("/"), ts, as_list(keys), delay_seconds

    def commits(self) -> list[dict]:
        """What each committed batch did, in order."""
        names = [n for n in list_names(self.spark, f"{self.root}/commits")]
        return [json.loads(read_text(self.spark, f"{self.root}/commits/{n}")) for n in names]

    def _read(self, what: str, folders: list[str]) -> DataFrame | None:
        paths = [f"{self.root}/{f}/{what}" for f in folders]
        return self.spark.read.parquet(*paths) if paths else None

    def kept(self) -> DataFrame | None:
        return self._read("kept", [c["folder"] for c in self.commits()])

    def late(self) -> DataFrame | None:
        return self._read("late", [c["folder"] for c in self.commits()])

    def counts(self) -> dict[str, int]:
        """Totals of all batches: sent, kept, late, duplicates."""
        done = self.commits()
        return {k: sum(c[k] for c in done) for k in ("sent", "kept", "late", "duplicates")}

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch (for ``foreachBatch``)."""
        done = self.commits()
        if any(c["batch"] == batch_id for c in done):
            return
        folder = f"batches/{batch_id:012d}-{uuid.uuid4().hex[:12]}"
        batch.write.parquet(f"{self.root}/{folder}/sent")  # read three times below
        sent = self.spark.read.parquet(f"{self.root}/{folder}/sent")
        top = done[-1]["top"] if done else None
        t = F.col(self.ts)
        mark = F.lit(datetime.fromisoformat(top)) - F.make_interval(secs=F.lit(self.delay)) if top else None
        is_late = t.isNull() if mark is None else (t.isNull() | (t < mark))
        sent.where(is_late).write.parquet(f"{self.root}/{folder}/late")
        fresh = latest_per_key(sent.where(~is_late), self.keys, [F.negate(F.unix_micros(t))])  # the first of a key stays
        if mark is not None:
            # kept events a key of this batch can repeat: not older than the watermark less the delay
            near = [c["folder"] for c in done if c["top"] and datetime.fromisoformat(c["top"]).timestamp() >= datetime.fromisoformat(top).timestamp() - 2 * self.delay]
            before = self._read("kept", near).where(t >= mark - F.make_interval(secs=F.lit(self.delay)))
            known = before.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).distinct()
            same = F.lit(True)
            for i, k in enumerate(self.keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
            fresh = fresh.join(known, same, "left_anti")
        fresh.write.parquet(f"{self.root}/{folder}/kept")
        n = {k: self._read(k, [folder]).count() for k in ("sent", "kept", "late")}
        newest = sent.agg(F.max(t).alias("m")).head()["m"]
        tops = [x for x in (top, newest.isoformat() if newest else None) if x]
        record = n | {"duplicates": n["sent"] - n["kept"] - n["late"], "batch": batch_id, "folder": folder, "top": max(tops) if tops else None}
        publish_once(self.spark, f"{self.root}/commits/{batch_id:012d}", json.dumps(record))

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Everything available, then stop; one checkpoint a table."""
        q = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(self.take).start()
        q.awaitTermination()
