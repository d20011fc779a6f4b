"""Scratch folders for streaming runs, inside the cluster's shared
checkpoint folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from strata.session import ensure_checkpoint_dir


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one run: ``<checkpoint dir>/strata-runs/<name>-<uuid>``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-runs/{name}-{uuid.uuid4().hex}"
