"""Large JSON arrays read in byte ranges."""

import json
import os
import random

import pytest

from strata.sources.json_split import read_json_array_split

SCHEMA = "id int, s string, n struct<x: int, y: array<string>>, items array<struct<k: string>>"


def element(rng, i):
    text = "".join(rng.choice('{}[]",:\\ \n é漢a') for _ in range(rng.randrange(30)))
    return {"id": i, "s": text, "n": {"x": i, "y": [text[::-1], "}"]} if i % 3 else None, "items": [{"k": text[:3]}] * (i % 4)}


@pytest.mark.parametrize("size", [64, 300, 1 << 20])
def test_every_cut_gives_the_same_rows(spark, tmp, size):
    rng = random.Random(size)
    whole = [element(rng, i) for i in range(120)]
    for n, (part, indent) in enumerate(((whole[:70], None), (whole[70:], 1), ([], None))):
        with open(os.path.join(tmp, f"a{n}.json"), "w") as f:
            f.write(json.dumps(part, ensure_ascii=n == 0, indent=indent) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = sorted((r.asDict(recursive=True) for r in read_json_array_split(spark, tmp, SCHEMA).collect()), key=lambda r: r["id"])
        tasks = spark.read.option("lineSep", "}").text(tmp).rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == whole
    assert tasks > 100 if size == 64 else tasks >= 1
