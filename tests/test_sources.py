"""Ingestion: idempotent copy, new files, drift, corrupt lines, rescue,
schema evolution, snapshots."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.sources import files, ingest, schema as SC, sinks


def write_json_lines(path, rows):
    with open(path, "w") as f:
        for r in rows:
            f.write(r if isinstance(r, str) else json.dumps(r))
            f.write("\n")


def test_copy_into_idempotent_new_file_new_column(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string").write.parquet(os.path.join(land, "f1"))
    target, ledger = os.path.join(tmp, "t"), os.path.join(tmp, "ledger")
    n1 = ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet")
    assert n1 >= 1 and spark.read.parquet(target).count() == 2
    assert ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet") == 0  # second run
    assert spark.read.parquet(target).count() == 2
    spark.createDataFrame([(3, "c", 1.5)], "id long, s string, extra double").write.parquet(os.path.join(land, "f2"))
    assert ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet") >= 1
    out = spark.read.option("mergeSchema", True).parquet(target)
    assert out.count() == 3 and "extra" in out.columns
    assert out.where("extra IS NULL").count() == 2
    assert out.select("_source_file").distinct().count() >= 2


def test_ndjson_corrupt_line_and_array_json(spark, tmp):
    p = os.path.join(tmp, "c.json")
    write_json_lines(p, [{"id": 1, "s": "a"}, "{not json", {"id": 2, "s": "b"}])
    df = files.read_ndjson(spark, p, StructType([StructField("id", LongType()), StructField("s", StringType())])).cache()
    assert df.count() == 3
    assert df.where("_corrupt_record IS NOT NULL").count() == 1
    q = os.path.join(tmp, "arr.json")
    with open(q, "w") as f:
        json.dump([{"policy_id": "P1", "coverages": [{"code": "A", "limit": 5}, {"code": "B", "limit": 7}]}], f, indent=2)
    arr = files.read_json_array(spark, q)
    assert arr.select(F.size("coverages")).first()[0] == 2


def test_csv_and_inventory_and_metadata(spark, tmp):
    p = os.path.join(tmp, "ref.csv")
    with open(p, "w") as f:
        f.write("code,name\nA,Alpha\nB,Beta\n")
    df = files.with_ingest_metadata(files.read_csv_batch(spark, p))
    r = df.orderBy("code").first()
    assert r.code == "A" and r._source_file.endswith("ref.csv") and r._ingest_ts is not None
    inv = files.list_landing(spark, tmp).collect()
    assert any(x.path.endswith("ref.csv") and x.length > 0 for x in inv)


def test_evolve_schema_modes():
    stored = StructType([StructField("id", LongType()), StructField("s", StringType())])
    incoming = StructType([StructField("id", StringType()), StructField("s", StringType()), StructField("fw", StringType())])
    add = SC.evolve_schema(stored, incoming, "addNewColumns")
    assert add.fieldNames() == ["id", "s", "fw"] and add["id"].dataType == StringType()
    assert SC.evolve_schema(stored, incoming, "none") == stored
    assert SC.evolve_schema(stored, incoming, "rescue").fieldNames()[-1] == "_rescued_data"
    with pytest.raises(SC.SchemaChanged):
        SC.evolve_schema(stored, incoming, "failOnNewColumns")
    assert SC.load_schema(SC.save_schema(add)) == add


def test_rescue_data(spark):
    df = spark.createDataFrame([('{"k": 5}',), ('{"k": 6, "extra": "x"}',), ('{"k": "abc"}',)], "props string")
    out = SC.with_rescued(df, "props", StructType([StructField("k", LongType())])).collect()
    assert [(r.k, r._rescued_data) for r in out] == [(5, None), (6, '{"extra":"x"}'), (None, '{"k":"abc"}')]


def test_snapshot_pointer_swap(spark, tmp):
    root = os.path.join(tmp, "dim")
    sinks.write_snapshot(spark, spark.range(3), root)
    cur = sinks.read_snapshot(spark, root)
    # the next snapshot is computed from the current one and written beside it
    sinks.write_snapshot(spark, cur.union(spark.range(3, 5)), root)
    assert sinks.read_snapshot(spark, root).count() == 5
    assert "/v=2-" in sinks.current_snapshot(spark, root)
    # a run that died before the swap does not stand in the way
    spark.range(1).write.parquet(os.path.join(root, "v=3-dead"))
    sinks.write_snapshot(spark, spark.range(7), root)
    assert sinks.read_snapshot(spark, root).count() == 7


def test_stream_ingest_exactly_once(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    schema = "id long, s string"
    write_json_lines(os.path.join(src, "a.json"), [{"id": 1, "s": "a"}])
    target, ck = os.path.join(tmp, "bronze"), os.path.join(tmp, "ck")
    ingest.ingest_json_stream(spark, src, target, ck, schema)
    ingest.ingest_json_stream(spark, src, target, ck, schema)  # restart: nothing new
    assert spark.read.parquet(target).count() == 1
    write_json_lines(os.path.join(src, "b.json"), [{"id": 2, "s": "b"}, {"id": 3, "s": "c"}])
    ingest.ingest_json_stream(spark, src, target, ck, schema)
    assert spark.read.parquet(target).count() == 3


def test_copy_into_type_conflict_is_rescued(spark, tmp):
    land = os.path.join(tmp, "land")
    spark.createDataFrame([(1, 10.5)], "id long, amount double").write.parquet(os.path.join(land, "f1"))
    target, ledger = os.path.join(tmp, "t"), os.path.join(tmp, "ledger")
    ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet")
    spark.createDataFrame([(2, "$7"), (3, "8.25")], "id long, amount string").write.parquet(os.path.join(land, "f2"))
    ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet")
    out = {r.id: (r.amount, r._rescued_data) for r in spark.read.option("mergeSchema", True).parquet(target).collect()}
    assert out == {1: (10.5, None), 2: (None, '{"amount":"$7"}'), 3: (8.25, None)}


def test_csv_columns_follow_the_header(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    for name, text in (("a.csv", "a,b\n1,x\n"), ("b.csv", "b,a\ny,2\n"), ("c.csv", "a,new,b\n3,n,z\nbad,q\n")):
        with open(os.path.join(land, name), "w") as f:
            f.write(text)
    target, ledger = os.path.join(tmp, "t"), os.path.join(tmp, "ledger")
    assert ingest.copy_into(spark, land, target, "csv", ledger, schema="a int, b string", glob="*.csv", rescue=True, max_files=2) == 3
    out = spark.read.option("mergeSchema", True).parquet(target)
    assert sorted((r.a, r.b, r.new, r._rescued_data) for r in out.collect() if r.a) == [(1, "x", None, None), (2, "y", None, None), (3, "z", "n", None)]
    assert [r._rescued_data for r in out.where("a IS NULL").collect()] == ["bad,q"]
    assert out.where("_source_file LIKE '%b.csv'").count() == 1
    # the streaming form refuses a file with another column order
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        ingest.ingest_csv_stream(spark, land, os.path.join(tmp, "s"), os.path.join(tmp, "ck"), "a int, b string")
    one = os.path.join(tmp, "one")
    os.makedirs(one)
    with open(os.path.join(one, "a.csv"), "w") as f:
        f.write("a,b\n1,x\nbad,y\n")
    ingest.ingest_csv_stream(spark, one, os.path.join(tmp, "s2"), os.path.join(tmp, "ck2"), "a int, b string", rescue=True)
    got = sorted((r.a, r.b, r._rescued_data) for r in spark.read.parquet(os.path.join(tmp, "s2")).collect() if r.a)
    assert got == [(1, "x", None)]
    assert spark.read.parquet(os.path.join(tmp, "s2")).where("_rescued_data = 'bad,y'").count() == 1


def test_copy_into_survives_a_crash(spark, tmp, monkeypatch):
    land = os.path.join(tmp, "land")
    spark.range(4).write.parquet(os.path.join(land, "f1"))
    target, ledger = os.path.join(tmp, "t"), os.path.join(tmp, "ledger")
    real = ingest.move_path
    monkeypatch.setattr(ingest, "move_path", lambda *a: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet")
    monkeypatch.setattr(ingest, "move_path", real)
    assert ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet") >= 1
    assert ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet") == 0
    assert spark.read.parquet(target).count() == 4
    # an unreadable ledger is an error, not a first run
    for f in os.listdir(ledger):
        with open(os.path.join(ledger, f), "wb") as x:
            x.write(b"broken")
    with pytest.raises(Exception):
        ingest.copy_into(spark, land, target, "parquet", ledger, glob="*.parquet")


def test_rescue_keeps_malformed_text(spark, tmp):
    p = os.path.join(tmp, "in")
    os.makedirs(p)
    write_json_lines(os.path.join(p, "a.json"), [{"id": 1, "x": 2}, "{bad json", {"id": "q"}])
    ingest.copy_into(spark, p, os.path.join(tmp, "t"), "json", os.path.join(tmp, "l"), schema="id long", glob="*.json", rescue=True)
    ingest.stream_to_table(ingest.file_stream(spark, p, "json", "id long", rescue=True), os.path.join(tmp, "s"), os.path.join(tmp, "ck"))
    for out in ("t", "s"):
        got = sorted((r.id or 0, r._rescued_data) for r in spark.read.parquet(os.path.join(tmp, out)).collect())
        assert got == [(0, '{"_malformed":"{bad json"}'), (0, '{"id":"q"}'), (1, '{"x":"2"}')]


def test_nested_drift(spark):
    old = spark.createDataFrame([([{"code": "A", "limit": 1}],)], "c array<struct<code string, limit int>>").schema
    wide = "id int, c array<struct<code string, limit long, extra string>>, _rescued_data string"
    df = spark.createDataFrame([(1, [("A", 5, None)], None), (2, [("B", 7, "e")], '{"k":"v"}'), (3, None, None)], wide)
    out = {r.id: r for r in SC.conform_to(df, old).collect()}
    assert [tuple(x) for x in out[1].c] == [("A", 5)] and out[1]._rescued_data is None
    assert [tuple(x) for x in out[2].c] == [("B", 7)]
    assert json.loads(out[2]._rescued_data) == {"k": "v", "c": '[{"code":"B","limit":7,"extra":"e"}]'}
    assert out[3].c is None and out[3]._rescued_data is None
    merged = SC.evolve_schema(old, df.schema)["c"].dataType.elementType
    assert merged.fieldNames() == ["code", "limit", "extra"] and merged["limit"].dataType == LongType()


def test_write_table_keeps_the_schema(spark, tmp):
    p = os.path.join(tmp, "t")
    sinks.write_table(spark.range(2), p)
    wider = spark.range(2).withColumn("x", F.lit(1))
    with pytest.raises(SC.SchemaChanged):
        sinks.write_table(wider, p)
    sinks.write_table(wider, p, merge_schema=True)
    assert spark.read.option("mergeSchema", True).parquet(p).where("x IS NULL").count() == 2
    with pytest.raises(SC.SchemaChanged):
        sinks.write_table(spark.range(1), p, mode="overwrite")
    sinks.write_table(spark.range(1), p, mode="overwrite", overwrite_schema=True)
    assert files.read_files(spark, p, "parquet").count() == 1
    sinks.write_quarantine(wider, p)
    assert spark.read.parquet(p + "_quarantine").count() == 2
