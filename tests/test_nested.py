"""Nested data and generated rows."""

import datetime as dt

from strata.operators import nested as H


def test_explode_zero_one_many_null(spark):
    df = spark.createDataFrame([(1, []), (2, [(1, "a")]), (3, [(1, "a"), (2, "b")]), (4, None)],
                               "id int, arr array<struct<n:int, s:string>>")
    assert H.explode_lines(df, "id", "arr").count() == 3
    out = H.explode_lines(df, "id", "arr", keep_empty=True)
    assert out.count() == 5 and set(out.columns) == {"id", "n", "s"}


def test_expand_months_rule(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 15), dt.date(2025, 3, 15)), (dt.date(2023, 3, 1), dt.date(2024, 2, 29)),
                                (dt.date(2024, 3, 1), dt.date(2025, 3, 1)), (dt.date(2024, 3, 2), dt.date(2024, 3, 20))],
                               "s date, e date")
    counts = [r["count"] for r in H.expand_months(df.withColumn("i", __import__("pyspark.sql.functions", fromlist=["x"]).monotonically_increasing_id()), "s", "e").groupBy("i").count().orderBy("i").collect()]
    assert counts == [12, 12, 13]  # the last row spans no month start


def test_date_spine_and_json(spark):
    assert H.date_spine(spark, "2018-01-01", "2027-12-31").count() == 3652
    df = spark.createDataFrame([('{"k": 5}',), ('{"x": 1}',)], "p string")
    assert [r[0] for r in df.select(H.json_field("p", "$.k", "int")).collect()] == [5, None]


def test_struct_fields(spark):
    df = spark.createDataFrame([(1, ("a", 2)), (2, None)], "id int, v struct<make:string, year:int>")
    out = H.struct_fields(df, "v")
    assert out.columns == ["id", "v_make", "v_year"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "a", 2), (2, None, None)]
