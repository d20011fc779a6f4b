"""Scalar cleaning functions on the edge rows of FIXTURES section 5."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import dates, flags, masks, numbers, text
from strata.functions.categories import CLAIM_STATUS_FIXES, POLICY_STATUS_FIXES, map_category
from strata.functions.hashing import row_hash


def col1(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_parse_money(spark):
    vals = ["$1,234.50", "$-1,234.50", "  1200.0 ", "1234,56", "1200,0", "-5", "abc", "", None]
    got = col1(spark, vals, numbers.parse_money)
    assert got == [1234.5, -1234.5, 1200.0, 1234.56, 1200.0, -5.0, None, None, None]


def test_parse_date(spark):
    vals = ["2020-03-15", "03/15/2020", "15-03-2020", "not_a_date", "2020-02-30", "2031-01-01", None]
    got = col1(spark, vals, dates.parse_date)
    d = dt.date
    assert got == [d(2020, 3, 15), d(2020, 3, 15), d(2020, 3, 15), None, None, d(2031, 1, 1), None]
    fut = col1(spark, vals, lambda c: dates.flag_future(dates.parse_date(c), "2026-01-01"))
    assert fut == [False, False, False, None, None, True, None]


def test_parse_bool(spark):
    vals = ["true", "Y", "1", "YES", "false", "N", "0", "NO", " yes ", "maybe", None]
    assert col1(spark, vals, flags.parse_bool) == [True] * 4 + [False] * 4 + [True, None, None]


def test_map_category(spark):
    vals = ["active", "Active ", "ACTIVEE", "Actv", "pend", "Pening", "LAPSE", "unknown"]
    got = col1(spark, vals, lambda c: map_category(c, POLICY_STATUS_FIXES, ["ACTIVE", "LAPSED", "PENDING", "CANCELLED"]))
    assert got == ["ACTIVE"] * 4 + ["PENDING"] * 2 + ["LAPSED", None]
    claims = ["in review", "opn", "CLOSE", "Reviewing", "Closed "]
    got = col1(spark, claims, lambda c: map_category(c, CLAIM_STATUS_FIXES))
    assert got == ["IN_REVIEW", "OPEN", "CLOSED", "IN_REVIEW", "CLOSED"]


def test_normalize_text(spark):
    vals = ["  new   york ", "NEW YORK", "new\tyork", None]
    assert col1(spark, vals, lambda c: text.normalize_text(c, "title")) == ["New York", "New York", "New York", None]
    assert col1(spark, vals, lambda c: text.normalize_text(c, "upper"))[0] == "NEW YORK"


def test_split_part(spark):
    assert col1(spark, ["a#b#c", "a", None], lambda c: text.split_part(c, "#", 1)) == ["b", None, None]


def test_masks(spark):
    assert col1(spark, ["jane@x.com", None], masks.mask_email) == ["***@x.com", None]
    assert col1(spark, ["jane@x.com"], lambda c: masks.mask_email(c, True)) == ["jane@x.com"]
    assert col1(spark, ["(312) 555-0142"], masks.mask_phone) == ["XXX-XXX-0142"]
    assert col1(spark, ["a"], masks.mask_null) == [None]
    assert col1(spark, ["a"], masks.mask_text) == ["***"]
    assert col1(spark, ["mail a.b@c.org and x@y.io"], masks.redact_emails) == ["mail ***@c.org and ***@y.io"]


def test_row_hash_null_safe(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("<null>", "a")], "x string, y string")
    hs = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert hs[0] != hs[1]
    assert len(hs[0]) == 64


def test_tenure_and_band(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31),), (dt.date(2020, 3, 1),), (None,)], "d date")
    got = [r[0] for r in df.select(dates.tenure_months("d", "2021-03-01")).collect()]
    assert got == [13, 12, None]
    b = col1(spark, [-1.0, 0.0, 999.0, 1000.0, 7000.0, None], lambda c: dates.band(c, [0, 1000, 5000], ["a", "b", "c"], below="neg"), "double")
    assert b == ["neg", "a", "a", "b", "c", None]


def test_date_and_month_key(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 4),)], "d date")
    r = df.select(dates.date_key("d"), dates.month_key("d")).first()
    assert tuple(r) == (20240504, 202405)


def test_exact_sum_is_order_free(spark):
    vals = [0.1, 0.2, 0.3] * 1000
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    a = df.agg(numbers.exact_sum("v")).first()[0]
    b = df.repartition(7).agg(numbers.exact_sum("v")).first()[0]
    assert a == b == 600.0


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(numbers.safe_ratio("n", "d")).collect()] == [None, None, 1.5]


def test_dirt_round_trip(spark):
    from strata.functions import dirt

    df = spark.range(200).select(F.round(F.col("id") * 13.37 + 0.01, 2).alias("x"), F.col("id"))
    shapes = df.select("x", numbers.parse_money(dirt.money_text("x", F.pmod("id", F.lit(3)))).alias("y"))
    assert all(r.x == r.y for r in shapes.collect())


def test_sql_functions_match_column_functions(spark):
    from strata.functions.sql_functions import register_sql_functions

    register_sql_functions(spark)
    vals = ["$1,234.50", "$-1,234.50", "  1200.0 ", "1234,56", "1200,0", "-5", "abc", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    df.createOrReplaceTempView("money_edge_rows")
    sql = [r[0] for r in spark.sql("SELECT parse_money(v) FROM money_edge_rows").collect()]
    assert sql == col1(spark, vals, numbers.parse_money)
    b = ["true", "Y", "1", "YES", "false", "N", "0", "NO", " yes ", "maybe", None]
    spark.createDataFrame([(v,) for v in b], "v string").createOrReplaceTempView("bool_edge_rows")
    assert [r[0] for r in spark.sql("SELECT parse_bool(v) FROM bool_edge_rows").collect()] == col1(spark, b, flags.parse_bool)
    r = spark.sql("SELECT mask_email('jane@x.com', false) a, mask_email('jane@x.com', true) b, "
                  "mask_phone('(312) 555-0142', false) c, safe_ratio(1.0, 0.0) d, date_key(DATE'2024-05-04') e").first()
    assert tuple(r) == ("***@x.com", "jane@x.com", "XXX-XXX-0142", None, 20240504)


def test_money_shapes_and_mask_types(spark):
    from strata.functions.masks import mask_hash, mask_null, mask_text
    from strata.functions.numbers import exact_sum, parse_money

    shapes = {"$1234,56": 1234.56, "1.234,56": None, "$-1,234.50": -1234.5, "12,34,567": None, "1,234": 1234.0, "-5": -5.0, "1e3": 1000.0, "$": None}
    df = spark.createDataFrame([(k,) for k in shapes], "s string")
    assert {r.s: r.m for r in df.select("s", parse_money("s").alias("m")).collect()} == shapes
    d = spark.createDataFrame([(1.5, True), (None, False)], "x double, p boolean")
    for privileged in (True, False, F.col("p")):
        out = d.select(mask_null("x", privileged).alias("n"), mask_hash("x", privileged).alias("h"), mask_text("x", privileged).alias("t"))
        assert [t for _, t in out.dtypes] == ["double", "string", "string"]
    # nothing is cut to cents and nothing overflows
    small = spark.range(1000).select(F.lit(0.004).alias("x")).agg(exact_sum("x").alias("s")).head().s
    large = spark.range(1000).select(F.lit(9.9e14).alias("x")).agg(exact_sum("x").alias("s")).head().s
    assert (small, large) == (4.0, 9.9e17)
