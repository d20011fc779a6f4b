"""The column functions as SQL scalar functions, for users who work in
SQL. They are SQL-bodied temporary functions (``CREATE TEMPORARY FUNCTION
... RETURN``), so Catalyst inlines them: no Python runs per row and the
expressions stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.functions.numbers import DECIMAL_COMMA, GROUPED, PLAIN


def _money(v: str) -> str:
    """The shapes of ``numbers.parse_money``, from the same patterns."""
    def shape(p: str) -> str:
        return p.replace("\\", "\\\\")

    return (f"try_cast(CASE WHEN {v} RLIKE '{shape(PLAIN)}' THEN {v} WHEN {v} RLIKE '{shape(DECIMAL_COMMA)}' THEN replace({v}, ',', '.') "
            f"WHEN {v} RLIKE '{shape(GROUPED)}' THEN replace({v}, ',', '') END AS DOUBLE)")


# name -> (parameters, return type, body)
SQL_FUNCTIONS = {
    "mask_email": ("v STRING, privileged BOOLEAN", "STRING",
                   "CASE WHEN privileged THEN v WHEN v IS NULL THEN NULL ELSE regexp_replace(v, '^.*@', '***@') END"),
    "mask_phone": ("v STRING, privileged BOOLEAN", "STRING",
                   "CASE WHEN privileged THEN v WHEN v IS NULL THEN NULL ELSE concat('XXX-XXX-', right(v, 4)) END"),
    "mask_hash": ("v STRING, privileged BOOLEAN", "STRING",
                  "CASE WHEN privileged THEN v ELSE sha2(v, 256) END"),
    "mask_text": ("v STRING, privileged BOOLEAN", "STRING",
                  "CASE WHEN privileged THEN v WHEN v IS NULL THEN NULL ELSE '***' END"),
    "safe_ratio": ("n DOUBLE, d DOUBLE", "DOUBLE", "try_divide(n, d)"),
    "date_key": ("d DATE", "INT", "year(d) * 10000 + month(d) * 100 + day(d)"),
    "month_key": ("d DATE", "INT", "year(d) * 100 + month(d)"),
    "parse_bool": ("v STRING", "BOOLEAN",
                   "CASE WHEN lower(trim(v)) IN ('true', 'y', '1', 'yes') THEN true "
                   "WHEN lower(trim(v)) IN ('false', 'n', '0', 'no') THEN false END"),
    "parse_money": ("v STRING", "DOUBLE", _money("regexp_replace(v, '[$\\\\s]', '')")),
    "is_overdue": ("status STRING", "BOOLEAN", "status IN ('LATE', 'MISSED')"),
}


def register_sql_functions(spark: SparkSession, names=None) -> list[str]:
    """Create (or replace) the temporary SQL functions in the session;
    returns their names."""
    done = []
    for name, (params, ret, body) in SQL_FUNCTIONS.items():
        if names and name not in names:
            continue
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
        done.append(name)
    return done
