"""Feed text derived from orders and customers, said once for both engines.

Expressions are SQL that Spark and DuckDB share, except for date rendering, which each
engine spells its own way. Dirt (impossible days, sentinels, blanks, signs, separators)
is spread over the rows by key so that every rule meets good and bad values.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from feedloom.queries.registry import table

SPARK, DUCKDB = "spark", "duckdb"
_DUCK_FORMATS = {"yyyyMMdd": "%Y%m%d", "yyyy-MM-dd": "%Y-%m-%d", "MM/dd/yyyy": "%m/%d/%Y",
                 "M/d/yyyy": "%-m/%-d/%Y", "M-d-yyyy": "%-m-%-d-%Y", "yyyy_MM_dd": "%Y_%m_%d"}


def render(expression: str, engine: str) -> str:
    """``DAY(x, pattern)`` and ``SHIFTED(x, days, pattern)`` in the engine's spelling."""
    def day(m: re.Match) -> str:
        value, pattern = m.group(1), m.group(2)
        if engine == SPARK:
            return f"date_format({value}, '{pattern}')"
        return f"strftime({value}, '{_DUCK_FORMATS[pattern]}')"

    def shifted(m: re.Match) -> str:
        value, days, pattern = m.groups()
        moved = f"date_add(to_date({value}), {days})" if engine == SPARK else f"(CAST({value} AS DATE) + {days})"
        return day(re.match(r"(.*)\|(.*)", f"{moved}|{pattern}"))

    expression = re.sub(r"SHIFTED\((\w+), ([^,]+), ([^)]+)\)", shifted, expression)
    return re.sub(r"DAY\((\w+), ([^)]+)\)", day, expression)


DIRTY_COMPACT = """CASE WHEN o_orderkey % 11 = 0 THEN '00000000' WHEN o_orderkey % 11 = 1 THEN '20260230'
    WHEN o_orderkey % 11 = 2 THEN '' WHEN o_orderkey % 11 = 3 THEN 'n/a' WHEN o_orderkey % 11 = 4 THEN NULL
    ELSE DAY(o_orderdate, yyyyMMdd) END"""
DIRTY_TAIL = """CASE WHEN o_orderkey % 7 < 3 THEN concat(DAY(o_orderdate, yyyyMMdd), '.0')
    WHEN o_orderkey % 7 = 3 THEN '20260231.0' WHEN o_orderkey % 7 = 4 THEN '' ELSE DAY(o_orderdate, yyyyMMdd) END"""
DIRTY_SLASH = """CASE WHEN o_orderkey % 7 = 0 THEN DAY(o_orderdate, M/d/yyyy) WHEN o_orderkey % 7 = 1 THEN '13/04/2026'
    WHEN o_orderkey % 7 = 2 THEN '02/29/2026' WHEN o_orderkey % 7 = 3 THEN concat(' ', DAY(o_orderdate, MM/dd/yyyy), ' ')
    ELSE DAY(o_orderdate, MM/dd/yyyy) END"""
DIRTY_ANY = """CASE WHEN o_orderkey % 9 = 0 THEN DAY(o_orderdate, yyyy-MM-dd) WHEN o_orderkey % 9 = 1 THEN DAY(o_orderdate, yyyyMMdd)
    WHEN o_orderkey % 9 = 2 THEN DAY(o_orderdate, M/d/yyyy) WHEN o_orderkey % 9 = 3 THEN DAY(o_orderdate, MM/dd/yyyy)
    WHEN o_orderkey % 9 = 4 THEN DAY(o_orderdate, M-d-yyyy) WHEN o_orderkey % 9 = 5 THEN '2/29/2026'
    WHEN o_orderkey % 9 = 6 THEN '2026-02-30' WHEN o_orderkey % 9 = 7 THEN '   ' ELSE '1/1/1900' END"""
AMOUNT = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"
DIRTY_AMOUNT = f"""CASE WHEN o_orderkey % 10 = 0 THEN concat('+', {AMOUNT}) WHEN o_orderkey % 10 = 1 THEN concat('-', {AMOUNT}, '.25')
    WHEN o_orderkey % 10 = 2 THEN concat({AMOUNT}, '.5') WHEN o_orderkey % 10 = 3 THEN concat('1,', {AMOUNT})
    WHEN o_orderkey % 10 = 4 THEN concat({AMOUNT}, '.') WHEN o_orderkey % 10 = 5 THEN '.5'
    WHEN o_orderkey % 10 = 6 THEN concat(' ', {AMOUNT}, ' ') WHEN o_orderkey % 10 = 7 THEN '' ELSE {AMOUNT} END"""
DIRTY_AGE = """CASE WHEN o_orderkey % 6 = 0 THEN '99999' WHEN o_orderkey % 6 = 1 THEN '-4' WHEN o_orderkey % 6 = 2 THEN ' 41 '
    ELSE CAST(o_custkey % 90 AS STRING) END"""
SWING = "CAST(CAST(floor(o_totalprice) AS BIGINT) % 61 - 30 AS INT)"
CODE = """CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderstatus = 'O' THEN 'T' ELSE 'A' END"""
FORM = "CASE WHEN o_orderpriority = '5-LOW' THEN 'EFT' ELSE 'DIR' END"
MODE = "CASE WHEN o_orderkey % 8 = 0 THEN '12' WHEN o_orderkey % 8 = 1 THEN 'x' ELSE '3' END"
PAID_TO = f"CASE WHEN o_orderkey % 13 = 0 THEN '20260230' ELSE SHIFTED(o_orderdate, {SWING}, yyyyMMdd) END"
KEY = "CAST(o_orderkey AS STRING)"
POLICY = "concat('P', CAST(o_custkey AS STRING))"

#: Policy file columns; the other columns of the feed are absent, hence NULL.
POLICY_TEXT = {
    "policy_nbr": POLICY,
    "first_name": "concat(' ', o_orderpriority, ' ')",
    "issue_date": DIRTY_COMPACT,
    "app_recvd_date": DIRTY_COMPACT,
    "paid_to_date": PAID_TO,
    "cntrct_date": DIRTY_TAIL,
    "term_date": DIRTY_TAIL,
    "cntrct_code": CODE,
    "billing_form": FORM,
    "billing_mode": MODE,
    "annual_premium": DIRTY_AMOUNT,
    "zip": "CAST(o_custkey AS STRING)",
    "zip_text": "CASE WHEN o_orderkey % 3 = 0 THEN concat(CAST(o_custkey AS STRING), '-0001') WHEN o_orderkey % 3 = 1 THEN '' END",
    "agent_ga_level_01": "concat('W', CAST(o_custkey % 10 AS STRING))",
    "agent_level_02": "CASE WHEN o_custkey % 4 > 0 THEN concat(' W', CAST(o_custkey % 100 AS STRING), ' ') ELSE ' ' END",
    "source_file": "concat('UNLFYM_Policy_', DAY(o_orderdate, yyyyMMdd), '060000.csv')",
    "load_id": "DAY(o_orderdate, yyyyMMdd)",
    "row_id": f"lpad({KEY}, 12, '0')",
}


def rendered_columns(columns: dict[str, str], engine: str) -> str:
    return ", ".join(f"{render(e, engine)} AS {name}" for name, e in columns.items())


def derived(spark, sf_dir, columns: dict[str, str], source: str = "orders") -> DataFrame:
    return table(spark, sf_dir, source).selectExpr(*[f"{render(e, SPARK)} AS {n}" for n, e in columns.items()])


def derived_sql(columns: dict[str, str], source: str = "orders") -> str:
    """The same rows as a DuckDB subquery."""
    return f"(SELECT {rendered_columns(columns, DUCKDB)} FROM {source})"


# --------------------------------------------------- DuckDB spellings of the rules

def sql_blank(x: str) -> str:
    return f"nullif(trim({x}, ' '), '')"


def sql_date(x: str, shape: str, pattern: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '{shape}') THEN CAST(try_strptime({x}, '{pattern}') AS DATE) END"


def sql_compact(x: str) -> str:
    return sql_date(x, r"\d{8}", "%Y%m%d")


def sql_slash(x: str) -> str:
    return sql_date(x, r"\d{2}/\d{2}/\d{4}", "%m/%d/%Y")


def sql_any(x: str) -> str:
    return "coalesce(" + ", ".join([
        sql_date(x, r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"), sql_compact(x),
        sql_date(x, r"\d{1,2}/\d{1,2}/\d{4}", "%m/%d/%Y"), sql_date(x, r"\d{1,2}-\d{1,2}-\d{4}", "%m-%d-%Y"),
    ]) + ")"


def sql_number(x: str, sign: str = "-") -> str:
    return f"CASE WHEN regexp_full_match({x}, '[{sign}]?\\d+(\\.\\d+)?') THEN CAST(TRY_CAST({x} AS DECIMAL(38, 10)) AS DOUBLE) END"


def sql_digits(x: str, kind: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '\\d+') THEN TRY_CAST({x} AS {kind}) END"
