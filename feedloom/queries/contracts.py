"""Typed feeds in the full width of their contracts.

Every text column of a feed is filled from the tables, dirt included. The SQL side spells the rule of each column's kind in
DuckDB's words.
"""

from pyspark.sql import functions as F

from feedloom.operators import typed as t
from feedloom.plans import specs as s
from feedloom.plans.feeds import ahl, gtl, heartland, manhattan, unl
from feedloom.queries import texts as x
from feedloom.queries.registry import query
from feedloom.queries.typing import (
    ADVANCE_TEXT, AHL_TEXT, GTL_TEXT, HEARTLAND_TEXT, MANHATTAN_TEXT, MOMENT_DAY, RISK,
)

FILLED = {
    s.DATE: x.DIRTY_COMPACT, s.DATE_AS_IS: x.DIRTY_COMPACT, s.DATE_TAIL: x.DIRTY_TAIL, s.DATE_SLASH: x.DIRTY_SLASH,
    s.DATE_ANY: x.DIRTY_ANY, s.NUMBER: x.DIRTY_AMOUNT, s.SIGNED: x.DIRTY_AMOUNT,
    s.INT: x.DIRTY_AGE, s.INT_AS_IS: x.DIRTY_AGE, s.SMALLINT: x.DIRTY_AGE,
}
LINEAGE = {
    "source_file": "'some file.csv'", "load_id": "'1'", "row_id": x.KEY, "row_hash": x.KEY, "first_seen_at": "o_orderdate",
    "source_modified_at": "o_orderdate",
}


def filled(spec: s.TypedSpec, given: dict[str, str]) -> dict[str, str]:
    """Text for all columns the spec reads; the given ones as they are."""
    texts = {}
    for i, c in enumerate(spec.columns):
        plain = f"CASE WHEN o_orderkey % 7 = {i % 7} THEN '  ' WHEN o_orderkey % 7 = {(i + 1) % 7} THEN NULL ELSE concat(' {c.raw} ', CAST(o_custkey % 50 AS STRING)) END"
        texts[c.raw] = given.get(c.raw, FILLED.get(c.kind, plain))
    texts |= {c.raw: given.get(c.raw, LINEAGE[c.raw]) for c in spec.lineage}
    return texts | {k: v for k, v in given.items() if k not in texts}


def spelled(c: s.Col) -> str:
    raw = f'"{c.raw}"'
    blank, tail = x.sql_blank(raw), f"nullif(split_part({raw}, '.', 1), '')"
    return {
        s.TEXT: blank, s.RAW: raw, s.DATE: x.sql_compact(blank), s.DATE_AS_IS: x.sql_compact(raw), s.DATE_TAIL: x.sql_compact(tail),
        s.DATE_SLASH: x.sql_slash(blank), s.DATE_ANY: x.sql_any(blank), s.INT: x.sql_digits(blank, "INTEGER"),
        s.INT_AS_IS: x.sql_digits(raw, "INTEGER"), s.SMALLINT: x.sql_digits(blank, "SMALLINT"), s.NUMBER: x.sql_number(blank),
        s.SIGNED: x.sql_number(blank, "+-"), s.ZIP: f"coalesce(nullif(zip_text, ''), lpad({raw}, 5, '0'))",
    }[c.kind]


def contract(name: str, spec: s.TypedSpec, given: dict[str, str], file_day: str | None = None, risk: str | None = None):
    """Register the feed's typed rows with all their columns."""
    texts = filled(spec, given)
    values = [f"{spelled(c)} AS {c.target}" for c in (*spec.columns, *spec.lineage)]
    values += [f"{file_day} AS file_date"] if file_day else []
    values += [f"row_number() OVER (PARTITION BY source_file ORDER BY row_id) AS {spec.row_number}"] if spec.row_number else []
    inner = f"SELECT {', '.join(values)} FROM {x.derived_sql({f'{chr(34)}{k}{chr(34)}': v for k, v in texts.items()})}"
    sql = f"SELECT *{f', {risk} AS at_risk_policy' if risk else ''} FROM ({inner})"

    def run(spark, sf_dir):
        raw = x.derived(spark, sf_dir, texts)
        moments = [c for c in ("source_modified_at", "first_seen_at") if c in texts]
        raw = raw.withColumns({c: F.col(c).cast("timestamp") for c in moments}) if moments else raw
        rows = t.typed(raw, spec)
        return rows.withColumns({f.name: F.col(f.name).cast("double") for f in rows.schema if f.dataType.typeName() == "decimal"})

    query(name, sql)(run)


POLICY_DAY = x.sql_compact("substring(split_part(source_file, '_Policy_', 2), 1, 8)")
NAMED_DAY = x.sql_compact("nullif(regexp_extract(source_file, 'FYM_POL_([0-9]{8})[.]csv$', 1), '')")
contract("contract_unl", unl.POLICY, x.POLICY_TEXT, POLICY_DAY, RISK)
contract("contract_gtl", gtl.POLICY, GTL_TEXT, POLICY_DAY, RISK)
contract("contract_ahl", ahl.POLICY, AHL_TEXT, MOMENT_DAY.format(name=f"{NAMED_DAY}, "), "false")
contract("contract_manhattan", manhattan.POLICY, MANHATTAN_TEXT, MOMENT_DAY.format(name=""), "false")
contract("contract_heartland", heartland.POLICY, HEARTLAND_TEXT)
contract(
    "contract_advances", unl.ADVANCES, ADVANCE_TEXT,
    "CAST(try_strptime(regexp_extract(source_file, 'WA_202JVV00_([0-9_]+)', 1), '%Y_%m_%d') AS DATE)",
)
