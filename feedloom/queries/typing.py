"""Typed projections, reject counts and the small rules they are made of."""

from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.operators import typed as t
from feedloom.plans.feeds import ahl, gtl, heartland, manhattan, unl
from feedloom.plans.specs import (
    DATE, DATE_ANY, DATE_SLASH, DATE_TAIL, FILE_TEXT, INT, NUMBER, SIGNED, SMALLINT, Col, TypedSpec,
)
from feedloom.queries import texts as x
from feedloom.queries.registry import query, table
from feedloom.session import cut

DATE_TEXTS = {
    "o_orderkey": "o_orderkey", "compact": x.DIRTY_COMPACT, "tail": x.DIRTY_TAIL,
    "slash": x.DIRTY_SLASH, "any_format": x.DIRTY_ANY,
}
DATE_SPEC = TypedSpec((
    Col("compact", DATE), Col("tail", DATE_TAIL), Col("slash", DATE_SLASH), Col("any_format", DATE_ANY),
))
NUMBER_TEXTS = {"o_orderkey": "o_orderkey", "amount": x.DIRTY_AMOUNT, "age": x.DIRTY_AGE}
NUMBER_SPEC = TypedSpec((
    Col("unsigned", NUMBER, "amount"), Col("signed", SIGNED, "amount"), Col("whole", INT, "age"),
    Col("small", SMALLINT, "age"),
))


def keyed(spec):
    """The spec with the order key passed through."""
    return TypedSpec(spec.columns, lineage=(Col("o_orderkey"),))


def as_double(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


TYPED_DATES_SQL = f"""
    SELECT o_orderkey, {x.sql_compact(x.sql_blank('compact'))} AS compact,
           {x.sql_compact("nullif(split_part(tail, '.', 1), '')")} AS tail,
           {x.sql_slash(x.sql_blank('slash'))} AS slash, {x.sql_any(x.sql_blank('any_format'))} AS any_format
    FROM {x.derived_sql(DATE_TEXTS)}"""


@query("typed_dates", TYPED_DATES_SQL)
def typed_dates(spark, sf_dir):
    return t.typed(x.derived(spark, sf_dir, DATE_TEXTS), keyed(DATE_SPEC))


@query("typed_numbers", f"""
    SELECT o_orderkey, {x.sql_number('a')} AS unsigned, {x.sql_number('a', '+-')} AS signed,
           {x.sql_digits('g', 'INTEGER')} AS whole, {x.sql_digits('g', 'SMALLINT')} AS small
    FROM (SELECT o_orderkey, {x.sql_blank('amount')} AS a, {x.sql_blank('age')} AS g
          FROM {x.derived_sql(NUMBER_TEXTS)})""")
def typed_numbers(spark, sf_dir):
    return as_double(t.typed(x.derived(spark, sf_dir, NUMBER_TEXTS), keyed(NUMBER_SPEC)), "unsigned", "signed")


def profile_line(name: str, text: str, value: str) -> str:
    return f"""SELECT '{name}' AS column_name, count(*) AS row_count, count({text}) AS text_count,
        count(*) FILTER (WHERE {text} IS NOT NULL AND ({value}) IS NULL) AS reject_count FROM raw"""


@query("typed_profile", f"WITH raw AS (SELECT * FROM {x.derived_sql(DATE_TEXTS)}) " + " UNION ALL ".join([
    profile_line("compact", x.sql_blank("compact"), x.sql_compact(x.sql_blank("compact"))),
    profile_line("tail", "nullif(split_part(tail, '.', 1), '')", x.sql_compact("nullif(split_part(tail, '.', 1), '')")),
    profile_line("slash", x.sql_blank("slash"), x.sql_slash(x.sql_blank("slash"))),
    profile_line("any_format", x.sql_blank("any_format"), x.sql_any(x.sql_blank("any_format"))),
]))
def typed_profile(spark, sf_dir):
    return t.reject_profile(x.derived(spark, sf_dir, DATE_TEXTS), DATE_SPEC)


# ---------------------------------------------------------------------- feeds

RISK = """(cntrct_code = 'A' AND billing_form = 'DIR' AND billing_mode = 3 AND paid_to_date IS NOT NULL
    AND file_date IS NOT NULL AND paid_to_date < file_date)"""
POLICY_COLUMNS = (
    "policy_nbr", "first_name", "issue_date", "app_recvd_date", "paid_to_date", "cntrct_date", "term_date",
    "cntrct_code", "billing_form", "billing_mode", "annual_premium", "zip", "file_date", "at_risk_policy",
    "load_id", "row_id",
)


def policy_sql(raw: dict[str, str], trimmed: bool) -> str:
    """Typed policy rows over derived text; the trimmed feed has no zip text variant."""
    text = x.sql_blank if trimmed else (lambda c: c)
    zip_rule = x.sql_blank("zip") if trimmed else "coalesce(nullif(zip_text, ''), lpad(zip, 5, '0'))"
    tail = "nullif(split_part({}, '.', 1), '')"
    return f"""
    SELECT *, {RISK} AS at_risk_policy FROM (
        SELECT {text('policy_nbr')} AS policy_nbr, {text('first_name')} AS first_name,
               {x.sql_compact(text('issue_date'))} AS issue_date, {x.sql_compact(text('app_recvd_date'))} AS app_recvd_date,
               {x.sql_compact(text('paid_to_date'))} AS paid_to_date, {x.sql_compact(tail.format('cntrct_date'))} AS cntrct_date,
               {x.sql_compact(tail.format('term_date'))} AS term_date, {text('cntrct_code')} AS cntrct_code,
               {text('billing_form')} AS billing_form, {x.sql_digits(text('billing_mode'), 'INTEGER')} AS billing_mode,
               {x.sql_number(x.sql_blank('annual_premium'), '+-')} AS annual_premium, {zip_rule} AS zip,
               {x.sql_compact("substring(split_part(source_file, '_Policy_', 2), 1, 8)")} AS file_date, load_id, row_id
        FROM {x.derived_sql(raw)})"""


def unl_policies(spark, sf_dir):
    return t.typed(x.derived(spark, sf_dir, x.POLICY_TEXT), unl.POLICY)


def stored_policies(spark, sf_dir):
    """Typed policies as a flow finds them: written once, then read."""
    return cut(unl_policies(spark, sf_dir).select("policy_nbr", "file_date", "at_risk_policy", "paid_to_date", "cntrct_code"))


@query("typed_unl", policy_sql(x.POLICY_TEXT, trimmed=False))
def typed_unl(spark, sf_dir):
    return as_double(unl_policies(spark, sf_dir).select(*POLICY_COLUMNS), "annual_premium")


#: This feed lacks most optional columns; the missing ones become NULL.
GTL_TEXT = {
    **{k: v for k, v in x.POLICY_TEXT.items() if k not in ("zip_text", "term_date", "agent_ga_level_01", "source_file")},
    "ga": "'G'",
    "source_file": "concat('GTLFYM_Policy_', DAY(o_orderdate, yyyyMMdd), '060000.csv')",
    "source_modified_at": "o_orderdate",
}


@query("typed_gtl", policy_sql({**GTL_TEXT, "term_date": "CAST(NULL AS STRING)"}, trimmed=True))
def typed_gtl(spark, sf_dir):
    raw = x.derived(spark, sf_dir, GTL_TEXT)
    required = [c.raw for c in gtl.POLICY.columns if c.raw not in gtl.OPTIONAL]
    rows = t.typed(t.with_missing(raw, required), gtl.POLICY)
    return as_double(rows.select(*POLICY_COLUMNS), "annual_premium")


AHL_TEXT = {
    "fympolkey": x.POLICY, "fymissage": x.DIRTY_AGE, "fymdob": x.DIRTY_COMPACT, "fympdtodat": x.PAID_TO,
    "fymannprem": x.DIRTY_AMOUNT, "fymbillmod": x.MODE, "fymstatcod": x.CODE, "fymstatdat": x.DIRTY_COMPACT,
    "source_file": """CASE WHEN o_orderstatus = 'F' THEN concat('FYM_POL_', DAY(o_orderdate, yyyyMMdd), '.csv')
        ELSE concat('FYM Policy Data ', CAST(o_custkey AS STRING), '.csv') END""",
    "source_modified_at": "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END",
    "load_id": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'manual' ELSE '1783955745.5023258' END",
    "row_id": x.KEY,
}
AHL_COLUMNS = (
    "policy_number", "issue_age", "date_of_birth", "paid_to_date", "annual_premium", "billing_mode", "contract_code",
    "contract_date", "file_date", "at_risk_policy", "row_id",
)
MOMENT_DAY = """coalesce({name}CAST(source_modified_at AS DATE),
    CASE WHEN regexp_full_match(load_id, '\\d+(\\.\\d+)?') THEN CAST(make_timestamp(CAST(TRY_CAST(load_id AS DOUBLE) * 1000000 AS BIGINT)) AS DATE) END)"""


def ahl_policies(spark, sf_dir):
    missing = [c.raw for c in ahl.COLUMNS if c.raw not in AHL_TEXT]
    raw = t.with_missing(x.derived(spark, sf_dir, AHL_TEXT), missing)
    return t.typed(raw.withColumn("source_modified_at", F.col("source_modified_at").cast("timestamp")), ahl.POLICY)


@query("typed_ahl", f"""
    SELECT {x.sql_blank('fympolkey')} AS policy_number, {x.sql_digits(x.sql_blank('fymissage'), 'SMALLINT')} AS issue_age,
           {x.sql_compact(x.sql_blank('fymdob'))} AS date_of_birth, {x.sql_compact(x.sql_blank('fympdtodat'))} AS paid_to_date,
           {x.sql_number(x.sql_blank('fymannprem'), '+-')} AS annual_premium,
           {x.sql_digits(x.sql_blank('fymbillmod'), 'INTEGER')} AS billing_mode, {x.sql_blank('fymstatcod')} AS contract_code,
           {x.sql_compact(x.sql_blank('fymstatdat'))} AS contract_date,
           {MOMENT_DAY.format(name=x.sql_compact("nullif(regexp_extract(source_file, 'FYM_POL_([0-9]{8})[.]csv$', 1), '')") + ", ")} AS file_date,
           false AS at_risk_policy, row_id
    FROM {x.derived_sql(AHL_TEXT)}""")
def typed_ahl(spark, sf_dir):
    return as_double(ahl_policies(spark, sf_dir).select(*AHL_COLUMNS), "annual_premium")


MANHATTAN_TEXT = {
    "policy": x.POLICY, "status": x.CODE, "app_rcvd": x.DIRTY_SLASH, "issue_date": x.DIRTY_SLASH,
    "modal_premium": x.DIRTY_AMOUNT, "annual_premium": x.DIRTY_AMOUNT, "wrtng_agt_1_nox": "CAST(o_custkey AS STRING)",
    "wrtng_agt_1_split": "CASE WHEN o_orderkey % 2 = 0 THEN '+50.5' ELSE '100%' END", "owner_phonex": "'  '",
    "source_file": "concat('policies ', o_orderstatus, '.csv')",
    "source_modified_at": "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END",
    "load_id": AHL_TEXT["load_id"], "row_id": x.KEY,
}


@query("typed_manhattan", f"""
    SELECT {x.sql_blank('policy')} AS policy, {x.sql_blank('status')} AS status, {x.sql_slash(x.sql_blank('app_rcvd'))} AS app_rcvd,
           {x.sql_slash(x.sql_blank('issue_date'))} AS issue_date, {x.sql_number(x.sql_blank('modal_premium'), '+-')} AS modal_premium,
           wrtng_agt_1_nox AS writing_agent_1_number, {x.sql_number('wrtng_agt_1_split', '+-')} AS writing_agent_1_split,
           {x.sql_blank('owner_phonex')} AS owner_phone, CAST(NULL AS DOUBLE) AS writing_agent_4_split,
           {MOMENT_DAY.format(name='')} AS file_date, false AS at_risk_policy, row_id
    FROM {x.derived_sql(MANHATTAN_TEXT)}""")
def typed_manhattan(spark, sf_dir):
    missing = [c.raw for c in manhattan.COLUMNS if c.raw not in MANHATTAN_TEXT and not c.raw.startswith("wrtng")]
    raw = t.with_missing(x.derived(spark, sf_dir, MANHATTAN_TEXT), [*missing, "wrtng_agt_1_name"])
    raw = raw.withColumn("source_modified_at", F.col("source_modified_at").cast("timestamp"))
    rows = t.typed(raw, manhattan.POLICY).select(
        "policy", "status", "app_rcvd", "issue_date", "modal_premium", "writing_agent_1_number",
        "writing_agent_1_split", "owner_phone", "writing_agent_4_split", "file_date", "at_risk_policy", "row_id",
    )
    return as_double(rows, "modal_premium", "writing_agent_1_split", "writing_agent_4_split")


HEARTLAND_TEXT = {
    "pol_no": x.POLICY, "app_date": x.DIRTY_ANY, "paid_to_date": x.DIRTY_ANY, "premium": x.DIRTY_AMOUNT,
    "share": "'100'", "iss_age": x.DIRTY_AGE, "client_state": "lpad(CAST(o_custkey AS STRING), 5, '0')",
    "client_zip": "' TX '", "hnl_status": "concat(o_orderstatus, ' ')", "row_hash": x.KEY, "row_id": x.KEY,
    "load_id": "'1'", "first_seen_at": "o_orderdate",
}


@query("typed_heartland", f"""
    SELECT pol_no, {x.sql_any(x.sql_blank('app_date'))} AS app_date, {x.sql_any(x.sql_blank('paid_to_date'))} AS paid_to_date,
           {x.sql_number(x.sql_blank('premium'))} AS premium, {x.sql_number('share')} AS share,
           {x.sql_digits(x.sql_blank('iss_age'), 'SMALLINT')} AS iss_age, {x.sql_blank('client_zip')} AS client_state,
           client_state AS client_zip, {x.sql_blank('hnl_status')} AS hnl_status, row_hash
    FROM {x.derived_sql(HEARTLAND_TEXT)}""")
def typed_heartland(spark, sf_dir):
    raw = t.with_missing(x.derived(spark, sf_dir, HEARTLAND_TEXT), heartland.FIELDS)
    rows = t.typed(raw, heartland.POLICY).select(
        "pol_no", "app_date", "paid_to_date", "premium", "share", "iss_age", "client_state", "client_zip",
        "hnl_status", "row_hash",
    )
    return as_double(rows, "premium", "share")


ADVANCE_TEXT = {
    "policy_nbr": x.POLICY, "desc": "concat(' ', o_orderpriority)", "trans_type": "o_orderstatus",
    "prem_paid_amt": x.DIRTY_AMOUNT, "amount": x.DIRTY_AMOUNT, "effective_date": x.DIRTY_ANY,
    "source_file": "concat('WA_202JVV00_', DAY(o_orderdate, yyyy_MM_dd), '.csv')", "load_id": "'1'",
    "row_id": f"lpad({x.KEY}, 12, '0')",
}


@query("typed_advances", f"""
    SELECT trans_type AS transaction_type, row_number() OVER (PARTITION BY source_file ORDER BY row_id) AS row_number,
           policy_nbr AS policy_number, {x.sql_blank('"desc"')} AS insured_name,
           {x.sql_number(x.sql_blank('prem_paid_amt'))} AS premium_paid_amount, {x.sql_number(x.sql_blank('amount'))} AS amount,
           {x.sql_any(x.sql_blank('effective_date'))} AS effective_date,
           CAST(try_strptime(regexp_extract(source_file, 'WA_202JVV00_([0-9_]+)', 1), '%Y_%m_%d') AS DATE) AS file_date, row_id
    FROM {x.derived_sql({('"desc"' if k == 'desc' else k): v for k, v in ADVANCE_TEXT.items()})}""")
def typed_advances(spark, sf_dir):
    raw = x.derived(spark, sf_dir, ADVANCE_TEXT)
    raw = t.with_missing(raw, [c.raw for c in unl.ADVANCES.columns])
    rows = t.typed(raw, unl.ADVANCES).select(
        "transaction_type", "row_number", "policy_number", "insured_name", "premium_paid_amount", "amount",
        "effective_date", "file_date", "row_id",
    )
    return as_double(rows, "premium_paid_amount", "amount")


# ---------------------------------------------------------------- small rules

@query("risk_flag_3vl", f"""
    SELECT o_orderkey, {RISK} AS at_risk FROM (
        SELECT o_orderkey, {x.CODE} AS cntrct_code, {x.FORM} AS billing_form,
               CASE WHEN o_orderkey % 8 = 0 THEN 12 WHEN o_orderkey % 8 > 1 THEN 3 END AS billing_mode,
               CASE WHEN o_orderkey % 13 > 0 THEN CAST(o_orderdate AS DATE) + {x.SWING} END AS paid_to_date,
               CAST(o_orderdate AS DATE) AS file_date FROM orders)""")
def risk_flag_3vl(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{x.CODE} AS cntrct_code", f"{x.FORM} AS billing_form",
        "CASE WHEN o_orderkey % 8 = 0 THEN 12 WHEN o_orderkey % 8 > 1 THEN 3 END AS billing_mode",
        f"CASE WHEN o_orderkey % 13 > 0 THEN date_add(to_date(o_orderdate), {x.SWING}) END AS paid_to_date",
        "to_date(o_orderdate) AS file_date",
    )
    return rows.select("o_orderkey", t.at_risk().alias("at_risk"))


@query("zip_rule", """
    SELECT c_custkey, coalesce(nullif(CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment WHEN c_nationkey % 3 = 1 THEN '' END, ''),
                               lpad(CAST(c_custkey * 97 AS VARCHAR), 5, '0')) AS zip FROM customer""")
def zip_rule(spark, sf_dir):
    text = F.when(F.col("c_nationkey") % 3 == 0, F.col("c_mktsegment")).when(F.col("c_nationkey") % 3 == 1, "")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fn.zip_code((F.col("c_custkey") * 97).cast("string"), text).alias("zip")
    )


@query("file_date_chain", """
    SELECT event_id, CASE event_type WHEN 'error' THEN CAST(ts AS DATE) WHEN 'click' THEN CAST(ts AS DATE) + 1
                                     WHEN 'view' THEN DATE '2026-07-13' END AS file_date FROM events""")
def file_date_chain(spark, sf_dir):
    """Errors are dated by name, clicks by modification time, views by load id."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", F.concat(F.lit("FYM_POL_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv")))
        .otherwise("other.csv").alias("source_file"),
        F.when(kind.isin("error", "click"), F.date_add("ts", 1).cast("timestamp")).alias("source_modified_at"),
        F.when(kind != "signup", F.when(kind == "purchase", "manual").otherwise("1783955745.5023258")).alias("load_id"),
    )
    dated = rows.select("*", ahl.file_text().alias(FILE_TEXT))
    return dated.select("event_id", ahl.file_date().alias("file_date"))


@query("cursor_scan", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS load_id FROM orders
    WHERE strftime(o_orderdate, '%Y%m') > (SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders WHERE o_orderstatus = 'F'
                                           AND o_orderdate < DATE '1999-01-01')""")
def cursor_scan(spark, sf_dir):
    """Rows of loads newer than the newest one already stored."""
    orders = table(spark, sf_dir, "orders")
    load = F.date_format("o_orderdate", "yyyyMM").alias("load_id")
    stored = orders.filter("o_orderstatus = 'F' AND o_orderdate < '1999-01-01'").select("o_orderkey", load)
    return t.newer_loads(orders.select("o_orderkey", load), stored)
