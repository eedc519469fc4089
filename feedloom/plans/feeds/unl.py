"""UNL: daily policy file, five raw-only statement files, weekly advances."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.operators.episodes import POLICY_RULE
from feedloom.operators.history import HistorySpec, Tracked
from feedloom.operators.typed import at_risk
from feedloom.plans.specs import (
    DATE_ANY, DATE_AS_IS, DATE_TAIL, FILE_TEXT, INT_AS_IS, NUMBER, RAW, SIGNED, ZIP, Col, FeedSpec, Route,
    TypedSpec,
)

#: Columns that key, history and risk rule cannot do without.
REQUIRED = ("policy_nbr", "cntrct_code", "billing_form", "billing_mode", "paid_to_date")

# Fixed values, to the end of VIEW_COLUMNS.
ROUTES = (
    Route("fym_policy", "unl/inbound/{UNL,}FYM_Policy_*.csv", "unl_fym_policy", required=REQUIRED),
    Route("life_professionals_policy", "unl/inbound/LifeProfessionals_Policy_*.csv", "unl_life_professionals_policy"),
    Route("weekly_commissions", "unl/inbound/CommissionStatements/WC_*.csv", "unl_weekly_commissions"),
    Route("monthly_commissions", "unl/inbound/CommissionStatements/MC_*.csv", "unl_monthly_commissions"),
    Route("weekly_advance_statements", "unl/inbound/CommissionStatements/WA_*.csv", "unl_weekly_advance_statements"),
    Route("monthly_advance_statements", "unl/inbound/CommissionStatements/MA_*.csv", "unl_monthly_advance_statements"),
)
LEVELS = ("agent_ga_level_01", *[f"agent_level_{i:02d}" for i in range(2, 11)])
FILE_PATTERNS = ("UNLFYM_Policy_%.csv", "FYM_Policy_%.csv")
ADVANCE_PATTERNS = ("WA_%.csv",)
EPISODE_START = dt.date(2026, 5, 14)
ADVANCE_FILE = r"WA_202JVV00_(\d{4}_\d{2}_\d{2})"

POLICY_FIELDS = (
    *[Col(c, RAW) for c in ("mga", "mga_name", "ga", "ga_name", "wa", "wa_name", *LEVELS, "plan_code")],
    Col("issue_date", DATE_AS_IS),
    Col("cntrct_code", RAW),
    Col("app_recvd_date", DATE_AS_IS),
    Col("annual_premium", SIGNED),
    Col("issue_state", RAW),
    Col("policy_nbr", RAW),
    Col("paid_to_date", DATE_AS_IS),
    Col("billing_mode", INT_AS_IS),
    Col("first_name", RAW),
    Col("last_name", RAW),
    Col("zip", ZIP),
    Col("phone_nbr", RAW),
    Col("cntrct_reason", RAW),
    Col("cntrct_date", DATE_TAIL),
    Col("billing_form", RAW),
    Col("term_date", DATE_TAIL),
)
RAW_POLICY_COLUMNS = tuple(dict.fromkeys([*[c.raw for c in POLICY_FIELDS], "zip_text"]))
RAW_IDS = tuple(Col(*pair) for pair in (
    ("source_file", RAW, "source_file"),
    ("raw_load_id", RAW, "load_id"),
    ("raw_row_id", RAW, "row_id"),
    ("load_id", RAW, "load_id"),
    ("row_id", RAW, "row_id"),
))
VIEW_COLUMNS = (
    "mga", "mga_name", "ga", "ga_name", "wa", "wa_name", *LEVELS, "plan_code", "issue_date", "cntrct_code",
    "app_recvd_date", "annual_premium", "issue_state", "policy_nbr", "paid_to_date", "billing_mode",
    "first_name", "last_name", "zip", "phone_nbr", "source_file", "load_id", "row_id", "cntrct_reason",
    "cntrct_date", "billing_form", "term_date", "file_date", "at_risk_policy",
)


def policy_file_text():
    """The eight characters after ``_Policy_`` in the file name."""
    return F.substring(F.split_part("source_file", F.lit("_Policy_"), F.lit(2)), 1, 8)


def policy_file_date():
    return fn.date_compact(F.col(FILE_TEXT))


def advance_file_text():
    return F.replace(fn.capture("source_file", ADVANCE_FILE), F.lit("_"), F.lit("-"))


def advance_file_date():
    return fn.date_any(F.col(FILE_TEXT))


POLICY = TypedSpec(
    columns=POLICY_FIELDS, lineage=RAW_IDS, file_text=policy_file_text, file_date=policy_file_date, risk=at_risk,
    optional=tuple(c for c in RAW_POLICY_COLUMNS if c != "zip_text"),
    output=(
        *VIEW_COLUMNS[:VIEW_COLUMNS.index("source_file") + 1], "raw_load_id", "raw_row_id",
        "cntrct_reason", "cntrct_date", "billing_form", "term_date", "file_date", "at_risk_policy",
        "load_id", "row_id",
    ),
)
ADVANCES = TypedSpec(
    columns=(
        Col("transaction_type", source="trans_type"),
        Col("policy_number", source="policy_nbr"),
        Col("insured_name", source="desc"),
        Col("agent_number", source="agent_nbr"),
        Col("first_name"),
        Col("last_name"),
        Col("agency"),
        Col("plan"),
        Col("premium_paid_amount", NUMBER, "prem_paid_amt"),
        Col("commission_rate", NUMBER, "comm_rate"),
        Col("commission_premium_amount", NUMBER, "comm_prem_amt"),
        Col("advance_percent", NUMBER, "adv_per"),
        Col("amount", NUMBER),
        Col("effective_date", DATE_ANY),
        Col("paid_to_date", DATE_ANY),
        Col("last_activity_date", DATE_ANY),
    ),
    lineage=tuple(Col(c, RAW) for c in ("source_file", "load_id", "row_id")),
    row_number="row_number",
    file_text=advance_file_text,
    file_date=advance_file_date,
)

TWO_CHANGES = (
    Tracked("cntrct_code", "previous_contract_code", "contract_code_last_change_date"),
    Tracked("at_risk_policy", "previous_at_risk_status", "at_risk_status_last_change_date"),
)
HISTORY = HistorySpec(
    key=("policy_nbr",), order=("file_date", "source_file", "row_id"), row_id="row_id", tracked=TWO_CHANGES,
)
EPISODES = replace(POLICY_RULE, start=EPISODE_START)

FEED = FeedSpec(
    name="unl", table="unl_fym_policy", routes=ROUTES, typed=POLICY, key="policy_nbr",
    history=HISTORY,
    episodes=EPISODES,
    carrier_pattern="%unl%", levels=LEVELS, file_patterns=FILE_PATTERNS, view_columns=VIEW_COLUMNS,
    side_tables={"unl_weekly_advance_statements": ADVANCES},
)
