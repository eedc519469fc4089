"""AHL: exact header contract, renamed fields; at-risk and episodes not defined."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.operators.history import CHANGE_ROW, HistorySpec, Tracked
from feedloom.operators.skew import Order
from feedloom.plans.feeds import unl
from feedloom.plans.specs import DATE, FILE_TEXT, INT, RAW, SIGNED, SMALLINT, TEXT, Col, FeedSpec, Route, TypedSpec

# Delivered header name, stored name, typed name, kind.
FIELDS = (
    ("FYMPOLKEY", "fympolkey", "policy_number", TEXT),
    ("FYMKEY", "fymkey", "fym_key", TEXT),
    ("FYMFNAME", "fymfname", "first_name", TEXT),
    ("FYMLNAME", "fymlname", "last_name", TEXT),
    ("FYMDOB", "fymdob", "date_of_birth", DATE),
    ("FYMPHONE", "fymphone", "phone", TEXT),
    ("FYMZIP", "fymzip", "zip", TEXT),
    ("FYMEMAIL", "fymemail", "email", TEXT),
    ("FYMRESSTAT", "fymresstat", "resident_state", TEXT),
    ("FYMISSSTAT", "fymissstat", "issue_state", TEXT),
    ("FYMISSAGE", "fymissage", "issue_age", SMALLINT),
    ("FYMBASEPLA", "fymbasepla", "base_plan_code", TEXT),
    ("FYMRDR1PLA", "fymrdr1_pla", "rider_1_plan_code", TEXT),
    ("FYMRDR2PLA", "fymrdr2_pla", "rider_2_plan_code", TEXT),
    ("FYMRDR3PLA", "fymrdr3_pla", "rider_3_plan_code", TEXT),
    ("FYMRDR4PLA", "fymrdr4_pla", "rider_4_plan_code", TEXT),
    ("FYMRDR5PLA", "fymrdr5_pla", "rider_5_plan_code", TEXT),
    ("FYMISSDATE", "fymissdate", "issue_date", DATE),
    ("FYMAPPDATE", "fymappdate", "app_received_date", DATE),
    ("FYMPDTODAT", "fympdtodat", "paid_to_date", DATE),
    ("FYMANNPREM", "fymannprem", "annual_premium", SIGNED),
    ("FYMBILLMOD", "fymbillmod", "billing_mode", INT),
    ("FYMBILLFOR", "fymbillfor", "billing_form", TEXT),
    ("FYMSTATCOD", "fymstatcod", "contract_code", TEXT),
    ("FYMSTATDAT", "fymstatdat", "contract_date", DATE),
    ("FYMSTATRSN", "fymstatrsn", "contract_reason", TEXT),
    ("FYMTERMDAT", "fymtermdat", "term_date", DATE),
    ("FYMATRISK", "fymatrisk", "at_risk", TEXT),
    ("FYMWRAGNO", "fymwragno", "writing_agent_number", TEXT),
    ("FYMWRAGNAM", "fymwragnam", "writing_agent_name", TEXT),
    ("FYMGANO", "fymgano", "ga_number", TEXT),
    ("FYMGANAME", "fymganame", "ga_name", TEXT),
    ("FYMMGA1NO", "fymmga1_no", "mga_1_number", TEXT),
    ("FYMMGA1NAM", "fymmga1_nam", "mga_1_name", TEXT),
    ("FYMMGA2NO", "fymmga2_no", "mga_2_number", TEXT),
    ("FYMMGA2NAM", "fymmga2_nam", "mga_2_name", TEXT),
)
HEADER = tuple(f[0] for f in FIELDS)
FILE_NAME = r"FYM_POL_(\d{8})\.csv\z"
ROUTES = (Route("fym_policy", "ahl/inbound/FYM_POL_*.csv", "ahl_fym_policy", columns=HEADER, keep_tokens=True),)
NEWEST_RAW = ("source_modified_at", "load_id")
NEWEST_TYPED = ("source_modified_at", "file_date", "raw_load_id")


def file_text():
    return fn.capture("source_file", FILE_NAME)


def file_date():
    """Name, else modification day, else load day."""
    return fn.file_date_chain(
        fn.date_compact(F.col(FILE_TEXT)),
        fn.utc_date(F.col("source_modified_at")),
        fn.epoch_date(F.col("load_id")),
    )


COLUMNS = tuple(Col(target, kind, stored) for _, stored, target, kind in FIELDS)
POLICY = TypedSpec(
    columns=COLUMNS, lineage=(*unl.RAW_IDS, Col("source_modified_at", RAW)),
    file_text=file_text, file_date=file_date, risk=lambda: F.lit(False), optional=("fymatrisk",),
    output=(
        *[c.target for c in COLUMNS], "source_file", "source_modified_at", "file_date", "at_risk_policy",
        "raw_load_id", "raw_row_id", "load_id", "row_id",
    ),
)
BY_FILE = (Order("file_date", nulls_first=True), Order("source_modified_at", nulls_first=True), "source_file", "row_id")
HISTORY = HistorySpec(
    key=("policy_number",), order=BY_FILE, row_id="row_id", date_rule=CHANGE_ROW,
    tracked=(
        Tracked("contract_code", "previous_contract_code", "contract_code_last_change_date"),
        Tracked("at_risk_policy", "previous_at_risk_status", "at_risk_status_last_change_date"),
    ),
)

FEED = FeedSpec(
    name="ahl", table="ahl_fym_policy", routes=ROUTES, typed=POLICY, key="policy_number", history=HISTORY,
    newest_raw=NEWEST_RAW, newest_typed=NEWEST_TYPED,
)
