"""Manhattan: slash dates, four writing agents; at-risk and episodes not defined."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.operators.history import CHANGE_ROW, HistorySpec, Tracked
from feedloom.plans.feeds import ahl, unl
from feedloom.plans.specs import DATE_SLASH, RAW, SIGNED, TEXT, Col, FeedSpec, Route, TypedSpec

# Fixed values.
ROUTES = (Route("policy", "manhattan/inbound/*.csv", "manhattan_policy", keep_tokens=True),)
AGENT_FIELDS = (("nox", "number", TEXT), ("split", "split", SIGNED), ("name", "name", TEXT))
AGENTS = tuple(
    Col(f"writing_agent_{i}_{target}", kind, f"wrtng_agt_{i}_{stored}")
    for i in range(1, 5) for stored, target, kind in AGENT_FIELDS
)
COLUMNS = (
    Col("company"), Col("block"), Col("policy"), Col("plan"), Col("plan_desc"), Col("first_name"), Col("last_name"),
    Col("app_rcvd", DATE_SLASH), Col("issue_date", DATE_SLASH), Col("paid_to_date", DATE_SLASH),
    Col("modal_premium", SIGNED), Col("annual_premium", SIGNED), Col("status"),
    *AGENTS,
    Col("group_no_name"), Col("owner_phone", source="owner_phonex"), Col("owner_email"), Col("owner_freq_cd"),
    Col("owner_pay_freq"), Col("insured_zip"), Col("issue_state"),
)


def file_date():
    """Modification day, else load day."""
    return fn.file_date_chain(fn.utc_date(F.col("source_modified_at")), fn.epoch_date(F.col("load_id")))


POLICY = TypedSpec(
    columns=COLUMNS, lineage=(*unl.RAW_IDS, Col("source_modified_at", RAW)),
    file_date=file_date, risk=lambda: F.lit(False), optional=tuple(c.raw for c in AGENTS[len(AGENT_FIELDS):]),
    output=(
        *[c.target for c in COLUMNS], "source_file", "source_modified_at", "file_date", "at_risk_policy",
        "raw_load_id", "raw_row_id", "load_id", "row_id",
    ),
)
HISTORY = HistorySpec(
    key=("policy",), order=ahl.BY_FILE, row_id="row_id", date_rule=CHANGE_ROW,
    tracked=(Tracked("status", "previous_status", "status_last_change_date"),),
)

FEED = FeedSpec(
    name="manhattan", table="manhattan_policy", routes=ROUTES, typed=POLICY, key="policy", history=HISTORY,
    newest_raw=ahl.NEWEST_RAW, newest_typed=ahl.NEWEST_TYPED,
)
