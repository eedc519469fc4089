"""GTL: the same policy workflow, text trimmed, some columns optional."""

from __future__ import annotations

from feedloom.operators.typed import at_risk
from feedloom.plans.feeds import unl
from feedloom.plans.specs import DATE, DATE_TAIL, INT, RAW, SIGNED, Col, FeedSpec, Route, TypedSpec

# Fixed values.
ROUTES = (Route("fym_policy", "unl/inbound/GTLFYM_Policy_*.csv", "gtl_fym_policy", keep_tokens=True),)
FILE_PATTERNS = ("GTLFYM_Policy_%.csv",)
OPTIONAL = ("ga", "ga_name", "agent_ga_level_01", "cntrct_reason", "cntrct_date", "billing_form", "term_date")
KINDS = {
    "issue_date": DATE, "app_recvd_date": DATE, "paid_to_date": DATE, "cntrct_date": DATE_TAIL,
    "term_date": DATE_TAIL, "annual_premium": SIGNED, "billing_mode": INT,
}

OUTPUT = (
    *unl.VIEW_COLUMNS[:unl.VIEW_COLUMNS.index("source_file") + 1], "source_modified_at", "raw_load_id", "raw_row_id",
    "cntrct_reason", "cntrct_date", "billing_form", "term_date", "file_date", "at_risk_policy", "load_id", "row_id",
)
POLICY = TypedSpec(
    columns=tuple(Col(c.target, KINDS[c.target]) if c.target in KINDS else Col(c.target) for c in unl.POLICY_FIELDS),
    lineage=(*unl.RAW_IDS, Col("source_modified_at", RAW)),
    file_text=unl.policy_file_text, file_date=unl.policy_file_date, risk=at_risk, optional=OPTIONAL, output=OUTPUT,
)

FEED = FeedSpec(
    name="gtl", table="gtl_fym_policy", routes=ROUTES, typed=POLICY, key="policy_nbr",
    history=unl.HISTORY, episodes=unl.EPISODES,
    carrier_pattern="%gtl%", levels=unl.LEVELS, file_patterns=FILE_PATTERNS,
)
