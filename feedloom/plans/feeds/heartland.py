"""Heartland: a JSON snapshot kept as hashed versions; upline derived from the rows."""

from __future__ import annotations

from feedloom.operators.history import PREVIOUS_ROW, HistorySpec, Tracked
from feedloom.plans.specs import DATE_ANY, NUMBER, RAW, SMALLINT, TEXT, Col, TypedSpec
from feedloom.sources.names import snake_case

# The fields of the payload and the kinds of those that are not text.
PAYLOAD_FIELDS = (
    "polNo", "agtCode", "agtFirstName", "agtLastName", "amrStatus", "appDate", "effDate", "birthDate",
    "premium", "plan", "productDesc", "type", "issueState", "entryDate", "firstName", "lastName", "share",
    "initialPaidDate", "clientAddress", "clientAddress2", "clientCity", "clientState", "clientZip",
    "clientEmail", "clientPhone", "paidToDate", "draftDay", "hnlStatus", "returnDescripton", "chargeBackDt",
    "upline", "issAge", "endDate", "appGuid", "appType", "writingSplit",
)
KINDS = {
    "app_date": DATE_ANY, "eff_date": DATE_ANY, "birth_date": DATE_ANY, "premium": NUMBER,
    "entry_date": DATE_ANY, "share": NUMBER, "initial_paid_date": DATE_ANY, "paid_to_date": DATE_ANY,
    "charge_back_dt": DATE_ANY, "iss_age": SMALLINT, "end_date": DATE_ANY,
}
# The feed delivers these two the wrong way round.
SWAPPED = {"client_state": "client_zip", "client_zip": "client_state"}

FIELDS = tuple(snake_case(f) for f in PAYLOAD_FIELDS)
SNAPSHOT_TABLE = "heartland_inforced_policy_snapshot"
TABLE = "heartland_inforced_policy"
VERSION_KEYS = ("pol_no", "agt_code", "writing_split")
NEWEST = ("first_seen_at", "row_hash")

POLICY = TypedSpec(
    columns=tuple(Col(f, KINDS.get(f, TEXT), SWAPPED.get(f)) for f in FIELDS),
    lineage=tuple(Col(c, RAW, src) for c, src in (
        ("source_load_id", "load_id"), ("source_row_id", "row_id"),
        ("row_hash", "row_hash"), ("first_seen_at", "first_seen_at"),
    )),
)
STATUS_HISTORY = HistorySpec(
    key=VERSION_KEYS, order=("first_seen_at", "row_hash"), row_id="row_hash", event_date="seen_on",
    date_rule=PREVIOUS_ROW, tracked=(Tracked("hnl_status", "previous_hnl_status", "previous_hnl_status_date"),),
)
