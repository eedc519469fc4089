"""Sources and whole flows on small landed files."""

import csv
import datetime as dt
import json
import os
import shutil
import time
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from feedloom.operators import audit, history as h
from feedloom.plans import flow
from feedloom.plans.feeds import FEEDS, ahl, heartland, unl
from feedloom.plans.specs import Route
from feedloom.sinks.commits import ConflictError
from feedloom.sinks.tables import Change, Tables
from feedloom.sources import files as src
from feedloom.sources.names import snake_case, stored_names
from feedloom.sources.snapshots import PayloadError, read_json_array
from feedloom.streaming.intake import start_intake
from test_hierarchy import roster

NOW = dt.datetime(2026, 7, 1, tzinfo=dt.timezone.utc)


def land(root, name, header, lines):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        writer.writerows(lines)
    return path


# ---------------------------------------------------------------- sources

@pytest.mark.parametrize("name, stored", [
    ("FYMRDR1PLA", "fymrdr1_pla"), ("polNo", "pol_no"), ("Wrtng Agt 1 No.", "wrtng_agt_1_nox"),
    ("Owner Phone#", "owner_phonex"), ("clientAddress2", "client_address2"), ("At Risk", "at_risk"),
])
def test_stored_names(name, stored):
    assert snake_case(name) == stored


def test_contract_header_becomes_the_typed_source():
    assert [snake_case(f[0]) for f in ahl.FIELDS] == [f[1] for f in ahl.FIELDS]


def test_colliding_names_are_an_error():
    with pytest.raises(ValueError):
        stored_names(["polNo", "pol_no"])


def test_routes_without_files_are_dropped(spark, tmp_path):
    land(tmp_path, "unl/inbound/UNLFYM_Policy_20260601000000.csv", ["mga"], [["1"]])
    land(tmp_path, "unl/inbound/GTLFYM_Policy_20260601000000.csv", ["mga"], [["1"]])
    found = src.matching_routes(spark, str(tmp_path), unl.ROUTES)
    assert {r.name: [f.name for f in files] for r, files in found.items()} == {
        "fym_policy": ["UNLFYM_Policy_20260601000000.csv"]
    }
    with pytest.raises(src.NoFilesError):
        src.matching_routes(spark, str(tmp_path), ahl.ROUTES)


def scan(spark, root, route):
    return src.read_routes(spark, str(root), [route], "1")[route.table]


def test_cells_and_lineage(spark, tmp_path):
    land(tmp_path, "in/a b+c%20.csv", ["Policy Number", "At Risk"], [["8002016", ""], ["NA", "x\ny"]])
    plain = scan(spark, tmp_path, Route("r", "in/*.csv", "t"))
    assert rows(plain.select("policy_number", "at_risk", "source_file"), "at_risk") == [
        ("8002016", None, "a b+c%20.csv"), (None, "x\ny", "a b+c%20.csv")
    ]
    kept = scan(spark, tmp_path, Route("r", "in/*.csv", "t", keep_tokens=True))
    assert rows(kept.select("policy_number", "at_risk"), "at_risk") == [("8002016", ""), ("NA", "x\ny")]
    assert kept.select("source_modified_at").first()[0].year >= 2024


@pytest.mark.parametrize("multiline", [True, False])
def test_malformed_file_aborts_with_its_name(spark, tmp_path, multiline):
    path = tmp_path / "in" / "broken.csv"
    path.parent.mkdir()
    path.write_text('first,second\n"unterminated,field\n')
    with pytest.raises(Exception, match="broken.csv"):
        scan(spark, tmp_path, Route("r", "in/*.csv", "t", multiline=multiline)).collect()


@pytest.mark.parametrize("text", ['a,b\n"1","x\ny"\n', 'a,b\n1,"x\n2,y"\n', 'a,b\n1,"say ""hi"", x\n2,y"\n', "a,b\n1\n", "a,b\n1,2,3\n", "a,b\n1,x\x01y\n"])
def test_split_files_never_invent_rows(spark, tmp_path, text):
    """A quoted line break fails the load also where its fragments have the right width."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(text)
    with pytest.raises(Exception, match="a.csv"):
        scan(spark, tmp_path, Route("r", "in/*.csv", "t", multiline=False)).collect()


def test_split_and_whole_files_give_the_same_rows(spark, tmp_path):
    lines = [["1", 'say "hi", x'], ["", "a\\b"], [" 5 ", "NA"], ['"', "é"], ["a", "b"], ["x", ""]]
    land(tmp_path, "in/a.csv", ["a", "b"], lines)
    whole, split = (scan(spark, tmp_path, Route("r", "in/*.csv", "t", multiline=m)).select("a", "b", "row_id") for m in (True, False))
    assert rows(whole, "row_id") == rows(split, "row_id") and whole.count() == len(lines)


@pytest.mark.parametrize("header", [["B", "A"], ["A", "X"], ["a", "B"], ["A"]])
def test_header_contract(spark, tmp_path, header):
    land(tmp_path, "in/f.csv", header, [["1"] * len(header)])
    route = Route("r", "in/*.csv", "t", columns=("A", "B"))
    with pytest.raises(src.ContractError, match="f.csv"):
        src.check_contracts(spark, str(tmp_path), [route])
    with pytest.raises(src.ContractError, match="expected 2"):
        scan(spark, tmp_path, route)


def test_json_payload(spark, tmp_path):
    path = str(tmp_path / "p.json")
    with open(path, "w") as f:
        json.dump([{"polNo": 1, "extra": 2}, {"polNo": "x", "agtCode": None}], f)
    assert rows(read_json_array(spark, path, ["polNo", "agtCode"]), "pol_no") == [("1", None), ("x", None)]
    assert read_json_array(spark, path, limit=1).count() == 1
    with open(path, "w") as f:
        json.dump({"polNo": 1}, f)
    with pytest.raises(PayloadError):
        read_json_array(spark, path, ["polNo"])


def test_plain_header_csv(spark, tmp_path):
    path = land(tmp_path, "c.csv", ["customer_id", "email"], [["1", "a@example.com"], ["2", ""]])
    assert rows(src.read_header_csv(spark, path), "customer_id") == [("1", "a@example.com"), ("2", "")]


# ------------------------------------------------------------- policy flow

HEADER = ["mga", "policy_nbr", "cntrct_code", "billing_form", "billing_mode", "paid_to_date", "agent_ga_level_01", "agent_level_02"]


def policy_file(root, day, *lines):
    """(policy, code, paid_to)."""
    land(root, f"unl/inbound/UNLFYM_Policy_202606{day:02d}060000.csv", HEADER,
         [["m", p, c, "DIR", "3", paid, "100", "200"] for p, c, paid in lines])


@pytest.fixture
def warehouse(spark, tmp_path):
    root = str(tmp_path / "landing")
    return Tables(spark, str(tmp_path / "tables")), root


def history_of(out):
    typed = out["typed"].select("row_id", "policy_nbr", "file_date")
    return rows(typed.join(out["history"], "row_id").drop("row_id"), "policy_nbr", "file_date")


def test_policy_flow(spark, warehouse):
    tables, root = warehouse
    feed = FEEDS["unl"]
    policy_file(root, 1, ("p", "A", "20260501"), ("q", "A", "20260701"))
    policy_file(root, 5, ("p", "A", "20260601"), ("q", "T", "20260701"))
    land(root, "unl/inbound/CommissionStatements/WA_202JVV00_2026_06_10.csv",
         ["policy_nbr", "desc", "agent_nbr", "first_name", "last_name", "agency", "trans_type", "plan", "prem_paid_amt",
          "comm_rate", "comm_prem_amt", "adv_per", "amount", "effective_date", "paid_to_date", "last_activity_date"],
         [["p", " X ", "1", "", "", "", "", "", "+1", "2.5", "", "", "-3", "6/1/2026", "2026-06-02", "bad"]])
    out = flow.load(tables, feed, root, "1", NOW, roster(spark))
    assert out["typed"].count() == 4 and list(out["typed"].columns) == list(unl.POLICY.output)
    assert flow.row_counts(out) | {"typed": 4, "history": 4, "episodes": 1, "latest_typed": 2} == flow.row_counts(out)
    assert rows(out["episodes"].select("policy_nbr", "ep_start", "ep_end", "outcome")) == [
        ("p", dt.date(2026, 6, 1), dt.date(2026, 6, 5), "left_censored")
    ]
    advance = out["unl_weekly_advance_statements_latest"].first()
    assert (advance["insured_name"], advance["premium_paid_amount"], float(advance["amount"])) == ("X", None, -3.0)
    assert (advance["row_number"], advance["effective_date"], advance["last_activity_date"]) == (1, dt.date(2026, 6, 1), None)
    latest = rows(out["latest_typed"].select("policy_nbr", "carrier", "previous_contract_code"), "policy_nbr")
    assert latest == [("p", "unl", None), ("q", "unl", "A")]
    assert json.loads(out["latest_typed"].first()["roster_hierarchy_json"])[0]["name"] == "Top"

    # Nothing new: nothing changes.
    assert flow.load(tables, feed, root, "2", NOW, roster(spark)) == {}

    # The next file only extends; a repeated refresh of the same load changes nothing.
    policy_file(root, 9, ("p", "T", "20260601"), ("q", "T", "20260701"))
    out = flow.load(tables, feed, root, "2", NOW, roster(spark))
    name = flow.history_name(feed)
    assert len(tables.loads(name)) == 2 and tables.pending(flow.typed_name(feed.table), name)[:2] == (["1", "2"], [])
    extended = history_of(out)
    again = flow.refresh(tables, feed, NOW, roster(spark))
    assert history_of(again) == extended and again["typed"].count() == 6

    # A late file repairs its policies; all equal a rebuild from the same rows.
    policy_file(root, 7, ("p", "X", "20260601"))
    out = flow.load(tables, feed, root, "3", NOW, roster(spark))
    out["history"] = out["history"].select(*feed.history.output)
    full = dict(out, history=h.change_history(out["typed"], feed.history))
    assert history_of(out) == history_of(full) and len(history_of(out)) == 7

    ledger = flow.ledger(tables)
    assert ledger.filter(F.col("status") == audit.LOADED).count() == 5
    # The newest landing decides, even when its day is older.
    assert rows(out["latest_typed"].select("policy_nbr", "file_date")) != []


def test_failed_verification_leaves_everything_else(spark, warehouse):
    tables, root = warehouse
    policy_file(root, 1, ("p", "A", "20260501"))
    policy_file(root, 2)  # a header without rows
    with pytest.raises(audit.MissingLoadError, match="UNLFYM_Policy_20260602060000.csv"):
        flow.load(tables, FEEDS["unl"], root, "1", NOW)
    assert flow.ledger(tables).isEmpty()
    assert not any(tables.exists(n) for n in (flow.raw_name("unl_fym_policy"), flow.typed_name("unl_fym_policy")))
    # Mended, the same rows are stored once, and the newest file is the mended one.
    policy_file(root, 2, ("p", "T", "20260501"))
    out = flow.load(tables, FEEDS["unl"], root, "2", NOW)
    assert tables.read(flow.raw_name("unl_fym_policy")).count() == 2 and out["latest_raw"].count() == 1


def test_load_ids_have_no_order(spark, warehouse):
    tables, root = warehouse
    for load_id, day, code in (("9", 1, "A"), ("10", 2, "T"), ("1", 3, "X")):
        policy_file(root, day, ("p", code, "20260501"))
        out = flow.load(tables, FEEDS["unl"], root, load_id, NOW + dt.timedelta(hours=day))
    assert out["typed"].count() == out["history"].count() == 3
    assert [r["cntrct_code"] for r in out["latest_typed"].collect()] == ["X"]
    policy_file(root, 4, ("p", "Y", "20260501"))
    with pytest.raises(flow.LoadIdError):
        flow.load(tables, FEEDS["unl"], root, "10", NOW)


def test_a_policy_file_needs_its_key(spark, warehouse):
    tables, root = warehouse
    land(root, "unl/inbound/UNLFYM_Policy_20260601060000.csv", ["policy_number", *HEADER[2:]], [["p", "A", "", "", "", "", ""]])
    with pytest.raises(src.ContractError, match="policy_nbr"):
        flow.load(tables, FEEDS["unl"], root, "1", NOW)


class Stop(Exception):
    pass


def stopping(tables, monkeypatch, at):
    """Let the tables' ``at``-th step fail; a step is a write aside, a commit that is not made, or one that is. Returns the steps seen."""
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == at:
            raise Stop(name)

    write, create = Change._write, tables.log.create

    def writing(self, kind, name, rows, load_id):
        written = write(self, kind, name, rows, load_id)
        step(name)
        return written

    def creating(name, text):
        step("before commit")
        made = create(name, text)
        step("after commit")
        return made

    monkeypatch.setattr(Change, "_write", writing)
    monkeypatch.setattr(tables.log, "create", creating)
    return seen


def state_of(tables, feed, out):
    """What all of a feed's tables say, ids of loads aside."""
    def plain(df):
        return sorted(map(str, df.select(sorted(set(df.columns) - {"load_id", "raw_load_id", "load", "recorded_at"})).collect()))

    kept = [flow.raw_name(feed.table), f"{flow.history_name(feed)}_tail", f"{flow.episodes_name(feed)}_last", flow.intake_name(feed), flow.EVENTS]
    return {n: plain(tables.read(n)) for n in kept} | {n: plain(out[n]) for n in ("typed", "history", "episodes", "latest_typed", "latest_raw")}


def test_a_load_stopped_anywhere_is_made_good_under_any_id(spark, tmp_path):
    """Stopped at every commit of the second load, then loaded under another id: as if nothing had happened."""
    feed, root, base = FEEDS["unl"], str(tmp_path / "landing"), str(tmp_path / "base")

    def lay(n, day):
        path = land(root, f"unl/inbound/UNLFYM_Policy_202605{day}060000.csv", HEADER, [
            ["m", p, "AT"[n], "DIR", "3", paid, "100", "200"] for p, paid in (("p", "20260501"), ("q", "20260720"), (f"r{n}", "20260501"))
        ])
        os.utime(path, (1_780_000_000 + n,) * 2)

    lay(0, 21)
    flow.load(Tables(spark, base), feed, root, "1", NOW)
    lay(1, 17)  # late
    stop_at, steps, want = 0, [], None
    while stop_at <= len(steps):
        shutil.copytree(base, tmp_path / f"t{stop_at}")
        tables = Tables(spark, str(tmp_path / f"t{stop_at}"))
        with pytest.MonkeyPatch.context() as m:
            seen = stopping(tables, m, stop_at)
            if stop_at:
                with pytest.raises(Stop):
                    flow.load(tables, feed, root, "2", NOW)
            else:
                out = flow.load(tables, feed, root, "2", NOW)
                steps, want = list(seen), state_of(tables, feed, out)
                assert len(want["typed"]) == len(want[flow.raw_name(feed.table)]) == 6 and want["episodes"]
        if stop_at:
            again = Tables(spark, tables.root)
            out = flow.load(again, feed, root, "other", NOW)
            # Stopped after its last commit, nothing is left to do.
            assert state_of(again, feed, out) == want if out else stop_at == len(steps), (stop_at, steps[stop_at - 1])
        # What is written aside is not seen, so one stop between two commits stands for all.
        stop_at += 1
        while 1 < stop_at <= len(steps) and steps[stop_at - 1] != "after commit":
            stop_at += 1


def test_two_first_loads_at_once_keep_both(spark, tmp_path):
    """Two feeds that share the ledger, each publishing first; then one feed loaded twice at once."""
    root = str(tmp_path / "landing")
    ahl_file(root, 1, ("p", "A", "20260101"))
    policy_file(root, 1, ("p", "A", "20260501"))
    one, two = (Tables(spark, str(tmp_path / "t")) for _ in range(2))
    create, done = two.log.create, []

    def beaten(name, text):
        if not done:
            done.append(name)
            flow.load(one, FEEDS["unl"], root, f"one {name}", NOW, refresh_derived=False)
        return create(name, text)

    two.log.create = beaten
    flow.load(two, FEEDS["ahl"], root, "1", NOW, refresh_derived=False)
    assert sorted(r.provider for r in flow.ledger(one).collect()) == ["ahl", "unl"]
    policy_file(root, 2, ("p", "T", "20260501"))
    done.clear()
    with pytest.raises(ConflictError, match="intake/unl"):
        flow.load(two, FEEDS["unl"], root, "2", NOW)
    assert one.read(flow.raw_name("unl_fym_policy")).count() == 2
    assert flow.load(two, FEEDS["unl"], root, "3", NOW)["typed"].count() == 2


def test_the_newest_file_is_told_by_statistics(spark, warehouse):
    """Three loads with a tie of times; the view opens the folder of one load."""
    tables, root = warehouse
    feed = FEEDS["ahl"]
    for n, day in enumerate((2, 3, 1)):
        ahl_file(root, day, (f"p{day}", "A", "20260101"))
        os.utime(os.path.join(root, f"ahl/inbound/FYM_POL_202606{day:02d}.csv"), (1_780_000_000,) * 2)
        out = flow.load(tables, feed, root, str(n), NOW)
    # Times are equal: the raw view goes by load id, the typed one by the day of the file.
    assert [r["fympolkey"] for r in out["latest_raw"].collect()] == ["p1"]
    assert [r["policy_number"] for r in out["latest_typed"].collect()] == ["p3"]
    for view, name in (("latest_raw", flow.raw_name(feed.table)), ("latest_typed", flow.typed_name(feed.table))):
        opened = {f.split("/part-")[1].split("/")[0] for f in out[view].inputFiles() if f"{name}/part-" in f}
        assert len(opened) == 1


def test_kept_episodes_equal_the_whole(spark, warehouse, monkeypatch):
    """Loads in order and late; a later load reads new rows, days and the keys they touch."""
    from feedloom.operators.episodes import risk_episodes

    tables, root = warehouse
    feed = FEEDS["unl"]
    for n, day in enumerate((16, 18, 26, 21, 28, 17)):
        land(root, f"unl/inbound/UNLFYM_Policy_202605{day}060000.csv", HEADER, [
            ["m", f"p{i}", "T" if (i + day) % 7 == 0 else "A", "DIR", "3", "20260501" if (i * day) % 3 else "20260720", "", ""] for i in range(12) if (i + day) % 4
        ])
        out = flow.load(tables, feed, root, str(n), NOW)
        want = risk_episodes(tables.read(flow.typed_name(feed.table)), feed.key, feed.episodes)
        assert sorted(map(str, out["episodes"].collect())) == sorted(map(str, want.collect())) and want.count()
    name = flow.episodes_name(feed)
    assert len(tables.loads(f"{name}_days")) == 6 and tables.loads(f"{name}_last") == ["base"]


def test_statements_are_typed_by_load_unless_a_file_came_again(spark, warehouse):
    tables, root = warehouse
    header = [c.raw for c in unl.ADVANCES.columns]
    for n, (day, cells) in enumerate(((1, "ab"), (8, "c"), (1, "abd"))):
        path = land(root, f"unl/inbound/CommissionStatements/WA_202JVV00_2026_06_{day:02d}.csv", header, [[c] * len(header) for c in cells])
        os.utime(path, (1_780_000_000 + n,) * 2)
        out = flow.load(tables, FEEDS["unl"], root, str(n), NOW)["unl_weekly_advance_statements"]
        assert len(tables.loads(flow.typed_name("unl_weekly_advance_statements"))) == (1, 2, 1)[n]
    assert sorted((r["source_file"][-6:], r["row_number"]) for r in out.collect()) == [("01.csv", i) for i in range(1, 6)] + [("08.csv", 1)]


def test_statements_may_come_first(spark, warehouse):
    tables, root = warehouse
    land(root, "unl/inbound/CommissionStatements/WA_202JVV00_2026_06_10.csv", [c.raw for c in unl.ADVANCES.columns],
         [["x"] * len(unl.ADVANCES.columns)])
    out = flow.load(tables, FEEDS["unl"], root, "1", NOW)
    assert set(out) == {"unl_weekly_advance_statements", "unl_weekly_advance_statements_latest"}
    policy_file(root, 1, ("p", "A", "20260501"))
    assert flow.load(tables, FEEDS["unl"], root, "2", NOW)["history"].count() == 1


def test_stopped_refresh_is_completed_later(spark, warehouse, monkeypatch):
    """Typed rows stored, history not: the next load finds and adds what is missing."""
    tables, root = warehouse
    feed = FEEDS["unl"]
    policy_file(root, 1, ("p", "A", "20260501"))
    flow.load(tables, feed, root, "1", NOW)
    policy_file(root, 2, ("p", "T", "20260501"))
    with monkeypatch.context() as m:
        m.setattr(flow, "refresh_history", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            flow.load(tables, feed, root, "2", NOW)
    # No new file, but the refresh is not finished.
    assert flow.load(tables, feed, root, "x", NOW)["history"].count() == 2
    assert flow.load(tables, feed, root, "x", NOW) == {}
    policy_file(root, 3, ("p", "T", "20260501"))
    out = flow.load(tables, feed, root, "3", NOW)
    full = dict(out, history=h.change_history(out["typed"], feed.history))
    assert history_of(out) == history_of(full) and len(history_of(out)) == 3


def test_rewritten_file_loads_again(spark, warehouse):
    tables, root = warehouse
    policy_file(root, 1, ("p", "A", "20260501"))
    flow.load(tables, FEEDS["unl"], root, "1", NOW)
    policy_file(root, 1, ("p", "A", "20260501"))
    path = os.path.join(root, "unl/inbound/UNLFYM_Policy_20260601060000.csv")
    os.utime(path, (time.time() + 100,) * 2)
    out = flow.load(tables, FEEDS["unl"], root, "2", NOW)
    assert out["typed"].count() == 2


def ahl_file(root, day, *lines):
    fill = {"FYMPOLKEY": 0, "FYMSTATCOD": 1, "FYMISSDATE": 2}
    land(root, f"ahl/inbound/FYM_POL_202606{day:02d}.csv", ahl.HEADER,
         [[line[fill[c]] if c in fill else "" for c in ahl.HEADER] for line in lines])


def test_rebuild_checks_contracts_first(spark, warehouse):
    tables, root = warehouse
    feed = FEEDS["ahl"]
    ahl_file(root, 1, ("p", "A", "20260101"))
    out = flow.load(tables, feed, root, "1", NOW)
    assert out["episodes"].count() == 0 and "previous_contract_code" in out["latest_typed"].columns
    broken = land(root, "ahl/inbound/FYM_POL_20260602.csv", ["x"], [["1"]])
    with pytest.raises(src.ContractError):
        flow.rebuild(tables, feed, root, "2", NOW)
    assert tables.read(flow.typed_name(feed.table)).count() == 1
    os.remove(broken)
    ahl_file(root, 2, ("p", "T", "00000000"))
    out = flow.rebuild(tables, feed, root, "2", NOW)
    assert rows(out["typed"].select("contract_code", "issue_date", "file_date"), "file_date") == [
        ("A", dt.date(2026, 1, 1), dt.date(2026, 6, 1)), ("T", None, dt.date(2026, 6, 2))
    ]


def test_stream_equals_batch(spark, tmp_path):
    feed = FEEDS["ahl"]
    root = str(tmp_path / "landing")
    streamed, batch = (Tables(spark, str(tmp_path / n)) for n in ("streamed", "batch"))
    for day in (1, 2, 3):
        ahl_file(root, day, ("p", "AAT"[day - 1], "20260101"), ("q", "A", ""))
        start_intake(streamed, feed, feed.routes[0], root, str(tmp_path / "checkpoint"), lambda: NOW).awaitTermination()
    flow.load(batch, feed, root, "1", NOW)
    for name in ("", "_change_history"):
        tables = [t.read(flow.typed_name(feed.table + name)) for t in (streamed, batch)]
        columns = [c for c in tables[0].columns if c not in ("load_id", "raw_load_id")]
        one, two = (rows(t.select(columns), "row_id") for t in tables)
        assert one == two and len(one) == 6


@pytest.mark.parametrize("lines, error", [([], "no stored rows"), (None, "0 times")])
def test_stream_sees_files_without_rows(spark, tmp_path, lines, error):
    feed, root = FEEDS["ahl"], str(tmp_path / "landing")
    ahl_file(root, 1, ("p", "A", "20260101"))
    land(root, "ahl/inbound/FYM_POL_20260602.csv", ahl.HEADER if lines is not None else ["x"] * len(ahl.HEADER), lines or [])
    tables = Tables(spark, str(tmp_path / "t"))
    with pytest.raises(Exception, match=error):
        start_intake(tables, feed, feed.routes[0], root, str(tmp_path / "c"), lambda: NOW).awaitTermination()
    assert flow.ledger(tables).isEmpty() and not tables.exists(flow.raw_name(feed.table))


def test_stream_of_split_files(spark, tmp_path):
    feed, root = FEEDS["ahl"], str(tmp_path / "landing")
    ahl_file(root, 1, ("p", "A", "20260101"), ("q, r", "T", ""))
    tables = Tables(spark, str(tmp_path / "t"))
    route = replace(feed.routes[0], multiline=False)
    start_intake(tables, feed, route, root, str(tmp_path / "c"), lambda: NOW).awaitTermination()
    assert sorted(r[0] for r in tables.read(flow.raw_name(feed.table)).select("fympolkey").collect()) == ["p", "q, r"]


# ----------------------------------------------------------- snapshot flow

def payload(path, *items):
    with open(path, "w") as f:
        json.dump([dict(zip(("polNo", "agtCode", "hnlStatus", "upline", "clientState", "clientZip"), i)) for i in items], f)


def test_snapshot_flow(spark, tmp_path):
    tables, path = Tables(spark, str(tmp_path / "tables")), str(tmp_path / "p.json")
    payload(path, ("1", "10", "Active", "Up - 20", "12345", "TX"), ("1", "10", "Active", "Up - 20", "12345", "TX"))
    out = flow.load_snapshot(tables, path, "1", NOW)
    assert out["versions"].count() == 1
    assert rows(out["typed"].select("client_state", "client_zip")) == [("TX", "12345")]

    repeated = flow.load_snapshot(tables, path, "2", NOW + dt.timedelta(days=1))
    assert repeated["versions"].count() == 1

    payload(path, ("1", "10", "Lapsed", "Up - 20", "12345", "TX"))
    out = flow.load_snapshot(tables, path, "3", NOW + dt.timedelta(days=2))
    latest = out["latest"].first()
    assert out["latest"].count() == 1 and out["history"].count() == 2
    assert (latest["hnl_status"], latest["previous_hnl_status"], latest["previous_hnl_status_date"]) == (
        "Lapsed", "Active", NOW.date()
    )
    assert json.loads(latest["roster_hierarchy_json"]) == [
        {"depth": "01", "name": "Up", "writing_number": "20", "is_person": True}
    ]
    # A retry of the same load writes the same rows.
    retried = flow.refresh_snapshot(tables, tables.read(flow.raw_name(heartland.SNAPSHOT_TABLE)), "3", NOW + dt.timedelta(days=2))
    assert retried["versions"].count() == 2 and retried["typed"].count() == 2


def test_output_widths():
    assert {n: len(f.typed.output) for n, f in FEEDS.items()} == {"unl": 40, "gtl": 41, "ahl": 44, "manhattan": 40}
    assert replace(FEEDS["unl"], name="x").by_ledger and not FEEDS["ahl"].by_ledger
