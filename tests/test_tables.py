"""Merges, versions, ledger, verification, freshness, latest, typed profile."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from feedloom.operators import audit, latest, merge, typed, versions
from feedloom.plans.specs import DATE, INT, Col, TypedSpec
from feedloom.sinks import commits
from feedloom.sinks.commits import ConflictError
from feedloom.sinks.tables import Tables

NOW = dt.datetime(2026, 7, 1, tzinfo=dt.timezone.utc)
KV = "k string, v string"


def test_merges(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], KV)
    new = spark.createDataFrame([("b", "x"), ("c", "y"), ("c", "z")], KV)
    assert rows(merge.insert_only(old, new, ["k"]), "k") == [("a", "1"), ("b", "2"), ("c", "y")]
    assert rows(merge.upsert(old, new, ["k"], [F.desc("v")]), "k") == [("a", "1"), ("b", "x"), ("c", "z")]
    assert rows(merge.mirror(old, new, ["k"]), "k") == [("b", "x"), ("c", "y")]
    assert rows(merge.delete_missing(old, new, ["k"]), "k") == [("b", "2")]
    assert rows(merge.delete_keys(old, new, ["k"]), "k") == [("a", "1")]


def test_merges_are_idempotent(spark):
    old = spark.createDataFrame([("a", "1")], KV)
    new = spark.createDataFrame([("a", "2"), ("b", "3")], KV)
    for operation in (merge.insert_only, merge.upsert, merge.mirror):
        once = operation(old, new, ["k"])
        assert rows(operation(once, new, ["k"]), "k") == rows(once, "k")


def test_first_run_equals_later_runs(spark):
    new = spark.createDataFrame([("a", "2")], KV)
    assert rows(merge.insert_only(merge.empty_like(spark, new.schema), new, ["k"])) == [("a", "2")]


def test_either_key(spark):
    source = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", None)], "x string, y string")
    stored = spark.createDataFrame([("1", "zz"), ("9", "b"), (None, None)], "p string, q string")
    assert rows(merge.either_key_unseen(source, stored, {"x": "p", "y": "q"}).select("x"), "x") == [("3",), ("4",)]


def test_versions(spark):
    def snapshot(*values):
        return spark.createDataFrame([(f"id{i}", *v) for i, v in enumerate(values)], "row_id string, a string, b string")

    first = versions.new_versions(snapshot(("x", None), ("x", None), ("x", "")), None, ["a", "b"], "row_id", NOW)
    assert rows(first.select("row_id"), "row_id") == [("id0",), ("id2",)]
    same = versions.version_snapshot(snapshot(("x", None), ("x", "")), first, ["a", "b"], "row_id", NOW)
    assert same.count() == 2
    more = versions.version_snapshot(snapshot(("x", None), ("y", None)), first, ["a", "b"], "row_id", NOW)
    assert more.count() == 3


def events(spark, *items):
    data = [(i, "unl", s, t, size, status, error) for i, (s, t, size, status, error) in enumerate(items)]
    return spark.createDataFrame(data, audit.EVENT_SCHEMA)


def test_ledger_keeps_sizes_and_separates_paths(spark):
    ledger = spark.createDataFrame([], audit.LEDGER_SCHEMA)
    ledger = audit.record_files(events(
        spark, ("/in/a.csv", "/in/a.csv", 10, audit.MOVED, None), ("/in/a.csv", "/in/a.csv", None, audit.LOADED, None),
        ("/in/a.csv", "/old/a.csv", None, audit.ARCHIVED, None),
    ), ledger, NOW)
    found = rows(ledger.select("target_path", "file_name", "file_size_bytes", "status"), "target_path")
    assert found == [("/in/a.csv", "a.csv", 10, audit.LOADED), ("/old/a.csv", "a.csv", None, audit.ARCHIVED)]
    later = NOW + dt.timedelta(hours=1)
    again = audit.record_files(events(spark, ("/in/a.csv", "/in/a.csv", None, audit.LOADED, "late")), ledger, later)
    row = again.filter("target_path = '/in/a.csv'").first()
    assert (row["file_size_bytes"], row["error_message"]) == (10, "late")
    assert again.agg(F.max("landed_at")).first()[0].hour == 1


def test_missing_loads_are_all_listed(spark):
    expected = spark.createDataFrame([("t", "a.csv"), ("t", "b.csv"), ("u", "c.csv")], "table_name string, file_name string")
    stored = {"t": spark.createDataFrame([("a.csv",)], "source_file string")}
    with pytest.raises(audit.MissingLoadError, match=r"t <- b.csv, u <- c.csv"):
        audit.require_loads(expected, stored)
    audit.require_loads(expected.limit(0), {})


@pytest.mark.parametrize("age, name, found, recent", [
    (dt.timedelta(hours=30), "UNLFYM_Policy_20260630000000.csv", True, True),
    (dt.timedelta(hours=30, seconds=1), "FYM_Policy_20260630000000.csv", True, False),
    (dt.timedelta(hours=1), "FYM_Policy_2026.csv", False, False),
])
def test_freshness(spark, age, name, found, recent):
    ledger = spark.createDataFrame(
        [("unl", "s", "t", name, 1, audit.LOADED, None, NOW - age), ("unl", "s", "u", name, 1, audit.ARCHIVED, None, NOW),
         ("gtl", "s", "t", name, 1, audit.LOADED, None, NOW)], audit.LEDGER_SCHEMA
    )
    row = audit.freshness(ledger, "unl", NOW).first()
    assert (row["found"], row["is_recent"]) == (found, recent)
    assert row["age_seconds"] == (age.total_seconds() if found else None)


def test_latest_file_ties_end_with_the_name(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("c", None, 9)], "source_file string, m int, l int")
    assert rows(latest.latest_file_by_metadata(df, ["m", "l"])) == [("b",)]


def test_latest_version_takes_null_first(spark):
    df = spark.createDataFrame([("p", 1, "a"), ("p", None, "b"), (None, 1, "c"), (None, 2, "d")], "k string, t int, id string")
    assert rows(latest.latest_version(df, ["k"], ["t", "id"]).select("id"), "id") == [("b",), ("d",)]


def test_reject_profile(spark):
    df = spark.createDataFrame([("20260101", "1"), ("bad", ""), (" ", "x")], "d string, n string")
    profile = typed.reject_profile(df, TypedSpec((Col("d", DATE), Col("n", INT))))
    assert rows(profile, "column_name") == [("d", 3, 2, 1), ("n", 3, 2, 1)]


@pytest.mark.parametrize("code, mode, paid, expected", [
    ("A", 3, 1, True), ("A", 3, 2, False), (None, 3, 1, None), (None, 1, 1, False), ("A", 3, None, False), ("T", None, 1, False),
])
def test_three_valued_risk(spark, code, mode, paid, expected):
    paid_to = None if paid is None else dt.date(2026, 1, paid)
    df = spark.createDataFrame(
        [(code, "DIR", mode, paid_to, dt.date(2026, 1, 2))],
        "cntrct_code string, billing_form string, billing_mode int, paid_to_date date, file_date date",
    )
    assert df.select(typed.at_risk()).first()[0] is expected


def test_unset_cursor_is_an_error(spark):
    df = spark.createDataFrame([("1",), (None,)], "load_id string")
    with pytest.raises(Exception, match="load_id is not set"):
        typed.newer_loads(df, None).collect()


def test_export_keeps_every_value(spark, tmp_path):
    from feedloom.sinks import export

    texts = ['say "hi", Bob', " 5 ", "a\nb", "", None, "007", "back\\slash", ",", '"']
    columns = list(export.EXPORT_COLUMNS.values())
    data = [("007", i, *[t] * len(columns)) for i, t in enumerate(texts)]
    schema = ", ".join(["source_report_id string", "row_number long", *[f"{c} string" for c in columns]])
    lines = spark.createDataFrame(data, schema)
    options = spark.createDataFrame([("007", "01/05/2026", "WA")], "report_id string, option_value string, commission_type string")
    reports = spark.createDataFrame([("007", "r.csv")], "id string, original_filename string")
    path = str(tmp_path / "out")
    manifest = export.export_reports(export.report_manifest(options, reports, lines), lines, path)
    assert manifest.first()["row_count"] == len(texts)
    back = export.read_export(spark, path).select("source_report_id", "amount", "plan").collect()
    assert {r["source_report_id"] for r in back} == {"007"}
    assert sorted(r["amount"] or "" for r in back) == sorted(t or "" for t in texts)
    assert sorted(r["plan"] or "" for r in back) == sorted((t or "").strip(" ") for t in texts)
    one = next(p for p in (tmp_path / "out").rglob("part-*.csv") if "_manifest" not in str(p))
    import csv

    with open(one, newline="") as f:
        assert sorted(r["amount"] for r in csv.DictReader(f)) == sorted(t or "" for t in texts)



def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def test_tables_change_by_commits(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    assert tables.read("a") is None and not tables.exists("a") and tables.loads("a") == []
    tables.append("a", frame(spark, 1), "10")
    before = tables.read("a")
    change = tables.change()
    assert rows(change.append("a", frame(spark, 2, 3), "9"), "n") == [(2,), (3,)]
    assert rows(tables.read("a"), "n") == [(1,)]
    change.discard()
    tables.append("a", frame(spark, 2, 4), "9")
    assert rows(tables.read("a"), "n") == [(1,), (2,), (4,)] and tables.loads("a") == ["10", "9"]
    assert rows(tables.read("a", only=["9"]), "n") == [(2,), (4,)] and rows(tables.read("a", without=["9"]), "n") == [(1,)]
    assert rows(tables.read("a", only=[])) == [] and tables.read_load("a", "x") is None
    tables.append("a", frame(spark, 5), "9")
    assert rows(tables.read("a"), "n") == [(1,), (5,)]
    assert tables.replace("a", tables.read("a").filter("n > 1")).count() == 1
    # The replaced folders stay for readers that have begun, until the next replacement.
    assert rows(before) == [(1,)]
    tables.replace("a", tables.read("a"))
    assert rows(tables.read("a"), "n") == [(5,)]
    with pytest.raises(Exception, match="(?i)not.exist|not found"):
        before.collect()
    tables.drop(["a"])
    assert tables.read("a") is None


def test_one_commit_shows_all_tables_or_none(spark, tmp_path):
    tables, other = (Tables(spark, str(tmp_path / "t")) for _ in range(2))
    change = tables.change()
    change.append("a", frame(spark, 1), "1")
    change.replace("b", frame(spark, 2))
    change.mark("step", 0)
    assert not other.exists("a") and not other.exists("b")
    assert change.publish() == 0
    assert rows(other.read("a")) == [(1,)] and rows(other.read("b")) == [(2,)]
    assert other.pending("a", "step") == (["1"], [], 0)
    tables.append("a", frame(spark, 3), "2")
    assert other.pending("a", "step") == (["1", "2"], ["2"], 1)


def test_two_first_appends_keep_both(spark, tmp_path):
    """Both writers find no table; the second one to publish meets a number that is taken."""
    one, two = (Tables(spark, str(tmp_path / "t")) for _ in range(2))
    first, second = one.change(), two.change()
    first.append("a", frame(spark, 1), "A")
    second.append("a", frame(spark, 2), "B")
    create, raced = two.log.create, []

    def beaten(name, text):
        if not raced:
            raced.append(name)
            first.publish()
        return create(name, text)

    two.log.create = beaten
    assert second.publish() == 1 and raced == ["000000000000.commit"]
    assert one.loads("a") == two.loads("a") == ["A", "B"] and rows(one.read("a"), "n") == [(1,), (2,)]


def test_a_replacement_of_what_has_changed_is_refused(spark, tmp_path):
    one, two = (Tables(spark, str(tmp_path / "t")) for _ in range(2))
    one.replace("a", frame(spark, 1))
    seen = two.read("a")
    one.append("a", frame(spark, 2), "x")
    with pytest.raises(ConflictError, match="a"):
        two.replace("a", seen)
    assert rows(one.read("a"), "n") == [(1,), (2,)]
    # Read again, it goes through; so does a change that depends on an untouched table.
    assert two.replace("a", two.read("a")).count() == 2
    change = one.change(depends=["b"])
    two.append("a", frame(spark, 3), "y")
    change.append("a", frame(spark, 4), "z")
    change.publish()
    change = one.change(depends=["a"])
    two.append("a", frame(spark, 5), "w")
    change.append("c", frame(spark, 6), "z")
    with pytest.raises(ConflictError):
        change.publish()
    assert rows(two.read("a"), "n") == [(1,), (2,), (3,), (4,), (5,)] and not two.exists("c")


def test_many_commits_are_summed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "EVERY", 3)
    tables = Tables(spark, str(tmp_path / "t"))
    for i in range(7):
        change = tables.change()
        change.mark(f"m{i % 2}", i)
        change.changes.append({"do": "append", "table": "a", "load": str(i), "folder": f"f{i}", "schema": "{}"})
        change.publish()
    fresh = Tables(spark, str(tmp_path / "t"))
    read, opened = fresh.log._read, []
    fresh.log._read = lambda name: opened.append(name) or read(name)
    assert fresh.loads("a") == [str(i) for i in range(7)] and fresh.log.state().marks == {"m0": 6, "m1": 5}
    assert opened == ["000000000005.sum", "000000000006.commit"]
    assert fresh.log.state().written() == tables.log.state().written()


def test_sweep_removes_what_no_commit_names(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    tables.append("a", frame(spark, 1), "1")
    tables.change().append("a", frame(spark, 2), "2")
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=2)
    assert tables.sweep("a", dt.timedelta(days=1), later) == 0
    assert tables.sweep("a", dt.timedelta(hours=1), later) == 1
    assert rows(tables.read("a")) == [(1,)] and tables.sweep("none", dt.timedelta(0), later) == 0
