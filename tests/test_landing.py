"""Files that queries land before they read them."""

import datetime as dt

import pytest
from conftest import rows

from feedloom.plans.specs import Route
from feedloom.queries import RUNS, refreshes
from feedloom.sources import files as src

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def order(key, customer, year):
    return key, customer, "FOP"[key % 3], 100.5 + key, dt.datetime(year, 3, 1), "1-URGENT"


@pytest.fixture
def orders(spark, tmp_path):
    """A folder with orders in a file per list, which a task each reads, the largest file first."""
    def write(*parts):
        for part in parts:
            spark.createDataFrame(part, ORDERS).coalesce(1).write.mode("append").parquet(str(tmp_path / "orders.parquet"))
        return str(tmp_path)

    return write


@pytest.mark.parametrize("name", ["load_flow", "stream_flow"])
def test_tasks_without_rows_land_no_file(spark, orders, name):
    late = [order(k, k, 1998 + k % 3) for k in range(300)]
    early = [order(k, k, 1996) for k in range(1000, 1020)]
    found = rows(RUNS[name](spark, orders(late, early)).select("policy"))
    assert len(found) == 320


def test_the_newest_landing_is_the_whole_last_day(spark, orders):
    day = [order(k, k, 2001) for k in range(700)]
    found = rows(RUNS["refresh_latest"](spark, orders(day, [order(k, k - 1000, 1996) for k in range(1000, 1020)])).select("policy_nbr"))
    assert len(found) == 700


def test_files_of_a_day_grow_instead_of_their_number(spark, orders, tmp_path):
    folder = orders([order(k, k, 1995) for k in range(10_000)])
    for most, files in ((refreshes.MOST_FILES, 16), (1, 1), (None, 20)):
        refreshes.land_year(spark, folder, f"{folder}/{most}", 1995, most)
        landed = list((tmp_path / str(most) / "unl/inbound").glob("UNLFYM_Policy_20260510*.csv"))
        assert len(landed) == files
        assert sum(len(f.read_text().splitlines()) - 1 for f in landed) == 10_000


def test_files_of_a_scan_are_listed_many_to_a_task(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"f{i:02d}.csv").write_text("a,b\n1,2\n")
    route = Route("files", "*.csv", "files")
    found = src.landed(spark, str(tmp_path), route.glob)
    spark.sparkContext.setJobGroup("listing", "scan")
    try:
        scan = src.scan_route(spark, found, route)
        tracker = spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) <= 8
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert scan.count() == 60


def test_headers_need_few_calls_a_file(spark, tmp_path, monkeypatch):
    for i in range(20):
        (tmp_path / f"f{i:02d}.csv").write_text("\ufeffa,\"b,c\"\n1,2\n")
    found, sent = src.landed(spark, str(tmp_path), "*.csv"), []
    client = spark._jvm._gateway_client
    monkeypatch.setattr(client, "send_command", lambda *a, real=client.send_command, **k: sent.append(a) or real(*a, **k))
    assert set(src.headers_of(spark, found).values()) == {("a", "b,c")}
    assert len([a for a in sent if not a[0].startswith("m\n")]) < 20 * 15  # without the release of objects
