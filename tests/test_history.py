import datetime as dt
import random
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from feedloom.operators import history as h
from feedloom.operators.skew import Order
from feedloom.plans import flow
from feedloom.sinks.tables import Tables

SCHEMA = "policy string, file_date date, source_file string, row_id string, code string, risk boolean"


def day(n):
    return None if n is None else dt.date(2026, 6, n)


def observations(spark, *items):
    """(policy, day, code) in file order; ids follow the position."""
    data = [(p, day(d), f"f{d}", f"r{i:04d}", c, c == "A") for i, (p, d, c) in enumerate(items)]
    return spark.createDataFrame(data, SCHEMA)


def spec(rule=h.RUNNING_MAX, nulls_first=False):
    return h.HistorySpec(
        key=("policy",), order=(Order("file_date", nulls_first), "source_file", "row_id"), row_id="row_id",
        date_rule=rule, tracked=(h.Tracked("code", "prev", "changed"), h.Tracked("risk", "prev_risk", "risk_changed")),
    )


def by_id(df):
    return {r["row_id"]: (r["prev"], r["changed"]) for r in df.collect()}


def test_first_observation_is_no_change(spark):
    out = by_id(h.change_history(observations(spark, ("p", 1, "A"), ("p", 2, "A"), ("p", 3, "T")), spec()))
    assert out == {"r0000": (None, None), "r0001": (None, None), "r0002": ("A", day(3))}


def test_null_is_a_value(spark):
    out = by_id(h.change_history(observations(spark, ("p", 1, "A"), ("p", 2, None), ("p", 3, "A")), spec()))
    assert out["r0001"] == ("A", day(2))
    assert out["r0002"] == (None, day(3))


def test_change_back_counts(spark):
    out = by_id(h.change_history(observations(spark, ("p", 1, "A"), ("p", 2, "T"), ("p", 3, "A"), ("p", 4, "A")), spec()))
    assert out["r0003"] == ("T", day(3))


@pytest.mark.parametrize("rule, expected", [
    (h.RUNNING_MAX, day(5)), (h.CHANGE_ROW, None), (h.PREVIOUS_ROW, day(5)),
])
def test_three_date_rules(spark, rule, expected):
    """Days 2, 5, NULL with a change on each: only the rule decides the reported day."""
    out = by_id(h.change_history(observations(spark, ("p", 2, "A"), ("p", 5, "T"), ("p", None, "X")), spec(rule)))
    assert out["r0002"] == ("T", expected)


def test_null_keys_are_one_group(spark):
    out = by_id(h.change_history(observations(spark, (None, 1, "A"), (None, 2, "T")), spec()))
    assert out["r0001"] == ("A", day(2))


def random_rows(spark, n=400, seed=1):
    rng = random.Random(seed)
    keys = ["hot"] * 12 + [None] * 5 + ["a", "b", "c"]
    return observations(spark, *[
        (rng.choice(keys), rng.choice([*range(1, 29), None]), rng.choice(["A", "T", "S", None])) for _ in range(n)
    ])


@pytest.mark.parametrize("rule, nulls_first", [(h.RUNNING_MAX, False), (h.CHANGE_ROW, True), (h.PREVIOUS_ROW, False)])
def test_hot_keys_give_the_same_history(spark, rule, nulls_first, request):
    typed = random_rows(spark)
    expected = rows(h.change_history(typed, spec(rule, nulls_first)), "row_id")
    request.getfixturevalue("hot")
    assert rows(h.change_history(typed, spec(rule, nulls_first)), "row_id") == expected


@pytest.mark.parametrize("cuts", [(10, 20), (14, 14)])
def test_incremental_equals_full(spark, cuts):
    """Rows without a day arrive with the second load."""
    typed = random_rows(spark)
    for rule, nulls_first in ((h.RUNNING_MAX, False), (h.CHANGE_ROW, True)):
        one = spec(rule, nulls_first)
        full = rows(h.change_history(typed, one), "row_id")
        stored = h.change_history(typed.limit(0), one)
        for upto in (*cuts, 31):
            known = typed.filter(F.coalesce(F.dayofmonth("file_date"), F.lit(cuts[1])) <= upto)
            stored = spark.createDataFrame(h.refreshed_history(known, stored, one).collect(), stored.schema)
        assert rows(stored, "row_id") == full


def test_incremental_hot_keys(spark, hot):
    typed = random_rows(spark)
    done = h.change_history(typed.filter("file_date < '2026-06-15'"), spec())  # days missing come last
    done = spark.createDataFrame(done.collect(), done.schema)
    both = done.unionByName(h.incremental_history(typed, done, spec()))
    assert rows(both, "row_id") == rows(h.change_history(typed, spec()), "row_id")


def test_late_files_are_repaired_in_any_order(spark):
    typed = random_rows(spark, 150)
    full = rows(h.change_history(typed, spec()), "row_id")
    stored, known = h.change_history(typed.limit(0), spec()), []
    for batch in ([2, 0], [1], [3]):
        known += batch
        seen = typed.filter((F.coalesce(F.dayofmonth("file_date"), F.lit(2)) % 4).isin(known))
        stored = spark.createDataFrame(h.refreshed_history(seen, stored, spec()).collect(), stored.schema)
    assert rows(stored, "row_id") == full


def test_same_day_resets_and_other_keys_stay(spark):
    typed = observations(spark, ("p", 1, "A"), ("q", 1, "A"), ("p", 1, "T"), ("q", 2, "T"), ("n", None, "A"))
    done = h.change_history(typed.filter("row_id < 'r0002'"), spec())
    late = h.out_of_order_keys(typed, done, spec())
    assert [r["policy"] for r in late.collect()] == ["p"]
    kept = h.out_of_order_reset(typed, done, spec())
    assert [r["row_id"] for r in kept.collect()] == ["r0001"]


def test_tails_carry_the_past(spark):
    typed = random_rows(spark)
    old, new = typed.filter("file_date < '2026-06-10'"), typed.filter("file_date >= '2026-06-10' OR file_date IS NULL")
    done = h.change_history(old, spec())
    past = h.tails(old, done, spec())
    assert h.late_keys(new, past, spec()).isEmpty()
    added = h.extend_history(new, past, spec())
    advanced = h.advanced_tails(past, new, added, spec())
    columns = sorted(advanced.columns)
    fresh = h.tails(typed, h.change_history(typed, spec()), spec())
    assert rows(advanced.select(columns), "policy") == rows(fresh.select(columns), "policy")


@pytest.mark.parametrize("rule", [h.RUNNING_MAX, h.CHANGE_ROW, h.PREVIOUS_ROW])
def test_tails_of_a_rebuild_need_no_stored_history(spark, hot, rule):
    typed = random_rows(spark)
    joined = h.tails(typed, h.change_history(typed, spec(rule)), spec(rule))
    columns = sorted(joined.columns)
    assert rows(h.rebuilt_tails(typed, spec(rule)).select(columns), "policy") == rows(joined.select(columns), "policy")


def test_a_load_that_is_late_for_most_keys_joins_no_rows_by_id(spark, tmp_path, monkeypatch):
    typed = random_rows(spark).withColumn("late", F.dayofmonth("file_date") < 10)
    tables, feed = Tables(spark, str(tmp_path)), SimpleNamespace(table="policies", history=spec())
    for load_id, late in (("1", False), ("2", True)):
        tables.append("typed/policies", typed.filter(F.coalesce("late", F.lit(False)) == late).drop("late"), load_id)
        if late:
            monkeypatch.setattr(h, "tails", None)
            monkeypatch.setattr(h, "refreshed_history", None)
        found = flow.refresh_history(tables, feed)
    full = h.change_history(typed, spec())
    assert rows(found.select(full.columns), "row_id") == rows(full, "row_id")
    kept = tables.read("typed/policies_change_history_tail")
    assert kept.count() == typed.select("policy").distinct().count()


def test_a_missing_day_resets_what_sorts_before_it(spark):
    typed = observations(spark, ("p", 1, "A"), ("p", None, "B"), ("p", 2, "C"), ("q", 1, "A"), ("q", None, "B"))
    done = h.change_history(typed.filter("row_id < 'r0002' OR row_id = 'r0003'"), spec())
    assert [r["policy"] for r in h.out_of_order_keys(typed, done, spec()).collect()] == ["p"]
    full = rows(h.change_history(typed, spec()), "row_id")
    assert rows(h.refreshed_history(typed, done, spec()), "row_id") == full


def test_correct_and_append(spark):
    stored = spark.createDataFrame([("a", "x", day(1)), ("b", None, None)], "row_id string, prev string, changed date")
    computed = spark.createDataFrame(
        [("a", "x", day(1)), ("b", "y", day(2)), ("c", "z", day(3))], "row_id string, prev string, changed date"
    )
    assert rows(h.correct_and_append(stored, computed, "row_id", ["prev", "changed"]), "row_id") == rows(computed, "row_id")


def test_partitioning_does_not_matter(spark):
    typed = random_rows(spark)
    one, many = (rows(h.change_history(typed.repartition(n), spec()), "row_id") for n in (1, 17))
    assert one == many
