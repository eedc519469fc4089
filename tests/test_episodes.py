import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from feedloom.operators.episodes import (
    EpisodeRule, day_bounds, extended, late_keys, merged_days, risk_days, risk_episodes, sessions, split_last, with_outcomes,
)

START = dt.date(2026, 6, 1)
RULE = EpisodeRule("d", lambda: F.col("risk"), lambda: F.col("cure"), lambda: F.col("term"))


def at(n):
    return START + dt.timedelta(days=n)


def episodes(spark, items, last=60):
    """(day, kinds) of policy p; another policy spans the whole period."""
    data = [("p", at(d), "r" in k, "c" in k, "t" in k) for d, k in items]
    data += [("other", at(0), False, False, False), ("other", at(last), False, False, False)]
    df = spark.createDataFrame(data, "policy string, d date, risk boolean, cure boolean, term boolean")
    out = risk_episodes(df, "policy", RULE)
    return [(r.episode_id, r.ep_start, r.ep_end, r.cure_date, r.term_date, r.outcome) for r in out.orderBy("episode_id").collect()]


def outcomes(*args):
    return [e[-1] for e in episodes(*args)]


def test_gap_of_seven_joins_and_eight_splits(spark):
    found = episodes(spark, [(10, "r"), (17, "r"), (25, "r")])
    assert [(e[0], e[1], e[2]) for e in found] == [(1, at(10), at(17)), (2, at(25), at(25))]


def test_rows_of_one_day_share_an_episode(spark):
    assert len(episodes(spark, [(10, "r"), (10, "r"), (10, "")])) == 1


@pytest.mark.parametrize("offset, expected", [(7, "saved"), (8, "ended_no_resolution")])
def test_cure_window(spark, offset, expected):
    assert outcomes(spark, [(10, "r"), (10 + offset, "c")]) == [expected]


def test_cure_inside_an_episode_does_not_count(spark):
    assert episodes(spark, [(10, "r"), (12, "c"), (15, "r"), (18, "t")])[0][3:] == (None, at(18), "lost")


def test_cure_and_termination_on_one_day(spark):
    assert outcomes(spark, [(10, "r"), (12, "ct")]) == ["saved"]


def test_termination_first(spark):
    assert outcomes(spark, [(10, "r"), (12, "t"), (13, "c")]) == ["lost"]


def test_start_on_first_day_is_censored_even_if_cured(spark):
    assert outcomes(spark, [(0, "r"), (2, "c")]) == ["left_censored"]


@pytest.mark.parametrize("end, expected", [(53, "still_open"), (52, "ended_no_resolution")])
def test_open_at_the_end(spark, end, expected):
    assert outcomes(spark, [(end, "r")]) == [expected]


def test_start_floor_moves_the_first_day(spark):
    data = spark.createDataFrame(
        [("p", at(0), True), ("p", at(20), True), ("q", at(60), False)], "policy string, d date, risk boolean"
    )
    rule = replace(RULE, cure=lambda: F.lit(False), term=lambda: F.lit(False), start=at(10))
    out = risk_episodes(data, "policy", rule).collect()
    assert [(r.ep_start, r.outcome) for r in out] == [(at(20), "left_censored")]


def test_null_flags_and_keys_are_not_risky(spark):
    data = spark.createDataFrame(
        [(None, at(5), True), ("p", at(5), None), ("p", at(6), True), ("q", at(0), False)],
        "policy string, d date, risk boolean",
    )
    out = risk_episodes(data, "policy", replace(RULE, cure=lambda: F.lit(False), term=lambda: F.lit(False))).collect()
    assert [(r.policy, r.ep_start) for r in out] == [("p", at(6))]


@pytest.mark.parametrize("seed", range(4))
def test_kept_episodes_equal_all_of_them(spark, seed):
    """Random loads, some days late, some repeated: what is kept between loads gives the episodes of all rows."""
    rng = random.Random(seed)
    rows, last, closed, days = [], None, None, None
    for load in range(4):
        fresh = []
        for _ in range(25):
            day = rng.randrange(0, 40) if rng.random() < 0.2 else 12 * load + rng.randrange(0, 13)
            fresh.append((rng.choice("pqrstuv"), at(day), *[rng.random() < x for x in (0.4, 0.3, 0.2)]))
        rows += fresh
        df = spark.createDataFrame(fresh, "policy string, d date, risk boolean, cure boolean, term boolean")
        new = risk_days(df, "policy", RULE)
        days = new if days is None else days.unionByName(new)
        if last is None:
            closed, last = split_last(new, sessions(new, "policy"), "policy")
        else:
            late = late_keys(new, last, "policy")
            again = merged_days(days.join(late, "policy", "left_semi"), "policy")
            redone = split_last(again, sessions(again, "policy"), "policy")
            on = new.join(late, "policy", "left_anti")
            more = extended(on, last, "policy")
            closed = closed.join(late, "policy", "left_anti").unionByName(redone[0]).unionByName(more[0])
            last = last.join(new.select("policy").distinct(), "policy", "left_anti").unionByName(redone[1]).unionByName(more[1])
        closed, last = (spark.createDataFrame(x.collect(), x.schema) for x in (closed, last))
    everything = spark.createDataFrame(rows, "policy string, d date, risk boolean, cure boolean, term boolean")
    kept = closed.unionByName(last.filter("episode_id IS NOT NULL").select(closed.columns))
    got = with_outcomes(kept, day_bounds(everything, RULE), "policy")
    want = risk_episodes(everything, "policy", RULE)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and want.count() > 7
