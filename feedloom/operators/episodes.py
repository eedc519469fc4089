"""At-risk episodes and what became of them.

Risk days of a policy form one episode while gaps stay within ``gap_days``. A cure or
termination counts in the window (end, end + gap_days]. Since the next episode starts
more than ``gap_days`` after an end, each such day belongs to one episode only, namely
that of the last risk day before it. So no interval join is needed: rows are reduced
to one per policy and day (map-side combined, which also bounds a hot policy by the
calendar), and a single sort per policy answers everything.

Between loads a policy is one row: its last episode with what followed it, and its last
day. Later days go on from there, and that episode's risk end, cure and termination stand
for all before. A policy with a day before its last one is taken again from all its days.
Outcomes depend on the first and last day of the whole feed, so they are told when
episodes are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Outcomes in order of precedence, and the default rule.
LEFT_CENSORED, SAVED, LOST, STILL_OPEN, UNRESOLVED = (
    "left_censored", "saved", "lost", "still_open", "ended_no_resolution",
)
GAP_DAYS = 7
FLAGS = ("risk", "cure", "term")
FACTS = ("episode_id", "ep_start", "ep_end", "cure_date", "term_date")


@dataclass(frozen=True)
class EpisodeRule:
    """What a row says about its day."""

    day: str
    risk: Callable[[], Column]
    cure: Callable[[], Column]
    term: Callable[[], Column]
    gap_days: int = GAP_DAYS
    #: Earlier observations do not count.
    start: dt.date | None = None


def _counted(observations: DataFrame, rule: EpisodeRule) -> DataFrame:
    return observations if rule.start is None else observations.filter(F.col(rule.day) >= F.lit(rule.start))


def day_bounds(observations: DataFrame, rule: EpisodeRule) -> DataFrame:
    """One row: the first and last day over all rows, at risk or not."""
    return _counted(observations, rule).agg(F.min(rule.day).alias("first_day"), F.max(rule.day).alias("last_day"))


def merged_days(days: DataFrame, key: str) -> DataFrame:
    """One row per key and day; a flag of any row counts."""
    return days.groupBy(key, "day").agg(*[F.max(f).alias(f) for f in FLAGS])


def risk_days(observations: DataFrame, key: str, rule: EpisodeRule) -> DataFrame:
    """(key, day, risk, cure, term) for days on which something is so."""
    flags = [F.coalesce(f(), F.lit(False)).alias(n) for n, f in zip(FLAGS, (rule.risk, rule.cure, rule.term), strict=True)]
    rows = _counted(observations, rule).select(F.col(key), F.col(rule.day).alias("day"), *flags)
    rows = rows.filter(F.col(key).isNotNull() & F.col("day").isNotNull() & (F.col("risk") | F.col("cure") | F.col("term")))
    return merged_days(rows, key)


def sessions(days: DataFrame, key: str, gap_days: int = GAP_DAYS) -> DataFrame:
    """(key, episode_id, ep_start, ep_end, cure_date, term_date) from merged days."""
    in_order = Window.partitionBy(key).orderBy("day")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    risk_day = F.when(F.col("risk"), F.col("day"))
    days = days.withColumn("_before", F.last(risk_day, ignorenulls=True).over(earlier))
    starts = F.col("risk") & (F.col("_before").isNull() | (F.datediff(F.col("day"), F.col("_before")) > gap_days))
    days = days.withColumns({
        "episode_id": F.sum(starts.cast("long")).over(in_order),
        "_last_risk": F.coalesce(risk_day, F.col("_before")),
    }).filter(F.col("episode_id") > 0)

    # What follows each risk day in reach; only the last risk day's findings count.
    after = ~F.col("risk") & (F.datediff(F.col("day"), F.col("_last_risk")) <= gap_days)
    stretches = days.groupBy(key, "episode_id", "_last_risk").agg(
        F.min(F.when(after & F.col("cure"), F.col("day"))).alias("_cured"),
        F.min(F.when(after & F.col("term"), F.col("day"))).alias("_ended"),
    )
    return stretches.groupBy(key, "episode_id").agg(
        F.min("_last_risk").alias("ep_start"),
        F.max("_last_risk").alias("ep_end"),
        F.max_by("_cured", "_last_risk").alias("cure_date"),
        F.max_by("_ended", "_last_risk").alias("term_date"),
    )


def with_outcomes(episodes: DataFrame, bounds: DataFrame, key: str, gap_days: int = GAP_DAYS) -> DataFrame:
    """The episodes with their outcome; ``bounds`` may come in parts."""
    bounds = bounds.agg(F.min("first_day").alias("_first_day"), F.max("last_day").alias("_last_day"))
    outcome = (
        F.when(F.col("ep_start") == F.col("_first_day"), LEFT_CENSORED)
        .when(
            F.col("cure_date").isNotNull()
            & (F.col("term_date").isNull() | (F.col("cure_date") <= F.col("term_date"))),
            SAVED,
        )
        .when(F.col("term_date").isNotNull(), LOST)
        .when(F.col("ep_end") >= F.date_sub(F.col("_last_day"), gap_days), STILL_OPEN)
        .otherwise(UNRESOLVED)
    )
    return episodes.crossJoin(F.broadcast(bounds)).select(key, *FACTS, outcome.alias("outcome"))


def risk_episodes(observations: DataFrame, key: str, rule: EpisodeRule) -> DataFrame:
    """(key, episode_id, ep_start, ep_end, cure_date, term_date, outcome)."""
    found = sessions(risk_days(observations, key, rule), key, rule.gap_days)
    return with_outcomes(found, day_bounds(observations, rule), key, rule.gap_days)


# ---------------------------------------------------------------- between loads

def split_last(days: DataFrame, episodes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Episodes that are not their key's last, and one row per key of ``days``: its last day and last episode, if any."""
    newest = Window.partitionBy(key).orderBy(F.col("episode_id").desc())
    numbered = episodes.withColumn("_nth", F.row_number().over(newest))
    last = numbered.filter("_nth = 1").drop("_nth")
    seen = days.groupBy(key).agg(F.max("day").alias("last_day"))
    return numbered.filter("_nth > 1").drop("_nth"), seen.join(last, key, "left").select(key, "last_day", *FACTS)


def late_keys(days: DataFrame, last: DataFrame, key: str) -> DataFrame:
    """Keys with a new day before their last one. The last day itself may come again."""
    first = days.groupBy(key).agg(F.min("day").alias("_first"))
    return first.join(last.select(key, "last_day"), key).filter(F.col("_first") < F.col("last_day")).select(key)


def extended(days: DataFrame, last: DataFrame, key: str, gap_days: int = GAP_DAYS) -> tuple[DataFrame, DataFrame]:
    """What ``split_last`` gives for the keys of the new ``days``, which go on from their last rows."""
    past = last.join(days.select(key).distinct(), key, "left_semi")
    no, yes = F.lit(False), F.lit(True)
    known = [("ep_end", (yes, no, no)), ("cure_date", (no, yes, no)), ("term_date", (no, no, yes))]
    told = past.select(key, F.explode(F.array(*[
        F.struct(F.col(c).alias("day"), *[f.alias(n) for f, n in zip(flags, FLAGS, strict=True)]) for c, flags in known
    ])).alias("d")).select(key, "d.*").filter(F.col("day").isNotNull())
    found = sessions(merged_days(days.select(key, "day", *FLAGS).unionByName(told), key), key, gap_days)
    before = past.select(key, F.col("episode_id").alias("_id"), F.col("ep_start").alias("_start"))
    goes_on = (F.col("episode_id") == 1) & F.col("_id").isNotNull()
    found = found.join(before, key, "left").select(
        key, (F.col("episode_id") + F.coalesce(F.col("_id") - 1, F.lit(0))).alias("episode_id"),
        F.when(goes_on, F.col("_start")).otherwise(F.col("ep_start")).alias("ep_start"), *FACTS[2:],
    )
    seen = days.select(key, "day").unionByName(past.select(key, F.col("last_day").alias("day")))
    return split_last(seen, found, key)


#: The rule over typed policy rows: flagged at risk; cured by a paid-to date that
#: is not before the file; terminated by contract code T.
POLICY_RULE = EpisodeRule(
    "file_date",
    risk=lambda: F.col("at_risk_policy"),
    cure=lambda: F.col("paid_to_date") >= F.col("file_date"),
    term=lambda: F.col("cntrct_code") == "T",
)
