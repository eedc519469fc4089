"""Risk episodes on the event stream: errors are risk days, purchases cure, signups end."""

from pyspark.sql import functions as F

from feedloom.operators.episodes import GAP_DAYS, EpisodeRule, risk_episodes
from feedloom.queries.registry import query, table


def episodes_from(seen: str, key: str, gap: int) -> str:
    """SQL over ``seen``, a query of (key, day, risky, cures, ends).

    An episode opens on a risk day without another one in the ``gap`` days before and closes on one without another in the
    days after; the n-th opening of a key belongs to its n-th closing.
    """
    return f"""
    WITH seen AS ({seen}),
    risk AS (SELECT DISTINCT {key}, day FROM seen WHERE risky),
    opens AS (
        SELECT {key}, day AS ep_start, row_number() OVER (PARTITION BY {key} ORDER BY day) AS episode_id
        FROM risk r WHERE NOT EXISTS (FROM risk e WHERE e.{key} = r.{key} AND e.day < r.day AND r.day - e.day <= {gap})
    ),
    closes AS (
        SELECT {key}, day AS ep_end, row_number() OVER (PARTITION BY {key} ORDER BY day) AS episode_id
        FROM risk r WHERE NOT EXISTS (FROM risk l WHERE l.{key} = r.{key} AND l.day > r.day AND l.day - r.day <= {gap})
    ),
    after AS (
        SELECT c.{key}, c.episode_id, min(o.day) FILTER (WHERE o.cures) AS cure_date, min(o.day) FILTER (WHERE o.ends) AS term_date
        FROM closes c JOIN seen o ON o.{key} = c.{key} AND o.day > c.ep_end AND o.day - c.ep_end <= {gap} GROUP BY ALL
    )
    SELECT {key}, CAST(episode_id AS BIGINT) AS episode_id, ep_start, ep_end, cure_date, term_date,
           coalesce(if(ep_start = bounds.first_day, 'left_censored', NULL),
                    if(cure_date IS NOT NULL AND (term_date IS NULL OR term_date >= cure_date), 'saved', NULL), if(term_date IS NOT NULL, 'lost', NULL),
                    if(bounds.last_day - ep_end <= {gap}, 'still_open', 'ended_no_resolution')) AS outcome
    FROM opens JOIN closes USING ({key}, episode_id) LEFT JOIN after USING ({key}, episode_id),
         (SELECT min(day) AS first_day, max(day) AS last_day FROM seen) bounds"""


def episode_sql(gap: int) -> str:
    return episodes_from("""
        SELECT user_id, CAST(ts AS DATE) AS day, event_type = 'error' AS risky, event_type = 'purchase' AS cures, event_type = 'signup' AS ends
        FROM events""", "user_id", gap)


def event_episodes(spark, sf_dir, gap):
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    rule = EpisodeRule("day", lambda: kind == "error", lambda: kind == "purchase", lambda: kind == "signup", gap)
    return risk_episodes(events, "user_id", rule)


@query("risk_episodes", episode_sql(GAP_DAYS))
def episodes_at_default_gap(spark, sf_dir):
    return event_episodes(spark, sf_dir, GAP_DAYS)


@query("risk_episodes_one_day_gap", episode_sql(1))
def episodes_at_one_day(spark, sf_dir):
    return event_episodes(spark, sf_dir, 1)
