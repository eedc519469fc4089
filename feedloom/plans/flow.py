"""Load and refresh of one feed.

A load is one commit: raw rows, their file statistics, ledger events and the intake become visible together, after every file is
verified to have rows. A load that stops before leaves every table as it was, and is repeated under any id; of two loads that bring the same
files one is refused. Each derived table is one commit too, with a mark of what it covers, so a refresh that stopped half-way is taken up
by the next load, new files or not. Which loads a step still has to do is told by the commits, never by a comparison of ids.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.dates import utc_date
from feedloom.operators import audit, history as hist, merge
from feedloom.operators.episodes import (
    day_bounds,
    extended,
    late_keys,
    merged_days,
    risk_days,
    sessions,
    split_last,
    with_outcomes,
)
from feedloom.operators.hierarchy import roster_hierarchy, self_hierarchy
from feedloom.operators.latest import (
    enrich,
    latest_file_by_ledger,
    latest_file_by_metadata,
    latest_version,
    rows_of_file,
)
from feedloom.operators.typed import typed, with_load
from feedloom.operators.versions import new_versions
from feedloom.plans.feeds import heartland, unl
from feedloom.plans.specs import FeedSpec, TypedSpec
from feedloom.session import cut, staging
from feedloom.sinks.tables import Change, Tables
from feedloom.sources import files as src
from feedloom.sources.snapshots import read_json_array, snapshot_identity

EVENTS = "audit/file_events"
INTAKE = "audit/intake"
TIMED_EVENTS = T.StructType([*audit.EVENT_SCHEMA.fields, T.StructField("recorded_at", T.TimestampType())])
INTAKE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modified_at", T.TimestampType()),
    T.StructField("load_id", T.StringType()),
])


class LoadIdError(ValueError):
    """A load id was used before, for other files."""


HIERARCHY_SCHEMA = T.StructType([
    T.StructField("row_id", T.StringType()),
    T.StructField("roster_hierarchy_json", T.StringType()),
])


def raw_name(table: str) -> str:
    return f"raw/{table}"


def typed_name(table: str) -> str:
    return f"typed/{table}"


def stats_name(table: str) -> str:
    """Per file and load of a stored table: its rows, and the largest values that tell the newest file."""
    return f"stats/{table}"


def intake_name(feed: FeedSpec) -> str:
    return f"{INTAKE}/{feed.name}"


def episode_schema(key: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, T.StringType()), T.StructField("episode_id", T.LongType()),
        *[T.StructField(c, T.DateType()) for c in ("ep_start", "ep_end", "cure_date", "term_date")],
        T.StructField("outcome", T.StringType()),
    ])


# ---------------------------------------------------------------------- intake

def unknown_files(tables: Tables, feed: FeedSpec, files: list[src.LandedFile]) -> list[src.LandedFile]:
    """Those of the files that no load brought. A rewritten file has a new modification time and is unknown."""
    intake = tables.read(intake_name(feed))
    if intake is None:
        return files
    listed = tables.spark.createDataFrame([(f.path, f.modified_at) for f in files], "path string, modified_at timestamp")
    paths = {r.path for r in listed.join(intake, ["path", "modified_at"], "left_anti").select("path").collect()}
    return [f for f in files if f.path in paths]


def new_files(tables: Tables, root: str, feed: FeedSpec) -> dict[src.Route, list[src.LandedFile]]:
    """Landed files not stored yet. Only files of the current listing come back to the driver."""
    found = src.matching_routes(tables.spark, root, feed.routes)
    fresh = set(unknown_files(tables, feed, [f for files in found.values() for f in files]))
    found = {r: [f for f in files if f in fresh] for r, files in found.items()}
    return {r: files for r, files in found.items() if files}


def load(tables: Tables, feed: FeedSpec, root: str, load_id: str, now: dt.datetime,
         roster: Mapping[str, DataFrame] | None = None, refresh_derived: bool = True) -> dict[str, DataFrame]:
    """Read new files, stage, verify, publish, refresh. Returns the published tables, nothing if all is up to date."""
    change = tables.change(depends=[intake_name(feed)])
    fresh = new_files(tables, root, feed)
    with staging(tables.spark):
        if fresh:
            scans = {r: (files, src.scan_route(tables.spark, files, r)) for r, files in fresh.items()}
            store(tables, feed, scans, load_id, now, change)
        elif not behind(tables, feed):
            return {}
        return refresh(tables, feed, now, roster) if refresh_derived else {}


def file_stats(rows: DataFrame, load_id: str, newest: Sequence[str]) -> DataFrame:
    """One row per file of a load: its rows, and the largest values of the columns ``newest``."""
    largest = [F.max(c).alias(c) for c in newest]
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("file_rows"), *largest).withColumn("load", F.lit(load_id))


def store(tables: Tables, feed: FeedSpec, fresh: Mapping[src.Route, tuple[list[src.LandedFile], DataFrame]],
          load_id: str, now: dt.datetime, change: Change | None = None) -> None:
    """Raw rows of one load with statistics, ledger events and intake, in one commit; nothing unless every file has rows.

    A load id is only good for the files that it brought; bringing these again changes nothing.
    """
    change = change or tables.change(depends=[intake_name(feed)])
    landed = [f for files, _ in fresh.values() for f in files]
    intake = tables.read(intake_name(feed))
    if intake is not None:
        used = {r["path"] for r in intake.filter(F.col("load_id") == load_id).select("path").collect()}
        if used == {f.path for f in landed} and not unknown_files(tables, feed, landed):
            return
        if used:
            raise LoadIdError(f"load {load_id!r} of {feed.name} has other files")

    _store_all(tables, feed, fresh, load_id, now, change)


def _store_all(tables: Tables, feed: FeedSpec, fresh: Mapping[src.Route, tuple[list[src.LandedFile], DataFrame]],
               load_id: str, now: dt.datetime, change: Change) -> None:
    spark, stats = tables.spark, {}
    landed = [f for files, _ in fresh.values() for f in files]
    for route, (_, rows) in fresh.items():
        name = raw_name(route.table)
        stored = change.append(name, src.identified(rows, load_id), load_id)
        newest = feed.newest_raw if route.table == feed.table else ()
        stats[route.table] = change.append(stats_name(name), file_stats(stored, load_id, newest), load_id)
    expected = spark.createDataFrame(
        [(r.table, f.name) for r, (files, _) in fresh.items() for f in files], "table_name string, file_name string"
    )
    try:
        audit.require_loads(expected, stats)
    except audit.MissingLoadError:
        change.discard()
        raise
    events = spark.createDataFrame(
        [(i, feed.name, f.path, f.path, f.size, audit.LOADED, None) for i, f in enumerate(landed)], audit.EVENT_SCHEMA
    )
    change.append(EVENTS, _timed(events, now), f"{feed.name}-{load_id}")
    seen = spark.createDataFrame([(f.path, f.modified_at, load_id) for f in landed], INTAKE_SCHEMA)
    change.append(intake_name(feed), seen, load_id)
    change.publish()


def _timed(events: DataFrame, now: dt.datetime) -> DataFrame:
    return events.withColumn("recorded_at", F.lit(now).cast("timestamp"))


def record(tables: Tables, events: DataFrame, now: dt.datetime, batch: str) -> None:
    """Store file events (copied, moved, loaded, archived) under a batch name of their own.

    Feeds that record at the same time write different folders, so none loses the other's events.
    """
    tables.append(EVENTS, _timed(events, now), batch)


def ledger(tables: Tables) -> DataFrame:
    """The ledger: the last event of every file, by time of recording and number."""
    events = tables.read_or_empty(EVENTS, TIMED_EVENTS)
    return audit.resolved(events)


def derived_names(feed: FeedSpec) -> list[str]:
    kinds = ("", "_change_history", "_change_history_tail", "_roster_hierarchy", *[f"_at_risk_{k}" for k in EPISODE_PARTS])
    names = [typed_name(feed.table + k) for k in kinds]
    return [*names, stats_name(names[0]), *[typed_name(t) for t in feed.side_tables]]


def rebuild(tables: Tables, feed: FeedSpec, root: str, load_id: str, now: dt.datetime,
            roster: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Reload one feed from its landed files. Contracts are checked and rows verified before anything
    is dropped, only tables of this feed are, and the new raw rows come with the same commit."""
    src.check_contracts(tables.spark, root, feed.routes)
    found = src.matching_routes(tables.spark, root, feed.routes)
    raw = [raw_name(r.table) for r in feed.routes]
    change = tables.change()
    change.drop([*raw, *map(stats_name, raw), *derived_names(feed), intake_name(feed)])
    with staging(tables.spark):
        scans = {r: (files, src.scan_route(tables.spark, files, r)) for r, files in found.items()}
        _store_all(tables, feed, scans, load_id, now, change)
        return refresh(tables, feed, now, roster)


# --------------------------------------------------------------------- refresh

def behind(tables: Tables, feed: FeedSpec) -> bool:
    """Whether a derived table lacks rows of a stored load."""
    typed_loads, raw_loads = tables.loads(typed_name(feed.table)), tables.loads(raw_name(feed.table))
    if set(raw_loads) - set(typed_loads):
        return True
    steps = [(typed_name(feed.table), s) for s in (history_name(feed) if feed.history else None, feed.episodes and episodes_name(feed)) if s]
    steps += [(raw_name(t), typed_name(t)) for t in feed.side_tables]
    return any(tables.pending(name, step)[1] for name, step in steps)


def append_typed(tables: Tables, feed: FeedSpec) -> DataFrame:
    """Type every stored load that has no typed rows yet, one by one; returns the typed table.

    Typed loads are published whole, so a load that is there is finished. Ids can only repeat
    where a file was loaded before, so only rows of such files are compared.
    """
    name, raw = typed_name(feed.table), raw_name(feed.table)
    done = set(tables.loads(name))
    for load_id in [i for i in tables.loads(raw) if i not in done]:
        rows = with_load(tables.read(raw, only=[load_id], evolving=True))
        fresh = typed(rows, feed.typed)
        earlier = earlier_loads(tables, raw, [load_id])
        if earlier:
            names = rows.select("source_file").distinct()
            stored = tables.read(name, only=earlier)
            fresh = merge.unseen(fresh, stored.join(names, "source_file", "left_semi"), ["row_id"])
        change = tables.change(depends=[name])
        written = change.append(name, fresh, load_id)
        change.append(stats_name(name), file_stats(written, load_id, feed.newest_typed), load_id)
        change.publish()
    return tables.read(name)


def earlier_loads(tables: Tables, raw: str, loads: Sequence[str]) -> list[str]:
    """Loads before these that hold a file of the same name, from the file statistics."""
    stats = tables.read(stats_name(raw))
    mine = stats.filter(F.col("load").isin(list(loads))).select("source_file").distinct()
    others = stats.filter(~F.col("load").isin(list(loads))).join(mine, "source_file", "left_semi")
    before = set(tables.loads(raw)[:min(tables.loads(raw).index(x) for x in loads)])
    return sorted(r["load"] for r in others.select("load").distinct().collect() if r["load"] in before)


def history_name(feed: FeedSpec) -> str:
    return typed_name(f"{feed.table}_change_history")


def refresh_history(tables: Tables, feed: FeedSpec) -> DataFrame:
    """The stored history with the loads it lacks.

    New rows extend each key from one stored tail row; history is only rewritten when rows came that sort
    before what was processed, and taken again as a whole where most keys have such rows: then one scan moves fewer
    bytes than joins that tell the other keys' rows. History, tails and the mark of what they cover are one commit.
    """
    spec, name, source = feed.history, history_name(feed), typed_name(feed.table)
    tail_name = f"{name}_tail"
    loads, todo, at = tables.pending(source, name)
    if not todo and tables.exists(name):
        return tables.read(name)
    change = tables.change(depends=[name, tail_name])
    policies, stored, past = tables.read(source, only=loads), tables.read(name), tables.read(tail_name)
    if stored is None or past is None:
        rebuild_history(change, name, policies, spec)
    else:
        pending = tables.read(source, only=todo)
        late = cut(hist.late_keys(pending, past, spec).select(*spec.key))
        if late.isEmpty():
            added = change.append(name, hist.extend_history(pending, past, spec), uuid.uuid4().hex)
            change.replace(tail_name, hist.advanced_tails(past, pending, added, spec))
        elif 2 * late.count() > past.count():
            rebuild_history(change, name, policies, spec)
        else:
            history = change.replace(name, hist.refreshed_history(policies, stored, spec, pending, past, late))
            change.replace(tail_name, hist.tails(policies, history, spec))
    change.mark(name, at)
    change.publish()
    return tables.read(name)


def rebuild_history(change: Change, name: str, policies: DataFrame, spec: hist.HistorySpec) -> None:
    """History and tails of all stored rows."""
    number = policies.count()
    change.replace(name, hist.change_history(policies, spec, number))
    change.replace(f"{name}_tail", hist.rebuilt_tails(policies, spec, number))


#: Tables that episodes are kept in: days on which something is so, episodes that are over, the last one of each key, days of the feed.
EPISODE_PARTS = ("days", "closed", "last", "bounds")


def episodes_name(feed: FeedSpec) -> str:
    return typed_name(f"{feed.table}_at_risk")


def refresh_episodes(tables: Tables, feed: FeedSpec) -> DataFrame:
    """The episodes after the loads that were not counted yet; their cost follows the new rows and the keys they touch.

    A key whose new days follow its last one goes on from its stored row. A key with a late day is taken again
    from its stored days. All parts and the mark of what they cover are one commit.
    """
    key, rule, base = feed.key, feed.episodes, episodes_name(feed)
    days_name, closed_name, last_name, bounds_name = (f"{base}_{k}" for k in EPISODE_PARTS)
    _, todo, at = tables.pending(typed_name(feed.table), base)
    if todo:
        change = tables.change(depends=[f"{base}_{k}" for k in EPISODE_PARTS])
        batch, pending = uuid.uuid4().hex, tables.read(typed_name(feed.table), only=todo)
        stored, last = tables.read(days_name), tables.read(last_name)
        days = change.append(days_name, risk_days(pending, key, rule), batch)
        change.append(bounds_name, day_bounds(pending, rule), batch)
        if last is None:
            closed, last = split_last(days, sessions(days, key, rule.gap_days), key)
            change.append(closed_name, closed, batch)
            change.replace(last_name, last)
        else:
            late = cut(late_keys(days, last, key))
            closed, ahead = extended(days.join(late, key, "left_anti"), last, key, rule.gap_days)
            kept = last.join(days.select(key).distinct(), key, "left_anti").unionByName(ahead)
            if late.isEmpty():
                change.append(closed_name, closed, batch)
            else:
                again = merged_days(stored.unionByName(days).join(late, key, "left_semi"), key)
                redone, ends = split_last(again, sessions(again, key, rule.gap_days), key)
                before = tables.read(closed_name).join(late, key, "left_anti")
                change.replace(closed_name, before.unionByName(closed).unionByName(redone))
                kept = kept.unionByName(ends)
            change.replace(last_name, kept)
        change.mark(base, at)
        change.publish()
    ended, last = tables.read(closed_name), tables.read(last_name)
    found = ended.unionByName(last.filter(F.col("episode_id").isNotNull()).select(ended.columns))
    return with_outcomes(found, tables.read(bounds_name), key, rule.gap_days)


def refresh_side_table(tables: Tables, table: str, spec: TypedSpec) -> DataFrame:
    """The typed statements. Rows are numbered within their file, so a load with a file of an earlier one types all again."""
    name, raw = typed_name(table), raw_name(table)
    loads, todo, at = tables.pending(raw, name)
    if todo:
        change = tables.change(depends=[name])
        if tables.exists(name) and not earlier_loads(tables, raw, todo):
            change.append(name, typed(tables.read(raw, only=todo, evolving=True), spec), uuid.uuid4().hex)
        else:
            change.replace(name, typed(tables.read(raw, only=loads, evolving=True), spec))
        change.mark(name, at)
        change.publish()
    return tables.read(name)


def refresh(tables: Tables, feed: FeedSpec, now: dt.datetime,
            roster: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Typed append, history, hierarchy, episodes, latest views; then the statements."""
    landings = ledger(tables)
    out = refresh_policies(tables, feed, landings, roster) if tables.loads(raw_name(feed.table)) else {}
    for table, spec in feed.side_tables.items():
        if tables.loads(raw_name(table)):
            out[table] = refresh_side_table(tables, table, spec)
            latest = latest_file_by_ledger(landings, feed.name, unl.ADVANCE_PATTERNS)
            out[f"{table}_latest"] = rows_of_file(out[table], latest)
    return out


def refresh_policies(tables: Tables, feed: FeedSpec, landings: DataFrame,
                     roster: Mapping[str, DataFrame] | None) -> dict[str, DataFrame]:
    policies = append_typed(tables, feed)
    out = {"typed": policies}
    if feed.history:
        out["history"] = refresh_history(tables, feed)

    # Only the folders of loads that hold the newest file are read.
    raw, name = raw_name(feed.table), typed_name(feed.table)
    if feed.by_ledger:
        newest_raw = newest_typed = latest_file_by_ledger(landings, feed.name, feed.file_patterns)
        holding = loads_of(tables, feed, newest_raw)
        current_raw, current = tables.read(raw, only=holding or None, evolving=True), tables.read(name, only=holding or None)
    else:
        newest_raw, holding = newest_by_stats(tables, raw, feed.newest_raw)
        current_raw = tables.read(raw, only=holding, evolving=True)
        newest_typed, holding = newest_by_stats(tables, name, feed.newest_typed)
        current = tables.read(name, only=holding)

    name = typed_name(f"{feed.table}_roster_hierarchy")
    empty = tables.spark.createDataFrame([], HIERARCHY_SCHEMA)
    if feed.carrier_pattern and roster:
        refreshed = roster_hierarchy(rows_of_file(current, newest_typed), roster, feed.carrier_pattern, feed.levels)
        stored = tables.read_or_empty(name, HIERARCHY_SCHEMA)
        out["hierarchy"] = tables.replace(name, merge.mirror(stored, refreshed, ["row_id"]))
    hierarchy = out.get("hierarchy", empty)

    if feed.episodes:
        out["episodes"] = refresh_episodes(tables, feed)
    else:
        out["episodes"] = tables.spark.createDataFrame([], episode_schema(feed.key))

    out["latest_raw"] = latest_load(current_raw, newest_raw, hierarchy, out.get("history"), feed)
    out["latest_typed"] = latest_load(current, newest_typed, hierarchy, out.get("history"), feed, feed.view_columns)
    return out


def newest_by_stats(tables: Tables, name: str, newest: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The newest file of a table as one row, and the loads that hold it, from the file statistics alone."""
    stats = tables.read(stats_name(name))
    found = latest_file_by_metadata(stats, newest)
    row = found.first()
    if row is None:
        return found, []
    # A row of its own: the statistics need not be read again with every use.
    found = tables.spark.createDataFrame([row], found.schema)
    return found, sorted(r["load"] for r in rows_of_file(stats, found).select("load").distinct().collect())


def loads_of(tables: Tables, feed: FeedSpec, newest: DataFrame) -> list[str]:
    """Loads that brought the file named in the one row of ``newest``."""
    row, intake = newest.first(), tables.read(intake_name(feed))
    if row is None or intake is None:
        return []
    same = audit.basename("path") == row[0]
    return sorted({r["load_id"] for r in intake.filter(same).select("load_id").collect()})


def row_counts(published: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows of each refreshed table; stored tables are counted from file footers."""
    return {name: rows.count() for name, rows in published.items()}


def latest_load(rows: DataFrame, newest: DataFrame, hierarchy: DataFrame, history: DataFrame | None,
                feed: FeedSpec, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of the newest file with hierarchy, carrier tag and history."""
    current = rows_of_file(rows, newest)
    current = current.select(*columns) if columns else current
    current = enrich(current, "row_id", hierarchy).withColumn("carrier", F.lit(feed.name))
    return enrich(current, "row_id", *([history] if history is not None else []))


# ------------------------------------------------------------- snapshot feed

def load_snapshot(tables: Tables, path: str, load_id: str, now: dt.datetime,
                  refresh_derived: bool = True) -> dict[str, DataFrame]:
    """Replace the stored snapshot with a JSON payload and refresh what follows."""
    payload = read_json_array(tables.spark, path, heartland.PAYLOAD_FIELDS)
    with staging(tables.spark):
        snapshot = tables.replace(
            raw_name(heartland.SNAPSHOT_TABLE), snapshot_identity(payload, heartland.FIELDS, load_id)
        )
        return refresh_snapshot(tables, snapshot, load_id, now) if refresh_derived else {"snapshot": snapshot}


def refresh_snapshot(tables: Tables, snapshot: DataFrame, load_id: str, now: dt.datetime) -> dict[str, DataFrame]:
    """Versions, typed rows, status history, hierarchy and the latest view."""
    name = raw_name(heartland.TABLE)
    stored = tables.read(name, without=[load_id])
    tables.append(name, new_versions(snapshot, stored, heartland.FIELDS, "row_id", now), load_id)
    versions = tables.read(name)

    name = typed_name(heartland.TABLE)
    fresh = typed(versions, heartland.POLICY)
    stored = tables.read(name, without=[load_id])
    if stored is not None:
        fresh = merge.unseen(fresh, stored, ["row_hash"])
    tables.append(name, fresh, load_id)
    policies = tables.read(name)
    out = {"versions": versions, "typed": policies}

    name = typed_name(f"{heartland.TABLE}_status_history")
    computed = status_history(policies)
    stored = tables.read(name)
    if stored is not None:
        values = [c for c in computed.columns if c != "row_hash"]
        computed = hist.correct_and_append(stored, cut(computed), "row_hash", values)
    out["history"] = tables.replace(name, computed)

    name = typed_name(f"{heartland.TABLE}_hierarchy")
    out["hierarchy"] = tables.replace(name, self_hierarchy(policies, heartland.VERSION_KEYS))
    out["latest"] = enrich(
        latest_version(policies, heartland.VERSION_KEYS, heartland.NEWEST), "row_hash", out["history"], out["hierarchy"]
    )
    return out


def status_history(policies: DataFrame) -> DataFrame:
    return hist.change_history(
        policies.withColumn("seen_on", utc_date(F.col("first_seen_at"))), heartland.STATUS_HISTORY
    )
