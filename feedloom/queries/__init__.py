"""Queries registered for the given tables."""

from feedloom.queries import audits, contracts, episodes, histories, hierarchies, latest, merges, refreshes, scans, typing
from feedloom.queries.registry import RUNS, SQL

__all__ = [
    "RUNS", "SQL", "audits", "contracts", "episodes", "histories", "hierarchies", "latest", "merges", "refreshes", "scans", "typing",
]
