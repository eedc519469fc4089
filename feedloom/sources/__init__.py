"""Readers: routed files, JSON snapshots, roster tables."""
