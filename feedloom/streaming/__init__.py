"""Structured Streaming intake."""
