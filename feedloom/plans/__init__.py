"""Declarative feed specifications and the flows that run them."""
