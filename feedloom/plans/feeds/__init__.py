"""The five feeds. Patterns, column lists and carrier tags are fixed values."""

from feedloom.plans.feeds import ahl, gtl, heartland, manhattan, unl

FEEDS = {f.name: f for f in (unl.FEED, gtl.FEED, ahl.FEED, manhattan.FEED)}
HEARTLAND = heartland

__all__ = ["FEEDS", "HEARTLAND", "ahl", "gtl", "heartland", "manhattan", "unl"]
