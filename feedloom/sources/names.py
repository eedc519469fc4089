"""Column names as stored."""

from __future__ import annotations

import re
from collections.abc import Sequence

# A word starts at a capital that follows a lower-case letter or a digit, and at a
# capitalised word inside a run of letters.
_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[^_])(?=[A-Z][a-z])")


def snake_case(name: str) -> str:
    """``clientAddress2`` to ``client_address2``, ``FYMRDR1PLA`` to ``fymrdr1_pla``.

    Other characters become ``_``. Underscores at the end, from trailing symbols, become
    ``x`` each, and a leading digit is prefixed.
    """
    plain = re.sub(r"[^A-Za-z0-9_]+", "_", name.strip())
    words = _WORD_START.sub("_", plain).lower()
    if words[:1].isdigit():
        words = "_" + words
    body = words.rstrip("_")
    return re.sub(r"_{2,}", "_", body + "x" * (len(words) - len(body)))


def stored_names(header: Sequence[str]) -> dict[str, str]:
    """Delivered to stored name; two headers for one stored name are an error."""
    names = {h: snake_case(h) for h in header}
    if len(set(names.values())) < len(header):
        raise ValueError(f"columns collide once renamed: {sorted(names.items())}")
    return names
