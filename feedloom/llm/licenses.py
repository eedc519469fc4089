"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Words are compared in lower case without outer punctuation; words of ASCII marks only, such as the comment signs before each line of a
file header, are left out of templates and documents alike. Templates of five words and more are compared in shingles of five; a shorter
template is one shingle of all its words. Templates are classed by length, doubling; for each class a document is cut into windows of
twice the class's length that overlap by half, so each occurrence lies whole in some window.

*Retrieval.* A window's and a template's signatures have ``BANDS`` bands of one MinHash each. A window has at most four
times a template's n shingles, so one that holds a share c of them has a similarity s of at least c / (5 - c), and it collides in some
band with probability 1 - (1 - s) ** BANDS: with c = 0.8 and 64 bands, over 0.999998. Bands of more rows would save
candidates only where unrelated windows share shingles, which verification settles anyway.

*Verification.* Of a retrieved pair, the exact share of the template's distinct shingles within the window is counted; at ``CONTAINED``
or more it matches. A match runs from the first to the last shared shingle. Overlapping matches of a template become one.

Templates are a bounded parameter (``shipped`` for the registered query), sent to the tasks; documents are read whole and stay where they are, so nothing is shuffled.

Defined results: a null or empty text has no matches, and a document without matches no row. Rows repeated are alike. A text shorter
than a window is one window. An empty table, or no templates, gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedloom.llm.common import Batches, as_bytes

SHINGLE = 5
CONTAINED = 0.8
BANDS = 64
#: Windows whose signatures are computed at once.
STRIP = 4096
#: Words whose hash a task keeps; more empty the memory, which changes nothing but time.
CACHE = 400_000

# Short public license notices and the names they stand for.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    ),
    "all-rights-reserved": "All rights reserved.",
}

#: License texts, standard file headers and disclaimers, one file each, by name.
TEXTS = Path(__file__).parent / "license_texts"
#: Identifiers that follow "SPDX-License-Identifier:".
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0", "GPL-2.0+", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
    "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "OFL-1.1", "PSF-2.0", "Unlicense", "WTFPL", "Zlib",
)


def shipped() -> dict[str, str]:
    """The templates of the registered scan: the short notices, SPDX identifier lines and the files of ``TEXTS``."""
    files = {p.stem: p.read_text("utf-8") for p in sorted(TEXTS.glob("*.txt"))}
    return {**NOTICES, **{f"SPDX:{i}": f"SPDX-License-Identifier: {i}" for i in SPDX}, **files}


_EDGE = b".,;:!?\"'()[]{}<>*#/"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MARKS = re.compile(rb"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Hashes:
    """64-bit numbers of words, equal for words that differ in case or outer punctuation only; 0 for words of marks only."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE:
            self.known.clear()
        for w in set(words).difference(self.known):
            self.known[w] = 0 if _MARKS.fullmatch(w) else xxhash.xxh64_intdigest(w.lower().strip(_EDGE))
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def kept(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of a text's words without those of marks only, and their places among all its words."""
        numbers = self.of(_WORD.findall(text))
        places = np.flatnonzero(numbers)
        return numbers[places], places


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """One number for each run of ``size`` words."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ words[i:i + n]) * _MIX
        out ^= out >> np.uint64(31)
    return out


def _seeds(bands: int) -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(parts: np.ndarray, starts: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(windows, bands): the least value of each band's hash over a window's shingles, which lie end to end."""
    out = np.empty((len(starts), bands), np.uint64)
    for band, seed in enumerate(_seeds(bands)):
        mixed = parts * seed
        out[:, band] = np.minimum.reduceat(mixed ^ mixed >> np.uint64(32), starts)
    return out


@dataclass
class Class:
    """Templates of one shingle size and length class: window length in shingles, all their shingles in order, and band values with their templates."""

    size: int
    window: int
    names: list[str]
    sets: list[np.ndarray]
    values: list[np.ndarray]
    owners: list[np.ndarray]
    least: list[int]
    known: np.ndarray


def prepared(templates: dict[str, str], bands: int = BANDS, contained: float = CONTAINED) -> list[Class]:
    """Templates by shingle size and by length, doubling, so a window is less than four times a template."""
    groups: dict[tuple[int, int], list[tuple[str, np.ndarray]]] = {}
    hashes = Hashes()
    for name, text in templates.items():
        words = hashes.kept(text.encode())[0]
        if len(words):
            size = min(SHINGLE, len(words))
            parts = np.unique(shingles(words, size))
            groups.setdefault((size, max(1, 1 << (len(words) - size).bit_length())), []).append((name, parts))
    out = []
    for (size, length), rows in sorted(groups.items()):
        signs = np.concatenate([signature(parts, np.array([0]), bands) for _, parts in rows])
        order = [np.argsort(signs[:, b], kind="stable") for b in range(bands)]
        out.append(Class(
            size, 2 * length, [n for n, _ in rows], [p for _, p in rows], [signs[o, b] for b, o in enumerate(order)], order,
            [int(np.ceil(contained * len(p))) for _, p in rows], np.unique(np.concatenate([p for _, p in rows])),
        ))
    return out


def matches(words: np.ndarray, places: np.ndarray, classes: list[Class]) -> list[tuple[str, float, int, int]]:
    """(template, containment, first word, end word) of all matches of a document's word numbers and their places."""
    out, by_size = [], {size: shingles(words, size) for size in {c.size for c in classes}}
    for c in classes:
        parts = by_size[c.size]
        if not len(parts):
            continue
        known = c.known[np.minimum(np.searchsorted(c.known, parts), len(c.known) - 1)] == parts
        if not known.any():
            # No window shares a shingle with a template, so no band can collide.
            continue
        step = max(1, c.window // 2)
        starts = np.arange(0, max(1, len(parts) - step), step)
        # A window with fewer shared shingles than the least that any template needs cannot be verified.
        upto = np.r_[0, np.cumsum(known)]
        starts = starts[upto[np.minimum(starts + c.window, len(parts))] - upto[starts] >= min(c.least)]
        spans: dict[int, list[tuple[int, int, float]]] = {}
        for at in range(0, len(starts), STRIP):
            some = starts[at:at + STRIP]
            ends = np.minimum(some + c.window, len(parts))
            flat = np.concatenate([parts[a:b] for a, b in zip(some.tolist(), ends.tolist(), strict=True)])
            signs = signature(flat, np.r_[0, np.cumsum(ends - some)[:-1]], len(c.values))
            pairs: set[tuple[int, int]] = set()
            for b, (values, owners) in enumerate(zip(c.values, c.owners, strict=True)):
                first, last = np.searchsorted(values, signs[:, b], "left"), np.searchsorted(values, signs[:, b], "right")
                for w in np.flatnonzero(first < last).tolist():
                    pairs.update((w, int(t)) for t in owners[first[w]:last[w]])
            for w, t in sorted(pairs):
                a, b = int(some[w]), int(ends[w])
                inside = np.flatnonzero(np.isin(parts[a:b], c.sets[t]))
                if len(inside) and len(np.unique(parts[a:b][inside])) >= c.least[t]:
                    share = len(np.unique(parts[a:b][inside])) / len(c.sets[t])
                    spans.setdefault(t, []).append((a + int(inside[0]), a + int(inside[-1]) + c.size, share))
        for t, found in spans.items():
            found.sort()
            merged = [found[0]]
            for a, b, share in found[1:]:
                if a < merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(b, merged[-1][1]), max(share, merged[-1][2]))
                else:
                    merged.append((a, b, share))
            out += [(c.names[t], share, int(places[a]), int(places[b - 1]) + 1) for a, b, share in merged]
    return sorted(out, key=lambda m: (m[2], m[0]))


def scanned(docs: DataFrame, templates: dict[str, str] = NOTICES, bands: int = BANDS, contained: float = CONTAINED) -> DataFrame:
    """One row per match: doc_id, template, containment, first_word, end_word (word numbers from 0, end exclusive)."""
    sent = docs.sparkSession.sparkContext.broadcast(prepared(templates, bands, contained))
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("template", T.StringType()), T.StructField("containment", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()),
    ])

    def run(batches: Batches) -> Batches:
        hashes = Hashes()
        for batch in batches:
            rows = []
            for i, text in enumerate(as_bytes(batch.column("text"))):
                rows += [(i, *m) for m in matches(*hashes.kept(text), sent.value)]
            columns = [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 5
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True))], names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
