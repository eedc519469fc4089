"""Periodic runs of words, found in a Re-Pair grammar.

A run is a stretch of consecutive words with smallest period q and at least ``max(LEAST, 2 * q)`` words that no neighbouring word
extends keeping the period.

1. *Grammar.* The words of a text are numbered and Re-Pair replaces repeated pairs of neighbours by nonterminals, the more
   frequent pair first, until no pair occurs twice. Texts are compressed side by side: in a round each pair that is
   more frequent than the pairs it overlaps is replaced wherever it wins, and a pair keeps its nonterminal for all rounds. Each
   replacement is noted with its word number, so all derivation positions of a nonterminal are known.
2. *Boundaries.* A run within a nonterminal's expansion lies in one of its two children or crosses the boundary between them. So only
   crossing runs are searched, once per nonterminal, at its first position, and at the boundaries between the symbols that remain at the
   top. A long nonterminal repeats without being searched again.
3. *Crossing runs.* If a run of period q crosses a boundary, the words before it match the words q further left or right over a
   window that grows with q. Equal windows of 4, 8, 16, ... words are named once per text by doubling, for repeated windows only;
   each boundary looks its two windows up within the distances that its class of periods allows, and the same names
   extend a match to its full length.
4. *Positions.* Runs are translated to all positions of their nonterminal. One that could go on beyond the expansion is not maximal,
   and its maximal one crosses an ancestor's boundary. Equal intervals are merged, the smallest period stays.

Work is near-linear in the words: a periodic text has few boundaries, and elsewhere few windows repeat. A text is handled whole by one
task; short texts share a strip of about ``STRIP`` words.

Defined results: a null or empty text, or one without words, has no runs. Rows repeated are reported as often as they occur. A null doc_id
counts as the empty text where its checksum is needed. An empty table gives an empty result. Other columns are ignored, and pass through
``collapsed`` unchanged.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedloom.llm.common import Batches, as_bytes

#: Words of the shortest run.
LEAST = 12
#: Words of the shortest window that is looked up, and the periods it serves; each class doubles both.
WINDOW, SHORT = 4, 16
#: Words whose texts are compressed together, and candidates that are checked together.
STRIP = 300_000
CHUNK = 2_000_000

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes: the group of each member, and its number in the group."""
    group = np.repeat(np.arange(len(count)), count)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)


@dataclass
class Grammar:
    """Replacements (nonterminal, first word), each nonterminal's left and whole size, and the starts of the symbols left at the top."""

    symbol: np.ndarray
    start: np.ndarray
    left: np.ndarray
    size: np.ndarray
    top: np.ndarray


def _winners(pair: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which pairs are replaced: repeated ones that are more frequent than the pairs they overlap.

    Equally frequent pairs are ordered by a hash, so a period is not eaten up one pair a round. Of a stretch of equal
    pairs, like aaaa, every other one is taken.
    """
    mixed = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    rank = np.where(count > 1, count << 31 | mixed.astype(np.int64), -1)
    change = np.r_[True, rank[1:] != rank[:-1]]
    first, stretch = np.flatnonzero(change), np.cumsum(change) - 1
    last, own = np.r_[first[1:], len(rank)] - 1, rank[first]
    before, after = np.r_[-1, own[:-1]], np.r_[own[1:], -1]
    nth = np.arange(len(rank)) - first[stretch] - (before > own)[stretch]
    win = (count > 1) & (nth >= 0) & (nth % 2 == 0)
    win[last[after > own]] = False
    return win


def repair(ids: np.ndarray, text: np.ndarray) -> Grammar:
    """Re-Pair of texts laid end to end; ``ids`` differ between texts, ``text`` is the number of each word's text."""
    seq, start, length = ids.copy(), np.arange(len(ids)), np.ones(len(ids), np.int64)
    base = known = int(ids.max()) + 1
    keys, names = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lefts, sizes, symbols, starts, tops = [], [], [], [], []
    while len(seq) > 1:
        pair = seq[:-1] << 32 | seq[1:]
        _, inverse, count = np.unique(pair, return_inverse=True, return_counts=True)
        count = count[inverse]
        # The pair across two texts occurs once, so nothing is joined there.
        going = np.zeros(text[-1] + 1, bool)
        going[text[start[:-1][count > 1]]] = True
        if not going.any():
            break
        chosen = np.flatnonzero(_winners(pair, count))
        kinds, one = np.unique(pair[chosen], return_index=True)
        new = ~np.isin(kinds, keys, assume_unique=True)
        one = chosen[one[new]]
        lefts.append(length[one])
        sizes.append(length[one] + length[one + 1])
        keys, names = np.concatenate([keys, kinds[new]]), np.concatenate([names, known + np.arange(new.sum())])
        known += int(new.sum())
        order = np.argsort(keys)
        keys, names = keys[order], names[order]
        seq[chosen] = names[np.searchsorted(keys, pair[chosen])]
        length[chosen] += length[chosen + 1]
        symbols.append(seq[chosen] - base)
        starts.append(start[chosen])
        keep = np.ones(len(seq), bool)
        keep[chosen + 1] = False
        rest = keep & ~going[text[start]]
        tops.append(start[rest])
        keep &= ~rest
        seq, start, length = seq[keep], start[keep], length[keep]
    parts = ([*x, np.zeros(0, np.int64)] for x in (symbols, starts, lefts, sizes))
    return Grammar(*(np.concatenate(x) for x in parts), np.sort(np.concatenate([*tops, start])))


def repeated_windows(ids: np.ndarray) -> list[np.ndarray]:
    """For windows of 1, 2, 4, ... words: a number that equal windows share, -1 where a window occurs once.

    Level 0 is the words themselves. Each level looks only at windows whose halves both repeat.
    """
    levels, size = [ids], 1
    while True:
        name = np.full(len(ids), -1, np.int64)
        half = levels[-1]
        at = np.flatnonzero((half[:-size] >= 0) & (half[size:] >= 0)) if len(ids) > size else np.zeros(0, np.int64)
        _, inverse, count = np.unique(half[at] << 32 | half[at + size], return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        if not twice.any():
            return levels
        name[at[twice]] = inverse[twice]
        levels.append(name)
        size *= 2


def extended(levels: list[np.ndarray], at: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words around ``at`` equal those ``period`` further on: start and end of the whole periodic stretch in [low, high)."""
    ahead, back, end = at.copy(), at.copy(), len(levels[0]) - 1
    for level in range(len(levels) - 1, -1, -1):
        name, size = levels[level], 1 << level
        mine = name[np.minimum(ahead, end)]
        ahead += size * ((ahead + period + size <= high) & (mine >= 0) & (mine == name[np.minimum(ahead + period, end)]))
        mine = name[np.maximum(back - size, 0)]
        back -= size * ((back - size >= low) & (mine >= 0) & (mine == name[np.clip(back - size + period, 0, end)]))
    return back, ahead + period


def crossing(levels: list[np.ndarray], middle: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs within [low, high) that cross ``middle``: (number of the boundary, start, end, period), each once or more."""
    parts = []
    for level in range(2, len(levels)):
        name, size = levels[level], 1 << level
        shortest, beyond = (1, SHORT) if size == WINDOW else (2 * size, 4 * size)
        where = np.flatnonzero(name >= 0)
        index = np.sort(name[where] << 32 | where)
        for shift in (0, size - 1):
            begin = middle - 1 - shift
            which = np.flatnonzero((begin >= low) & (begin + size <= high) & (name[np.maximum(begin, 0)] >= 0))
            begin = begin[which]
            for ahead in (True, False):
                nearest = begin + shortest if ahead else np.maximum(begin - beyond + 1, low[which])
                farthest = np.minimum(begin + beyond - 1, high[which] - size) if ahead else begin - shortest
                first = np.searchsorted(index, name[begin] << 32 | np.maximum(nearest, 0))
                last = np.searchsorted(index, name[begin] << 32 | np.maximum(farthest, 0), side="right")
                count = np.where(farthest >= nearest, np.maximum(last - first, 0), 0)
                for part in _chunks(count):
                    group, nth = _spread(count[part])
                    group += part.start
                    other = index[first[group] + nth] & 0xFFFFFFFF
                    period = np.abs(other - begin[group])
                    one = which[group]
                    start, end = extended(levels, np.minimum(other, begin[group]) + shift, period, low[one], high[one])
                    good = (end - start >= np.maximum(LEAST, 2 * period)) & (start < middle[one]) & (middle[one] < end)
                    parts.append(_smallest(one[good], start[good], end[good], period[good]))
    none = np.zeros(0, np.int64)
    return _smallest(*(np.concatenate([none, *x]) for x in (zip(*parts, strict=True) if parts else ([],) * 4)))


def _chunks(count: np.ndarray) -> Iterator[slice]:
    """Consecutive parts of about ``CHUNK`` candidates."""
    total = np.cumsum(count)
    at = 0
    while at < len(count):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + CHUNK, side="right")))
        if total[end - 1] > done:
            yield slice(at, end)
        at = end


def _smallest(group: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each interval of a group once, with its smallest period, by group, start and period."""
    order = np.lexsort((period, end, start, group))
    group, start, end, period = group[order], start[order], end[order], period[order]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    group, start, end, period = group[new], start[new], end[new], period[new]
    order = np.lexsort((period, start, group))
    return group[order], start[order], end[order], period[order]


def find_runs(texts: Sequence[np.ndarray]) -> list[Runs]:
    """(start, end, period) arrays of every text's runs, by start, then period. A text is an array of word numbers."""
    size = np.array([len(t) for t in texts], np.int64)
    none = np.zeros(0, np.int64)
    if not size.sum():
        return [(none, none, none)] * len(texts)
    # Words of different texts get different numbers, so nothing repeats across texts.
    kinds = np.array([int(t.max()) + 1 if len(t) else 0 for t in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), size)
    ids = np.concatenate([np.asarray(t, np.int64) for t in texts]) + np.repeat(np.cumsum(kinds) - kinds, size)
    text_start, text_end = np.cumsum(size) - size, np.cumsum(size)
    grammar, levels = repair(ids, text), repeated_windows(ids)

    # Nonterminals, at their first positions.
    by_symbol = np.lexsort((grammar.start, grammar.symbol))
    symbol, begin = grammar.symbol[by_symbol], grammar.start[by_symbol]
    kind, first, many = np.unique(symbol, return_index=True, return_counts=True)
    long = grammar.size[kind] >= LEAST
    kind, first, many = kind[long], first[long], many[long]
    low, high = begin[first], begin[first] + grammar.size[kind]
    which, start, end, period = crossing(levels, low + grammar.left[kind], low, high)
    # All their derivation positions; a run that goes on outside is not maximal there.
    group, nth = _spread(many[which])
    moved = begin[first[which][group] + nth] - low[which][group]
    start, end, period, mine = start[group] + moved, end[group] + moved, period[group], text[low[which][group]]
    before, after = np.maximum(start - 1, 0), np.minimum(end, len(ids) - 1)
    more = ((start > text_start[mine]) & (ids[before] == ids[np.minimum(before + period, len(ids) - 1)])) | (
        (end < text_end[mine]) & (ids[after] == ids[after - period]))
    inner = [x[~more] for x in (mine, start, end, period)]

    # Boundaries between the symbols at the top.
    middle = np.setdiff1d(grammar.top, text_start)
    mine = text[middle]
    which, start, end, period = crossing(levels, middle, text_start[mine], text_end[mine])
    outer = (mine[which], start, end, period)
    mine, start, end, period = _smallest(*(np.concatenate(x) for x in zip(inner, outer, strict=True)))
    cuts = np.searchsorted(mine, np.arange(len(texts) + 1))
    return [
        (start[a:b] - at, end[a:b] - at, period[a:b]) for a, b, at in zip(cuts[:-1], cuts[1:], text_start, strict=True)
    ]


def numbered(words: Sequence[bytes]) -> np.ndarray:
    """The words as numbers, by first occurrence."""
    number: dict[bytes, int] = {}
    return np.array([number.setdefault(w, len(number)) for w in words], np.int64)


def dropped(n: int, runs: Runs) -> np.ndarray:
    """Which of ``n`` words some run holds after its first period."""
    start, end, period = runs
    level = np.zeros(n + 1, np.int64)
    np.add.at(level, start + period, 1)
    np.add.at(level, end, -1)
    return np.cumsum(level[:-1]) > 0


def strips(texts: Sequence[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``STRIP`` words."""
    first = words = 0
    for i, text in enumerate(texts):
        words += len(text)
        if words >= STRIP or i == len(texts) - 1:
            yield first, i + 1
            first, words = i + 1, 0


def batch_runs(texts: Sequence[list[bytes]], places: Sequence[np.ndarray | None] | None = None) -> Iterator[Runs]:
    """Runs of each text; ``places`` may name, for a text, the original word that stands at each position."""
    for a, b in strips(texts):
        ids = [numbered(words) for words in texts[a:b]]
        if places is not None:
            ids = [x if p is None else x[p] for x, p in zip(ids, places[a:b], strict=True)]
        yield from find_runs(ids)


def runs(docs: DataFrame) -> DataFrame:
    """One row per run: doc_id, start (word number), length, period."""
    fields = [T.StructField(n, T.LongType()) for n in ("start", "length", "period")]
    schema = T.StructType([docs.schema["doc_id"], *fields])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            got = list(batch_runs([t.split() for t in as_bytes(batch.column("text"))]))
            row = np.repeat(np.arange(len(got)), [len(x[0]) for x in got])
            start, end, period = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*got, strict=True)) if got else (np.zeros(0, np.int64),) * 3
            columns = [batch.column("doc_id").take(pa.array(row)), *(pa.array(x) for x in (start, end - start, period))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def collapsed(docs: DataFrame) -> DataFrame:
    """``docs`` whose texts lose the words that runs repeat; texts without runs and other columns stay as they are."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            words = [t.split() for t in texts]
            out = []
            for old, mine, found in zip(batch.column("text").to_pylist(), words, batch_runs(words), strict=True):
                keep = ~dropped(len(mine), found)
                out.append(old if keep.all() else b" ".join([mine[i] for i in np.flatnonzero(keep)]).decode())
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """The original word at each place of a text of ``n`` words, where the query makes a tail periodic."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def reported(docs: DataFrame) -> DataFrame:
    """One row per document: its number of runs, the longest one, and digests of all runs and of the words that stay.

    Every tenth document, by the checksum of its id, is read with a periodic tail (``planted``).
    """
    numbers = ("n_runs", "start", "length", "period", "exponent_milli")
    schema = T.StructType([
        docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in numbers),
        T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType()),
    ])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            texts = [t.split() for t in as_bytes(batch.column("text"))]
            places = [planted(k, len(t)) for k, t in zip(keys, texts, strict=True)]
            out: dict[str, list] = {n: [] for n in schema.names[1:]}
            for words, place, found in zip(texts, places, batch_runs(texts, places), strict=True):
                start, end, period = found
                length = end - start
                text = words if place is None else [words[i] for i in place]
                out["n_runs"].append(len(start))
                if len(start):
                    best = np.lexsort((period, start, -length))[0]
                    best = [int(x[best]) for x in (start, length, period)]
                    text = [text[i] for i in np.flatnonzero(~dropped(len(text), found))]
                    for name, value in zip(numbers[1:], [*best, 1000 * best[1] // best[2]], strict=True):
                        out[name].append(value)
                else:
                    for name in numbers[1:]:
                        out[name].append(None)
                listed = "".join(f"{a},{n},{q}\n" for a, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
                out["runs_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
                out["collapsed_sha256"].append(hashlib.sha256(b" ".join(text)).hexdigest())
            rest = [pa.array(out[n], pa.int64() if n in numbers else pa.string()) for n in schema.names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *rest], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
