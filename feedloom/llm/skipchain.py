"""Personal data with a skip-chain conditional random field.

Patterns find the base spans: e-mail and IP addresses, card and phone numbers. The field then labels all tokens that have a
digit or an at sign, with O or one of the four kinds. Potentials are a softmax over token features (unary), a table for
neighbouring tokens (chain) and a table for distant tokens that repeat or resemble each other (skip): same text, same
digits, or same last seven digits. A token inside a base span is observed; the last one of a card or phone number also has the keys of
the number's joined digits, and so have unobserved neighbours that together write the number. Loopy message passing then carries labels along
both kinds of edges until the messages stop changing, so another writing of a number that is known elsewhere in the document gets its label; what is
labelled with enough certainty becomes a further span. Base spans always stay.

All other tokens are O by definition and cut the chain, so a document without such tokens costs one scan. A
token that shares a key with observed ones is linked to the first of them of each label, so a label reaches all repeats at once; observed
tokens among themselves, and those that share no observed key, are linked to the next one. Edges grow with the text, not with the square of repeats.

Potentials are trained on the base spans of at most ``SAMPLE`` documents (the first by a hash of their id, and
``SAMPLE_BYTES`` of text): softmax regression for tokens, smoothed log ratios of pair counts for the tables.

Patterns run in time in proportion to the text also on hostile input: a text is entered at its at signs and at the starts of digit runs.

Defined results: a null or empty text has no spans. Offsets are code points, ends exclusive. A pattern's match that fails its check is
dropped and not retried. Rows repeated are alike. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import Batches, texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("o", *KINDS)
#: Documents, and bytes of their texts, that potentials are trained on at most.
SAMPLE = 4000
SAMPLE_BYTES = 16_000_000
SHORT_BYTES = 100_000
#: Change of a log message that counts as none, rounds after which messages that still swing are taken as they are, part of a message
#: kept from the round before, and certainty of a new span.
STILL = 1e-3
ROUNDS = 1000
DAMP = 0.3
SURE = 0.8
STEPS = 200
#: Neighbouring tokens that may write one number together.
RUN = 6

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_WHOLE_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}(?::[0-9]+)?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_ANY = re.compile(r"[0-9@]")
_EDGE = ".,;:!?\"'<>[]{}"

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _valid_ip(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in address.partition(":")[0].split("."))


def emails(text: str) -> list[tuple[int, int]]:
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            floor = match.end()
            found.append((start, floor))
        at = text.find("@", max(at + 1, floor))
    return found


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of all pattern matches that pass their check, in order."""
    if not _ANY.search(text):
        return []
    spans = [(a, 0, b) for a, b in emails(text)]
    spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _valid_ip(m.group())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


@dataclass
class Tokens:
    """Candidate tokens of a document: place, features, keys for skip edges, and label by base span (0: none)."""

    start: np.ndarray
    end: np.ndarray
    features: np.ndarray
    keys: list[set[str]]
    label: np.ndarray
    neighbour: np.ndarray


def tokenise(text: str, spans: list[Span]) -> Tokens:
    places, keys, rows = [], [], []
    for m in _TOKEN.finditer(text):
        raw = m.group()
        core = raw.strip(_EDGE)
        if not core or not _ANY.search(core):
            continue
        start = m.start() + raw.index(core)
        digits = "".join(c for c in core if "0" <= c <= "9")
        places.append((start, start + len(core)))
        keys.append({core.lower(), *([f"d{digits}"] if len(digits) >= 6 else []), *([f"s{digits[-7:]}"] if len(digits) >= 7 else [])})
        rows.append(_features(core, digits))
    n = len(places)
    start, end = (np.array([p[i] for p in places], np.int64) for i in (0, 1))
    own = np.array(rows, np.float64).reshape(n, -1)
    neighbour = np.array([i for i in range(n - 1) if start[i + 1] - end[i] <= 2], np.int64)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[neighbour + 1] = own[neighbour]
    after[neighbour] = own[neighbour + 1]
    label = np.zeros(n, np.int64)
    # Tokens lie in order and apart, so those that a span meets are neighbours.
    first = np.searchsorted(end, [a for a, _, _ in spans], side="right").tolist()
    beyond = np.searchsorted(start, [b for _, _, b in spans]).tolist()
    for i, j, (_, kind, _) in zip(first, beyond, spans, strict=True):
        part = label[i:j]
        part[part == 0] = kind + 1
    _join(text, spans, start, end, label, neighbour, keys)
    return Tokens(start, end, np.hstack([own, before, after, np.ones((n, 1))]) if n else np.zeros((0, 1)), keys, label, neighbour)


def _join(text: str, spans: list[Span], start: np.ndarray, end: np.ndarray, label: np.ndarray, neighbour: np.ndarray, keys: list[set[str]]) -> None:
    """Give numbers written over several tokens the keys of their joined digits."""
    known: set[str] = set()
    ends = (np.searchsorted(start, [b for _, _, b in spans]) - 1).tolist()
    for at, (a, kind, b) in zip(ends, spans, strict=True):
        digits = "".join(c for c in text[a:b] if "0" <= c <= "9")
        if KINDS[kind] in ("card", "phone") and at >= 0:
            keys[at] |= {f"d{digits}", f"s{digits[-7:]}"}
            known.update(digits[i:] for i in range(len(digits) - 6))
    if not known:
        return
    near = set(neighbour.tolist())
    written = ["" if label[i] else "".join(c for c in text[start[i]:end[i]] if "0" <= c <= "9") for i in range(len(start))]
    for i in range(len(start)):
        joined = written[i]
        for j in range(i + 1, min(i + RUN, len(start))):
            if j - 1 not in near or not joined or not written[j] or len(joined) > 19:
                break
            joined += written[j]
            if joined in known:
                for k in range(i, j + 1):
                    keys[k].add(f"s{joined[-7:]}")


def _features(core: str, digits: str) -> list[float]:
    n, plain = len(digits), core.replace("-", "").replace(".", "")
    return [
        *(float(a <= n <= b) for a, b in ((0, 0), (1, 3), (4, 6), (7, 7), (8, 9), (10, 13), (14, 19), (20, 1 << 60))),
        float(14 <= n <= 19 and luhn(digits)), float(14 <= n <= 19 and not luhn(digits)), float("@" in core), float(bool(_WHOLE_IP.fullmatch(core)) and _valid_ip(core)), float("." in core), float("-" in core), float(core[0] == "+"),
        float(core[0] == "(" or core[-1] == ")"), float(plain.isdigit()), float(any(c.isalpha() for c in core)), float("=" in core or '"' in core),
    ]


def edges(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, type): neighbours (0) and tokens that share a key (1), each pair once."""
    pairs = {(int(i), int(i) + 1): 0 for i in tokens.neighbour}
    label = tokens.label.tolist()
    hubs: dict[str, dict[int, int]] = {}
    for i, keys in enumerate(tokens.keys):
        if label[i]:
            for key in keys:
                hubs.setdefault(key, {}).setdefault(label[i], i)
    last: dict[tuple[bool, str], int] = {}
    for i, keys in enumerate(tokens.keys):
        first: dict[int, int] = {}
        if not label[i]:
            for key in keys:
                for kind, k in hubs.get(key, {}).items():
                    first[kind] = min(k, first.get(kind, k))
        for k in first.values():
            if (min(i, k), max(i, k)) not in pairs:
                pairs[min(i, k), max(i, k)] = 1
        if not first:
            for key in keys:
                before = last.get((label[i] > 0, key))
                if before is not None:
                    pairs.setdefault((before, i), 1)
                last[label[i] > 0, key] = i
    a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    return a, b, np.array(list(pairs.values()), np.int64)


@dataclass
class Field:
    """Weights of the features per label, and log potentials of the two kinds of edges."""

    weights: np.ndarray
    tables: np.ndarray


def fit(documents: list[str]) -> Field:
    """Potentials from the base spans of the documents."""
    size, kinds = None, len(LABELS)
    rows, labels = [], []
    counts = np.ones((2, kinds, kinds))
    for text in documents:
        tokens = tokenise(text, base_spans(text))
        if len(tokens.label):
            rows.append(tokens.features)
            labels.append(tokens.label)
            a, b, kind = edges(tokens)
            np.add.at(counts, (kind, tokens.label[a], tokens.label[b]), 1)
    counts += counts.transpose(0, 2, 1)
    share = counts / counts.sum(axis=(1, 2), keepdims=True)
    tables = np.log(share / (share.sum(axis=2, keepdims=True) * share.sum(axis=1, keepdims=True)))
    if not rows:
        size = tokenise("0", []).features.shape[1]
        return Field(np.zeros((size, kinds)), tables * 0)
    x, y = np.vstack(rows), np.concatenate(labels)
    weights, target = np.zeros((x.shape[1], kinds)), np.eye(kinds)[y]
    for _ in range(STEPS):
        logit = x @ weights
        chance = np.exp(logit - logit.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        weights += 0.5 * (x.T @ (target - chance) / len(x) - 1e-4 * weights)
    return Field(weights, tables)


def marginals(tokens: Tokens, field: Field) -> np.ndarray:
    """Label probabilities of all tokens after loopy message passing, observed labels held."""
    unary = tokens.features @ field.weights
    unary -= unary.max(axis=1, keepdims=True)
    seen = tokens.label > 0
    unary[seen] = -50.0
    unary[seen, tokens.label[seen]] = 0.0
    a, b, kind = edges(tokens)
    belief = unary
    if len(a):
        source, sink = np.concatenate([a, b]), np.concatenate([b, a])
        table = np.concatenate([field.tables[kind], field.tables[kind].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        message = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, sink, message)
            inward = belief[source] - message[back]
            full = inward[:, :, None] + table
            top = full.max(axis=1, keepdims=True)
            new = (top + np.log(np.exp(full - top).sum(axis=1, keepdims=True)))[:, 0, :]
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - message).max()
            message = DAMP * message + (1 - DAMP) * new
            if change < STILL:
                break
        belief = unary.copy()
        np.add.at(belief, sink, message)
    chance = np.exp(belief - belief.max(axis=1, keepdims=True))
    return chance / chance.sum(axis=1, keepdims=True)


def further_spans(text: str, spans: list[Span], field: Field) -> list[Span]:
    """Spans that the field adds; neighbours with the same label are one span."""
    if not _ANY.search(text):
        return []
    tokens = tokenise(text, spans)
    if not len(tokens.label) or (tokens.label > 0).all():
        return []
    chance = marginals(tokens, field)
    best = chance.argmax(axis=1)
    new = (tokens.label == 0) & (best > 0) & (chance.max(axis=1) >= SURE)
    near, out = set(tokens.neighbour.tolist()), []
    for i in np.flatnonzero(new).tolist():
        a, b, kind = int(tokens.start[i]), int(tokens.end[i]), int(best[i]) - 1
        if out and out[-1][0] == i - 1 and i - 1 in near and out[-1][2] == kind:
            out[-1] = (i, out[-1][1], kind, b)
        else:
            out.append((i, a, kind, b))
    return [(a, kind, b) for _, a, kind, b in out]


def train(docs: DataFrame) -> Field:
    """Fitted on the documents with the smallest hashes of id and text; equal rows count once.

    The hashes decide first, so only texts of the sample travel.
    """
    rows = texts(docs).withColumn("order", F.xxhash64("doc_id", "text", F.lit("private")))
    found = rows.where(F.col("text").rlike("[0-9@]"))
    last = found.select("order").distinct().orderBy("order").limit(SAMPLE).agg(F.max("order")).first()[0]
    if last is None:
        return fit([])
    chosen = found.where(F.col("order") <= last).groupBy("order").agg(F.min("text").alias("text"))
    # A long text comes after all shorter ones that do not exceed SHORT_BYTES, so it never takes their place.
    size = F.octet_length("text").cast("long")
    upto = Window.orderBy(F.greatest(size, F.lit(SHORT_BYTES)), "order").rowsBetween(Window.unboundedPreceding, 0)
    chosen = chosen.withColumn("upto", F.sum(size).over(upto)).where(F.col("upto") <= SAMPLE_BYTES)
    return fit(chosen.orderBy("order").select("text").toArrow().column("text").to_pylist())


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(spans))


def found(docs: DataFrame, field: Field) -> DataFrame:
    """One row per document: doc_id, counts of base spans by kind, base_sha256, spans."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    rows = texts(docs)
    schema = T.StructType([
        rows.schema["doc_id"], *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    ])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            counts, digests, all_spans = [[] for _ in KINDS], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                for k, c in enumerate(counts):
                    c.append(sum(kind == k for _, kind, _ in base))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                all_spans.append(written(base + further_spans(text, base, sent.value)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(all_spans, pa.string())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
