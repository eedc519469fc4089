"""Quality discriminant, word runs and lexical search against plain versions of themselves, and on odd tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import discriminant, fptree, queries, wordruns

SF_DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, "b a b a b a b a b a b a b a x", "s", 1), (2, None, "s", 2), (3, "", None, 3), (4, " \t\n ", "s", 4), (5, "\u00a0 \u2003 caf\u00e9 CAF\u00c9", "s", 5),
    (5, "repeated id", "s", 6), (6, "a " * 40_000, "s", 7), (None, "no id here", "s", 8), (None, None, None, None), (1, "b a b a b a b a b a b a b a x", "s", 1),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id bigint, text string, source string, rank int").repartition(3)


# ---------------------------------------------------------------- word runs


def slow_runs(ids):
    """(start, end, period) of all runs: for each period, the longest stretches that keep it."""
    best = {}
    for q in range(1, len(ids) // 2 + 1):
        i = 0
        while i + q < len(ids):
            j = i
            while j + q < len(ids) and ids[j] == ids[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def slow_report(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    row = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *row, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


@st.composite
def periodic(draw):
    words = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 2, 5, 40]))), max_size=120))
    for _ in range(draw(st.integers(0, 3))):
        if words:
            a = draw(st.integers(0, len(words) - 1))
            p = draw(st.integers(1, max(1, (len(words) - a) // 2)))
            for i in range(a, draw(st.integers(a, len(words)))):
                words[i] = words[a + (i - a) % p]
    return words


@settings(max_examples=150, deadline=None)
@given(st.lists(periodic(), max_size=6))
def test_runs_equal_brute_force(texts):
    got = wordruns.find_runs([np.array(t, np.int64) for t in texts])
    assert [[tuple(map(int, r)) for r in zip(*x, strict=True)] for x in got] == [slow_runs(t) for t in texts]


def test_runs_of_words_that_are_periodic_at_every_scale():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(300)]
    squares = [1] * 100 + [2] + [1] * 100 + [2] + [1] * 100
    for ids in (b, thue, squares, [0] * 333):
        (got,) = wordruns.find_runs([np.array(ids)])
        assert [tuple(map(int, r)) for r in zip(*got, strict=True)] == slow_runs(ids)


def test_grammar_expands_to_the_text():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 3, 500), 3 + rng.integers(0, 2, 200)])
    text = np.repeat([0, 1], [500, 200])
    grammar = wordruns.repair(ids, text)
    at = np.argsort(grammar.symbol, kind="stable")
    for kind in np.unique(grammar.symbol):
        places = grammar.start[at[grammar.symbol[at] == kind]]
        parts = {tuple(ids[p:p + grammar.size[kind]]) for p in places}
        assert len(parts) == 1 and len({text[p] for p in places}) == 1
    assert {0, 500} <= set(grammar.top.tolist())


def test_run_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = sorted((slow_report(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 6000), key=str)
    ids = {w[0] for w in want}
    got = sorted((tuple(r) for r in queries.RUNS["op12_word_runs"](spark, SF_DIR).collect() if r.doc_id in ids), key=str)
    assert got == want and sum(1 for w in want if w[1]) > 10


def test_runs_of_odd_and_empty_tables(odd):
    long = "a " * 40_000
    got = {r.doc_id: tuple(r) for r in wordruns.reported(odd.where("text is null or length(text) < 1000")).collect()}
    for doc_id, text, _, _ in ODD:
        if doc_id not in (None, 5) and text != long:
            assert got[doc_id] == slow_report(doc_id, text)
    assert wordruns.reported(odd).count() == len(ODD)
    assert {(r.start, r.length, r.period) for r in wordruns.runs(odd).where("doc_id = 6").collect()} == {(0, 40_000, 1)}
    kept = {(r.doc_id, r.text, r.rank) for r in wordruns.collapsed(odd).collect()}
    assert (6, "a", 7) in kept and (1, "b a x", 1) in kept and (2, None, 2) in kept and (4, " \t\n ", 4) in kept
    none = odd.where("doc_id = 999")
    assert wordruns.reported(none).count() == wordruns.runs(none).count() == wordruns.collapsed(none).count() == 0


# ------------------------------------------------------------ lexical search


def slow_search(docs, items):
    """Every document's score for every item; the ten best."""
    split = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    texts = [(d, split(t)) for d, t in docs]
    texts = [(d, Counter(t), len(t)) for d, t in texts if t]
    total, words = len(texts), sum(n for _, _, n in texts)
    df = Counter(t for _, many, _ in texts for t in many)
    out = []
    for item, text in items:
        scores = []
        for d, many, n in texts:
            m = 100 - 75 + (75 * n * total) // words
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * many[t]) // (1000 * many[t] + 8 * m))
                for t in split(text) if many[t]
            )
            scores.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(s for s in scores if s[0] < 0)[:10], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=str)


def search(docs, items):
    return sorted((tuple(r) for r in fptree.search(docs, items).collect()), key=str)


def test_search_equals_brute_force_on_small_vocabularies(spark, monkeypatch):
    """Many ties, copies and shared paths; trees and leaves of few documents."""
    monkeypatch.setattr(fptree, "CELLS", 400)
    monkeypatch.setattr(fptree, "LEAF", 3)
    rng = np.random.default_rng(5)
    docs = [(int(i), " ".join(f"w{int(x)}" for x in np.minimum(rng.geometric(0.2, rng.integers(0, 30)), 20))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]
    items = [(i, " ".join(f"w{int(x)}" for x in rng.integers(1, 22, rng.integers(0, 12)))) for i in range(15)] + [(3, "w1 W2 w2, w2!")]
    got = search(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert got == slow_search(docs, items)


def test_search_in_blocks_of_items_gives_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    whole = search(docs, items)
    monkeypatch.setattr(fptree, "BLOCK_BYTES", 3000)
    assert search(docs, items) == whole


def test_tree_nodes_bound_what_lies_below():
    rng = np.random.default_rng(2)
    rows = [(d, r, int(rng.integers(1, 9))) for d in range(200) for r in sorted(set(rng.geometric(0.15, 12).tolist()))]
    doc, rank, count = (np.array(x, np.int64) for x in zip(*rows, strict=True))
    tree = fptree.Tree(doc, rank, count, rng.integers(25, 400, 200), np.arange(200))
    for node, below in enumerate(tree.children):
        low, high = tree.low[node], tree.high[node]
        assert (tree.most[node] == tree.counts[low:high].max(axis=0)).all() and tree.least_m[node] == tree.m[low:high].min()
        if below is not None:
            assert [tree.low[below][0], tree.high[below][-1]] == [low, high] and tree.low[below][1:] == tree.high[below][:-1]
    assert any(below is not None for below in tree.children[1:])


def test_search_of_odd_and_empty_tables(spark, odd):
    items = [(1, "b a b"), (2, None), (3, ""), (None, "repeated ID caf\u00e9"), (5, "nowhere"), (1, "b a b")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    assert search(odd, asked) == slow_search([(d, t) for d, t, _, _ in ODD], items)
    assert search(odd.where("doc_id = 999"), asked) == [] and search(odd, asked.where("item_id = 999")) == []


# ------------------------------------------------------- quality discriminant


def test_discriminant_equals_plain_gaussians():
    """Scores against densities written out with the inverse and determinant of each covariance."""
    rng = np.random.default_rng(1)
    d = len(discriminant.NAMES)
    rows = {k: np.rint((rng.normal(k, 1 + k, (300 + 50 * k, d)) @ rng.normal(0, 1, (d, d)) / 4).clip(-60, 60) * discriminant.UNIT) for k in (0, 1)}
    model = discriminant.fit({k: (len(x), [int(v) for v in x.sum(axis=0)], [[int(v) for v in r] for r in x.T @ x]) for k, x in rows.items()})
    points = np.concatenate([x[:40] for x in rows.values()]) / discriminant.UNIT
    covs = {k: np.cov((x / discriminant.UNIT).T, bias=True) for k, x in rows.items()}
    pooled = sum(covs[k] * len(rows[k]) for k in rows) / sum(map(len, rows.values()))
    unit = np.diag(np.sqrt(np.diag(pooled)))
    for k, part in zip((0, 1), model.classes, strict=True):
        inside = np.linalg.inv(unit)
        cov = unit @ discriminant.shrunk(inside @ covs[k] @ inside, inside @ pooled @ inside, len(rows[k])) @ unit
        away = points - rows[k].mean(axis=0) / discriminant.UNIT
        want = -0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away) - 0.5 * np.linalg.slogdet(cov)[1]
        got = part.log_density(points) - np.log(np.diag(unit)).sum()
        assert np.allclose(got, want, rtol=1e-6, atol=1e-6)


def test_shrinkage_keeps_covariances_definite():
    """Statistics that never vary, and fewer rows than statistics."""
    d = len(discriminant.NAMES)
    flat = np.zeros((3, d), int)
    flat[:, 0] = [1, 2, 3]
    wide = np.arange(5 * d).reshape(5, d) % 7 * 1000
    sums = {k: (len(x), [int(v) for v in x.sum(axis=0)], [[int(v) for v in r] for r in x.T @ x]) for k, x in ((0, flat), (1, wide))}
    model = discriminant.fit(sums)
    assert all(np.isfinite(c.whiten).all() and math.isfinite(c.half_log_det) for c in model.classes)
    assert 0 <= model.score(discriminant.vectors([b""]))[0] <= 1


def test_discriminant_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    good = docs.join(labels, "doc_id").select("doc_id", "text", "quality")
    got = discriminant.scored(discriminant.described(good), discriminant.train(discriminant.described(docs), labels)).where("held_out")
    got = got.join(labels, "doc_id").groupBy("quality").agg({"predicted": "avg", "*": "count"}).collect()
    share = {r["quality"]: r["avg(predicted)"] for r in got}
    assert share[1] > 0.98 and share[0] < 0.03


def test_discriminant_does_not_depend_on_partitions_or_order(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    one = discriminant.train(discriminant.described(docs.coalesce(1)), labels)
    many = discriminant.train(discriminant.described(docs).repartition(7), labels)
    assert all((a.whiten == b.whiten).all() and (a.mean == b.mean).all() for a, b in zip(one.classes, many.classes, strict=True))


def test_discriminant_on_odd_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 1), (None, 1), (2, None), (77, 0), (6, 1)], "doc_id bigint, quality int")
    rows = discriminant.described(odd)
    model = discriminant.train(rows, labels)
    got = discriminant.scored(rows, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    none = rows.where("doc_id = 999")
    assert discriminant.scored(none, model).count() == 0
    for empty in (discriminant.train(none, labels), discriminant.train(rows, labels.where("doc_id = 999"))):
        assert {r.score for r in discriminant.scored(rows, empty).collect()} == {0.5}
    good = discriminant.train(rows, labels.where("doc_id = 6"))
    assert discriminant.keep_good(odd, good).count() == len(ODD) and discriminant.keep_good(odd, good).columns == odd.columns
    assert set(model.__dict__) == {"classes", "fixed"}
