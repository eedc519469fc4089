"""The registered queries of the folder on the smallest tables: against SQL where SQL can say them, else their shape."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import compare
import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from feedloom.llm import graysimhash, queries, toxicity

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_context_tree_scores": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op2_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op5_license_scan": {"doc_id", "template", "containment", "first_word", "end_word"},
    "op6_tag_path_extraction": {"page_id", "url", "text", "n_chars"},
    "op7_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op9_private_spans": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op10_simhash_near_dedup": {"doc_id", "fingerprint", "component_id"},
    "op11_quality_discriminant": {"doc_id", "held_out", "score", "predicted"},
    "op12_word_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, compiled, duck, name):
    spark_types, (spark_columns, spark_rows) = compare.spark_side(queries.RUNS[name](spark, SF_DIR))
    duck_types, (duck_columns, duck_rows) = compare.duck_side(duck, queries.SQL[name])
    assert spark_columns == duck_columns
    assert spark_types == duck_types
    assert spark_rows == duck_rows


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_other_queries_give_a_row_per_document(spark, name):
    df = queries.RUNS[name](spark, SF_DIR)
    assert COLUMNS[name] <= set(df.columns)
    key = "page_id" if "page_id" in df.columns else "doc_id"
    source = spark.read.parquet(f"{SF_DIR}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    got = df.select(key).distinct().count()
    assert got <= source.count() if name == "op5_license_scan" else got == source.count()


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in queries.RUNS} == {f"op{n}" for n in range(1, 14)}


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, SF_DIR))
        counts.append(docs.count())
        if name != names[-1]:
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    assert {"doc_id", "sequence_id", "offset"} <= set(docs.columns)


# ------------------------------------------------- the pipeline, written out


def targets(sizes):
    """Shares of the sources by weight, capped at three times a source's size, the excess shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, full, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        goal = {s: 3.0 * sizes[s] if s in full else weight[s] * left / sum(weight[t] for t in sizes if t not in full) for s in sizes}
        over = {s for s in sizes if s not in full and goal[s] >= 3 * sizes[s]}
        if not over:
            return goal
        full |= over


def copies(docs):
    """How often the mix takes each document, by position."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs]
    sizes = Counter()
    for d, n in zip(docs, size, strict=True):
        sizes[d.source] += n
    goal, taken = targets(sizes), [0] * len(docs)
    for source in sizes:
        mine = sorted((i for i, d in enumerate(docs) if d.source == source), key=lambda i: (hashlib.md5(f"mix-1:{docs[i].doc_id}:{docs[i].text or ''}".encode()).hexdigest(), size[i]))
        passes = int(goal[source] // sizes[source]) if sizes[source] else 0
        want, place, picked = goal[source] - passes * sizes[source], 0, set()
        for i in mine:
            place += size[i]
            if place <= want:
                picked.add(i)
        for _ in range(3):
            missing, filled, more = want - sum(size[i] for i in picked), 0, set()
            for i in mine:
                if i not in picked and size[i] <= missing:
                    filled += size[i]
                    if filled <= missing:
                        more.add(i)
            picked |= more
        for i in mine:
            taken[i] = passes + (i in picked)
    return taken


def test_pipeline_equals_its_stages_written_out(spark):
    docs_df, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.Scorer(toxicity.train(docs_df, labels))
    docs = [d for d in docs_df.collect() if scorer.score((d.text or "").encode()) < 0.5]
    first = {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", d.text or ""), d)
    docs = sorted(first.values(), key=lambda d: d.doc_id)
    prints = [graysimhash.fingerprint((d.text or "").encode().lower().split()) for d in docs]
    group = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for a in range(len(docs)):
            for b in range(a):
                if bin(prints[a] ^ prints[b]).count("1") <= 2 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    docs = [docs[i] for i in sorted(set(group))]
    whole, want = Tokenizer.from_file(queries.VOCABULARY), Counter()
    for d, n in zip(docs, copies(docs), strict=True):
        ids = np.array([*whole.encode(d.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for nth, at in enumerate(range(0, len(ids), 4096)):
            want[(d.doc_id, nth, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()))] += n
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == +want
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1] and sum(n for _, n in spans) <= 4096
    gaps = []
    for n in sorted((r.length for r in rows), reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((4096 if fit is None else fit) - n)
    assert len(places) == len(gaps)
