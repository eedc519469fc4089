"""Each operator's result shows its whole method."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from feedloom.llm import licenses, mixing, queries, skipchain


def many(spark):
    rows = [(i, " ".join(["w"] * (i % 37 + 1)), "abcde"[min(4, i // 60)]) for i in range(400)]
    return spark.createDataFrame([*rows, (1000, None, None), (1001, "w w w", None)], "doc_id long, text string, source string").repartition(3).cache()


def test_taken_words_are_those_of_the_dealt_copies(spark, monkeypatch):
    docs = many(spark)
    size = {r.doc_id: r.size for r in mixing.drawn(docs).collect()}
    rows = mixing.mix(docs, shards=4).collect()
    whole = Counter(r.doc_id for r in rows)
    assert {r.doc_id: r.taken for r in mixing.mixed(docs, 4).collect()} == {i: n * whole[i] for i, n in size.items()}
    one = Counter(r.doc_id for r in rows if r.mix_shard == 0)
    assert 0 < sum(one.values()) < sum(whole.values())
    deal = mixing.deal
    monkeypatch.setattr(mixing, "deal", lambda *args: deal(*args).where("shard = 0"))
    assert {r.doc_id: r.taken for r in mixing.mixed(docs, 4).collect()} == {i: n * one[i] for i, n in size.items()}


def test_mixed_stage_is_written_shard_by_shard_in_the_order_of_its_keys(spark):
    docs = many(spark)
    shards = {}
    for r in sorted(mixing.mix(docs).collect(), key=lambda r: (r.mix_shard, r.mix_key)):
        shards.setdefault(r.mix_shard, []).append(r.doc_id)
    assert len(shards) == mixing.SHARDS
    files = {}
    stored = corpus_pipeline.cut(corpus_pipeline.mix_sources(spark, docs, ""))
    for r in stored.select("doc_id", F.input_file_name().alias("file"), F.expr("_metadata.row_index").alias("at")).orderBy("file", "at").collect():
        files.setdefault(r.file, []).append(r.doc_id)
    left = dict(shards)
    for ids in files.values():
        while ids:
            shard = next(k for k in sorted(left) if ids[:len(left[k])] == left[k])
            ids = ids[len(left.pop(shard)):]
    assert not left and stored.columns == docs.columns


@pytest.mark.parametrize("mark", [" * ", "# ", "// ", "-- ", "% "])
@pytest.mark.parametrize("name", ["MIT-grant", "GPL-header", "Apache-2.0-header", "BSD-conditions"])
def test_commented_notices_are_found(mark, name):
    words = licenses.NOTICES[name].split()
    text = "/*\n" + "".join(f"{mark}{' '.join(words[i:i + 9])}\n" for i in range(0, len(words), 9)) + " */\nint x;"
    hashes, all_words = licenses.Hashes(), text.split()
    found = {m[0]: m for m in licenses.matches(*hashes.kept(text.encode()), licenses.prepared(licenses.NOTICES))}
    _, share, first, end = found[name]
    assert share == 1 and all_words[first] == words[0] and all_words[end - 1] == words[-1]


def test_the_registered_scan_knows_headers_and_whole_texts(spark, tmp_path):
    wanted = [
        "LGPL-2.1-header", "AGPL-3.0-header", "MPL-2.0-header", "ISC-text", "CC0-1.0-header", "CC-BY-SA-4.0-header", "Unlicense-text", "BSD-disclaimer", "MIT-disclaimer",
        "GPL-3.0-text", "Apache-2.0-text", "LGPL-2.1-text", "MPL-2.0-text",
    ]
    shipped = licenses.shipped()
    rows = [(i, "before it " * 40 + "\n# ".join(shipped[name].splitlines()) + " and after" * 40) for i, name in enumerate(wanted)]
    rows.append((len(rows), "// SPDX-License-Identifier: LGPL-2.1-or-later\nint x;"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.template): r.containment for r in queries.RUNS["op5_license_scan"](spark, str(tmp_path)).collect()}
    assert all(got[i, name] == 1 for i, name in enumerate([*wanted, "SPDX:LGPL-2.1-or-later"]))
    assert len(licenses._WORD.findall(shipped["GPL-3.0-text"].encode())) > 5000


@pytest.fixture(scope="module")
def field(spark):
    return skipchain.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


@pytest.mark.parametrize("number", ["+1 988 555 2485", "+1 (988) 555-2485"])
@pytest.mark.parametrize("repeats", [1, 5, 40])
@pytest.mark.parametrize("last", [False, True])
def test_every_other_writing_of_a_number_is_found(field, number, repeats, last):
    parts = [f"call {number} now. ", "then 988-555-2485 again, text. " * repeats]
    text = "".join(reversed(parts) if last else parts)
    base = skipchain.base_spans(text)
    assert [text[a:b] for a, _, b in base] == [number]
    assert [(text[a:b], k) for a, k, b in skipchain.further_spans(text, base, field)] == [("988-555-2485", 3)] * repeats


def test_a_number_in_several_words_is_one_span(field):
    text = "call +1 988 555 2485 now, then 988 555 2485 again, text. or 988 and 2485"
    assert [text[a:b] for a, _, b in skipchain.further_spans(text, skipchain.base_spans(text), field)] == ["988 555 2485"]
