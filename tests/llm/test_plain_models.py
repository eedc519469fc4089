"""Trained models against the same written out plainly, and the pipeline on odd and empty tables."""

import itertools
import math

import corpus_pipeline
import numpy as np

from feedloom.llm import skipchain, toxicity

WRAP = 1 << 64


def plain_bag(word):
    """Table rows of a word's n-grams and of the word itself, character by character."""
    text = "<" + word.decode().lower().strip(toxicity.EDGE) + ">"

    def row(value):
        value = (value ^ value >> 29) * 0x9E3779B97F4A7C15 % WRAP
        return value >> 47

    whole, rows = 0, []
    for c in text:
        whole = ((whole ^ ord(c)) * 0x100000001B3 + 1) % WRAP
    rows.append(row(whole))
    for n in toxicity.GRAMS:
        for i in range(len(text) - n + 1):
            value = n
            for c in text[i:i + n]:
                value = (value ^ ord(c)) * 0x100000001B3 % WRAP
            rows.append(row(value))
    return rows


def plain_score(model, text):
    words = text.split()
    if not words:
        return model.empty
    value = {w: sum(float(model.rows[r]) for r in plain_bag(w)) / len(plain_bag(w)) for w in words}
    windows = [words[i:i + toxicity.WINDOW] for i in range(0, len(words), toxicity.WINDOW)]
    top = sorted(sum(value[w] for w in set(win)) for win in windows)[-2:]
    return 1 / (1 + math.exp(-(sum(top) / len(top) + model.bias)))


def test_toxicity_scores_equal_plain_bags():
    texts = [b"you are an idiot and a fool, truly " * 2 if i % 2 else b"a walk in the garden, with tea and bread " * 2 for i in range(60)]
    model = toxicity.fit(texts, [i % 2 for i in range(60)])
    scorer = toxicity.Scorer(model)
    for text in ("idiot", "", "an idiott in the garden", "Fool! " * 30 + "tea " * 50, "née idiot über x y z", "tea and bread. idiot", "<>&&&"):
        assert abs(scorer.score(text.encode()) - plain_score(model, text.encode())) < 1e-6
    assert scorer.score(b"what an idiott you are") > 0.5 > scorer.score(b"bread and tea")


def test_messages_give_the_exact_marginals_of_trees():
    """On documents whose edges form a tree, message passing equals summing over all labelings."""
    rng = np.random.default_rng(3)
    size = skipchain.tokenise("0", []).features.shape[1]
    kinds, checked = len(skipchain.LABELS), 0
    for text in ("call 5551234567 now", "mail a@b.com, then 1.2.3.4", "5551234567 and so on, 5551234567 again", "12 34 56 78", "+1 555 123 4567 or 1234567"):
        field = skipchain.Field(rng.normal(0, 1, (size, kinds)), rng.normal(0, 1, (2, kinds, kinds)))
        field.tables += field.tables.transpose(0, 2, 1)
        tokens = skipchain.tokenise(text, skipchain.base_spans(text))
        a, b, kind = skipchain.edges(tokens)
        n = len(tokens.label)
        if n > 6 or len(set(map(frozenset, zip(a.tolist(), b.tolist(), strict=True)))) >= n:
            continue
        unary = tokens.features @ field.weights
        total = np.zeros((n, kinds))
        for labels in itertools.product(range(kinds), repeat=n):
            if any(seen and label != seen for seen, label in zip(tokens.label.tolist(), labels, strict=True)):
                continue
            energy = sum(unary[i, k] for i, k in enumerate(labels) if not tokens.label[i])
            energy += sum(field.tables[t, labels[i], labels[j]] for i, j, t in zip(a.tolist(), b.tolist(), kind.tolist(), strict=True))
            for i, k in enumerate(labels):
                total[i, k] += math.exp(energy)
        assert np.allclose(skipchain.marginals(tokens, field), total / total.sum(axis=1, keepdims=True), atol=2e-3)
        checked += 1
    assert checked >= 3


ROWS = [
    (1, "one two three four five six seven", "s", "x", 7), (2, "one  two three four five six seven", "s", "y", 8), (3, None, None, None, None), (4, "", "t", "z", 1),
    (None, "no id at all, but a text of its own", "t", "z", 2), (5, "word " * 30_000, "s", "x", 3), (6, "tie", "t", "x", 4), (6, "tie", "t", "x", 4), (7, " \n\t", "u", "x", 5),
]


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, source string, lang string, mix_key int"
    labels = spark.createDataFrame([(1, 1, 0), (6, None, 1), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    for name, rows in (("odd", ROWS), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.cut(stage(spark, docs, folder))
            assert docs.columns == ["doc_id", "text", "source", "lang", "mix_key"]
        packed = corpus_pipeline.run(spark, folder).collect()
        assert bool(packed) == bool(rows)
        for r in packed:
            assert 0 < r.length and 0 <= r.offset and r.offset + r.length <= 4096
