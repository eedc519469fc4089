"""Operators of the folder against brute force, and on odd rows: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import itertools
import math
import time
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import ctw, graysimhash, heavydedup, licenses, linefreq, mixing, packing, skipchain, tagpaths, toxicity

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, rid long, fp long, size long, nth int, tie long"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [
    (1, "one two three four five six seven eight nine ten"), (2, "one  two three\tfour five six seven eight nine ten"),
    (3, None), (4, ""), (5, " \n\t "), (None, "no id here, and a line\nno id here, and a line"), (7, LONG), (8, LONG + " more"),
    (9, "tie tie tie"), (9, "tie tie tie"), (10, "naïve café ☃ "), (11, "x" * 5000), (12, "line\n" * 40), (13, "One Two three four five six seven eight nine ten"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None if k % 4 == 0 else f"s{k % 3}", None, "row", k, 1, 2, 3, 4) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# exact dedup


def test_dedup_equals_brute_force_on_both_paths(odd):
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(hashlib.sha256(plain(t).encode()).hexdigest(), []).append(i)
    want = sorted(((i, min((x for x in groups[h] if x is not None), default=None), len(groups[h]), h) for i, t in TEXTS for h in [hashlib.sha256(plain(t).encode()).hexdigest()]), key=repr)
    for least in (2, 64):
        got = heavydedup.assign(odd, least=least).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_dedup_keeps_one_row_of_each_group(odd, none):
    for least in (2, 64):
        kept = heavydedup.drop_copies(odd, least=least)
        assert kept.columns == odd.columns
        assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 5, None, 7, 8, 9, 10, 11, 12, 13], key=repr)
    assert heavydedup.assign(none).count() == heavydedup.drop_copies(none).count() == 0


# mixing


def test_mix_is_whole_near_its_targets_and_stable(spark):
    rows = [(i, " ".join(["w"] * (i % 37 + 1)), "abcde"[min(4, int(math.sqrt(i / 16)))]) for i in range(400)]
    docs = spark.createDataFrame([*rows, (1000, None, None), (1001, "w w w", None)], "doc_id long, text string, source string")
    got = mixing.mixed(docs).collect()
    assert len(got) == 402
    taken, sizes, goals = Counter(), Counter(), {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[r.source_size] += r.taken
        sizes[r.source_size] += r.size
        goals[r.source_size] = r.target
    assert all(goals[s] <= 3 * s + 1e-9 and abs(taken[s] - goals[s]) <= max(2, 0.02 * goals[s]) for s in goals)
    assert abs(sum(goals.values()) - sum(sizes.values())) < 1e-6
    assert sorted(got) == sorted(mixing.mixed(docs.repartition(3)).collect())


def test_mixed_rows_are_the_copies_taken(odd, none):
    want = Counter()
    for r in mixing.drawn(odd.select("doc_id", "source", "text")).collect():
        want[r.doc_id] += r.copies
    mixed = mixing.mix(odd, shards=4)
    assert mixed.columns == [*odd.columns, "mix_copy", "mix_shard", "mix_part", "mix_key"]
    assert Counter(r.doc_id for r in mixed.collect()) == +want
    assert Counter(r.doc_id for r in mixing.shuffled(odd).collect()) == +want and mixing.shuffled(odd).columns == odd.columns
    assert mixing.mixed(none).count() == mixing.mix(none).count() == mixing.shuffled(none).count() == 0


def test_shards_follow_the_words_and_lie_in_order(spark, monkeypatch):
    assert [mixing.shards_of(n) for n in (0, 1, mixing.SHARD_WORDS * 16, mixing.SHARD_WORDS * 16 + 1, 10**13)] == [16, 16, 16, 32, 1 << 19]
    monkeypatch.setattr(mixing, "SHARDS", 4)
    monkeypatch.setattr(mixing, "PART_WORDS", 300)
    docs = spark.createDataFrame([(i, "w " * (i % 9), "ab"[i % 2]) for i in range(800)], "doc_id long, text string, source string")
    places = {(r.doc_id, r.mix_copy): (r.mix_shard, r.mix_part, r.mix_key) for r in mixing.mix(docs).collect()}
    assert len({p[:2] for p in places.values()}) > 8
    files = mixing.shuffled(docs.select("*", F.lit(1).alias("mix_key"))).select("doc_id", F.spark_partition_id().alias("file")).collect()
    one = {d: [p for (x, _), p in places.items() if x == d] for d in {r.doc_id for r in files}}
    alone = [(r.file, one[r.doc_id][0]) for r in files if len(one[r.doc_id]) == 1]
    assert alone == sorted(alone) and len(alone) > 50


def test_equal_rows_without_ids_are_cut_up_and_drawn_alike(spark, monkeypatch):
    rows = [(None, "w w w", "a")] * 500 + [(None, f"x {i}", "a") for i in range(300)] + [(7, "same", "b")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    plain = sorted(mixing.mixed(docs).collect(), key=str)
    monkeypatch.setattr(mixing, "EQUAL_ROWS", 50)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 20)
    slices = mixing.sliced(mixing.cut(mixing.drawn(docs).drop("slice"))).groupBy("source", "slice").count()
    assert slices.agg(F.max("count")).first()[0] <= 200
    assert sorted(mixing.mixed(docs).collect(), key=str) == plain


def test_lines_have_one_limit_at_every_size(spark):
    """Thirty thousand texts of one host: a line in 21 of them goes, one in 20 stays."""
    docs = spark.range(30_000).selectExpr(
        "id AS doc_id", "'h' AS source",
        "concat('text ', id, if(id < 21, '\nshared by twenty-one', ''), if(id < 20, '\nshared by twenty', '')) AS text",
    )
    often = linefreq.frequent_lines(linefreq.distinct_lines(docs)).collect()
    # Digits count as zero, so numbers of equal length are one line.
    assert sorted(r.texts for r in often)[:1] == [21] and all(r.texts == 21 or r.texts >= 90 for r in often)


def test_a_long_labelled_text_takes_no_places(spark, monkeypatch):
    """A text longer than the whole bound, labelled toxic: the others are learned from all the same."""
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 400_000)
    rows = [(i, f"plain words number {i} " + ("you utter idiot fool" if i % 2 else "of a garden path")) for i in range(200)]
    rows += [(1000 + i, "idiot " * 50_000) for i in range(4)]
    labels = spark.createDataFrame([(d, int(d % 2 or d >= 1000)) for d, _ in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.scored(docs.where("doc_id < 1000"), toxicity.train(docs, labels)).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    monkeypatch.setattr(skipchain, "SAMPLE_BYTES", 5_000)
    mails = spark.createDataFrame([(i, f"mail me at a{i}@b{i}.com or call +1 555 123 {4000 + i}") for i in range(40)] + [(99, "no 1 " * 50_000)], "doc_id long, text string")
    assert np.abs(skipchain.train(mails).weights).sum() > 1


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A chain of a thousand fingerprints, named along it: the worst order for least names."""
    stored = []
    real = graysimhash.cut
    monkeypatch.setattr(graysimhash, "cut", lambda df: stored.append(0) or real(df))
    edges = spark.createDataFrame([(i, i + 1) for i in range(1000)] + [(5000, 5001)], "a long, b long")
    roots = {r.v: r.root for r in graysimhash.components(edges).collect()}
    assert len({roots[i] for i in range(1001)}) == 1 and roots[5000] == roots[5001] != roots[0]
    # Five stored tables a round at most, and one before.
    assert len(stored) <= 1 + 5 * 15


def test_spans_of_long_logs_are_found_in_linear_time():
    text = " ".join(f"10.{i % 250}.{i // 250 % 250}.7" for i in range(100_000))
    began = time.process_time()
    spans = skipchain.base_spans(text)
    tokens = skipchain.tokenise(text, spans)
    assert len(spans) == 100_000 and (tokens.label == 2).all()
    assert time.process_time() - began < 30


def test_quotas_are_exact_at_every_depth(spark):
    quotas = spark.createDataFrame([("a", 700), ("b", 300), (None, 1), ("c", 0)], "source string, blocks long")
    for shards in (1, 2, 16):
        got = mixing.split(quotas, shards).collect()
        assert Counter({s: sum(r.quota for r in got if r.source == s) for s in ("a", "b", None, "c")}) == Counter({"a": 700, "b": 300, None: 1, "c": 0})
        loads = [sum(r.quota for r in got if r.shard == k) for k in range(shards)]
        assert max(loads) - min(loads) <= shards.bit_length()
    dealt = mixing.deal(quotas, 4).collect()
    assert len({(r.source, r.block) for r in dealt}) == len(dealt) == 1001


def test_draw_follows_the_hypergeometric_law(spark):
    draw = mixing.draw_sql("30", "12", "50", "(id + 0.5D) / 20000D")
    got = Counter(r.x for r in spark.range(20000).select(F.expr(draw).alias("x")).collect())
    for k in range(13):
        share = math.comb(12, k) * math.comb(38, 30 - k) / math.comb(50, 30) if 30 - k <= 38 else 0
        assert abs(got[k] / 20000 - share) < 2e-4


# simhash


def brute_classes(docs):
    prints = [graysimhash.fingerprint((t or "").encode().lower().split()) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(docs)), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 2:
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, f"{prints[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(docs)), key=repr)


def test_simhash_classes_equal_brute_force(odd, none):
    assert sorted((tuple(r) for r in graysimhash.near_copies(odd).collect()), key=repr) == brute_classes(TEXTS)
    assert graysimhash.near_copies(none).count() == 0


def test_simhash_keeps_one_row_per_class(odd, none):
    kept = graysimhash.drop_near_copies(odd)
    want = {c: None for _, _, c in brute_classes(TEXTS)}
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert graysimhash.drop_near_copies(none).count() == 0


def test_crowded_keys_are_keyed_again_and_lose_no_link(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3, 300, 2)).astype(np.uint64)
    fps = np.unique((centres[:, None] ^ flips[..., 0] ^ flips[..., 1]).ravel())
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    root = np.arange(len(fps))
    for _ in range(len(fps)):
        root = np.array([root[row].min() for row in near])
    for group in (3, 256):
        found = {r.v: r.root for r in graysimhash.components(graysimhash.linked(rows, 2, group)).collect()}
        got = [found.get(int(x), int(x)) for x in fps.view(np.int64)]
        assert len(set(zip(got, root.tolist(), strict=True))) == len(set(got)) == len(set(root.tolist()))


def test_index_finds_all_pairs():
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64))
    fps = fps[np.argsort(graysimhash.gray_rank(fps))]
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    assert set(zip(*map(list, graysimhash.links(fps)), strict=True)) == {(i, j) for i, j in np.argwhere(near).tolist() if i < j}


# packing


def test_packing_round_trip(odd, none):
    rows = packing.pack(odd, VOCABULARY, ids=True).collect()
    whole = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for i, text in TEXTS:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for nth, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096].tobytes()
            want[(i, nth, at, len(part) // 4, zlib.crc32(part), part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1] and sum(n for _, n in spans) <= 4096
    assert packing.pack(none, VOCABULARY).count() == 0


def test_words_give_the_tokenizers_ids():
    text = "Don't STOP. it's <|endoftext|>x, 12.5% naïve… İstanbul now é a,b c.. d., \x1f! l'été. ..."
    work, whole = packing.encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    rng = np.random.default_rng(4)
    mixed = ["".join(rng.choice(list("aZé.,'s<|>&1 \nńßİ~`^_-€x"), 60)) for _ in range(300)]
    for t in (text, text.replace("<|", "<"), "", " \n", "Plain words only, here.", "x<|endoftext|>. <|startoftext|>&&", "a's, b'll! 'tis 'S.", *mixed):
        assert np.frombuffer(work.ids([t.encode()])[0], "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = sorted(rng.integers(1, 33, rng.integers(1, 200)).tolist(), reverse=True)
        gaps: list[int] = []
        for n in lengths:
            fit = min((g for g in gaps if g >= n), default=None)
            if fit is None:
                gaps.append(32 - n)
            else:
                gaps[gaps.index(fit)] = fit - n
        plan = packing.plan(Counter(lengths), 32)
        used = Counter()
        for k, (length, rank, first, _) in enumerate(plan.tolist()):
            end = plan[k + 1][1] if k + 1 < len(plan) and plan[k + 1][0] == length else lengths.count(length)
            used.update({first + i: length for i in range(end - rank)})
        assert sorted(32 - n for n in used.values()) == sorted(gaps)


# language model


def test_scores_match_brute_force(spark, odd, none):
    docs = [(i, (t or "").encode()) for i, t in TEXTS]
    rows = ctw.scored(odd, buckets=3).collect()
    trained = Counter()
    for i, t in docs:
        if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1:
            trained.update([*t.lower().split(), b"\n"])
    total, kinds = sum(trained.values()), len(trained)
    want = []
    for i, t in docs:
        words = [*t.lower().split(), b"\n"]
        base = sum(math.log10((trained[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        want.append((i, len(words), sum(trained[w] > 0 for w in words), total, round(base, 4)))
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows), key=repr) == sorted(want, key=repr)
    assert ctw.scored(none).count() == 0


class Tree:
    """Context-tree weighting written out over dictionaries."""

    def __init__(self, texts):
        self.seen = {}
        for text in texts:
            for context, bits in self.steps(text):
                for prefix, bit in bits:
                    for depth in range(ctw.DEPTH + 1):
                        self.seen.setdefault((context[:depth], prefix), [0, 0])[bit] += 1
        self.below = {}
        for context, prefix in self.seen:
            if context:
                self.below.setdefault((context[:-1], prefix), []).append((context, prefix))
        self.weight = {}
        for node in sorted(self.seen, key=lambda n: -len(n[0])):
            a, b = self.seen[node]
            kt = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            if len(node[0]) == ctw.DEPTH:
                self.weight[node] = (kt, 1.0)
            else:
                all_in = np.logaddexp(math.log(0.5) + kt, math.log(0.5) + sum(self.weight[c][0] for c in self.below[node]))
                self.weight[node] = (all_in, math.exp(math.log(0.5) + kt - all_in))

    @staticmethod
    def steps(text):
        flat = b"\n" * ctw.DEPTH + b" ".join(text.lower().split()) + b"\n"
        for at in range(ctw.DEPTH, len(flat)):
            bits = f"{flat[at]:08b}"
            yield flat[at - ctw.DEPTH:at][::-1], [(bits[:k], int(bits[k])) for k in range(8)]

    def score(self, text):
        total = 0.0
        for context, bits in self.steps(text):
            for prefix, bit in bits:
                chance = None
                for depth in range(ctw.DEPTH, -1, -1):
                    node = (context[:depth], prefix)
                    if node in self.seen:
                        own = (self.seen[node][bit] + 0.5) / (sum(self.seen[node]) + 1)
                        stop = self.weight[node][1]
                        chance = own if chance is None else stop * own + (1 - stop) * chance
                total += math.log10(0.5 if chance is None else chance)
        return total


def test_scores_equal_a_plain_context_tree(spark, monkeypatch):
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 200)
    texts = ["The cat sat on the mat.", "the cat ran", "A dog ran\n to the cat", "zebra ☃", "", "the mat"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tree = Tree([t.encode() for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1])
    for r in ctw.scored(docs, buckets=4).collect():
        assert abs(r.score - tree.score(texts[r.doc_id].encode())) < 1e-4


def test_code_length_beats_words_on_held_out_documents(spark):
    rows = ctw.scored(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


# toxicity


def test_classifier_finds_held_out_toxic_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.scored(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert (n[(0, 0)] + n[(1, 1)]) / sum(n.values()) > 0.95 and n[(1, 1)] > 0.75 * (n[(1, 1)] + n[(1, 0)])


def test_scores_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, None), (7, 0, 0), (7, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd, labels)
    rows = toxicity.scored(odd, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert {r.score for r in rows if r.doc_id in (3, 4, 5)} == {model.empty}
    assert toxicity.scored(none, model).count() == 0
    clean = toxicity.keep_clean(odd, model)
    assert clean.columns == odd.columns and clean.count() == sum(r.score < 0.5 for r in rows)
    untaught = toxicity.train(odd, labels.limit(0))
    assert {r.score for r in toxicity.scored(odd, untaught).collect()} == {0.0}


def test_a_misspelling_shares_vectors():
    texts = [b"what a stupidity this is today", b"a calm day in the park with friends"] * 40
    model = toxicity.fit(texts, [1, 0] * 40)
    scorer = toxicity.Scorer(model)
    assert scorer.score(b"what a stupidityy") > scorer.score(b"a calmm day")


# line frequency


def test_lines_in_many_texts_of_a_host_are_removed(spark):
    body = [f"this is line {chr(97 + i % 26)}{chr(97 + i // 26)} with its own ten words in it" for i in range(60)]
    rows = [(i, f"{body[i]}\nShared  footer line of the whole site number {i % 9}", "h") for i in range(30)]
    rows += [(100 + i, "Shared footer line of the whole site number 5\nshared footer line of the whole site number 7", "h") for i in range(3)]
    rows += [(200 + i, rows[0][1], "h") for i in range(50)]
    rows += [(300, rows[0][1], "other"), (301, None, None), (302, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in linefreq.judged(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept and got[i].n_words - got[i].words_left == 9 for i in range(30))
    assert not any(got[100 + i].kept for i in range(3)) and all(got[200 + i].kept for i in range(50))
    assert got[300].words_left == got[300].n_words and not got[301].kept and got[302].base_failed
    cleaned = {r.doc_id: r.text for r in linefreq.clean(docs).collect()}
    assert cleaned[4] == body[4] and cleaned[300] == rows[0][1] and cleaned[301] is None and len(cleaned) == len(rows)


def test_base_counts_equal_brute_force(odd, none):
    for _, t in TEXTS:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        five = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if five[tuple(words[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert linefreq.base_counts((t or "").encode()) == want
    assert linefreq.judged(odd).count() == len(TEXTS) and linefreq.judged(none).count() == 0
    assert linefreq.clean(odd).columns == odd.columns


# licenses


def test_licenses_equal_exact_containment(spark, odd, none):
    grant = licenses.NOTICES["MIT-grant"]
    texts = [
        "before " * 300 + grant + " after" * 300, grant.upper(), "All rights  reserved", "all rights are reserved", "Licensed under the Apache\nLicense, Version 2.0!",
        " ".join(w for k, w in enumerate(grant.split()) if k % 3), grant.replace("sublicense", "lend"), "", None, "released under the MIT License. " * 3,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.template) for r in licenses.scanned(docs).collect()}

    def shingles(text, size):
        words = [w for w in (x.lower().strip(licenses._EDGE) for x in (text or "").encode().split())]
        return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}

    want = set()
    for i, text in enumerate(texts):
        for name, notice in licenses.NOTICES.items():
            size = min(5, len(notice.split()))
            mine = shingles(notice, size)
            if len(mine & shingles(text, size)) >= 0.8 * len(mine):
                want.add((i, name))
    assert got == want and len(want) >= 6
    assert licenses.scanned(odd).count() == licenses.scanned(none).count() == licenses.scanned(docs, {}).count() == 0


def test_license_matches_have_their_place(spark):
    docs = spark.createDataFrame([(1, "a b c All rights reserved. d"), (2, "x " * 500 + licenses.NOTICES["GPL-3.0"])], "doc_id long, text string")
    got = sorted((r.doc_id, r.template, r.first_word, r.end_word) for r in licenses.scanned(docs).collect())
    assert got == [(1, "all-rights-reserved", 3, 6), (2, "GPL-3.0", 500, 512)]


# pages

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=x>Home</a></header>
<div class="cookie-notice">We use cookies, as you know, to make this page work, please accept them all now.</div>
<div id="content"><h1>A title here</h1><p>First paragraph, with <b>some</b> text; it goes on, and on,
as texts do.<p>Short.</p><ul><li>One thing, listed.<li>two</ul><p>Second &amp; last paragraph, &#233;t&eacute;, with more text.</div>
<form>Name, please, and more <input></form><script>var t = "</p>, , , , and text";</script><!-- a, b, c, d -->
<section id="comments"><p>Great article, thanks for writing it, it was very good, and long, and true.</p></section>
<aside><p>Related, things, here, in a sentence that is long, but not content at all.</p></aside><footer>&copy; 2020, all rights</footer>"""


def test_page_text():
    want = ["A title here", "First paragraph, with some text; it goes on, and on, as texts do.", "Short.", "One thing, listed.", "two", "Second & last paragraph, été, with more text."]
    assert tagpaths.content(PAGE) == "\n\n".join(want)


def test_pages_of_the_table_give_their_articles(spark):
    import html as h

    rows = tagpaths.extracted(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html"), "page_id").collect()
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = [re.sub(r"\s+", " ", h.unescape(re.sub(r"<[^>]+>", "", p))).strip() for p in re.split(r"</?(?:p|h1|br|div|ul|li)\b[^>]*>", article)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_odd_pages(spark):
    pages = [(1, None, None), (2, "u", ""), (3, "u", "plain words"), (4, "u", "<nav>menu</nav>"), (5, "u", "</div></p><b>x"), (5, "u", "</div></p><b>x"), (6, "u", "<!-- never closed")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = [(r.page_id, r.text, r.n_chars) for r in tagpaths.extracted(df).orderBy("page_id").collect()]
    assert got == [(1, "", 0), (2, "", 0), (3, "plain words", 11), (4, "", 0), (5, "x", 1), (5, "x", 1), (6, "", 0)]
    assert tagpaths.extracted(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<" * 50_000, "<p" * 50_000, "<div>x" * 10_000, "<b>x" * 10_000, "<a href=\"" * 10_000, "</i>" * 20_000])
def test_hostile_pages_end(page):
    assert isinstance(tagpaths.content(page), str)


# private data

SAID = (
    "call +1 (988) 555-2485 or (988) 555-2485, also 988-555-2485. Card 4041894974608795, not 4041894974608796; mail bosbt.42@mail8.example.com, "
    "ip 42.144.35.254:80 and 300.1.1.1, version 4.0. key AKIA8HUB2 a@b c@d.e +49 30 1234567 12"
)


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        odd, even = digits[::-1][::2], digits[::-1][1::2]
        if 14 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_plain_patterns(spark):
    rng = np.random.default_rng(2)
    texts = [SAID, *("".join(rng.choice(list("ab1 2.3@+-()9"), 60)) for _ in range(400))]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()]
    assert all(skipchain.base_spans(t) == brute_spans(t) for t in texts)


def test_other_writings_of_a_number_get_its_label(spark):
    field = skipchain.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    base = skipchain.base_spans(SAID)
    more = {(SAID[a:b], skipchain.KINDS[k]) for a, k, b in skipchain.further_spans(SAID, base, field)}
    assert {("(988) 555-2485", "phone"), ("988-555-2485", "phone")} <= more
    assert not any(word in text for text, _ in more for word in ("AKIA", "4.0", "300.1"))


def test_private_spans_of_odd_rows(odd, none):
    field = skipchain.train(odd)
    rows = skipchain.found(odd, field).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(TEXTS) and all(r.base_sha256 == empty and r.n_email == 0 for r in rows)
    assert skipchain.found(none, field).count() == 0


@pytest.mark.parametrize("text", ["1" * 100_000, "a" * 100_000, "a@" * 50_000, "+1" * 50_000, "1." * 50_000, "+1" + "(" * 100_000])
def test_hostile_texts_end(text):
    skipchain.further_spans(text, skipchain.base_spans(text), skipchain.fit([SAID]))
