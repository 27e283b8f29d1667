"""Language identification, toxicity, quality and language-model scoring against plain versions and held-out labels."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import language_id, lm_scoring, quality, toxicity
from riskloom.llm.common import held_out, table
from riskloom.llm.vectors import slices
from llm_cases import edge, frame, nothing, prose, sf  # noqa: F401  (fixtures)

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    if not letters.strip():
        return Counter()
    padded = f" {' '.join(letters.split())} "
    out = Counter(padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1))
    del out[" "]
    return out


@pytest.mark.parametrize("text", ["Été à la plage!", "a", " 12 b", "x1y  z", "\U0001f600 日本語", "", "...", "ab" * 400_000])
def test_grams(text):
    keys, counts = language_id.counted(language_id.grams(text))
    decoded = {}
    for k, n in zip(keys.tolist(), counts.tolist()):
        chars = [k >> 42, k >> 21 & 0x1FFFFF, k & 0x1FFFFF]
        decoded["".join(chr(c) for c in chars if c)] = n
    assert decoded == dict(plain_grams(text))


def test_nearest_profile_is_out_of_place_distance():
    texts = {"aa": "the cat and the dog " * 5, "bb": "der hund und die katze " * 5}
    made = {k: language_id.ranked(*language_id.counted(language_id.grams(t)), 50) for k, t in texts.items()}
    profiles = language_id.Profiles(made, 50)

    def brute(text):
        rank = lambda t: [g for g, _ in sorted(plain_grams(t).items(), key=lambda x: (-x[1], pack(x[0])))][:50]
        pack = lambda g: int("".join(f"{ord(c):021b}" for c in g), 2)
        own = rank(text)
        away = {k: sum(abs(rank(t).index(g) - i) if g in rank(t) else 50 for i, g in enumerate(own)) for k, t in texts.items()}
        best = min(away, key=lambda k: (away[k], k))
        return best, 1 - away[best] / (50 * len(own))

    for text in ("the hat", "und der hut", "q", "katze the dog"):
        assert profiles.nearest(text) == pytest.approx(brute(text))
    assert profiles.nearest("") == ("und", 0.0)
    assert language_id.Profiles({}, 50).nearest("text") == ("und", 0.0)


def test_language_edge_cases(edge, nothing):
    rows = edge.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "xx").when(F.col("doc_id") % 3 == 0, "yy"))
    rows = rows.withColumn("held_out", held_out("doc_id", 3, 1))
    got = language_id.predict(rows, language_id.learn_profiles(rows.where("NOT held_out"))).collect()
    assert len(got) == edge.count()
    assert {r.lang_pred for r in got if r.doc_id in (7, 8, 9)} == {"und"}
    assert {r.lang_pred for r in got} <= {"xx", "yy", "und"} and all(0 <= r.score <= 1 for r in got)
    none = nothing.selectExpr("*", "CAST(NULL AS STRING) AS lang", "true AS held_out")
    assert language_id.predict(none, language_id.learn_profiles(none)).count() == 0


def test_language_held_out_accuracy(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    got = language_id.op2_language_id(spark, sf).where("held_out").join(docs, "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def brute_segments(scores):
    """All maximal segments by definition: the best segment, then the same left and right of it."""
    if not len(scores):
        return []
    best = max(
        ((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        default=None,
    )
    if best[0] <= 1e-12:
        return []
    _, _, _, i, j = best
    return brute_segments(scores[:i]) + [(i, j)] + [(s + j, e + j) for s, e in brute_segments(scores[j:])]


def test_segments_are_all_maximal_ones():
    rng = random.Random(4)
    for _ in range(200):
        # Distinct powers keep sums unique, so the definition has one answer.
        scores = [rng.choice((-1, 1)) * rng.random() for _ in range(rng.randint(0, 14))]
        got = toxicity.segments(np.array(scores))
        assert [(s, e) for s, e, _ in got] == brute_segments(scores)
        assert all(x == pytest.approx(sum(scores[s:e])) for s, e, x in got)


def test_toxicity_edge_cases(spark, edge, nothing):
    labels = edge.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    got = toxicity.assess(edge, labels).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (7, 8, 9)}
    assert len(empty) == 1
    assert {r.score for r in toxicity.assess(edge, labels.where("false")).collect()} == {0.0}
    assert toxicity.assess(nothing, labels).count() == 0
    assert toxicity.clean_documents(edge, labels).columns == edge.columns


def test_toxic_passage_is_found(spark):
    rows = [(i, f"{prose(i, 60)} vile{'abcdef'[i % 6]} vilething {prose(i + 900, 60)}" if i % 4 == 0 else prose(i, 120)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.assess(frame(spark, rows), labels).where("held_out").collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in got)
    for r in got:
        if r.doc_id % 4 == 0:
            assert any(p.first_word <= 61 and p.last_word >= 60 for p in r.passages)


def test_toxicity_separates_held_out_rows(spark, sf):
    got = toxicity.op6_toxicity(spark, "/root/testdata/sf0.01").where("held_out").join(
        table(spark, "/root/testdata/sf0.01", "labels"), "doc_id"
    )
    clean, toxic = got.where("toxic = 0"), got.where("toxic = 1")
    assert clean.where("predicted = 0").count() >= 0.95 * clean.count()
    assert toxic.where("score > 0.2").count() >= 0.5 * toxic.count()


def walk(trees, x):
    """One row down every tree, node by node."""
    total = trees.base
    inner = trees.feature.shape[1]
    for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        node = 0
        while node < inner:
            node = 2 * node + (2 if x[f[node]] > t[node] else 1)
        total += leaf[node - inner]
    return total


def test_flat_trees_equal_a_walk_and_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 5))
    y = ((x[:, 1] > 0.6) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit(x, y)
    assert np.allclose(trees.margin(x[:50]), [walk(trees, r) for r in x[:50]])
    assert ((trees.probability(x) >= 0.5) == y).mean() > 0.97
    assert np.allclose(quality.fit(x, np.ones(2000)).probability(x), 2000.5 / 2001)


def test_statistics_by_hand():
    part = next(slices(pa.array(["Ab ab!! ab\nab 12", "", "xx"])))
    got = {n: v for n, v in zip(quality.FEATURES, quality.statistics(part).T)}
    assert got["share_upper"].tolist() == [1 / 16, 0, 0]
    assert got["share_shout"].tolist() == [2 / 16, 0, 0]
    assert got["distinct_words"].tolist() == [3 / 5, 0, 1]
    assert got["top_word"].tolist() == [3 / 5, 0, 1]
    assert got["words_a_line"].tolist() == [5 / 2, 0, 1]
    assert got["longest_run"].tolist() == [2 / 16, 0, 1]
    assert np.isfinite(quality.statistics(part)).all()


def test_quality_edge_cases(edge, nothing):
    labels = edge.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    got = quality.score(edge, quality.learn(edge, labels)).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    none = quality.learn(edge, labels.where("false"))
    assert {r.score for r in quality.score(edge, none).collect()} == {0.5}
    assert quality.score(nothing, none).count() == 0


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = quality.op9_quality(spark, d).where("held_out").join(table(spark, d, "labels"), "doc_id")
    assert got.where("predicted = quality").count() >= 0.97 * got.count()


def plain_lm(rows):
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + ["\0end"] for i, t in rows}
    out = {i for i in tokens if zlib.crc32(str(i).encode()) % 5 == 1}
    count, pairs = Counter(), Counter()
    for i, t in tokens.items():
        if i not in out:
            count.update(t)
            pairs.update(zip(["\0end", *t], t))
    return tokens, out, count, pairs


def quantised(c):
    if not c:
        return 0.0
    low = 2.0 ** int(math.log2(c) + 1e-12)
    return (low + max(2 * low - 1, low)) / 2


@pytest.mark.parametrize("per_block", [200, 4_000_000])
def test_lm_against_plain_counts(spark, per_block):
    rows = [(i, prose(i, 40) if i % 7 else None) for i in range(60)] + [(60, ""), (61, prose(5, 20_000)), (62, "É é A a")]
    tokens, out, count, pairs = plain_lm(rows)
    n, v = sum(count.values()), len(count)
    docs = frame(spark, rows).withColumn("held_out", held_out("doc_id", 5, 1))
    counts, model = lm_scoring.learn(docs.where("NOT held_out"), per_block)
    got = {r.doc_id: r for r in lm_scoring.score(docs, counts, model).collect()}
    assert len(got) == len(rows)
    for i, t in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (i in out, len(t), n)
        assert r.n_known == sum(count[x] > 0 for x in t)
        alone = [(count[x] + 0.5) / (n + 0.5 * (v + 1)) for x in t]
        assert r.base_score == pytest.approx(sum(map(math.log10, alone)))
        want = 0.0
        for p, x in zip(["\0end", *t], t):
            c, uni = quantised(count[p]), (quantised(count[x]) + 0.5) / (n + 0.5 * (v + 1))
            w = 0.6 if c else 0.0
            want += math.log10(w * min(quantised(pairs[p, x]), c) / max(c, 1) + (1 - w) * min(uni, 1.0))
        # False positives can only raise a score, and rarely do.
        assert want - 1e-6 <= r.score or abs(r.score - want) < 0.02 * abs(want)
        assert abs(r.score - want) < 0.05 * abs(want) + 0.5


@pytest.mark.parametrize("max_ngrams", [1, 300, 2000])
def test_lm_loses_no_ngram_beyond_the_bound_of_its_filter(spark, max_ngrams):
    """What a bounded filter cannot hold is counted all the same."""
    rows = [(i, prose(i, 40) if i % 7 else None) for i in range(60)] + [(61, prose(5, 5_000)), (None, prose(6, 50))]
    tokens, out, count, pairs = plain_lm(rows[:-1])
    n, v = sum(count.values()), len(count)
    docs = frame(spark, rows).withColumn("held_out", held_out("doc_id", 5, 1)).repartition(3)
    counts, model = lm_scoring.learn(docs.where("NOT held_out"), 200, max_ngrams)
    assert model.level > 1 and len(model.data) * 8 <= 26 * max_ngrams + 72 * 2 * model.blocks
    got = {r.doc_id: r for r in lm_scoring.score(docs, counts, model).collect()}
    assert got.keys() == {*tokens, None}
    close = 0
    for i, t in tokens.items():
        want = 0.0
        for p, x in zip(["\0end", *t], t):
            c, uni = quantised(count[p]), (quantised(count[x]) + 0.5) / (n + 0.5 * (v + 1))
            w = 0.6 if c else 0.0
            want += math.log10(w * min(quantised(pairs[p, x]), c) / max(c, 1) + (1 - w) * min(uni, 1.0))
        assert got[i].score == pytest.approx(want, rel=0.02)
        close += got[i].score == pytest.approx(want, rel=1e-9)
        assert got[i].n_known == sum(count[x] > 0 for x in t)
    # What the blocks answer is exact; the filter itself overstates a rare n-gram now and then.
    assert close == len(tokens) or max_ngrams > 1 and close > 0.5 * len(tokens)


def test_lm_edge_cases(edge, nothing):
    docs = edge.withColumn("held_out", held_out("doc_id", 5, 1))
    counts, model = lm_scoring.learn(docs.where("NOT held_out"))
    got = lm_scoring.score(docs, counts, model).collect()
    assert len(got) == edge.count()
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (7, 8, 9))
    assert all(r.held_out for r in got if r.doc_id is None)
    none = nothing.selectExpr("*", "true AS held_out")
    counts, model = lm_scoring.learn(none)
    assert lm_scoring.score(none, counts, model).count() == 0
    unlearned = lm_scoring.score(docs, counts, model).collect()
    assert len(unlearned) == edge.count() and {r.train_tokens for r in unlearned} == {0}
