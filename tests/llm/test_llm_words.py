"""Token counts against the library, hard negatives and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import hard_negatives, spelling, token_counts
from riskloom.llm.common import stored, table
from riskloom.llm.vectors import slices
from llm_cases import edge, frame, nothing, prose, sf  # noqa: F401  (fixtures)


# Token counts

PIECES = [
    "a", "b", "s", "t", "re", "ll", "'", " ", "  ", "\n", "\t", "1", "23", "!", "?", "é", "ß", "日", "本", " ", "　",
    "\U0001f600", "<|endoftext|>", "<|endof", "text|>", "'s", "'ll", "'re", "d", "́", "٣", "½", "x", "\x1c", "\x85",
    "​", "the", "ing", "aaaa", "----", "    ", "İ", "ß", "\x00",
]


@pytest.fixture(scope="module")
def counts_of_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def worker():
    return token_counts.compiled(token_counts.vocabulary_text())


def counted(worker, texts):
    return np.concatenate([worker.count(p) for p in slices(pa.array(texts, pa.string()))]).tolist()


def test_random_strings_have_the_counts_of_the_library(worker, counts_of_library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(0, 40))) for _ in range(5000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0, 0x3100)])) for _ in range(40)) for _ in range(3000)]
    texts += ["".join(rng.choices("eta oin", k=rng.randrange(0, 60))) for _ in range(3000)]
    assert counted(worker, texts) == counts_of_library(texts)


def test_long_pieces_and_a_table_that_starts_anew(worker, counts_of_library, monkeypatch):
    texts = ["x" * 70_000, "ab" * 30_000, "", " ", None, "\n" * 5000 + "a", " " * 50_000, "0123456789" * 2000, prose(1, 5000)]
    want = counts_of_library(texts)
    assert counted(worker, texts) == want
    small = token_counts.Counter(worker.counter.merges, held=40)
    monkeypatch.setattr(worker, "counter", small)
    assert counted(worker, texts) == want
    assert len(small.states) < 5000


def test_a_special_token_does_not_reach_over_two_rows(worker, counts_of_library):
    texts = ["a <|endof", "text|> b", "<|endoftext|>", "  <|endoftext|>  x", "'<|endoftext|>s"]
    assert counted(worker, texts) == counts_of_library(texts)


def test_stores_of_a_worker_go_with_another_operator(worker, monkeypatch):
    from riskloom.llm import common

    monkeypatch.setattr(common, "_held", {})
    again = token_counts.compiled(token_counts.vocabulary_text())
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some text"])], ["doc_id", "text"])
    list(common._call(token_counts._count, (token_counts.vocabulary_text(),), [batch]))
    assert token_counts.compiled(token_counts.vocabulary_text()) is again
    list(common._call(spelling._count, (0,), [batch]))
    assert not token_counts._compiled and not common._held


def test_scan_composes_state_maps():
    splitter, rng = token_counts.Splitter(), np.random.default_rng(1)
    symbols = rng.integers(0, 16, 1000).astype(np.uint8)
    state, want = token_counts.DONE, []
    for s in symbols.tolist():
        want.append(bool(splitter.cut[state, s]))
        state = splitter.next[state, s]
    assert splitter.cuts(symbols).tolist() == want
    maps = splitter.of_symbol[symbols]
    after = splitter.scan(maps)
    assert splitter.maps[after[-1], token_counts.DONE] == state


def test_token_count_edge_cases(edge, nothing, counts_of_library):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in token_counts.count_tokens(edge).collect()), key=repr)
    want = counts_of_library([t for _, t in rows])
    assert got == sorted(((i, len((t or "").encode()), n) for (i, t), n in zip(rows, want)), key=repr)
    assert token_counts.count_tokens(nothing).count() == 0


def test_documents_have_the_counts_of_the_library(spark, sf, counts_of_library):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in token_counts.op11_token_counts(spark, sf).collect()}
    want = dict(zip([i for i, _ in docs], counts_of_library([t for _, t in docs])))
    assert got == {i: (n, n > 1024) for i, n in want.items()}


# Hard negatives


def brute_negatives(rows, anchors, positives=5, negatives=5, percent=80):
    """rows: (vec_id, label, list of whole numbers)."""
    out = []
    for a, label, q in sorted({(i, x, tuple(v)) for i, x, v in anchors}):
        scores = [(sum(x * y for x, y in zip(q, v)), i, other) for i, other, v in rows if i != a]
        best = sorted((-s, i) for s, i, other in scores if other == label)[:positives]
        for s, p in best:
            fits = sorted((-n, i) for n, i, other in scores if other != label and -percent * s <= 100 * n <= -100 * s)
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(fits[:negatives])]
    return sorted(out)


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(spark, rows, every=7, **parts):
    df = spark.createDataFrame(rows, "vec_id long, label long, q array<long>").repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(df, df.where(F.col("vec_id") % every == 0), **parts).select(NAMES).collect())


def vectors(seed, n, size=12, spread=40, clusters=0):
    rng = np.random.default_rng(seed)
    if clusters:
        centres = rng.integers(-200, 200, (clusters, size))
        return (centres[rng.integers(0, clusters, n)] + rng.integers(-spread, spread, (n, size))).tolist()
    return rng.integers(-spread, spread, (n, size)).tolist()


@pytest.mark.parametrize("clusters", [0, 6])
def test_negatives_equal_brute_force(spark, monkeypatch, clusters):
    monkeypatch.setattr(hard_negatives, "PIECE", 100)
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    vecs = vectors(2, 500, clusters=clusters)
    # One vector holds a third of the rows, others come in ties.
    vecs[100:260] = [vecs[100]] * 160
    vecs[300:305] = [vecs[299]] * 5
    rows = [(i, (i * 7 + i // 50) % 3, v) for i, v in enumerate(vecs)]
    anchors = [r for r in rows if r[0] % 7 == 0]
    assert mined(spark, rows) == brute_negatives(rows, anchors)


def test_negatives_with_few_rows_and_large_numbers(spark):
    # One positive only; scores beyond 2**53; repeated rows of one id, and of an anchor.
    rows = [(0, 1, [1 << 29, 3]), (1, 1, [1 << 29, 5]), (2, 2, [(1 << 29) - 1, 7]), (3, 2, [1 << 28, 9]), (3, 2, [1 << 28, 9])]
    rows += [(14, 5, [1, 1]), (0, 1, [1 << 29, 3]), (21, 1, [0, 0])]
    anchors = [r for r in rows if r[0] % 7 == 0]
    assert mined(spark, rows) == brute_negatives(rows, anchors)


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [0.5, 0.25], 1), (1, [0.5, 0.125], 1), (2, [0.5, 0.2], 2), (3, None, 2), (4, [0.5, None], 2), (5, [0.5, nan], 2),
        (6, [inf, 0.5], 2), (7, [0.5, 0.5], None), (None, [0.5, 0.5], 2), (8, [0.5], 2), (9, [], 2), (10, [0.5, -0.001], 2),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS q", "'x' AS cell")
    used = hard_negatives.whole_numbers(df)
    assert sorted((r.vec_id, r.label, r.q) for r in used.collect()) == [
        (0, 1, [128, 64]), (1, 1, [128, 32]), (2, 2, [128, 51]), (10, 2, [128, -1]),
    ]
    got = sorted(tuple(r) for r in hard_negatives.mine(used, used.where("vec_id = 0")).select(NAMES).collect())
    assert got == [(0, 1, 1, 10, 128 * 128 + 64 * 32, 128 * 128 - 64)]
    empty = hard_negatives.whole_numbers(df.where("false"))
    assert hard_negatives.mine(empty, empty).count() == 0


def test_balls_bound_inner_products():
    points, queries = np.array(vectors(5, 400, clusters=4)), np.array(vectors(6, 20, spread=200))
    most = float((points * points).sum(axis=1).max())
    own = hard_negatives._augmented(points, most)
    tree, order = hard_negatives.cover_tree(own)
    assert sorted(order.tolist()) == list(range(400))
    low, high = hard_negatives._bounds(hard_negatives._augmented(queries, most, query=True), tree.centres, tree.radii, most)
    for node, (begin, end) in enumerate(zip(tree.begins.tolist(), tree.ends.tolist())):
        inner = queries @ points[order[begin:end]].T
        assert (inner.min(axis=1) >= low[:, node]).all() and (inner.max(axis=1) <= high[:, node]).all()
    leaves = tree.leaves.nonzero()[0]
    assert sum((tree.ends - tree.begins)[leaves]) == 400
    # Children are covered by what they keep, and balls shrink on the way down.
    inner = [n for n in range(1, len(tree.radii)) if tree.radii[n] > 0]
    assert inner and np.mean([tree.radii[n] < tree.radii[tree.parents[n]] for n in inner]) > 0.9


def test_descent_skips_balls_outside_of_windows(monkeypatch):
    points = np.array(vectors(7, 2000, clusters=40, spread=5))
    most = float((points * points).sum(axis=1).max())
    tree, order = hard_negatives.cover_tree(hard_negatives._augmented(points, most))
    piece = hard_negatives.Piece(tree, order, np.zeros(2000, np.int64), points[order], order)
    q = points[:10]
    seen, plain = [0], hard_negatives._scores

    def counting(a, b, most):
        seen[0] += len(a) * len(b)
        return plain(a, b, most)

    monkeypatch.setattr(hard_negatives, "_scores", counting)
    far = hard_negatives._FAR
    asked = hard_negatives.Asked(np.arange(10), np.zeros(10, np.int64), q, np.full((10, 1), -far), np.full((10, 1), far))
    score, row, found = hard_negatives.search(piece, asked, True, 3, most)
    assert found.all() and seen[0] < 10 * 2000 / 3
    for i in range(10):
        want = sorted((-int(q[i] @ points[j]), j) for j in range(2000) if j != i)[:3]
        assert sorted((-int(s), int(order[r])) for s, r in zip(score[i, 0], row[i, 0])) == want


# Spelling variants


def brute_variants(rows, misprints=97, length=5, count=3, factor=2):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None and misprints:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % misprints == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    own = {w: n for w, n in seen.items() if len(w) >= length and n >= count}
    near, open_place = defaultdict(set), defaultdict(set)
    for w in own:
        for i in range(len(w)):
            open_place[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in own:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in open_place.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in own.items():
        best = min(near[w], key=lambda x: (-own[x], x), default=None)
        form[w] = best if best and own[best] >= factor * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), own.get(form[w])) for w, n in own.items()}


def found_variants(df, misprints=97):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, misprints).collect()}


def test_variants_equal_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    want = brute_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sum(f is not None for f, *_ in want.values()) > 100
    assert found_variants(docs) == want


def test_variant_edge_cases(edge, nothing):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    assert found_variants(edge) == brute_variants(rows)
    assert found_variants(edge, 3) == brute_variants(rows, 3)
    assert found_variants(nothing) == {}


@pytest.mark.parametrize("pairs", [1, 10, 100_000])
def test_words_that_share_most_of_their_text(spark, monkeypatch, pairs):
    """Chunks that many words share are cut further; the pairs are the same."""
    rng = random.Random(4)
    own = {"prefix" * 3 + "".join(rng.choices("ab", k=rng.randrange(4, 9))) for _ in range(200)}
    own |= {"".join(rng.choices("abé", k=rng.randrange(5, 8))) for _ in range(200)} | {"x" * k for k in range(5, 80)}
    own |= {"Éx" + "".join(rng.choices("ÿz", k=4)) + "suffix" for _ in range(30)}
    plain, seen = spelling._halves, []
    monkeypatch.setattr(spelling, "_halves", lambda rows: seen.append(1) or plain(rows))
    df = spark.createDataFrame([(w,) for w in own], "word string").repartition(3)
    got = {(r.a, r.b) for r in spelling.near_pairs(df, pairs).collect()}
    assert all(len(a) <= len(b) for a, b in got)
    want = set()
    for w in own:
        for i in range(len(w)):
            for c in ["", *"abxz", "é", "ÿ", *set("prefixsuffixÉ")]:
                for other in (w[:i] + c + w[i + 1 :], w[:i] + c + w[i:], w + c):
                    if other in own and other != w:
                        want.add(frozenset((w, other)))
    assert {frozenset(p) for p in got} == want and len(got) == len(want)
    assert (len(seen) > 2) == (pairs < 100_000)


def test_chains_of_forms_end_at_their_root(spark):
    chain = [("abcdefghij"[: 5 + k] if k < 6 else "abcdefghij" + "k" * (k - 5), 3 * 2**k) for k in range(9)]
    formed = stored(spelling.forms(spark.createDataFrame(chain, "word string, n long")))
    ends = {r.word: r.root for r in spelling.roots(formed).collect()}
    assert ends == {w: chain[-1][0] for w, _ in chain[:-1]}
    assert {r.word: r.form for r in formed.collect()}[chain[0][0]] == chain[1][0]


def test_ties_for_a_form_go_to_the_smaller_word(spark):
    df = spark.createDataFrame([("aaaaa", 3), ("aaaab", 6), ("aaaac", 6), ("zzzzz", 5), ("zzzzzz", 9)], "word string, n long")
    got = {r.word: (r.form, r.n_near, r.form_n) for r in spelling.forms(df).collect()}
    assert got["aaaaa"] == ("aaaab", 2, 6) and got["aaaab"] == (None, 2, None) and got["zzzzz"] == (None, 1, None)
