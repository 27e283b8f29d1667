"""Decontamination, Jaccard join, license scan, BPE and the pipeline against brute force."""

import hashlib
import random
import re

import pytest

import corpus_pipeline
from riskloom.llm import bpe, decontaminate, jaccard_join, licenses
from riskloom.llm.common import stored, table
from llm_cases import edge, frame, nothing, prose, sf  # noqa: F401  (fixtures)


def sets_of(rows):
    """Shingle sets; a text of one to four words is one shingle."""
    out = []
    for i, t in rows:
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate(decontaminate._LOWER))
        out.append((i, frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else frozenset()))
    return out


def brute_groups(rows, threshold=0.8):
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            p, q = sets[x][1], sets[y][1]
            if p and q and len(p & q) >= threshold * len(p | q) - 1e-9:
                parent[root(x)] = root(y)
    members = {}
    for x, (i, _) in enumerate(sets):
        members.setdefault(root(x), []).append(i)
    return sorted((i, min((m for m in members[root(x)] if m is not None), default=None)) for x, (i, s) in enumerate(sets)
                  if i is not None and s)


def test_join_edge_cases(edge, nothing):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    got = jaccard_join.join(edge).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.class_id) for r in got if r.doc_id not in (None, 7, 8, 9)) == brute_groups(rows)
    assert all(r.n_links == 0 and r.class_id == r.doc_id for r in got if r.doc_id in (7, 8, 9))
    assert jaccard_join.join(nothing).count() == 0


def test_join_large_group_of_near_copies(spark, monkeypatch):
    """A node above the leaf size is split round its leaders; links on the border of a dense group are met in chunks."""
    rng, rows = random.Random(3), []
    for group in range(3):
        words = prose(group, 150).split()
        for _ in range(120):
            own = list(words)
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                own[rng.randrange(len(own))] = f"w{rng.random()}"
            rows.append((len(rows), " ".join(own)))
    rows += [(1000 + i, f"{prose(0, 40)} {prose(500 + i, 120)}") for i in range(80)]  # a shared passage, but no copies
    got = {r.doc_id: r for r in jaccard_join.join(frame(spark, rows)).collect()}
    sets = dict(sets_of(rows))
    links = [(x, y) for x in sets for y in range(x) if y in sets and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])]
    lost = [p for p in links if got[p[0]].class_id != got[p[1]].class_id]
    # Sets whose only partner stands out from a hundred others by less than the sketches can tell may be lost.
    assert len(lost) <= 0.001 * len(links)
    want = dict(brute_groups(rows))
    assert all(want[i] == want[r.class_id] for i, r in got.items())
    assert all(r.n_links == 0 for i, r in got.items() if i >= 1000)
    linked = {x for p in links for x in p if p not in lost}
    assert all(got[i].n_links > 0 for i in linked)
    kept = sorted(r.doc_id for r in jaccard_join.one_of_each(frame(spark, rows)).collect())
    assert kept == sorted({r.class_id for r in got.values()})


def brute_contained(docs, items, threshold=0.8):
    """Every item row is an item; one of fewer than five words is one shingle."""
    out = []
    for item, text in items:
        width = min(len(decontaminate.found_words(text or "")), 5)
        own = set(decontaminate.word_shingles(text or "", width)) if width else set()
        for d, t in docs:
            shared = len(own & set(decontaminate.word_shingles(t or "", width or 5)))
            if own and shared >= threshold * len(own) - 1e-9:
                out.append((d, item, shared, len(own)))
    return sorted(out, key=repr)


def test_containment_search(spark, edge, nothing):
    rng = random.Random(5)
    items = [(i, prose(2000 + i, rng.choice((3, 5, 6, 9, 20, 33, 60)))) for i in range(60)]
    items += [(61, None), (62, ""), (5, "a second text of item five " * 2), (None, prose(2900, 12)), (63, items[7][1])]
    docs = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    for k, (i, t) in enumerate(items[:60]):
        words = t.split()
        if k % 3 == 0:  # whole, inside a long text
            docs.append((5000 + k, f"{prose(k, 400)} {t.upper()}, {prose(k + 1, 300)}"))
        elif k % 3 == 1:  # some words lost, above and below the threshold
            lost = rng.randrange(len(words))
            docs.append((5000 + k, f"{prose(k, 400)} {' '.join(words[:lost] + words[lost + 1 :])}"))
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id")
    for size in (7, 50_000):
        got = decontaminate.search(frame(spark, docs), bench, items_per_block=size).collect()
        assert sorted(((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got), key=repr) == brute_contained(docs, items)
    assert decontaminate.search(nothing, bench).count() == 0
    assert decontaminate.search(edge, bench.where("false")).count() == 0
    assert decontaminate.short_items(bench).where("item_id IN (61, 62)").count() == 2
    clean = decontaminate.clean_documents(frame(spark, docs), bench)
    found = brute_contained(docs, items)
    hit = {d for d, *_ in found}
    assert {i for _, i, _, n in found if n == 1} >= {i for i, t in items[:60] if len(t.split()) < 5 and i % 3 == 0}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {d for d, _ in docs if d not in hit}


def brute_detections(text):
    low = text.translate(decontaminate._LOWER)
    found = []
    for i, r in enumerate(licenses.rules()):
        found += [(i, r.label, r.priority, m.start(), m.end()) for m in re.finditer(r.expression, low, re.ASCII)]
    keep = []
    for d in found:
        beaten = any(
            e[3] <= d[3] and e[4] >= d[4]
            and (e[2], e[4] - e[3], -e[0]) > (d[2], d[4] - d[3], -d[0])
            for e in found
        )
        if not beaten:
            keep.append(d)
    return sorted(keep)


LICENSE_TEXTS = [
    "Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3. General  public-license",
    "CC BY-NC 4.0 and cc by 3.0, see https://creativecommons.org/licenses/by-sa/4.0/",
    "Released under the MIT License. All rights reserved. ALL-RIGHTS\nreserved",
    "Copyright (c) 2020 X. Permission is hereby granted, free of charge, to any person. MPL-2.0 mozilla public license 2.0",
    "the Unlicense; BSD 3-Clause License; http://opensource.org/licenses/bsd-3-clause; ISC License",
    "gpl lgpl agpl cc0 public domain", "mit der Zeit", "cc\x00by", "accc bye", "écc by", "", "general public",
]


def test_license_scan(spark, edge, nothing):
    rows = list(enumerate(LICENSE_TEXTS)) + [(50, None), (51, " ".join(LICENSE_TEXTS) * 20), (3, LICENSE_TEXTS[3])]
    got = licenses.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t in rows:
        low = (t or "").translate(decontaminate._LOWER)
        words = re.findall(licenses.WORD, low)
        places = sorted((w, n) for n, p in licenses.PHRASES.items() for w in range(len(words)) if tuple(words[w : w + len(p)]) == p)
        assert by_id[i].n_words == len(words)
        assert [(x.word, x.label) for x in by_id[i].phrases] == places
        if i != 51:
            assert sorted((d.rule, d.label, d.priority, d.start, d.end) for d in by_id[i].detections) == brute_detections(t or "")
    assert licenses.scan(edge).count() == edge.count() and licenses.scan(nothing).count() == 0
    assert len(licenses.rules()) > 200
    plan = licenses.scan(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_rule_needs_a_stem():
    """The first gate must not hide a rule: each rule's own keyword or expression brings a stem along."""
    for text in LICENSE_TEXTS:
        if brute_detections(text):
            assert any(s in text.lower() for s in licenses.STEMS), text


ALPHABET = "ab  \n\t\x1c\x1f\x85\xa0  ́İΣσÉe'stvre-!?9١½<|startoftext|>\U0001f600\x00ẛ̣가ᄀ᠎﻿​"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


def test_bpe_equals_the_library(spark, edge, nothing, library):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 300)))) for i in range(400)]
    rows += [(500, "<|startoftext|> a<|endoftext|>b"), (501, "é" * 3000), (502, ("ab" * 40 + " ") * 300), (503, None)]
    docs = frame(spark, rows).unionByName(edge)
    got = bpe.encode_documents(docs).collect()
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    assert len(got) == docs.count()
    for r in got:
        want = [library.encode(t, add_special_tokens=False).ids for t in texts[r.doc_id]]
        assert r.ids in want
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert bpe.encode_documents(nothing).count() == 0


def test_bpe_stores_are_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "WORDS_HELD", 50)
    monkeypatch.setattr(bpe, "CHUNKS_HELD", 3)
    worker = bpe.Encoder(open(bpe.vocabulary_path(), encoding="utf-8").read())
    text = prose(1, 3000)
    data = text.encode()
    ids, decoded = worker.encode(data, [*range(97, len(data), 97), len(data)])
    want = library.encode(text, add_special_tokens=False).ids
    import numpy as np

    assert np.frombuffer(ids, "<i4").tolist() == want and decoded == library.decode(want, skip_special_tokens=False)
    assert len(worker.words.young) <= 51 and len(worker.chunks.young) <= 3


def test_equal_passages_give_equal_chunks():
    import pyarrow as pa

    from riskloom.llm.vectors import slices

    passage = prose(7, 2000)
    parts = [next(slices(pa.array([lead + passage]))) for lead in ("", "something else before ", "é" * 77)]
    ends = [{len(p.data) - int(c) for c in bpe.cuts(p)} for p in parts]
    assert len(ends[0]) > 5 and all(len(ends[0] - e) <= 1 for e in ends[1:])


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    kept = docs
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stored(stage(spark, kept, sf))
        assert kept.columns == columns, name
        assert kept.join(before, "doc_id", "left_anti").count() == 0
    rows = {r.doc_id: r.text for r in kept.collect()}
    lowered = [(t or "").translate(decontaminate._LOWER) for t in rows.values()]
    assert len(set(lowered)) == len(lowered)
    groups = brute_groups(list(rows.items()))
    assert all(i == c for i, c in groups)
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    assert not brute_contained(list(rows.items()), items)
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert out.keys() == rows.keys()
    for i, r in out.items():
        assert hashlib.sha256(r.ids.encode()).hexdigest() == r.ids_sha256 and r.n_tokens == len(r.ids.split())


def test_names_of_stages():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[0].startswith("toxicity") and names[-1].startswith("BPE")


def brute_links(rows, threshold=0.8):
    """Linked pairs of (id, text) by comparing all sets."""
    sets = [(i, s) for i, s in sets_of(rows) if s]
    return [
        (i, j) for x, (i, p) in enumerate(sets) for j, q in sets[:x] if len(p & q) >= threshold * len(p | q) - 1e-9
    ]


def edited(seed, n, length=150, edits=(0, 1, 1, 2, 3)):
    """Texts of a group of edited copies; the first is the one they were copied from."""
    rng, words = random.Random(seed), prose(seed, length).split()
    out = [" ".join(words)]
    for k in range(1, n):
        own = list(words)
        for _ in range(rng.choice(edits)):
            own[rng.randrange(len(own))] = f"w{seed}x{k}x{rng.random()}"
        out.append(" ".join(own))
    return out


def test_join_counts_all_links(spark):
    """Three near copies in one leaf, a dense group, equal copies: n_links is the number of links, not a bound."""
    rows = list(enumerate(edited(900, 3, edits=(1,)) + edited(901, 150) + edited(902, 40, 60)))
    rows += [(500, rows[0][1]), (501, prose(903, 80))]
    got = {r.doc_id: r.n_links for r in jaccard_join.join(frame(spark, rows)).collect()}
    want = dict.fromkeys(got, 0)
    sets = {}
    for i, s in sets_of(rows):
        sets.setdefault(s, []).append(i)
    for i, j in brute_links([(ids[0], dict(rows)[ids[0]]) for ids in sets.values()]):
        want[i] += 1
        want[j] += 1
    for ids in sets.values():
        for i in ids[::-1]:
            want[i] = want[ids[0]] + len(ids) - 1
    assert want[1] == 3 - 1 and max(want.values()) > 100
    assert got == want


def test_links_of_large_groups_are_counted_in_blocks(spark):
    """A group above the size of a block is dealt into pairs of blocks; tiles and columns have edges, too."""
    rows = list(enumerate(edited(905, 90, edits=(2, 8)) + [prose(906, 40)]))
    hashed = jaccard_join.in_arrow(
        frame(spark, rows, False).selectExpr("*", "CAST(NULL AS string) AS nameless"), jaccard_join._sketch, jaccard_join._SKETCH
    )
    sets = jaccard_join.stored(hashed.selectExpr("doc_id AS id", "shingles").dropDuplicates(["id"]))
    groups = spark.createDataFrame([(i, 0) for i in range(1, 90)], "id long, group long")
    want = dict.fromkeys(range(90), 0)
    for i, j in brute_links(rows[:90]):
        want[i] += 1
        want[j] += 1
    for size in (1 << 30, 15_000, 3_000):
        got = jaccard_join.degrees(sets, groups, block_bytes=size).collect()
        assert {r.id: r.linked for r in got} == want


def test_join_loses_no_link_that_the_paths_miss(spark, monkeypatch):
    """Without any proposal of the paths, and with some of them, groups and links are those of brute force."""
    rows = list(enumerate(edited(910, 60, edits=(2, 5)) + edited(911, 3, 9, edits=(0, 1)) + ["two words", "TWO words!"]))
    rows += [(200 + i, f"{prose(912, 60)} {prose(913 + i, 60)}") for i in range(30)]  # half a text shared, not linked
    rows += [(300 + i, " ".join(prose(950, 100).split()[: 100 - i])) for i in range(0, 40, 4)]  # chains of sizes
    want = brute_groups(rows)
    links = {frozenset(p) for p in brute_links(rows)}
    real = jaccard_join.candidates
    some = lambda sets, *_: real(sets).where("pmod(a, 7) = 1 AND pmod(b, 3) = 1")
    none = lambda sets, *_: sets.selectExpr("id AS a", "id AS b").where("false")
    for proposals in (none, some):
        monkeypatch.setattr(jaccard_join, "candidates", proposals)
        got = jaccard_join.join(frame(spark, rows)).collect()
        assert sorted((r.doc_id, r.class_id) for r in got) == want
        assert all((r.n_links > 0) == any(r.doc_id in p for p in links) for r in got)


def test_long_runs_of_a_shingle_are_compared_in_tiles(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rows = np.zeros(53, jaccard_join._TOKENS)
    rows["token"], rows["size"], rows["id"] = np.repeat([7, 8, 9], [40, 3, 10]), 10, np.arange(53)
    rows["group"] = np.where(np.arange(53) < 43, np.arange(53) // 2, 99)  # the last shingle is of one group only
    want = {(i, j) for j in range(43) for i in range(j) if (i < 40) == (j < 40) and i // 2 != j // 2}
    for tile in (3, 7, 1000):
        monkeypatch.setattr(jaccard_join, "RUN_TILE", tile)
        mixed = jaccard_join._mixed(pa.table({"rows": pa.array([rows[:30].tobytes(), rows[30:].tobytes()], pa.binary())}))
        pairs = [p for b in jaccard_join._possible(mixed.to_batches(), 0.8) for p in zip(*(c.to_pylist() for c in b.columns))]
        assert set(pairs) == want


def sample(expression, gap, optional=True):
    """A text that the expression matches, with all or no optional parts and ``gap`` wherever it allows white space."""

    def one(parts):
        out = ""
        for kind, value in parts:
            kind = str(kind)
            if kind in ("LITERAL", "NOT_LITERAL"):
                out += chr(value) if kind == "LITERAL" else "x"
            elif kind == "IN":
                first = str(value[0][0]), value[0][1]
                out += {"CATEGORY_SPACE": gap, "CATEGORY_NOT_SPACE": "x", "CATEGORY_DIGIT": "1"}[str(first[1])] if first[0] == "CATEGORY" else chr(value[0][1])
            elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
                out += one(value[2]) if optional or value[0] else ""
            elif kind == "SUBPATTERN":
                out += one(value[3])
            elif kind == "BRANCH":
                out += one(value[1][0])
        return out

    return one(re._parser.parse(expression))


def test_names_wrapped_at_a_line_end_are_found(spark):
    """Every rule, with line ends and several blanks between the words of its names, against all rules by brute force."""
    rules = licenses.rules()
    gaps = [(" ", False), (" ", True), ("\n", True), ("  ", True), ("\r\n\t", False)]
    texts = [(i, gap, f"x: {sample(r.expression, gap, o)} ;") for i, r in enumerate(rules) for gap, o in gaps]
    assert all(re.search(rules[i].expression, t, re.ASCII) for i, _, t in texts)
    headers = ["under the MIT\nLicense", "GNU General\nPublic License, version 3", "creative  commons\tlicense", "is in the public\n domain"]
    rows = list(enumerate([t for _, _, t in texts] + headers + [" ".join(headers)]))
    got = {r.doc_id: r.detections for r in licenses.scan(frame(spark, rows)).collect()}
    for i, t in rows:
        assert sorted((d.rule, d.label, d.priority, d.start, d.end) for d in got[i]) == brute_detections(t), t
    assert {d.label for d in got[len(texts)]} == {"mit"} and "gpl-3.0" in {d.label for d in got[len(texts) + 1]}


def without_ids(df):
    return sorted(r.text or "" for r in df.where("doc_id IS NULL").select("text").collect())


def test_rows_without_id_are_filtered_in_every_stage(spark):
    """Copies, near copies, leaks and toxic texts go although their id is NULL; one row of each group stays."""
    from riskloom.llm import exact_dedup, toxicity

    near, only, item = edited(960, 4, edits=(1,)), edited(961, 3, edits=(1,)), prose(962, 30)
    rows = [(1, near[0]), (None, near[0].upper()), (None, near[1]), (2, near[2]), *[(None, t) for t in only], (None, only[0])]
    rows += [(None, None), (None, ""), (None, "..."), (None, f"{prose(963, 50)} {item} {prose(964, 50)}"), (None, "Some text"), (None, "sOME text")]
    docs = frame(spark, rows)
    copies = exact_dedup.kept_documents(docs)
    assert copies.columns == docs.columns
    assert without_ids(copies) == sorted([near[1], *only, "", "...", rows[-3][1], min("Some text", "sOME text")])
    one = jaccard_join.one_of_each(docs)
    assert one.columns == docs.columns
    left = without_ids(one)
    assert len(left) == 6 and not set(left) & {t for _, t in rows[1:4]} and len(set(left) & set(only)) == 1
    assert [r.doc_id for r in one.where("doc_id IS NOT NULL").collect()] == [1]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert without_ids(decontaminate.clean_documents(docs, bench)) == sorted((t or "") for i, t in rows if i is None and item not in (t or ""))
    bad = "vile awful slur hateful scum"
    labelled = [(100 + i, f"{prose(970 + i, 30)} {bad * (i % 2)} {prose(990 + i, 9)}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in labelled], "doc_id long, toxic int")
    texts = [(None, f"{prose(1100 + i, 30)} {bad * (i % 2)}") for i in range(6)]
    kept = toxicity.clean_documents(frame(spark, labelled + texts), labels)
    assert without_ids(kept) == sorted(t for _, t in texts[::2])


def test_recall_does_not_depend_on_runs_or_depth(spark, monkeypatch):
    """One run of a deep recursion, at two sizes: groups are those of brute force."""
    monkeypatch.setattr(jaccard_join, "runs_for", lambda *_: 1)
    monkeypatch.setattr(jaccard_join, "LEAF", 2)
    for pairs in (10, 60):
        texts = [f"{prose(1200, 60)} {t}" for k in range(pairs) for t in edited(1300 + k, 2, 60, edits=(1, 2))]
        rows = list(enumerate(texts))
        got = jaccard_join.join(frame(spark, rows)).collect()
        assert sorted((r.doc_id, r.class_id) for r in got) == brute_groups(rows)


def test_sets_with_nothing_in_common_do_not_meet():
    """The rows that share a node grow with the similar sets and not with the square of all."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for n in (2000, 10_000):
        mins = np.stack([jaccard_join.min_hashes(np.sort(rng.integers(0, 2**64, 60, np.uint64))) for _ in range(n)])
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n)), pa.array([m.astype("<u4").tobytes() for m in mins], pa.binary())], ["id", "mins"]
        )
        (paths,) = jaccard_join._first_level([batch], 1, 0.8)
        assert len(np.unique(paths.column("node").to_numpy())) == paths.num_rows >= n


def test_sets_of_a_large_node_leave_by_their_best_smaller_partner():
    import numpy as np
    import pyarrow as pa

    mins = np.arange(4 * jaccard_join.COORDINATES, dtype=np.uint32).reshape(4, -1)
    mins[2, :120] = mins[0, :120]  # agrees with 0 on 120 of 128
    mins[3, :110] = mins[0, :110]
    members = [[{"id": 9 - i, "mins": m.astype("<u4").tobytes()} for i, m in enumerate(mins)]]
    kind = pa.list_(pa.struct([("id", pa.int64()), ("mins", pa.binary())]))
    batch = pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), pa.array(members, kind)], ["node", "members"])
    (got,) = jaccard_join._next_level([batch], 0.8, 1)
    rows = got.to_pylist()
    # 9 and 7 have the smaller partners 7 and 6; 8 and 6 have none and go on.
    assert {(r["id"], r["a"]) for r in rows if r["kind"] == jaccard_join.LINK} == {(9, 7), (7, 6)}
    assert {r["id"] for r in rows if r["kind"] == jaccard_join.PATH} == {8, 6}


def test_recall_is_measured_by_what_runs_join():
    """Deep nodes alone do not ask for further runs, a run that joins as much as the one before it does."""
    assert jaccard_join.recall_reached([990, 10], 20, 0.8) < 0.99  # one comparison is not enough
    assert jaccard_join.recall_reached([900, 90, 10], 20, 0.8) > 0.99
    assert jaccard_join.recall_reached([300, 310, 10], 20, 0.8) < 0.99
    assert jaccard_join.recall_reached([300, 100, 0], 20, 0.8) == 1.0
    assert jaccard_join.recall_reached([0], 20, 0.8) == 1.0


def test_a_leaf_proposes_no_square_of_its_sets():
    import numpy as np

    ids = np.arange(100, 164)
    sketches = np.tile(np.arange(jaccard_join.COORDINATES, dtype=np.uint32), (64, 1))
    sketches[np.arange(64), np.arange(64)] = 1000 + np.arange(64)  # all agree on 126 of 128
    pairs = jaccard_join._leaf_links(ids, sketches)
    assert len(pairs) <= jaccard_join.BEST * len(ids)
    assert {b for _, b in pairs} == set(ids[1:].tolist()) and all(a < b for a, b in pairs)


def test_a_worker_frees_the_stores_of_other_operators(monkeypatch):
    from riskloom.llm import common

    freed = []
    monkeypatch.setattr(common, "_held", {"a": lambda: freed.append("a")})
    monkeypatch.setattr(common, "_last", ["a"])
    common._turn_to("a")
    assert not freed
    common._turn_to("b")
    assert freed == ["a"] and not common._held and common._last == ["b"]


def test_the_size_of_the_store_of_words_changes_no_result():
    from riskloom.llm.bpe import Encoder, vocabulary_path

    vocabulary = open(vocabulary_path(), encoding="utf-8").read()
    small, usual = Encoder(vocabulary, 10), Encoder(vocabulary)
    for k in range(20):
        data = prose(1400 + k, 80).encode()
        assert small.encode(data, [len(data)]) == usual.encode(data, [len(data)])
    assert len(small.words.young) <= 10 and len(small.words.old) <= 10
    assert usual.words.size == bpe.WORDS_HELD
