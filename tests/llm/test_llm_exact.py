"""Exact dedup and chat formatting against plain Python."""

import hashlib
from collections import defaultdict

from llm_cases import edge, frame, nothing, prose, sf  # noqa: F401  (fixtures)

from riskloom.llm import chat, exact_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_deduplicate_edge_cases(edge):
    want = defaultdict(list)
    for r in edge.select("doc_id", "text").collect():
        want[sha((r.text or "").translate(LOW))].append(r.doc_id)
    got = exact_dedup.deduplicate(edge).collect()
    assert len(got) == edge.count()
    for r in got:
        group = want[r.digest.hex()]
        ids = [i for i in group if i is not None]
        assert r.group_size == len(group)
        assert r.keep_id == (max(ids) if ids else None)
        assert r.kept == (r.doc_id == r.keep_id)


def test_index_takes_only_new_digests(spark, edge):
    index = exact_dedup.temporary_index(spark, 10)
    rows = edge.select("doc_id", exact_dedup.text_digest("text").alias("digest"))
    index.append(rows.where("doc_id < 5"))
    first = index.frame().count()
    index.append(rows.where("doc_id < 5"))
    assert index.frame().count() == first == 2
    assert index.new_rows(rows.where("doc_id < 7")).count() == 2
    plan = index.new_rows(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    index.drop()


def test_kept_documents(edge):
    kept = exact_dedup.kept_documents(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 1 not in ids and 2 not in ids and ids.count(3) == 2 and 7 not in ids and 8 in ids and 9 in ids


def test_id_shared_by_two_texts(spark):
    docs = frame(spark, [(1, "first text"), (1, "second text"), (2, "FIRST text")])
    assert sorted(r.text for r in exact_dedup.kept_documents(docs).collect()) == ["FIRST text", "second text"]


def test_empty(nothing):
    assert exact_dedup.deduplicate(nothing).count() == 0
    assert exact_dedup.kept_documents(nothing).count() == 0


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' AS segments", "'x' AS formatted"
    )


NASTY = ["", "<next>", "</turn>\n", "\\", "\\\\l<", "\\l", "<turn user>\n", "a<b>c\\g\\", "é\U0001f600", "\n", None]


def test_chat_round_trip(spark):
    rows = [(1, i, ("user", "assistant", "user", None)[i % 4], t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (2, None, "user", "first"), (2, 1, "a>\nb<", "c")]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (None, 0, "assistant", "no id")]
    got = {r.conv_id: r for r in chat.format_conversations(turns(spark, rows)).select(
        "conv_id", "formatted", chat.read_back(chat.F.col("formatted")).alias("turns"),
        chat.learned_text(chat.F.col("segments")).alias("learned"), "segments").collect()}
    for conv in (1, 2, 3, None):
        own = [(-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv]
        own = [(r, x) for _, r, x in sorted(own)]
        assert [(t.role, t.text) for t in got[conv].turns] == own
        assert got[conv].learned == "".join(x for r, x in own if r == "assistant")
        assert "".join(s.text for s in got[conv].segments) == got[conv].formatted
    assert got[3].formatted == "<turn user>\nsame<next>same</turn>\n"


def test_chat_empty(spark):
    assert chat.format_conversations(turns(spark, [])).count() == 0


def test_chat_uses_no_python(spark, sf):
    plan = chat.op4_chat_formatting(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
