"""The stages in a row, each held against its own input."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.common import write_once
from strata.llm.near_dedup import near_duplicates
from strata.llm.queries import QUERIES
from strata.session import shared_root
from tests.llm.brute import components, shingles
from tests.llm.test_dedup import _cut

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    import __spark_entry__

    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = write_once(stage(spark, docs, SF), f"test-{name}")
        before = {r.doc_id: r for r in docs.collect()}
        rows = out.collect()
        if k < 4:
            assert out.columns == columns
            assert all(r.n_chars == len(r.text or "") for r in rows if name == "line_dedup")
        if name == "line_dedup":
            cut = _cut({i: r.text for i, r in before.items()})
            for r in rows:
                lines = (before[r.doc_id].text or "").split("\n")
                assert (r.text or "") == "\n".join(x for i, x in enumerate(lines) if i not in cut[r.doc_id])
        if name == "near_dedup":
            root = components({i: shingles(r.text) for i, r in before.items()})
            assert {r.doc_id for r in rows} == {i for i in before if root[i] == i}
        if name == "packing":
            assert {r.doc_id for r in rows} == set(before)
        docs = out
    assert near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).count() >= 200


def _odd_documents(spark, words):
    text = " ".join(words[:30])
    rows = [
        (1, text, "en", "a", 10),
        (1, text, "en", "a", 10),
        (2, None, None, None, None),
        (None, "a line alone\nand another one", "de", "b", 3),
        (3, "", "en", "a", 0),
        (4, "word " * 30_000, "en", "b", 1),
        (5, "one more line of this text\nand another one", "fr", None, 2),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ("size", "target", "taken", "copies", "positions", "n_lines", "dropped_lines", "component_id", "score", "place")
    return docs.withColumns({c: F.lit("mine") for c in extra}), extra


def test_stages_on_odd_documents(spark, words):
    """Nulls, repeated rows, a long text, columns named as the operators' own, no rows."""
    docs, extra = _odd_documents(spark, words)
    for empty in (False, True):
        now = write_once(docs.limit(0) if empty else docs, "odd")
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = write_once(stage(spark, now, SF), f"odd-{name}")
            if k < 4:
                assert out.columns == docs.columns, name
                rows = out.collect()
                assert all(r[c] == "mine" for r in rows for c in extra), name
                assert {r.doc_id for r in rows} <= {1, 2, 3, 4, 5, None}
            assert (out.count() == 0) == empty, name
            now = out


def test_run_keeps_no_stage_but_the_last(spark):
    import os

    before = shared_files(spark)
    rows = corpus_pipeline.run(spark, SF)
    left = {os.path.dirname(f) for f in shared_files(spark) - before}
    assert len(left) == 1 and "stage-packing" in left.pop()
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def shared_files(spark) -> set[str]:
    import glob

    root = shared_root(spark).removeprefix("file://")
    return set(glob.glob(f"{root}/**/part-*.parquet", recursive=True))


def test_sequences_follow_the_order_of_the_documents(make_docs, words):
    from strata.llm.packing import pack

    docs = make_docs({k: " ".join(words[k % 500 : k % 500 + 90]) for k in range(400)}).repartition(7)
    for order, turn in (((), 1), ((-F.col("doc_id"),), -1)):
        rows = pack(docs, window=256, pieces_per_shard=100, order=order).collect()
        shard = {r.doc_id: r.sequence_id >> 32 for r in rows if r.start == 0}
        assert [shard[k] for k in sorted(shard)][::turn] == sorted(shard.values()) and len(set(shard.values())) > 3
        firsts: dict = {}
        for r in sorted(rows, key=lambda r: (turn * r.doc_id, r.start)):
            firsts.setdefault(r.sequence_id, len(firsts))
        assert [firsts[s] for s in sorted(firsts)] == sorted(firsts.values())
