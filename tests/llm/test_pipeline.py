"""The pipeline's stages against plain Python, and the registered queries' shapes."""

from __future__ import annotations

import os

import corpus_pipeline as P
from tests.llm import brute
from tidemark.llm import queries
from tidemark.llm.common import stored
from tidemark.llm.tokens import encoder
from tidemark.session import shared_path

SMALL = "/root/testdata/sf0.001"


def test_stages_on_awkward_documents(spark):
    rows = brute.awkward(4)
    rows = [(*r[:2], "en" if r[0] % 2 else "de", *r[3:]) for r in rows] + [(None, "a text without an id is kept", "en", "s1", 1, 1, 2, 3, 4, 5, 6, 7)]
    docs = spark.createDataFrame(rows, brute.DOCS)
    stages = dict(P.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "source_mixing", "best_fit_packing"]

    lines = stored(stages["line_dedup"](spark, docs, SMALL), "test")
    assert lines.columns == docs.columns and lines.count() == len(rows)
    want = brute.deduped_lines([r for r in rows if r[0] is not None])
    for r in lines.where("doc_id is not null").collect():
        assert r.text == want[r.doc_id][2] and r.n_chars == (None if r.text is None else len(r.text))

    near = stored(stages["near_dedup"](spark, lines, SMALL), "test")
    kept = [(r.doc_id, r.text) for r in lines.collect() if r.doc_id is not None]
    assert near.columns == docs.columns
    assert sorted(r.doc_id for r in near.where("doc_id is not null").collect()) == sorted(i for i, _, c, k in brute.near_copies(kept, 5) if k)
    assert near.where("doc_id is null").count() == 1

    mixed = stages["source_mixing"](spark, near, SMALL)
    assert mixed.columns == docs.columns
    plan = brute.mixed([tuple(r) for r in near.collect()])
    taken: dict = {}
    for r in mixed.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(brute.WORD.findall(r.text))
    assert taken == {i: t for i, *_, t in plan if t}


CLASHES = ("n_lines", "n_removed", "kept_row", "kept_id", "kept", "mix_size", "mix_id", "of", "taken", "size", "c0", "number", "known", "text_hash")


def test_stages_leave_columns_of_any_name_alone(spark):
    texts = ["the first line of a text\nthe second line of it", "another text that is quite different from it", "the first line of a text\nand more of it"]
    rows = [(i, t, "en", "s1", len(t), *[100 * i + k for k in range(len(CLASHES))]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in CLASHES))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        found = out.collect()
        assert {r.doc_id for r in found} == {0, 1, 2}, name
        assert all(tuple(r)[5:] == rows[r.doc_id][5:] for r in found), name


def test_near_dedup_keeps_every_text_of_an_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (1, b), (1, b), (2, a), (3, None), (3, None), (4, "")]
    docs = spark.createDataFrame([(*r, None, None, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = P.near_dedup(spark, docs, SMALL).collect()
    own = sorted((r.doc_id, r.text or "") for r in found if r.doc_id != 2)
    assert own == sorted([(1, a), (1, b), (3, ""), (4, "")])


def test_stages_on_no_rows(spark):
    docs = spark.createDataFrame([], brute.DOCS)
    for name, stage in P.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0
        assert name == P.STAGES[-1][0] or out.columns == docs.columns


def test_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    judged = P.language_id(spark, docs, SMALL)
    assert judged.columns == docs.columns
    lettered = [r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert sorted(r.doc_id for r in judged.collect()) == sorted(lettered)
    out = P.run(spark, SMALL)
    rows = out.collect()
    assert {r.doc_id for r in rows} <= set(lettered)
    fill: dict[int, int] = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096 and encoder().model is not None


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_stages_leave_little_behind_and_move_texts_once(spark):
    docs = stored(spark.createDataFrame(brute.awkward(5), brute.DOCS), "test")
    left = lambda: {f.rsplit("-", 1)[0] for f in os.listdir(shared_path(spark, "tidemark-llm").removeprefix("file:")) if f not in before}
    for name, kept in (("line_dedup", {"gone"}), ("near_dedup", {"ids-of-several-texts", "kept"}), ("source_mixing", {"mix-plan"})):
        before: set = set()
        before = set(os.listdir(shared_path(spark, "tidemark-llm").removeprefix("file:")))
        out = dict(P.STAGES)[name](spark, docs, SMALL)
        assert left() == kept, name
        out.collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = dict(P.STAGES)["source_mixing"](spark, docs, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2, plan  # the texts and the plan of the mix
