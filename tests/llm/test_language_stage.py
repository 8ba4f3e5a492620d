"""The language stage: what stays when nothing or something could be learned."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tidemark.llm import common, language, near_copies, stages, tokens

SMALL = "/root/testdata/sf0.01"


def _with(spark, texts, unlabelled=False):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").limit(500)
    docs = docs.unionByName(spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(texts)], docs.schema))
    return docs.withColumn("lang", F.lit(None).cast("string")) if unlabelled else docs


def test_without_labels_every_text_with_a_letter_stays(spark):
    texts = ["a clean text", "ещё один", "12 !?", "", None]
    docs = _with(spark, texts, unlabelled=True)
    kept = P.language_id(spark, docs, SMALL)
    assert kept.where("doc_id < 0").count() == 2
    assert kept.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_unknown_scripts_and_random_letters_go_and_clean_short_texts_stay(spark):
    texts = ["Совершенно другой текст", "文字だけの行", "xqzvk wjxqp zzkqv qvxjw", "the", "and the", "der und die", "of the thing"]
    docs = _with(spark, texts)
    kept = P.language_id(spark, docs, SMALL)
    assert sorted(r.doc_id for r in kept.where("doc_id < 0").collect()) == [-7, -6, -5, -4]
    assert kept.where("doc_id >= 0").count() == docs.where((F.col("doc_id") >= 0) & F.col("text").rlike(r"\p{L}")).count()


def test_every_held_out_text_and_every_labelled_text_counts(spark):
    """The bound is the mean over all held-out texts, and a word of any labelled text is learned."""
    ids = spark.range(24_000).withColumn("held", language.held_out(F.col("id")))
    last = ids.where("held").agg(F.max("id")).first()[0]
    docs = ids.select(F.col("id").alias("doc_id"), F.when(F.col("id") == last, "zzqx").otherwise("the").alias("text"), F.lit("en").alias("lang"))
    model = language.train(language.labelled(docs))
    n = ids.where("held").count()
    assert stages.usual_known(docs, model) == pytest.approx((n - 1) / n, abs=1e-9)
    one = docs.where(~language.held_out(F.col("doc_id"))).withColumn("text", F.concat(F.lit("w"), F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij")))
    assert len(language.train(one).words) == one.count()


def test_a_worker_forgets_what_other_steps_left():
    tokens.encoder()
    assert set(common._remembered) == {"tokens"} and tokens.encoder() is tokens.encoder()
    near_copies.word_hashes(pa.array(["the cat sat"], pa.large_string()))
    assert set(common._remembered) == {"word powers"}
    common.remembered("language")["model"] = 1
    assert common._remembered == {"language": {"model": 1}} and common.remembered("language") == {"model": 1}


def test_texts_without_a_byte_may_be_a_workers_first():
    common._remembered.clear()
    hashes, offsets = near_copies.word_hashes(pa.array(["", ""], pa.large_string()))
    assert not len(hashes) and offsets.tolist() == [0, 0, 0]
