"""Quality, language and toxicity: held-out accuracy and odd rows."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.llm import language_id, quality, toxicity
from adjudica.llm.common import whole_texts
from adjudica.llm.queries import llm_queries

FOLDER = "/root/testdata/sf0.01"


def ranked(rows):
    """Share of (1, 0) pairs that the score puts in order."""
    ones, zeros = (np.array([r.score for r in rows if r.label == k]) for k in (1, 0))
    return ((ones[:, None] > zeros).mean() + (ones[:, None] == zeros).mean() / 2) if len(ones) and len(zeros) else 1.0


@pytest.mark.parametrize("name, label, least, share", [("op5_quality", "quality", 0.85, 0.9), ("op10_toxicity", "toxic", 0.75, 0.9)])
def test_held_out(spark, name, label, least, share):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col(label).alias("label")).where("label is not null")
    scored = llm_queries()[name](spark, FOLDER)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and scored.count() == 1000
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert ranked(rows) >= least and np.mean([r.predicted == r.label for r in rows]) >= share
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = llm_queries()["op8_language_id"](spark, FOLDER).join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.97


def odd(spark):
    rows = [(1, "a fine text"), (2, None), (3, ""), (4, "12 !! 34"), (None, "text"), (1, "a fine text"), (5, "very long " * 200_000), (6, "\u0000 ")]
    return spark.createDataFrame([(i, t, "x", 0.5) for i, t in rows], "doc_id long, text string, label string, score double")


def learning(spark):
    random.seed(9)
    words = {1: ["the", "house", "river", "walks", "morning"], 0: ["XX!!", "##", "BUY", "$$$", "NOW!!"]}
    rows = [(i, " ".join(random.choices(words[i % 2], k=60)), i % 2) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "z") for i, t, _ in rows] + [(500, None, "z")], "doc_id long, text string, label string")
    labels = [(i, q, 1 - q, "z") for i, _, q in rows] + [(500, 1, 1, "z"), (501, 1, 1, "z"), (3, None, None, "z"), (3, 1, 0, "z")]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_odd_rows(spark, kind):
    score = quality.quality_scores if kind is quality else toxicity.toxicity_scores
    docs, labels = learning(spark)
    rows = odd(spark)
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        found = score(rows, kind.train(docs, known)).collect()
        assert len(found) == 8 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
        assert len({r.score for r in found if r.doc_id in (2, 3)}) == 1 and len({r.score for r in found if r.doc_id == 1}) == 1
    model = kind.train(docs, labels)
    assert score(rows.limit(0), model).count() == 0
    own = score(docs, model).join(labels.select("doc_id", F.col("quality" if kind is quality else "toxic").alias("label")), "doc_id")
    assert ranked(own.where("label is not null and doc_id < 500").collect()) > 0.99
    if kind is quality:
        good = quality.good_rows(docs.withColumn("_text", F.lit(1)), model)
        assert good.columns == ["doc_id", "text", "label", "_text"]
        assert {r.doc_id for r in good.collect()} >= set(range(1, 120, 2)) - {3}


def test_odd_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = odd(spark)
    model = language_id.train(docs)
    found = {r.doc_id: r for r in language_id.languages(rows, model).collect()}
    assert [found[i].lang_pred for i in (2, 3, 4, 6)] == ["und"] * 4 and found[2].score == 0 and found[None].lang_pred != "und"
    assert found[5].lang_pred in {"de", "en", "es", "fr"} and 0 <= found[5].score <= 1
    for nothing in (docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        assert {r.lang_pred for r in language_id.languages(rows, language_id.train(nothing)).collect()} == {"und"}
    only = language_id.train(docs.where("lang = 'fr'"))
    assert {r.lang_pred for r in language_id.languages(rows, only).collect()} == {"und", "fr"}
    kept = language_id.rows_in(rows, model)
    assert kept.columns == rows.columns and {r.doc_id for r in kept.collect()} == {1, 5, None}
    others = ["qzx kkj wwq zzv", "สวัสดีครับ วันนี้อากาศดีมาก", "Это русский текст о погоде", "日本語の文章です " * 40]
    others = spark.createDataFrame(list(enumerate(others)), "doc_id long, text string")
    assert language_id.rows_in(others, model).count() == 0 and language_id.rows_in(others, model, least=0.0).count() == 4
    assert language_id.rows_in(docs, model).count() == docs.where("text rlike '[a-zA-Z]'").count()
    assert language_id.languages(rows.limit(0), model).count() == 0


@pytest.mark.parametrize("kind, name", [(quality, "quality"), (toxicity, "toxic"), (language_id, "lang")])
def test_telling_words_after_a_long_start(spark, kind, name):
    random.seed(4)
    same = " ".join(random.choices("lorem ipsum dolor sit amet consetetur".split(), k=3500))
    telling = {1: "gentle meadow harvest lantern willow", 0: "rotten grubby vulgar nasty filthy"}
    rows = [(i, same + " " + " ".join(random.choices(telling[i % 2].split(), k=900)), str(i % 2)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(t) for _, t, _ in rows) > 25_000 and len(same) > 20_000
    if kind is language_id:
        found = language_id.languages(docs, language_id.train(docs)).join(docs, "doc_id").collect()
        assert all(r.lang == r.lang_pred for r in found)
        return
    labels = docs.select("doc_id", F.col("lang").cast("int").alias(name))
    model = kind.train(docs, labels)
    found = (quality.quality_scores if kind is quality else toxicity.toxicity_scores)(docs, model)
    assert ranked(found.join(labels.withColumnRenamed(name, "label"), "doc_id").collect()) > 0.99


def test_sample_takes_whole_texts_within_a_budget(spark):
    docs = spark.createDataFrame([(1, "a" * 10), (2, "b" * 30), (3, "c" * 50), (3, "c" * 50), (4, "d" * 60)], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (9, 1)], "doc_id long, label int")
    assert sorted(len(r.text) for r in whole_texts(docs, chosen, "label", 100).collect()) == [10, 30, 60]
    assert sorted(len(r.text) for r in whole_texts(docs, chosen, "label", 140).collect()) == [10, 30, 50, 50, 60]
    assert whole_texts(docs, chosen, "label", 59).collect() and whole_texts(docs.limit(0), chosen, "label", 59).count() == 0


def test_densest_stretch():
    clean = " ".join(["fine"] * 6000)
    values = dict(zip(toxicity.NAMES, toxicity.dense(clean + " dolt" * 40, toxicity.Flags(toxicity.Lexicon(frozenset({"dolt"}), frozenset())))))
    assert values["lexicon"] == 40 / 6040 and values["lexicon_max"] >= 0.3 and values["stems_max"] == 0.0


def test_isotonic_curve(spark):
    x = spark.createDataFrame([(v,) for v in (-1.0, 0.1, 0.15, 0.2, 0.5, 0.8, 2.0)], "raw double")
    found = [r[0] for r in x.select(toxicity._calibrated("raw", [0.1, 0.2, 0.2, 0.8], [0.0, 0.4, 0.4, 1.0])).collect()]
    assert np.allclose(found, [0.0, 0.0, 0.2, 0.4, 0.7, 1.0, 1.0])


def test_features():
    lexicon = toxicity.Flags(toxicity.Lexicon(frozenset({"dolt"}), frozenset({"vequ"})))
    values = dict(zip(toxicity.NAMES, toxicity.dense("You IDIOT, 1d10t! dolt vequre. Fine", lexicon)))
    assert values["lexicon"] == 3 / 6 and values["seeds"] == 2 / 6 and values["disguised"] == 1 / 6 and values["stems"] == 1 / 6
    assert values["you"] == 1 / 6 and values["near_you"] > 0 and values["shouted"] == 1 / 6
    assert toxicity.dense(None, lexicon) == toxicity.dense("", lexicon) == [0.0] * len(toxicity.NAMES)


def test_training_rows_take_their_memory_once():
    found = [f"some words of text {n} " * 5 for n in range(300)]
    expected = np.hstack([np.stack([language_id.features(t) for t in found]), np.ones((300, 1), np.float32)])
    tracemalloc.start()
    made = language_id.training_rows(found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (made == expected).all() and made.dtype == expected.dtype
    assert peak < 1.2 * made.nbytes


def test_training_rows_are_kept_without_their_zeros():
    rng = np.random.default_rng(5)
    found = ["".join(rng.choice(list("abcdefghij klmno"), 400)) for _ in range(900)]
    whole, y = language_id.training_rows(found), np.where(np.arange(900) % 2, 1.0, -1.0)
    tracemalloc.start()
    made = language_id.Rows(found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 0.5 * whole.nbytes
    assert all((row == kept).all() and row.dtype == kept.dtype for row, kept in zip(whole, made, strict=True))
    for a, b in zip(language_id.fit_svm(whole, y), language_id.fit_svm(made, y)):
        assert np.array_equal(a, b)
