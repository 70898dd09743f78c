"""Language and toxicity predictions on held-out documents."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybook.llm import langid, queries, toxicity

PATH = "/root/testdata/sf0.1"


def test_language_accuracy(spark):
    rows = queries.op7_language_filters(spark, PATH).join(spark.read.parquet(f"{PATH}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = [r for r in rows.where("held_out and lang_pred <> 'und' and lang is not null").collect()]
    assert len(held) > 1500 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_language_of_awkward_rows(spark, awkward, nothing):
    filters = langid.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = langid.predict(awkward.select("doc_id", "text"), filters).collect()
    found = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == awkward.count()
    assert all(found[i] == ("und", 0.0) for i in (1, 2, 3, 10))
    assert found[11][0] in filters.languages
    assert langid.predict(nothing.select("doc_id", "text"), filters).count() == 0
    none = langid.fit(nothing)
    assert {r.lang_pred for r in langid.predict(awkward.select("doc_id", "text"), none).collect()} == {"und"}


def test_filters_return_every_language():
    grams = {f"l{n}": np.arange(n * 50, n * 50 + 100, dtype=np.int64) for n in range(70)}
    filters = langid.Filters.build(list(grams), grams)
    assert filters.planes.shape[0] == 2
    for n, name in enumerate(grams):
        for slots in langid._probes(grams[name].view(np.uint64)):
            assert (filters.planes[n // 64][slots] >> np.uint64(n % 64) & np.uint64(1)).all()


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    positive = label == 1
    return (rank[positive].mean() - (positive.sum() - 1) / 2) / (~positive).sum()


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{PATH}/labels.parquet").select("doc_id", "toxic")
    held = queries.op10_toxicity(spark, PATH).where("held_out").join(labels, "doc_id").collect()
    score, label = np.array([r.score for r in held]), np.array([r.toxic for r in held])
    predicted = np.array([r.predicted for r in held])
    assert auc(score, label) > 0.95
    assert ((score >= 0.3) == (predicted == 1)).all()
    assert (predicted[label == 0] == 0).mean() > 0.98 and (predicted[label == 1] == 1).mean() > 0.7


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    return toxicity.fit(docs.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id"))


def test_toxicity_of_awkward_rows(awkward, nothing, model):
    rows = toxicity.score(awkward.select("doc_id", "text"), model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    found = {r.doc_id: r.score for r in rows}
    assert found[1] == found[2] == found[3] == found[10]
    assert toxicity.score(nothing.select("doc_id", "text"), model).count() == 0


def test_one_label_only(awkward, nothing):
    for label, expected in ((0, 0.0), (1, 1.0)):
        model = toxicity.fit(awkward.select("doc_id", "text", F.lit(label).alias("toxic")))
        assert {round(r.score, 6) for r in toxicity.score(awkward.select("doc_id", "text"), model).collect()} == {expected}
    model = toxicity.fit(nothing.select("doc_id", "text", F.lit(1).alias("toxic")))
    assert {round(r.score, 6) for r in toxicity.score(awkward.select("doc_id", "text"), model).collect()} == {0.0}


def test_fit_on_ids_first_gives_the_same_model(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    twice = labels.unionByName(labels).unionByName(labels.limit(3).withColumn("toxic", F.lit(None).cast(labels.schema["toxic"].dataType)))
    other = toxicity.fit_documents(docs.withColumn("toxic", F.lit("clash")), twice)
    assert other.buckets.tolist() == model.buckets.tolist()
    assert np.allclose(other.weights, model.weights)
    assert other.intercept == pytest.approx(model.intercept)


def test_a_small_language_takes_nothing_and_stays(spark):
    """One mislabelled document neither empties the large language's filter nor drops out."""
    texts = [f"the weather in the north is cold and the wind blows over hill number {'abcdefghij'[i % 10]}" for i in range(300)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(900, "the the wind", "xx"), (901, "zqj vkw", "yy")]
    filters = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert filters.languages == ["en", "xx", "yy"]
    asked = spark.createDataFrame([(1, texts[0]), (2, "zqj vkw")], "doc_id bigint, text string")
    found = {r.doc_id: r.lang_pred for r in langid.predict(asked, filters).collect()}
    assert found == {1: "en", 2: "yy"}
    en = filters.votes(langid.Grams(pa.array(["the wind the wind"]), langid.WIDTH))[0, 0]
    assert en == pytest.approx(13, abs=0.5)


def test_known_texts(spark, awkward, nothing):
    """Clean texts stay, of many languages and of small ones; junk and unlearned languages go."""
    import random

    chance = random.Random(4)

    def language(seed):
        own = random.Random(seed)
        letters = "abcdefghijklmnopqrstuvwxyz"
        syllables = ["".join(own.choice(letters) for _ in range(own.choice([2, 3]))) for _ in range(40)]
        return lambda n: " ".join("".join(chance.choice(syllables) for _ in range(chance.choice([1, 2, 3]))) for _ in range(n))

    makers = {f"l{k:02}": language(k) for k in range(12)}
    rows = [(100 * k + i, make(60), name) for k, (name, make) in enumerate(makers.items()) for i in range(3 if k == 0 else 40)]
    for learned in (sorted(makers), ["l00", "l01"]):
        filters = langid.fit(spark.createDataFrame([r for r in rows if r[2] in learned], "doc_id bigint, text string, lang string"))
        asked = [(1000 + i, makers[name](n), name) for i in range(20) for name in learned for n in (8, 200)]
        junk = [(-1 - i, "".join(chance.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)), "en") for i, n in enumerate([30, 300, 3000] * 8)]
        junk += [(-100 - i, t, "en") for i, t in enumerate([None, "", "1234 !!", "日本語のテキスト" * 20])]
        junk += [(-200 - i, language(99)(200), "en") for i in range(5)]
        found = langid.known_texts(spark.createDataFrame(asked + junk, "doc_id bigint, text string, lang string"), filters)
        assert sorted(r.text for r in found.collect()) == sorted(t for _, t, _ in asked)
    assert langid.known_texts(nothing, filters).count() == 0
    assert langid.known_texts(awkward, langid.fit(nothing)).count() == 0
    assert langid.known_texts(awkward, filters).columns == awkward.columns
