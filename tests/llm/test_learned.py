"""Language and quality: accuracy on held-out rows, and the cases the docstrings define."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from pricewright.llm import language, quality
from pricewright.llm.common import held_out
from pricewright.llm.queries import op3_language, op5_quality

FOLDER = "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark):
    found = op3_language(spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    out = found.join(truth, "doc_id").where("held_out AND lang IS NOT NULL")
    assert out.where("lang = lang_pred").count() >= 0.95 * out.count() > 0
    assert found.count() == truth.count()
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_language_edges(spark):
    texts = ["the cat and the dog", "der Hund und die Katze"] * 30
    rows = [(n, t, "en" if n % 2 == 0 else "de", "c") for n, t in enumerate(texts)] + [(99, "the dog", None, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, found string")
    model = language.fit(df, "doc_id", "text", "lang")
    assert model.languages == ["de", "en"]
    asked = [None, "", "123 !?", "́", "x", "the " * 40000, "\x00a", "北京"]
    out = spark.createDataFrame([(t,) for t in asked], "t string").select(language.predict(F.col("t"), model).alias("p")).collect()
    assert [r.p.lang for r in out[:4]] == ["und"] * 4 and all(r.p.score == 0 for r in out[:4])
    assert out[5].p.lang == "en" and all(r.p.lang in model.languages for r in out[4:])
    assert language.fit(df.where("lang IS NULL"), "doc_id", "text", "lang") is None
    nothing = spark.createDataFrame([("x",)], "t string").select(language.predict(F.col("t"), None).alias("p"))
    assert nothing.first().p.lang == "und"
    assert df.limit(0).select(language.predict(F.col("text"), model)).count() == 0


def test_windows_cover_every_byte():
    for size in (0, 1, 255, 256, 257, 1000):
        data = bytes(random.Random(size).randrange(256) for _ in range(size))
        made = language.windows_of(data)[:, : language.WINDOW].ravel()
        assert bytes(made[made != language.PAD].astype(np.uint8)) == data


def test_convolution_by_tables_equals_the_plain_one():
    model = language.train(["abc def " * 9, "xyz uvw " * 9] * 8, ["a", "x"] * 8, epochs=1, least_steps=1)
    windows = language.windows_of("some bytes of a window that is long enough ".encode() * 9)
    spans = windows.shape[1] - len(model.steps) + 1
    plain = np.full((len(windows), model.steps.shape[2]), -np.inf)
    for n, w in enumerate(windows):
        for t in range(spans):
            plain[n] = np.maximum(plain[n], sum(model.steps[j][w[t + j]] for j in range(len(model.steps))))
    assert np.allclose(model.pooled(windows), np.maximum(plain + model.bias, 0), atol=1e-4)


def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1.0
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_on_held_out_rows(spark):
    found = op5_quality(spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = found.join(labels, "doc_id").where("held_out").toPandas()
    assert auc(out.score.to_numpy(), out.quality.to_numpy()) > 0.9
    assert found.where("score < 0 OR score > 1 OR score IS NULL OR predicted != cast(score >= 0.3 AS int)").count() == 0


def test_word_vectors_equal_a_plain_sum(spark):
    texts = ["a b c a", "", None, "c c d e f g", "a " * 300]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    slots, index = quality._Slots(), quality.index_vectors()
    plain = np.zeros((quality.SLOTS + 1, quality.DIMENSIONS))
    for t in texts:
        ids = [slots[w] for w in (t or "").encode().split()]
        for n, s in enumerate(ids):
            for m in range(max(0, n - quality.REACH), min(len(ids), n + quality.REACH + 1)):
                if m != n:
                    plain[s] += index[ids[m]]
    used = plain.any(axis=1)
    plain[used] /= np.linalg.norm(plain[used], axis=1, keepdims=True)
    plain[used] -= plain[used].mean(axis=0)
    plain[used] /= np.linalg.norm(plain[used], axis=1, keepdims=True)
    assert np.allclose(quality.word_vectors(df, "text"), plain, atol=1e-5)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "a b", 0), (2, None, 0), (3, "", 0), (3, "", 0)], "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (7, 0)], "doc_id bigint, quality int")
    vectors = quality.word_vectors(docs, "text")
    assert quality.fit(docs, labels.limit(0), vectors, "doc_id", "text", "quality") == 0.5
    assert quality.fit(docs, labels, vectors, "doc_id", "text", "quality") == 1.0
    assert quality.word_vectors(docs.limit(0), "text").shape == (quality.SLOTS + 1, quality.DIMENSIONS)
    network = quality.train(np.random.default_rng(0).normal(size=(40, 48)), np.arange(40) % 2, epochs=2)
    scored = docs.select(quality.score(F.col("text"), vectors, network).alias("s")).collect()
    assert len(scored) == 4 and all(0 <= r.s <= 1 for r in scored)


def test_held_out_rule(spark):
    from zlib import crc32

    df = spark.range(200).select("id", held_out(F.col("id")).alias("h"))
    assert all(r.h == (crc32(str(r.id).encode()) % 5 == 0) for r in df.collect())
    assert spark.sql("SELECT cast(NULL AS bigint) AS d").select(held_out(F.col("d"))).first()[0] is False
