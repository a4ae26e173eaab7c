"""The quality classifier on held-out texts, and its gradient and means against plain loops."""

import numpy as np
from pyspark.sql import functions as F

from storelens.llm import kernels, quality_classifier, toxicity


def corpus(spark):
    draw = np.random.default_rng(3)
    syllables = ["ka", "lo", "mi", "ten", "ra", "sul", "or", "en"]
    word = lambda: "".join(draw.choice(syllables, draw.integers(1, 4)))
    rows = []
    for i in range(900):
        words = [word() for _ in range(draw.integers(20, 60))]
        kind = draw.random()
        if kind < 0.15:
            words = [w + "###" for w in words]
        elif kind < 0.3:
            words = [words[0]] * len(words)
        rows.append((i, " ".join(words), int(kind >= 0.3)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def auc(rows, label):
    good = np.array([r.score for r in rows if r[label]])
    return np.mean([np.mean(good > r.score) + np.mean(good == r.score) / 2 for r in rows if not r[label]])


def test_held_out_texts(spark, messy, empty):
    docs = corpus(spark)
    labels = docs.select("doc_id", "quality").union(spark.createDataFrame([(None, 0), (3, None)], "doc_id long, quality int"))
    held_out = toxicity.id_fold(5) == 0
    model = quality_classifier.learn(docs.drop("quality"), labels, ~held_out)
    rows = quality_classifier.score(docs, model).join(labels.dropna(), "doc_id").where(held_out).collect()
    # words repeated are words never seen before: only the pair of a word with itself tells them
    assert auc(rows, "quality") > 0.97
    # labels of held-out rows change nothing
    turned = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality_classifier.learn(docs, turned, ~held_out).vectors, model.vectors)
    scored = quality_classifier.score(messy, model).collect()
    assert len(scored) == messy.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    assert len({r.score for r in scored if r.doc_id in (0, 1, 2)}) == 1
    assert quality_classifier.score(empty, model).count() == 0
    bare = quality_classifier.learn(empty, labels.limit(0), F.lit(True))
    assert all(0 < r.score < 1 for r in quality_classifier.score(messy, bare).collect())


def test_scores_are_the_softmax_of_the_mean(spark, messy):
    docs = corpus(spark)
    model = quality_classifier.learn(docs, docs.select("doc_id", "quality"), F.lit(True), rounds=2)
    bits = len(model.vectors).bit_length() - 1
    for r in quality_classifier.score(messy.where("doc_id is not null"), model).join(messy, "doc_id").where("doc_id != 7").collect():
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        owner, terms, times = quality_classifier.terms_of(kernels.Texts(raw, np.array([0, len(raw)])), bits)
        mean = sum((model.vectors[t].astype(float) * n for t, n in zip(terms, times)), np.zeros(8)) / max(times.sum(), 1e-9)
        z = np.exp([model.output[c] @ mean + model.bias[c] for c in (0, 1)])
        assert abs(z[1] / z.sum() - r.score) < 1e-5
        assert abs(model.probabilities(owner, terms, times, 1)[0, 1] - r.score) < 1e-5


def test_terms():
    def of(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        owner, terms, times = quality_classifier.terms_of(kernels.Texts(raw, np.array([0, len(raw)])), 30)
        assert (owner == 0).all()
        return dict(zip(terms.tolist(), times.tolist()))

    # words, the pair, and 4-grams of " word ", those of a word counting one; white space of any kind counts the same
    assert sorted(of("abc de").values()) == [0.5, 0.5, 1, 1, 1, 1]
    assert of("abc  de\n") == of("abc\tde") and of(" \n ") == {}
    again = set(of("aa aa")) & set(of("longer longer"))
    assert len(again) == 1


def test_labels_of_one_kind_give_the_rate():
    model = quality_classifier.fit(np.array([0, 1]), np.array([3, 3]), np.array([1, 1]), np.array([1.0, 1.0]), 4)
    assert model.probabilities(np.array([0]), np.array([3]), np.array([1]), 2)[:, 1].tolist() == [2.1 / 2.2] * 2
