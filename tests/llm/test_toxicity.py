import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bandscope.llm import toxicity, words as W


def brute_score(text, model):
    """The score from the text's own distinct slots, one text at a time."""
    dense = dict(zip(model.slots.tolist(), model.weights.tolist()))
    _, _, hashes, _ = W.words(W.column(pa.array([text or ""])))
    total = model.bias + sum(dense.get(s, 0.0) for s in toxicity.features(hashes, model.bits).tolist())
    return 1 / (1 + np.exp(-total))


def test_scores_are_those_of_each_text_alone(spark, prose):
    rng = np.random.default_rng(0)
    texts = [*prose[:30], None, "", "one", "one two", "w1 w2 w3 " * 500]
    slots = np.unique(np.concatenate([toxicity.features(W.words(W.column(pa.array([t or ""])))[2], 12) for t in texts]))[::2]
    model = toxicity.Model(slots, rng.standard_normal(len(slots)).astype(np.float32).astype(float) / 20, -0.5, 12)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for k, text in enumerate(texts):
        assert abs(got[k] - brute_score(text, model)) < 1e-5


def test_ftrl_follows_its_formula():
    """Against the per-coordinate update written out for one slot at a time."""
    how = toxicity.Ftrl(alpha=0.2, beta=1.0, l1=0.05, l2=0.3, epochs=3)
    rows, labels = [np.array([1, 3]), np.array([2, 3]), np.array([1])], np.array([1.0, 0.0, 1.0])
    w, bias = toxicity.fit(rows, labels, 2, how)
    z, n = [0.0] * 5, [0.0] * 5

    def weight(i):
        l1 = 0.0 if i == 4 else how.l1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((how.beta + n[i] ** 0.5) / how.alpha + how.l2)

    for _ in range(how.epochs):
        for slots, y in zip(rows, labels):
            at = [*slots.tolist(), 4]
            now = {i: weight(i) for i in at}
            g = (1 / (1 + np.exp(-sum(now.values()))) - y)
            for i in at:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / how.alpha
                z[i] += g - sigma * now[i]
                n[i] += g * g
    assert np.allclose(w, [weight(i) for i in range(4)]) and np.isclose(bias, weight(4))


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/../sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/../sf0.1/labels.parquet")
    scored = toxicity.toxicity(docs, labels).join(labels, "doc_id")
    held = scored.filter(toxicity.held_out_fold("doc_id") == 2)
    rows = held.select("score", "predicted", "toxic").collect()
    right = [r.score for r in rows if r.toxic == 1]
    wrong = [r.score for r in rows if r.toxic == 0]
    ranked = np.argsort(np.argsort(right + wrong))[: len(right)]
    auc = (ranked.mean() - (len(right) - 1) / 2) / len(wrong)
    caught = sum(r.predicted for r in rows if r.toxic == 1) / len(right)
    false = sum(r.predicted for r in rows if r.toxic == 0) / len(wrong)
    # About 3,000 labelled rows, 300 of them toxic.
    assert auc > 0.97 and caught > 0.8 and false < 0.01


def test_calibration_turns_margins_into_probabilities():
    rng = np.random.default_rng(1)
    margins = rng.standard_normal(20_000) * 2
    labels = (rng.random(20_000) < 1 / (1 + np.exp(-(1.7 * margins - 0.6)))).astype(float)
    assert np.allclose(toxicity.calibrate(margins, labels), (1.7, -0.6), atol=0.1)
    scale, shift = toxicity.calibrate(np.zeros(50), np.arange(50) % 5 == 0)
    assert abs(1 / (1 + np.exp(-shift)) - 0.2) < 0.03 and scale == 1
    assert np.isfinite(toxicity.calibrate(np.array([3.0]), np.array([1.0]))).all()


def test_the_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit(1).alias("label"))
    docs = docs.unionByName(docs.filter("doc_id < 300").withColumn("text", F.lit("z")))
    labels = spark.range(4000).selectExpr("id as doc_id", "cast(if(id % 10 = 0, 1, 0) as int) as toxic")
    odd = spark.createDataFrame([(None, 1), (7, None), (8, 5), (9, 1), (9, 0)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels.unionByName(odd), 500).collect()
    assert 400 < len(rows) < 600 and {r.text for r in rows} == {"a b"}
    ids = {r.doc_id for r in toxicity.sample(docs, labels.unionByName(odd), 10**6).collect()}
    assert ids == {i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r.doc_id: r.label for r in toxicity.sample(docs, labels.unionByName(odd), 10**6).collect()}[9] == 1


def test_empty_tables_nulls_and_columns(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "x", 0.1), (1, None, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    assert [r.score for r in got.collect()] == [0.5] * 3
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    kept = toxicity.drop_toxic(docs, labels, threshold=0.6)
    assert kept.columns == docs.columns and sorted(r.score for r in kept.collect()) == [0.1, 0.5, 0.5]
