import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus import frame, none, odd, words
from docstruct.llm import quality
from docstruct.llm.common import crc_mod


def plain(slots):
    """Values of slots, words first and then pairs, passage by passage."""
    n = (len(slots) + 1) // 2
    out = {}
    for at in range(0, n, quality.PASSAGE):
        for s in {*slots[at : min(n, at + quality.PASSAGE)], *slots[n + at : n + at + quality.PASSAGE]}:
            out[s] = out.get(s, 0) + quality.SCALE / len(slots)
    return out


def test_vectors():
    for n in (0, 1, 2, 63, 64, 65, 500):
        slots = quality.features(" ".join(words(n, n)), {})
        assert dict(zip(*(x.tolist() for x in quality.vector(slots)))) == pytest.approx(plain(slots.tolist()))


def test_ftrl_agrees_with_one_weight_at_a_time():
    r = np.random.default_rng(1)
    vocabulary = words(30, 3)
    examples = [(" ".join(r.choice(vocabulary, 12)), int(r.integers(2))) for _ in range(40)]
    z, n, memory = {}, {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= quality.L1:
            return 0.0
        return (np.sign(zi) * quality.L1 - zi) / ((quality.BETA + np.sqrt(n.get(i, 0.0))) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for text, label in examples:
            x = plain(quality.features(text, memory).tolist()) | {1 << quality.BITS: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                z[i] = z.get(i, 0.0) + g - (np.sqrt(n.get(i, 0.0) + g * g) - np.sqrt(n.get(i, 0.0))) / quality.ALPHA * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got = quality.fit(examples)
    assert np.allclose([got[i] for i in z], [weight(i) for i in z], atol=1e-4)


def test_features_are_sums_of_words_and_pairs(monkeypatch):
    assert len(quality.features("one two one", {})) == 3 + 2
    text = " ".join([*words(300, 2), "x" * 300 + "1" * 300, "y" * 255 + "-" + "z" * 5, *words(300, 3)] * 2)
    whole = quality.features(text, {}).tolist()
    for most in (0, 1, 7, 10_000):
        monkeypatch.setattr(quality, "MEMORY", most)
        memory = {}
        assert quality.features(text, memory).tolist() == quality.features(text, memory).tolist() == whole
        assert len(memory) <= most + 1
    assert len(quality.features(None, {})) == len(quality.features(" \n", {})) == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fold = crc_mod(F.col("doc_id"), 3)
    weights = quality.train(docs, labels.where(fold != 1))
    scored = quality.score(docs, weights).join(labels.where(fold == 1), "doc_id")
    right = scored.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("quality")).cast("double"))).first()[0]
    assert right >= 0.95


def test_odd_rows(spark):
    rows = odd(spark)
    labels = frame(spark, [(5, 1, 0), (7, 0, 0), (6, None, 0), (None, 1, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    weights = quality.train(rows, labels)
    out = quality.score(rows, weights)
    assert set(out.columns) == set(rows.columns) and out.count() == rows.count()
    scores = {r["doc_id"]: r["score"] for r in out.collect()}
    assert scores[1] == scores[2] == scores[3] and all(0 <= s <= 1 for s in scores.values())
    nothing = quality.train(none(spark), labels)
    assert {r["score"] for r in quality.score(rows, nothing).collect()} == {0.5}
    assert quality.score(none(spark), weights).count() == 0


def test_training_rows_are_bounded_by_number_not_by_length(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 40)
    long = [(i, " ".join(words(20_000, i, ["good", "fine", "well"])), None, None, None) for i in range(3)]
    short = [(100 + i, " ".join(words(30, i, ["spam", "junk", "trash"])), None, None, None) for i in range(300)]
    again = [(7, "spam junk trash", None, None, None)] * 2_000
    labels = frame(spark, [(i, 1, 0) for i in range(3)] + [(100 + i, 0, 0) for i in range(300)] + [(7, 0, 0)] * 2_000, "doc_id long, quality int, toxic int")
    weights = quality.train(frame(spark, long + short + again), labels)
    scores = {r["text"]: r["score"] for r in quality.score(frame(spark, [(1, "good fine well", None, None, None), (2, "spam junk", None, None, None)]), weights).collect()}
    assert scores["good fine well"] > 0.5 > scores["spam junk"]


def test_sampled_keeps_to_its_bounds(spark):
    from docstruct.llm.common import lot, sampled

    rows = [("a", i % 50, f"{i % 50} " + "x" * 1_000) for i in range(500)] + [("b", i, f"text {i}") for i in range(300)] + [("c", 1, "y" * 100_000)]
    df = spark.createDataFrame(rows, "_kind string, _key long, _text string").withColumn("_lot", lot(1, "_key", "_text"))
    found = sampled(df, {"a": 50, "b": 300, "c": 1}, 20, 30_000)
    assert {k: len(v) for k, v in found.items()} == {"a": 10, "b": 20, "c": 1}
    assert all(len(set(v)) == len(v) for v in found.values())
    assert found == sampled(df.repartition(7), {"a": 50, "b": 300, "c": 1}, 20, 30_000)
