import json

import numpy as np
import pytest

import corpus_pipeline as cp
from corpus import frame, none, odd
from docstruct.llm import decontaminate, langid, quality, simhash
from docstruct.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(materialize(stage(spark, out[-1], SF)))
    return out


def ids(df):
    return [r["doc_id"] for r in df.select("doc_id").collect()]


def test_stages(steps):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup", "benchmark decontamination", "mixing to target weights"]
    for before, after in zip(steps, steps[1:]):
        assert set(ids(after)) <= set(ids(before))
        assert after.columns[: len(before.columns)] == before.columns or after is steps[-1]
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def test_against_brute_force(spark, steps):
    """Every decision once more, without Spark."""
    rows = sorted(steps[0].collect(), key=lambda r: r["doc_id"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    weights = quality.train(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))

    def good(text):
        at, values = quality.vector(quality.features(text, {}))
        return weights[at].astype(float) @ values + weights[-1] >= 0

    kept = [r for r in rows if good(r["text"])]
    assert sorted(ids(steps[1])) == [r["doc_id"] for r in kept]
    assert all(labels[r["doc_id"]] for r in kept if r["doc_id"] in labels)
    model = langid.train(steps[1])
    bits = model.lengths([r["text"].encode() for r in kept])
    kept = [r for r, b in zip(kept, bits) if b.min() / len(r["text"].encode()) <= cp.LANGUAGE_BITS and 1 / np.exp2(np.maximum(b.min() - b, -1000)).sum() >= cp.LANGUAGE_SCORE]
    assert sorted(ids(steps[2])) == [r["doc_id"] for r in kept]
    prints = [np.frombuffer(simhash.wide(r["text"]), np.uint64) for r in kept]
    root = list(range(len(kept)))
    for i in range(len(kept)):
        for j in range(i):
            if int(np.bitwise_count(prints[i] ^ prints[j]).sum()) <= simhash.WIDE_RADIUS:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    kept = [r for i, r in enumerate(kept) if root[i] == i]
    assert sorted(ids(steps[3])) == [r["doc_id"] for r in kept]
    items = [decontaminate.words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def holds(text):
        w = b" " + b" ".join(decontaminate.words(text)) + b" "
        return any(b" " + b" ".join(i) + b" " in w for i in items)

    kept = [r for r in kept if not holds(r["text"])]
    assert sorted(ids(steps[4])) == [r["doc_id"] for r in kept]
    total = {}
    for r in steps[5].collect():
        total.setdefault(r["source"], [r["source_target"], 0])[1] += r["taken"]
        assert 0 < r["taken"] <= 3 * r["n_words"]
    assert all(abs(t - got) <= 3 for t, got in total.values())


def test_run_agrees_with_its_stages(spark, steps):
    assert sorted(map(str, cp.run(spark, SF).collect())) == sorted(map(str, steps[-1].collect()))


def test_odd_rows_and_empty_tables(spark, tmp_path):
    frame(spark, [(5, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, [(1, "nothing of this kind is in any of the documents here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd(spark)
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.collect()
        assert stage(spark, none(spark), str(tmp_path)).count() == 0
    out = cp.STAGES[-1][1](spark, docs, str(tmp_path))
    assert len(set(out.columns)) == len(out.columns) and set(docs.columns) <= set(out.columns)
    assert out.where("taken > 3 * n_words").count() == 0
    assert cp.STAGES[-1][1](spark, none(spark), str(tmp_path)).count() == 0


def test_without_languages_or_labels_all_stay(spark, tmp_path):
    frame(spark, [], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(spark, [(i, f"some text of number {i}", None, "s", 1) for i in range(5)])
    assert cp.quality_stage(spark, docs, str(tmp_path)).count() == cp.language_stage(spark, docs, str(tmp_path)).count() == 5


def test_queries_are_registered():
    import __spark_entry__ as e

    names = list(e.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11)) and "pipeline" in names
    assert json.dumps(sorted(e.oracle_sql()))
