from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus import frame, none, odd, words
from docstruct.llm import langid
from docstruct.llm.common import crc_mod


def brute(samples, lang, text):
    """Code length by walking the context trees byte by byte."""
    counts, total = {}, {}
    for name, texts in samples.items():
        joined = b"\n" * langid.ORDER + (b"\n" * langid.ORDER).join(texts)
        for i in range(langid.ORDER, len(joined)):
            for k in range(langid.ORDER + 1):
                c = joined[i - k : i]
                total[c] = total.get(c, 0) + 1
                counts.setdefault((name, c), {}).setdefault(joined[i], 0)
                counts[name, c][joined[i]] += 1

    def kept(c):
        return len(c) < 2 or total.get(c, 0) >= langid.LEAST

    def distribution(c):
        if len(c) == 0:
            below = np.full(256, 1 / 256)
        else:
            below = distribution(c[1:])
        own = counts.get((lang, c))
        if not own or (len(c) and not kept(c)):
            return below
        n, d = sum(own.values()), len(own)
        rest = below.copy()
        rest[list(own)] = 0
        left = rest.sum()
        out = rest * (d / (n + d) / left) if left > 1e-12 else rest * 0
        for b, x in own.items():
            out[b] = x / (n + d if left > 1e-12 else n)
        return out

    data = b"\n" * langid.ORDER + text
    return sum(-log2(distribution(data[i - langid.ORDER : i])[data[i]]) for i in range(langid.ORDER, len(data)))


def test_code_lengths_are_exact():
    samples = {"x": [b"abracadabra abra", b"cab a cab"], "y": [b"mississippi miss", b"sip a sip of mist"]}
    model = langid.Model(samples)
    for text in (b"abra cab", b"miss sip", b"zzz \xff\xfe abra", b"a", b"mist of abracadabra"):
        got = model.lengths([text])[0]
        for i, lang in enumerate(model.langs):
            assert got[i] == pytest.approx(brute(samples, lang, text), rel=1e-5)


def test_blocks_do_not_matter(monkeypatch):
    model = langid.Model({"x": [b"abracadabra abra"], "y": [b"mississippi"]})
    texts = [b"abra" * 30, b"", b"miss" * 77, b"q"]
    whole = model.lengths(texts)
    monkeypatch.setattr(langid, "BLOCK", 50)
    assert np.allclose(model.lengths(texts), whole)
    assert not whole[1].any()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = crc_mod(F.col("doc_id"), 5)
    found = langid.predict(docs, langid.train(docs.where(fold != 0))).where(fold == 0)
    right, n = found.agg(F.avg((F.col("lang") == F.col("_lang.lang_pred")).cast("double")), F.count("*")).first()
    assert n > 100 and right >= 0.98


def test_odd_rows(spark):
    rows = odd(spark)
    model = langid.train(frame(spark, [(i, " ".join(words(80, i // 2)), "de" if i % 2 else "en", "s", 1) for i in range(20)]))
    out = {(r["doc_id"], r["text"]): r["_lang"] for r in langid.predict(rows, model).collect()}
    assert out[1, None]["lang_pred"] == out[2, ""]["lang_pred"] == langid.UNKNOWN
    assert [v["score"] for k, v in out.items() if k[0] == 6] == [0.0]
    assert all(0 <= v["score"] <= 1 for v in out.values())
    assert langid.predict(none(spark), langid.train(none(spark))).count() == 0
    assert {r["_lang"]["lang_pred"] for r in langid.predict(rows, langid.Model({})).collect()} == {langid.UNKNOWN}


@pytest.mark.parametrize("samples", [{"de": ["der hund und die katze"]}, {"x": ["abc def ghi"], "y": ["abc def ghi"]}, {"x": ["a"], "y": ["b"]}, {"x": [""]}])
def test_little_to_learn_from(spark, samples):
    rows = [(i, t, lang, None, None) for lang, texts in samples.items() for i, t in enumerate(texts)]
    model = langid.train(frame(spark, rows))
    assert model.langs == sorted(samples)
    coded = {k: [t.encode() for t in v] for k, v in samples.items()}
    for text in (b"abc", b"der hund", b"zz"):
        assert np.allclose(model.lengths([text])[0], [brute(coded, lang, text) for lang in model.langs], rtol=1e-4)


def test_a_language_of_long_texts_and_a_repeated_key(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 10)
    en, de = words(300, 1), words(300, 2)
    rows = [(i, " ".join(words(40_000, i, en)), "en", None, None) for i in range(2)] + [(9, " ".join(words(50, 7, de)), "de", None, None)] * 3_000
    model = langid.train(frame(spark, rows))
    assert model.langs == ["de", "en"]
    found = langid.predict(frame(spark, [(1, " ".join(words(30, 8, en)), None, None, None), (2, " ".join(words(50, 7, de)[:30]), None, None, None)]), model)
    assert {r["doc_id"]: r["_lang"]["lang_pred"] for r in found.collect()} == {1: "en", 2: "de"}


def test_many_languages_fit_by_dropping_rare_contexts(monkeypatch):
    samples = {f"l{i:02}": [" ".join(words(200, 50 + i)).encode()] for i in range(30)}
    whole = langid.Model(samples)
    monkeypatch.setattr(langid, "CELLS", whole.table.size // 4)
    less = langid.Model(samples)
    assert less.table.size <= whole.table.size // 3 and max(less.least) > langid.LEAST
    texts = [" ".join(words(100, 200 + i, words(200, 50 + i))).encode() for i in range(30)]
    assert (less.lengths(texts).argmin(1) == np.arange(30)).all()
    found = less.lengths(texts)
    monkeypatch.setattr(langid, "BLOCK", 400)
    assert np.allclose(less.lengths(texts), found)
