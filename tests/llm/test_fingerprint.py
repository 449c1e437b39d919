import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpus import frame, none, odd, words
from docstruct.llm import fingerprint


def canonical(text):
    def composed(x):
        return unicodedata.normalize("NFKC", x)

    return " ".join(composed(composed(text or "").casefold()).split())


TEXTS = ["Straße", "STRASSE", " strasse\n", "ﬁne", "fine", "é", "é", "É", "a  b", "A B", "a b ", "", None, "\t", "Ⅷ", "viii", "other"]


def test_equal_exactly_if_canonical_texts_are(spark):
    got = fingerprint.fingerprints(frame(spark, [(i, t, None, None, None) for i, t in enumerate(TEXTS)])).collect()
    by = {r["doc_id"]: r["fingerprint"] for r in got}
    for i, a in enumerate(TEXTS):
        for j, b in enumerate(TEXTS):
            assert (by[i] == by[j]) == (canonical(a) == canonical(b)), (a, b)


def test_collisions_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "digest", lambda canon: F.substring(F.hex(F.xxhash64(canon)), 1, 1))
    rows = frame(spark, [(i, f"text {i % 20}", None, None, None) for i in range(40)])
    got = fingerprint.fingerprints(rows).collect()
    assert len({r["fingerprint"] for r in got}) == 20 == len({(r["fingerprint"], r["text"]) for r in got})


@pytest.mark.parametrize("rows", [1, 2, 7, 40])
def test_neighbours_and_edits(spark, monkeypatch, rows):
    monkeypatch.setattr(fingerprint, "ROWS", 5)
    texts = {37 * i % 101 * 3: " ".join(words(i * 3 % 17, i)) + "é" * (i % 3) for i in range(rows)}
    ids = sorted(texts)
    found = fingerprint.beside(frame(spark, [(i, t, None, None, None) for i, t in texts.items()]))
    got = found.withColumn("e", fingerprint.edited(F.col("_text"), F.col("_next"))).collect()
    assert len(got) == rows
    for r in got:
        after = texts[ids[(ids.index(r["_id"]) + 1) % len(ids)]]
        own = texts[r["_id"]]
        n = len(own) // 4
        assert r["_next"] == after and r["e"] == own[: len(own) - n] + after[:n]
        assert hashlib.sha256(r["e"].encode()).hexdigest()


def test_ids_of_other_types(spark, monkeypatch):
    """Ids of text, with nulls: the same neighbours by the order of code points, nulls first, the first after the last."""
    monkeypatch.setattr(fingerprint, "ROWS", 4)
    ids = [f"doc-{i * 37 % 101:03}" for i in range(30)] + [None, "é", "Z"]
    got = fingerprint.beside(spark.createDataFrame([(i, f"text of {i}") for i in ids], "doc_id string, text string")).collect()
    order = [None, *sorted(i for i in ids if i is not None)]
    assert {r["_id"]: r["_next"] for r in got} == {a: f"text of {b}" for a, b in zip(order, order[1:] + order[:1])}


def test_odd_rows(spark):
    rows = odd(spark)
    out = fingerprint.fingerprints(rows)
    assert set(out.columns) == set(rows.columns) and out.count() == rows.count()
    by = {}
    for r in out.collect():
        by.setdefault(r["fingerprint"], set()).add(r["doc_id"])
    assert {1, 2, 3} in by.values()
    assert fingerprint.beside(rows).count() == rows.count()
    assert fingerprint.fingerprints(none(spark)).count() == fingerprint.beside(none(spark)).count() == 0
    assert fingerprint.copies(rows).agg(F.max("n")).first()[0] == 3
