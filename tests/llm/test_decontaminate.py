import random
import time

import numpy as np
import pytest

from corpus import frame, none, odd, words
from docstruct.llm import decontaminate as d

ITEM = "item_id long, text string"


def edit_distance(item, run):
    """Least edit distance of item to any stretch of run."""
    row = [0] * (len(run) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(run, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def mutated(item, k, r, vocabulary):
    out = list(item)
    for _ in range(k):
        i = r.randrange(len(out))
        kind = r.randrange(3)
        if kind == 0:
            out[i] = r.choice(vocabulary)
        elif kind == 1:
            out.insert(i, r.choice(vocabulary))
        else:
            del out[i]
    return out


@pytest.fixture(scope="module")
def planted():
    r = random.Random(3)
    vocabulary = words(300, 8)
    items = [[r.choice(vocabulary) for _ in range(r.randint(12, 50))] for _ in range(60)]
    docs = []
    for i in range(300):
        text = [r.choice(vocabulary) for _ in range(r.randint(0, 150))]
        if i % 3 == 0:
            item = items[i % 60]
            at = r.randrange(len(text) + 1)
            text[at:at] = mutated(item, r.randint(0, int(len(item) * 0.2)), r, vocabulary)
        docs.append(text)
    return items, docs


def test_distances():
    r = np.random.default_rng(1)
    item, runs = r.integers(0, 5, 9), r.integers(0, 5, (40, 14))
    assert d.distances(item, runs).tolist() == [edit_distance(item.tolist(), x) for x in runs.tolist()]


def test_recall_and_precision_against_brute_force(planted):
    items, docs = planted
    coded = lambda xs: [[w.encode() for w in x] for x in xs]
    found = {(t, i): e for t, i, _, e in d.Index(coded(items)).search(coded(docs))}
    want = {(t, i): e for t, doc in enumerate(docs) for i, item in enumerate(items) if (e := edit_distance(item, doc)) <= int(len(item) * d.EDITS + 1e-9)}
    assert set(found) <= set(want)
    assert all(found[k] == want[k] for k in found)
    assert len(found) >= 0.95 * len(want) and len(want) >= 90
    exact = {k for k, e in want.items() if e <= 2}
    assert len(exact & set(found)) >= 0.99 * len(exact)


def test_blocks_do_not_matter(planted, monkeypatch):
    items, docs = planted
    coded = lambda xs: [[w.encode() for w in x] for x in xs]
    index = d.Index(coded(items))
    whole = sorted(index.search(coded(docs)))
    monkeypatch.setattr(d, "BLOCK", 300)
    monkeypatch.setattr(d, "CELLS", 50)
    assert sorted(index.search(coded(docs))) == whole


def test_items_of_every_length():
    """Exact for items of one to four words, and for longer ones up to ten times a piece's length with all edits they may have."""
    r = random.Random(8)
    vocabulary = words(2000, 8)
    coded = lambda xs: [[w.encode() for w in x] for x in xs]
    short = [[r.choice(vocabulary) for _ in range(1 + i % 4)] for i in range(40)] + [["of"], ["of", "of"], []]
    docs = [[r.choice(vocabulary) for _ in range(r.randint(0, 60))] for _ in range(150)] + [["of"] * 5_000, short[3], []]
    found = {(t, i): e for t, i, _, e in d.Index(coded(short)).search(coded(docs))}
    assert found == {(t, i): 0 for t, doc in enumerate(docs) for i, item in enumerate(short) if item and any(doc[j : j + len(item)] == item for j in range(len(doc)))}
    for size in (5, 9, 24, 48, 49, 120, 400):
        items = [[r.choice(vocabulary) for _ in range(size)] for _ in range(100 if size < 100 else 30)]
        around = [docs[j] + mutated(item, d.allowed(size), r, vocabulary) + docs[j + 20] for j, item in enumerate(items)]
        got = {(t, i) for t, i, _, _ in d.Index(coded(items)).search(coded(around))}
        assert sum((i, i) in got for i in range(len(items))) >= 0.97 * len(items)


def test_common_runs_stay_cheap():
    """20,000 items with one opening, equal items, and a block of their opening: linear work, exact results."""
    r = random.Random(9)
    coded = lambda xs: [[w.encode() for w in x] for x in xs]
    vocabulary = [f"w{i}" for i in range(5_000)]
    opening = "which of the following".split()
    items = [opening + [r.choice(vocabulary) for _ in range(8 + i % 8)] for i in range(20_000)] + [opening] * 3
    block = [w for _ in range(10_000) for w in (*opening, r.choice(vocabulary))]
    block[30_000:30_000] = items[77]
    index = d.Index(coded(items))
    began = time.time()
    found = index.search(coded([block, opening * 20_000]))
    assert {(t, i) for t, i, _, _ in found} == {(0, 77), *((t, 20_000 + k) for t in (0, 1) for k in range(3))}
    assert time.time() - began < 60


def test_scripts_without_spaces():
    item = "什么是光合作用的主要产物以及它在植物中的作用"
    index = d.Index([d.words(item), d.words("氧气")])
    found = index.search([d.words(f"前文很长。{item}，后文"), d.words("没有"), d.words("有氧气吗")])
    assert sorted((t, i) for t, i, _, _ in found) == [(0, 0), (2, 1)]


def test_case_punctuation_and_boundaries(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, "Alpha, BETA gamma; delta (epsilon) zeta-eta theta iota kappa.", None, None, None), (2, "beta gamma delta epsilon zeta eta theta iota kappa", None, None, None), (3, "alpha beta gamma", None, None, None), (4, item[:28], None, None, None), (5, item[28:], None, None, None)]
    items = frame(spark, [(7, item), (8, "too short"), (9, None), (None, item)], ITEM)
    got = d.leaks(frame(spark, rows), items).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == {(1, 7, 0), (2, 7, 1)}
    held = {r["doc_id"]: r["_held"] for r in d.held(frame(spark, rows), items).collect()}
    assert held == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}


def test_several_passes(spark, monkeypatch):
    monkeypatch.setattr(d, "ITEMS", 2)
    texts = [" ".join(words(15, i)) for i in range(7)]
    items = frame(spark, list(enumerate(texts)), ITEM)
    rows = frame(spark, [(i, f"before {t} after", None, None, None) for i, t in enumerate(texts)])
    assert {(r["doc_id"], r["item_id"]) for r in d.leaks(rows, items).collect()} == {(i, i) for i in range(7)}
    assert {r["_held"] for r in d.held(rows, items).collect()} == {1}


def test_odd_rows(spark):
    rows = odd(spark)
    items = frame(spark, [(1, "the same text twice over and over again"), (2, "")], ITEM)
    assert [r["doc_id"] for r in d.leaks(rows, items).collect()] == [5, 5]
    out = d.held(rows, items)
    assert set(out.columns) == set(rows.columns) and out.count() == rows.count()
    empty = frame(spark, [], ITEM)
    assert d.leaks(rows, empty).count() == d.leaks(none(spark), items).count() == 0
    assert {r["_held"] for r in d.held(rows, empty).collect()} == {0}
