import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpus import frame, none, odd, words
from docstruct.llm import simhash


def plain(text):
    """The fingerprint by the definition, one bit at a time."""
    parts = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    if not parts:
        return 0
    runs = [b" ".join(parts[i : i + 3]) for i in range(len(parts) - 2)] or [b" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(values, linked):
    """Components by brute force: {value: smallest index}."""
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def near(text, edits, seed):
    r = random.Random(seed)
    w = text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = "edited"
    return " ".join(w)


def test_fingerprint(monkeypatch):
    texts = [None, "", "One", "one TWO", "a b c", "A\tb\x0bC d", "Ünï x y z", " ".join(words(200, 1))]
    assert [simhash.fingerprint(t) for t in texts] == [plain(t) for t in texts]
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(texts[-1]) == plain(texts[-1])


@pytest.fixture(scope="module")
def texts():
    base = [" ".join(words(400, i)) for i in range(12)]
    return base + [near(base[i % 4], 1 + i % 5, i) for i in range(40)] + base[:3] + ["", None, "one", "two words"]


def test_groups_are_those_of_brute_force(spark, texts):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    prints = [plain(t) for t in texts]
    root = closed(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    got = {r["doc_id"]: (r["_fp"] % (1 << 64), r["component"]) for r in simhash.groups(frame(spark, rows)).collect()}
    assert got == {i: (prints[i], root[i]) for i in range(len(texts))}
    assert len(set(root)) < len(texts) - 10


def test_hot_buckets_are_split_and_lose_nothing(spark, texts, monkeypatch):
    rows = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    want = sorted(map(tuple, simhash.groups(rows).select("doc_id", "component").collect()))
    monkeypatch.setattr(simhash, "BUCKET", 3)
    assert sorted(map(tuple, simhash.groups(rows).select("doc_id", "component").collect())) == want


def test_links_join_what_is_connected():
    r = np.random.default_rng(0)
    prints = r.integers(0, 1 << 64, (300, 1), dtype=np.uint64)
    prints[100:200] = prints[:100] ^ np.uint64(0b101)
    keys = np.sort(r.integers(0, 4, 300))
    pairs = simhash.linked(keys, prints, simhash.pivot_distances(prints, *simhash.NARROW_PIVOTS), 3)
    root = closed(list(zip(keys.tolist(), prints[:, 0].tolist())), lambda a, b: a[0] == b[0] and (a[1] ^ b[1]).bit_count() <= 3)
    mine = list(range(300))
    for a, b in pairs.tolist():
        x, y = mine[a], mine[b]
        mine = [min(x, y) if m in (x, y) else m for m in mine]
    assert mine == root


def test_pivots_bound_the_distance_and_prune():
    r = np.random.default_rng(5)
    for words_, pivots, radius, left in ((1, simhash.NARROW_PIVOTS, simhash.RADIUS, 0.01), (4, simhash.WIDE_PIVOTS, simhash.WIDE_RADIUS, 0.7)):
        x = r.integers(0, 1 << 64, (4_000, words_), dtype=np.uint64)
        flips = r.random((4_000, words_ * 64)) < r.random((4_000, 1)) * 0.5
        y = x ^ np.packbits(flips, axis=1).view(np.uint64)
        a, b = (simhash.pivot_distances(z, *pivots) for z in (x, y))
        assert (simhash._bound(a, b) <= simhash._apart(x, y)).all()
        assert (simhash._bound(a, np.roll(a, 1, axis=0)) <= radius).mean() < left


def test_tables_do_not_depend_on_the_number_of_documents():
    assert {simhash.samples(n).shape for n in (0, 1, 10_000, 1 << 18, 1 << 22)} == {simhash.samples(1).shape}
    assert simhash.samples(1 << 30).shape[0] < 400


def test_recall_at_the_stated_similarity():
    """Texts of 60 to 600 words with a copy of similarity 0.8 to 0.82: within the radius, and met in a table."""

    def sets(w):
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    r = random.Random(6)
    places = simhash.samples(1)
    bits = lambda w: np.unpackbits(np.frombuffer(simhash.wide(" ".join(w)), np.uint8))
    n = near_ = met = far = 0
    for seed in range(300):
        base = words(r.randint(60, 600), seed)
        other = list(base)
        while (similar := len(sets(base) & sets(other)) / len(sets(base) | sets(other))) > 0.82:
            other[r.randrange(len(other))] = f"edit{r.random()}"
        if similar < 0.8:
            continue
        x, y = bits(base), bits(other)
        n += 1
        near_ += np.count_nonzero(x != y) <= simhash.WIDE_RADIUS
        met += np.count_nonzero(x != y) <= simhash.WIDE_RADIUS and (x[places] == y[places]).all(axis=1).any()
        half = base[: len(base) // 3] + words(2 * len(base) // 3, -seed - 1)
        far += np.count_nonzero(x != bits(half)) <= simhash.WIDE_RADIUS
    assert n > 100 and near_ >= 0.96 * n and met >= 0.95 * n and not far


def test_hot_keys_are_dealt_out(spark, texts, monkeypatch):
    """One text in half of all rows, and a component of most fingerprints: shares of them give the same result."""
    from docstruct.llm import common

    rows = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts + texts[:1] * 60)])
    want = sorted(map(tuple, simhash.groups(rows).select("doc_id", "component").collect()))
    kept = sorted(r["doc_id"] for r in simhash.representatives(rows).collect())
    monkeypatch.setattr(common, "HOT", 2)
    assert sorted(map(tuple, simhash.groups(rows).select("doc_id", "component").collect())) == want
    assert sorted(r["doc_id"] for r in simhash.representatives(rows).collect()) == kept


def test_representatives_keep_one_of_each_group(spark):
    base = [" ".join(words(300, 100 + i)) for i in range(30)]
    copies = [near(base[i], 1 + i % 3, i) for i in range(10)]
    rows = [(i, t, None, None, None) for i, t in enumerate(base + copies + base[20:25])]
    kept = {r["doc_id"] for r in simhash.representatives(frame(spark, rows)).collect()}
    assert kept == set(range(30))


def test_wide_fingerprints_follow_the_similarity():
    def sets(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    base = " ".join(words(300, 9))
    for edits in range(0, 40, 4):
        other = near(base, edits, edits)
        similar = len(sets(base) & sets(other)) / len(sets(base) | sets(other))
        apart = sum((a ^ b).bit_count() for a, b in zip(simhash.wide(base), simhash.wide(other)))
        assert not (similar >= 0.85 and apart > simhash.WIDE_RADIUS) and not (similar < 0.5 and apart <= simhash.WIDE_RADIUS)


def test_repeated_lines_count_once(spark):
    """Different documents that share a much repeated line stay; copies that repeat a line differently are one."""
    line = " ".join(words(14, 999))
    own = [" ".join(words(300, 500 + i)) for i in range(12)]
    rows = [(i, f"{t} {' '.join([line] * 20)}", None, None, None) for i, t in enumerate(own)]
    rows += [(100 + i, f"{t} {' '.join([line] * 60)}", None, None, None) for i, t in enumerate(own)]
    assert {r["doc_id"] for r in simhash.representatives(frame(spark, rows)).collect()} == set(range(12))


def test_odd_rows(spark):
    rows = odd(spark)
    got = simhash.groups(rows).collect()
    assert len(got) == rows.count()
    assert {r["component"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    kept = simhash.representatives(rows)
    assert kept.columns == rows.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(x or 0 for x in ids) == [0, 1, 4, 5, 6, 7]
    assert simhash.groups(none(spark)).count() == simhash.representatives(none(spark)).count() == 0
    again = kept.withColumn("copy", F.lit(1)).count()
    assert again == len(ids)
