import re

import pytest
from pyspark.sql import functions as F

from corpus import frame, none, odd, words
from docstruct.llm import mixing


def brute_targets(sizes):
    """Reshare the excess until no target is above its cap."""
    total, cap = sum(sizes.values()), {s: 3.0 * n for s, n in sizes.items()}
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = total - sum(cap[s] for s in full)
        free = sum(weight[s] for s in sizes if s not in full)
        out = {s: cap[s] if s in full else rest * weight[s] / free for s in sizes}
        over = {s for s in sizes if out[s] > cap[s] + 1e-9}
        if not over:
            return out
        full |= over


def brute_seats(votes, total, cap):
    seats = [0] * len(votes)
    for _ in range(total):
        open_ = [i for i in range(len(votes)) if seats[i] < cap[i]]
        if not open_:
            break
        best = max(open_, key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    return seats


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for s, (source, n) in enumerate((("a", 60), ("b", 40), ("c", 3), ("é", 25), ("Z", 1), (None, 30), ("empty", 4))):
        rows += [(1000 * s + i, "" if source == "empty" else " ".join(words(5 + 37 * i % 200, i)), None, source, None) for i in range(n)]
    return frame(spark, rows)


def test_targets_and_taken(spark, docs):
    got = mixing.plan(docs).collect()
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    want, taken = brute_targets(sizes), {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3, s
    assert sorted(map(str, got)) == sorted(map(str, mixing.plan(docs.repartition(3)).collect()))


def test_several_shards(spark, docs, monkeypatch):
    want = {r["source"]: r["target"] for r in mixing.plan(docs).collect()}
    monkeypatch.setattr(mixing, "SHARD", 500)
    monkeypatch.setattr(mixing, "BLOCK", 16)
    taken = {r["source"]: r["t"] for r in mixing.plan(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert all(abs(taken[s] - want[s]) <= 40 for s in want)


def test_small_and_capped_sources_keep_their_share_in_large_mixes(spark, monkeypatch):
    """Blocks far larger than some sources: these, and one of several shards that is taken as often as it may be, get their targets."""
    monkeypatch.setattr(mixing, "BLOCKS", 16)
    monkeypatch.setattr(mixing, "SHARD", 1500)
    rows = [(i, " ".join(words(100, i)), None, "big", None) for i in range(400)]
    rows += [(1000 + i, " ".join(words(77, i)), None, "capped", None) for i in range(41)]
    rows += [(2000 + i, " ".join(words(3 + i, i)), None, f"tiny{i:02}", None) for i in range(30)] + [(3000, " ".join(words(1000, 1)), None, "small", None)]
    got = mixing.plan(frame(spark, rows)).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size")).collect()
    assert len(got) == 33 and sum(r["target"] == 3 * r["size"] for r in got) >= 31
    for r in got:
        assert abs(r["taken"] - r["target"]) <= (1024 if r["source"] == "big" else 2), r
        assert r["taken"] <= 3 * r["size"]


def test_seats_are_those_of_the_highest_quotients(spark):
    for votes, total, cap in (([50, 30, 20, 7, 1], 13, [99] * 5), ([3, 3, 3], 7, [9] * 3), ([100, 1, 1, 1, 1], 20, [99] * 5), ([10, 20, 30], 12, [1, 99, 99]), ([5, 0, 0], 4, [9, 9, 9]), ([1, 1], 0, [9, 9]), ([1000, 999, 1], 50, [99] * 3)):
        rows = spark.createDataFrame([(i, float(v), c, total) for i, (v, c) in enumerate(zip(votes, cap))], "i int, votes double, cap long, total long")
        got = mixing.apportion(rows, [], [F.col("i")], "votes", "seats", "total", "cap").orderBy("i").collect()
        assert [r["seats"] for r in got] == brute_seats(votes, total, cap)


def test_odd_rows(spark):
    rows = odd(spark)
    got = mixing.plan(rows)
    assert got.count() == rows.count()
    assert got.where("taken < 0 or taken > 3 * size").count() == 0
    assert [r["size"] for r in got.where("doc_id in (1, 2, 3)").collect()] == [0, 0, 0]
    assert mixing.plan(none(spark)).count() == 0
    assert got.agg(F.sum("taken")).first()[0] == pytest.approx(got.agg(F.sum("size")).first()[0], rel=0.01)


def test_strides_scatter_the_blocks_of_any_shard(spark):
    """For numbers of blocks of every kind a step that visits all, and whose first half lies in many runs."""
    from math import gcd

    rows = [(n, 1, h) for n in (1, 2, 3, 7, 62, 63, 64, 66, 77, 93, 154, 256, 1000, 4096, 65_536, 1_000_003) for h in (0, 5, -7, 123_456_789_012)]
    df = spark.createDataFrame(rows, "_words long, _block long, _drawn long").withColumn("step", mixing._stride())
    seen = set()
    for r in df.collect():
        n, step = r["_words"], r["step"]
        assert n == 1 or (gcd(n, step) == 1 and 0 < step < n)
        if 62 <= n <= 65_536:
            first = sorted(j for j in range(n) if (j * step + r["_drawn"]) % n < n // 2)
            assert sum(b != a + 1 for a, b in zip(first, first[1:])) > 3
        seen.add((n, step))
    assert len({s for n, s in seen if n == 4096}) > 1
