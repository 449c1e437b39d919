import numpy as np
import pyarrow as pa

from corpus import frame, none, odd, words
from docstruct.llm import lm
from docstruct.llm.common import materialize


def weights(seed=0):
    r = np.random.default_rng(seed)
    return {k: (r.standard_normal(s) * 0.3).astype(np.float32) for k, s in lm._SHAPES.items()}


def test_conditional_probabilities_sum_to_one():
    around = np.array([[1, 5, 900, lm.SIZE]])
    every = lm.log_probabilities(weights(), np.repeat(around, lm.SIZE, 0), np.arange(lm.SIZE))
    assert abs(np.exp(every).sum() - 1) < 1e-4


def test_sums_by_hand():
    w = weights(1)
    row = np.array([3, 7, 900, 3, 1000])
    padded = np.concatenate([[lm.SIZE] * 2, row, [lm.SIZE] * 2])
    want = 0.0
    for i, t in enumerate(row):
        h = np.tanh(w["b"] + sum(w["e"][k][padded[i + 2 + o]] for k, o in enumerate((-2, -1, 1, 2))))
        c, m = divmod(int(t), lm.SIZE // lm.CLASSES)
        x, y = h @ w["wc"] + w["bc"], h @ w["wm"][c] + w["bm"][c]
        want += x[c] - np.log(np.exp(x).sum()) + y[m] - np.log(np.exp(y).sum())
    got = lm.sums(w, [row, np.array([], np.int64), row])
    assert np.allclose(got, [want, 0, want], rtol=1e-4)


def test_gradients():
    """A step goes down, and large weights don't overflow."""
    r = np.random.default_rng(2)
    around, tokens = r.integers(0, lm.SIZE + 1, (500, 4)), r.integers(0, lm.SIZE, 500)
    trainer = lm.Trainer(lm.start(np.ones(lm.SIZE)))
    before = lm.log_probabilities(trainer.w, around, tokens).mean()
    for _ in range(5):
        trainer.step(around, tokens)
    assert lm.log_probabilities(trainer.w, around, tokens).mean() > before
    large = {k: v * 100 for k, v in weights().items()}
    assert np.isfinite(lm.log_probabilities(large, around, tokens)).all()


def test_tokens_are_those_of_the_pattern():
    named = ["the", "a", ",", "word"]
    tokens = lm.Tokens(named)
    text = "The word, a word a1b2,c3!! THE " + "x-" * 40
    want = lm._TOKENS(text.lower())
    got = tokens(text)
    assert len(got) == len(want)
    assert all((named[g] == t) if t in named else g >= lm.KNOWN for g, t in zip(got, want))
    assert len(tokens(None)) == len(tokens(" ")) == 0


def score(rows, train=None):
    named, counts = lm.vocabulary(rows if train is None else train)
    encoded = materialize(lm.encode(rows, named))
    return {(r["doc_id"], r["text"]): r["_lm"] for r in lm.score(encoded, lm.train(encoded, counts)).collect()}


def test_ordered_text_scores_better_than_shuffled(spark):
    vocabulary = words(50, 1)
    sentence = vocabulary[:12]
    rows = [(i, " ".join(sentence * 20), None, None, None) for i in range(120)]
    r = np.random.default_rng(0)
    rows += [(1000 + i, " ".join(r.permutation(sentence * 20)), None, None, None) for i in range(5)]
    got = score(frame(spark, rows))
    mean = {k[0]: v["log_prob"] / v["n_tokens"] for k, v in got.items()}
    assert min(mean[i] for i in range(120)) > max(mean[1000 + i] for i in range(5)) + 0.2


def test_odd_rows(spark):
    got = score(odd(spark))
    assert got[1, None]["n_tokens"] == 0 and got[2, ""]["log_prob"] == 0.0
    assert got[4, "word " * 50_000]["n_tokens"] == 50_000
    assert all(v["log_prob"] <= 0 for v in got.values())
    assert score(none(spark)) == {}


def test_tokens_that_share_a_slot_divide_it(spark, monkeypatch):
    """Their probabilities are the slot's, shared by their counts in all documents, whether counts are sent or joined."""
    monkeypatch.setattr(lm, "NEAR", 3)
    common = [f"c{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}" for i in range(lm.KNOWN)]
    rare = [f"rare{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(60)]
    texts = [" ".join(common * 30)] + [" ".join(rare[i:] + [rare[i] + "!", "cakucaku"]) for i in range(20)]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    tokens = materialize(lm.counted(docs))
    named, counts = lm.vocabulary(docs, tokens=tokens)
    share = lm.shares(tokens, named)
    assert 0 < len(share.near) <= 3 and share.far.count() > 0
    monkeypatch.setattr(lm, "NEAR", 100_000)
    assert lm.shares(tokens, named).far is None
    other = docs.union(frame(spark, [(99, "never counted " + rare[5], None, None, None)]))
    encoded = materialize(lm.encode(other, named, share=share))
    w = lm.train(encoded, counts)
    got = {r["doc_id"]: r["_lm"]["log_prob"] for r in lm.score(encoded, w, share=share).collect()}
    slots = {r["doc_id"]: r["_lm"]["log_prob"] for r in lm.score(encoded, w).collect()}
    n = {r["token"]: r["n"] for r in tokens.collect()}
    slot = {t: lm._hash(t) % lm.BUCKETS for t in [*n, "never", "counted"] if t not in named}
    total = np.ones(lm.BUCKETS)
    for t in slot:
        total[slot[t]] += n.get(t, 0)
    for r in other.collect():
        within = sum(np.log(n.get(t, 1) / total[slot[t]]) for t in lm._TOKENS(r["text"]) if t not in named)
        assert abs(got[r["doc_id"]] - slots[r["doc_id"]] - within) < 1e-6


def test_every_window_is_learned_from_once():
    rows = [np.arange(n) + 10 * n for n in (1, 0, 2, 7, 1, 30)]
    due = [lm._due(rows, r) for r in range(lm.ROUNDS)]
    line, every = lm._line(rows)
    assert sorted(np.concatenate([at for _, at in due]).tolist()) == every.tolist()
    assert all((x == line).all() for x, _ in due)


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    """One partition or many, texts in any order, copies in plenty, several learners and levels of the tree."""
    monkeypatch.setattr(lm, "LEARNER", 400)
    monkeypatch.setattr(lm, "FAN", 2)
    rows = [(i, " ".join(words(50 + i % 40, i)), None, None, None) for i in range(80)] + [(500 + i, " ".join(words(60, 3)), None, None, None) for i in range(70)]
    docs = frame(spark, rows)
    a = score(docs.repartition(1).sortWithinPartitions("doc_id"))
    b = score(docs.repartition(8, "text").sortWithinPartitions("n_chars", "doc_id", ascending=False))
    assert a.keys() == b.keys() and len(a) == 150
    assert np.allclose([a[k]["log_prob"] for k in a], [b[k]["log_prob"] for k in a], rtol=1e-5)


def test_learners_get_every_text_as_often_as_it_is_there(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEARNER", 100)
    texts = [np.arange(n, n + 20, dtype="<u2").tobytes() for n in range(30)] + [np.full(5, 7, "<u2").tobytes()] * 101 + [b""]
    dealt, n = lm._learners(spark.createDataFrame([(bytearray(t),) for t in texts], "_tokens binary"))
    rows = dealt.collect()
    assert n == 12 and {r["_learner"] for r in rows} <= set(range(n))
    seen = {}
    for r in rows:
        seen[bytes(r["_tokens"])] = seen.get(bytes(r["_tokens"]), 0) + r["_copies"]
    assert seen == {t: texts.count(t) for t in texts if t}
    assert {r["_copies"] for r in rows if len(r["_tokens"]) == 10} == {8, 9}


def test_conditionals_sum_to_one_over_the_counted_tokens(spark, monkeypatch):
    """Named tokens, counted ones in shared slots, and one token not counted in each of these."""
    monkeypatch.setattr(lm, "NEAR", 5)
    docs = frame(spark, [(i, " ".join(words(300, i, [f"{c}{d}{e}" for c in "abcdefghij" for d in "klmnopqrst" for e in "uvwxyzabcd"])), None, None, None) for i in range(12)])
    tokens = materialize(lm.counted(docs))
    named, counts = lm.vocabulary(docs, tokens=tokens)
    share = lm.shares(tokens, named)
    far = {r["hash"]: r["log_n"] for r in share.far.collect()} if share.far else {}
    w, around = weights(3), np.array([[1, 5, 900, lm.SIZE]])
    slots = np.exp(lm.log_probabilities(w, np.repeat(around, lm.SIZE, 0), np.arange(lm.SIZE)))
    total = slots[: len(named)].sum() + slots[len(named) : lm.KNOWN].sum()
    within = np.exp(-share.totals)  # the one that isn't counted
    for r in tokens.collect():
        if r["token"] not in named:
            h = lm._hash(r["token"])
            log_n = share.near.get(r["token"], far.get(int(np.uint64(h).view(np.int64)), 0.0))
            within[h % lm.BUCKETS] += np.exp(log_n - share.totals[h % lm.BUCKETS])
    assert np.allclose(within, 1) and abs(total + (slots[lm.KNOWN :] * within).sum() - 1) < 1e-4


def test_a_step_makes_both_levels_at_once(monkeypatch):
    """One softmax for each level, however many classes, and the gradients that windows give one by one."""
    made, softmax = [], lm._softmax
    monkeypatch.setattr(lm, "_softmax", lambda x: made.append(len(x)) or softmax(x))
    r = np.random.default_rng(4)
    around, tokens = r.integers(0, lm.SIZE + 1, (300, 4)), r.integers(0, lm.SIZE, 300)
    around[:50], around[0] = [7, lm.SIZE, 7, 900], 7
    w = weights(5)
    g = {k: np.zeros(s) for k, s in lm._SHAPES.items()}
    for a, t in zip(around, tokens):
        c, m = divmod(int(t), lm.SIZE // lm.CLASSES)
        h = np.tanh(w["b"] + sum(w["e"][k][a[k]] for k in range(4)))
        x, y = np.exp(h @ w["wc"] + w["bc"]), np.exp(h @ w["wm"][c] + w["bm"][c])
        x, y = x / x.sum() - np.eye(lm.CLASSES)[c], y / y.sum() - np.eye(lm.SIZE // lm.CLASSES)[m]
        back = (w["wc"] @ x + w["wm"][c] @ y) * (1 - h * h)
        g["wc"] += np.outer(h, x)
        g["bc"] += x
        g["wm"][c] += np.outer(h, y)
        g["bm"][c] += y
        g["b"] += back
        for k in range(4):
            g["e"][k][a[k]] += back
    trainer = lm.Trainer(w)
    trainer.step(around, tokens)
    assert made == [300, 300]
    for k, v in g.items():
        v /= len(tokens)
        assert np.allclose(trainer.w[k], w[k] - lm.RATE * v / np.sqrt(1e-3 + v * v), atol=1e-5), k


def test_scoring_makes_both_levels_at_once(monkeypatch):
    made, log_sum = [], lm._log_sum
    monkeypatch.setattr(lm, "_log_sum", lambda x, *w: made.append(len(x)) or log_sum(x, *w))
    lm.log_probabilities(weights(6), np.full((2000, 4), 5), np.arange(2000) % lm.SIZE)
    assert made == [2000, 2000]


def test_words_and_their_marks_need_no_pattern(monkeypatch):
    seen, find = [], lm._TOKENS
    monkeypatch.setattr(lm, "_TOKENS", lambda chunk: seen.append(chunk) or find(chunk))
    text = "Word word, été. 日本語! straße; a) b\" c' ok? x:"
    tokens = lm.Tokens(["word", ","])
    got = tokens(text)
    rows = {t: n for b in lm._count(iter([pa.record_batch([pa.array([text, None])], names=["t"])])) for t, n in zip(*(c.to_pylist() for c in b.columns))}
    assert seen == []
    want = find(text.lower())
    assert rows == {t: want.count(t) for t in want} and len(got) == len(want)
    for chunk in ("a,", ",", ",,", "a,,", "a.b.", "1,", "a1,", "é,", "́,", "_", "a_", "“a”", "²,", "ⅷ.", "ª)"):
        assert list(lm._split(chunk)) == find(chunk), chunk
