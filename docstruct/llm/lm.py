"""Masked pseudo-likelihood scores by a bidirectional window network, trained in numpy.

Every token of a text is predicted from SIDE tokens on either side, the token itself being masked: embeddings by place are
added up, a tanh layer follows, and a softmax in two levels (class, token in class) gives the conditional probability of a
slot. The most frequent tokens have slots of their own; the others share some, and in those the slot's probability is
divided among its tokens by their counts in all documents, however many there are (one is kept for tokens not counted). A
document's score is the sum of its tokens' conditional log-probabilities.

The vocabulary is counted over all documents. Training goes over all documents too, and over each of their windows once,
every ROUNDS-th of a document in a round. Documents are dealt to learners by the hash of their tokens, about LEARNER tokens
each (copies of a document in turn), and every learner goes through its documents in the order of that hash, so weights and
scores do not depend on how the input is partitioned. In each of ROUNDS rounds the learners start from the shared weights;
the mean of what they come to, weighted by windows, is the next round's start. The mean is made in a tree, FAN weights at a
time, so neither a task nor the driver ever gets more. What is gathered grows with the corpus.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, nan

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize

SIDE = 2
#: Tokens known by name, and buckets that the others are hashed to. Together CLASSES * CLASSES.
KNOWN, BUCKETS, CLASSES = 896, 128, 32
HIDDEN = 32
ROUNDS = 2
#: Tokens per learner, about, learners at most (with more tokens they get more each), and weights that are added up at a time.
LEARNER, LEARNERS, FAN = 3_000_000, 100_000, 16
BATCH = 4096
RATE = 0.2
SEED = 3
#: Chunks between spaces remembered by a worker; distinct tokens counted before they are passed on.
MEMORY = 400_000
#: Tokens of shared slots whose counts are sent to workers; those of rarer ones are joined.
NEAR = 100_000
#: Tokens scored at a time.
BLOCK = 1 << 14

SIZE = KNOWN + BUCKETS
_SHAPES = {"e": (2 * SIDE, SIZE + 1, HIDDEN), "b": (HIDDEN,), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "wm": (CLASSES, HIDDEN, SIZE // CLASSES), "bm": (CLASSES, SIZE // CLASSES)}

_TOKENS = regex.compile(r"[\p{L}\p{M}]+|\p{N}+|[^\p{L}\p{M}\p{N}\s]+").findall
#: What ends many words.
_MARKS = frozenset(".,;:!?)\"'")


def _split(chunk: str) -> tuple[str, ...] | list[str]:
    """Tokens of a chunk between spaces. Words, and those that one mark ends, need no pattern."""
    if chunk.isalpha():
        return (chunk,)
    if chunk[-1] in _MARKS and (word := chunk[:-1]).isalpha():
        return word, chunk[-1]
    return _TOKENS(chunk)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counter) -> pa.RecordBatch:
        tokens: dict[str, int] = {}
        get, put = tokens.get, tokens.__setitem__
        for chunk, n in counts.items():
            if chunk.isalpha():
                put(chunk, n + get(chunk, 0))
            else:
                for t in _split(chunk):
                    put(t, n + get(t, 0))
        return pa.RecordBatch.from_arrays([pa.array(list(tokens), pa.string()), pa.array(list(tokens.values()), pa.int64())], names=["token", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update((text or "").lower().split())
            if len(counts) > MEMORY:
                yield rows(counts)
                counts = Counter()
    yield rows(counts)


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, n) of every token of all documents. Worth writing down if it is read more than once."""
    return docs.select(F.col(text).alias("_text")).mapInArrow(_count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text: str = "text", tokens: DataFrame | None = None) -> tuple[list[str], np.ndarray]:
    """The KNOWN most frequent tokens of all documents (ties by code point) and the counts of all SIZE slots. tokens: counted(docs)."""
    top = (counted(docs, text) if tokens is None else tokens).orderBy(F.desc("n"), "token").limit(KNOWN).collect()
    total = sum(r["n"] for r in top)
    named = [r["token"] for r in top]
    counts = np.ones(SIZE)
    counts[: len(named)] += [r["n"] for r in top]
    counts[KNOWN:] += total / 2 / BUCKETS  # a guess to start from; training learns the buckets' shares
    return named, counts


def _hash(token: str) -> int:
    try:
        return xxhash.xxh64_intdigest(token, SEED)
    except UnicodeEncodeError:
        return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), SEED)


@dataclass
class Shares:
    """How the tokens of shared slots divide them: log of each slot's total, logs of the counts of up to NEAR tokens, and a table of the rarer ones.

    The table has (hash, log_n) of the tokens that were counted twice or more, if there are any that aren't near; for those
    that were counted once, as for those that were not, the log is 0.
    """

    totals: np.ndarray
    near: dict[str, float]
    far: DataFrame | None


def shares(tokens: DataFrame, named: list[str]) -> Shares:
    """Shares of all tokens but the named ones; tokens as of counted. The driver gets the near ones, and a row for each count that occurs."""
    known = frozenset(named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(t, _hash(t), n) for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t not in known]
            hashes = np.array([h for _, h, _ in kept], np.uint64)
            slots = (hashes % BUCKETS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _, _ in kept], pa.string()), pa.array(hashes.view(np.int64)), pa.array(slots), pa.array([n for _, _, n in kept], pa.int64())], names=["token", "hash", "slot", "n"])

    rest = materialize(tokens.select("token", "n").mapInArrow(run, "token string, hash long, slot int, n long"))
    totals = np.ones(BUCKETS)
    for r in rest.groupBy("slot").agg(F.sum("n").alias("n")).collect():
        totals[r["slot"]] += r["n"]
    least, room = None, NEAR
    for r in sorted(rest.where("n > 1").groupBy("n").count().collect(), reverse=True):
        if (room := room - r["count"]) < 0:
            break
        least = r["n"]
    near = {} if least is None else {r["token"]: log(r["n"]) for r in rest.where(F.col("n") >= least).select("token", "n").collect()}
    if room >= 0:
        return Shares(np.log(totals), near, None)
    few = rest.where("n > 1") if least is None else rest.where((F.col("n") > 1) & (F.col("n") < least))
    return Shares(np.log(totals), near, few.groupBy("hash").agg(F.log(F.sum("n").cast("double")).alias("log_n")))


#: Bits of a token's number, and tokens of a chunk that fit into one word with their count.
_BITS, _PACKED = SIZE.bit_length(), 4


class _Chunks(dict):
    """Chunk between spaces -> its number; codes and logs hold what is known of it.

    A code has the numbers of the chunk's tokens in one integer, of which the lowest bits count them (0: too many to fit);
    a log is the sum of the log counts of its tokens in shared slots (nan: some must be joined).
    """

    def __init__(self, number: dict[str, int], near: dict[str, float]):
        super().__init__()
        self.number, self.near = number, near
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.codes, self.logs = np.empty(1 << 12, np.int64), np.empty(1 << 12)
        self.held = 0

    def tokens(self, chunk: str) -> list[int]:
        number = self.number
        return [number[t] if t in number else KNOWN + _hash(t) % BUCKETS for t in _split(chunk)]

    def __missing__(self, chunk: str) -> int:
        number, near = self.number, self.near
        tokens = _split(chunk)
        code, log_n, shift = 0, 0.0, 3
        for t in tokens:
            n = number.get(t)
            if n is None:
                n = KNOWN + _hash(t) % BUCKETS
                log_n += near.get(t, nan)
            if shift < 3 + _PACKED * _BITS:
                code |= n << shift
            shift += _BITS
        code = code | len(tokens) if len(tokens) <= _PACKED else 0
        at = len(self)
        if at == len(self.codes):
            self.codes, self.logs = np.resize(self.codes, 2 * at), np.resize(self.logs, 2 * at)
        self.codes[at], self.logs[at] = code, log_n
        self[chunk] = at
        self.held += len(chunk)
        return at


class Tokens:
    """Token numbers of texts."""

    def __init__(self, named: list[str], totals: np.ndarray | None = None, near: dict[str, float] | None = None):
        self.known = _Chunks({t: i for i, t in enumerate(named)}, near or {})
        self.totals = totals

    def _chunks(self, text: str | None) -> tuple[list[str], np.ndarray]:
        if len(self.known) > MEMORY or self.known.held > 32 * MEMORY:
            self.known.forget()
        chunks = (text or "").lower().split()
        return chunks, np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))

    def __call__(self, text: str | None) -> np.ndarray:
        return self._numbers(*self._chunks(text))

    def both(self, text: str | None) -> tuple[np.ndarray, float, np.ndarray]:
        """Token numbers, the summed log shares of tokens in their slots, and the hashes of those whose log counts are still to be added."""
        chunks, at = self._chunks(text)
        numbers = self._numbers(chunks, at)
        logs = self.known.logs[at]
        value = float(np.nansum(logs)) - float(self.totals[numbers[numbers >= KNOWN] - KNOWN].sum())
        number, near, far = self.known.number, self.known.near, []
        for i in np.flatnonzero(np.isnan(logs)).tolist():
            for t in _split(chunks[i]):
                if t in near:
                    value += near[t]
                elif t not in number:
                    far.append(_hash(t))
        return numbers, value, np.array(far, np.uint64).view(np.int64)

    def _numbers(self, chunks: list[str], at: np.ndarray) -> np.ndarray:
        codes = self.known.codes[at]
        counts = codes & 7
        if len(long := np.flatnonzero(counts == 0)):
            # rare: such chunks' tokens one by one, between those of the others
            parts = np.split(np.arange(len(codes)), np.stack([long, long + 1], 1).ravel())
            return np.concatenate([self._unpack(codes[p]) if i % 2 == 0 else np.array(self.known.tokens(chunks[p[0]]), np.int64) for i, p in enumerate(parts)])
        return self._unpack(codes)

    @staticmethod
    def _unpack(codes: np.ndarray) -> np.ndarray:
        counts = codes & 7
        shifts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(codes >> 3, counts) >> (shifts * _BITS) & ((1 << _BITS) - 1)


def start(counts: np.ndarray) -> dict[str, np.ndarray]:
    random = np.random.default_rng(SEED)
    w = {k: (random.standard_normal(s) * 0.1).astype(np.float32) for k, s in _SHAPES.items()}
    share = (counts / counts.sum()).reshape(CLASSES, -1)
    w["bc"], w["bm"], w["b"] = np.log(share.sum(1)).astype(np.float32), np.log(share).astype(np.float32), np.zeros(HIDDEN, np.float32)
    return w


def pack(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in _SHAPES])


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    ends = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()])
    return {k: p.reshape(s).astype(np.float32) for (k, s), p in zip(_SHAPES.items(), np.split(flat, ends[:-1]))}


_AROUND = np.array([o for o in range(-SIDE, SIDE + 1) if o])


def _softmax(x: np.ndarray) -> np.ndarray:
    """Softmax of the rows, in their place."""
    np.exp(np.minimum(x, 60, out=x), out=x)
    x *= (1 / (x @ _ONES))[:, None]
    return x


def _hidden(w: dict, around: list[np.ndarray]) -> np.ndarray:
    total = w["e"][0].take(around[0], axis=0)
    for e, ids in zip(w["e"][1:], around[1:]):
        total += e.take(ids, axis=0)
    total += w["b"]
    return np.tanh(total, out=total)


def _by_class(around: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """An order of tokens by class; in it the tokens at each place around, the classes and places in them; and where each class stands."""
    kind = (tokens // (SIZE // CLASSES)).astype(np.uint16)  # so narrow numbers are sorted by radix
    order = np.argsort(kind, kind="stable")
    kind = kind[order].astype(np.intp)
    cuts = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    return order, [ids.take(order) for ids in around.T], kind, tokens[order] % (SIZE // CLASSES), [(c, slice(a, b)) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def _within(w: dict, h: np.ndarray, kind: np.ndarray, classes: list[tuple[int, slice]]) -> np.ndarray:
    """Inputs of the softmax in each row's class; rows stand by class."""
    y = np.empty((len(h), SIZE // CLASSES), np.float32)
    for c, rows in classes:
        np.matmul(h[rows], w["wm"][c], out=y[rows])
    y += w["bm"].take(kind, axis=0)
    return y


_ONES = np.ones(CLASSES, np.float32)


def _log_sum(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Log of the rows' summed exponentials, which take their place. Hidden values are within 1, so small weights can't overflow unshifted."""
    if np.abs(weights).sum(-2).max() + np.abs(bias).max() < 60:
        return np.log(np.exp(x, out=x) @ _ONES)
    most = x.max(1)
    x -= most[:, None]
    return most + np.log(np.exp(x, out=x) @ _ONES)


def log_probabilities(w: dict, around: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Natural log of each token's conditional probability."""
    order, around, kind, place, classes = _by_class(around, tokens)
    each = np.arange(len(tokens))
    h = _hidden(w, around)
    x = h @ w["wc"]
    x += w["bc"]
    y = _within(w, h, kind, classes)
    here = x[each, kind] + y[each, place]
    here -= _log_sum(x, w["wc"], w["bc"])
    here -= _log_sum(y, w["wm"], w["bm"])
    out = np.empty(len(tokens))
    out[order] = here
    return out


class Trainer:
    """Adagrad on one partition's windows."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = {k: v.copy() for k, v in w.items()}
        self.seen = {k: np.full(v.shape, 1e-3, np.float32) for k, v in w.items()}
        self.windows = 0

    def _move(self, name: str, at, g: np.ndarray) -> None:
        s = self.seen[name]
        s[at] += g * g
        self.w[name][at] -= RATE * g / np.sqrt(s[at])

    def step(self, around: np.ndarray, tokens: np.ndarray) -> None:
        n = len(tokens)
        if not n:
            return
        self.windows += n
        w = self.w
        _, around, kind, place, classes = _by_class(around, tokens)
        each, ones = np.arange(n), np.full(n, 1 / n, np.float32)
        h = _hidden(w, around)
        x = h @ w["wc"]
        x += w["bc"]
        x = _softmax(x)
        x[each, kind] -= 1
        y = _softmax(_within(w, h, kind, classes))
        y[each, place] -= 1
        back = np.empty_like(h)
        wm, bm = np.zeros_like(w["wm"]), np.zeros_like(w["bm"])
        for c, rows in classes:
            np.matmul(y[rows], w["wm"][c].T, out=back[rows])
            np.matmul(h[rows].T, y[rows], out=wm[c])
            np.matmul(ones[rows], y[rows], out=bm[c])
        back += x @ w["wc"].T
        for name, delta in (("wc", h.T @ x / n), ("bc", ones @ x), ("wm", wm / n), ("bm", bm)):
            self._move(name, ..., delta)
        h *= h
        back *= np.subtract(1, h, out=h)
        back /= n
        self._move("b", ..., back.sum(0))
        # pairs of numbers are added up as complex ones, which takes half as many additions
        pairs = back.view(np.complex64).ravel()
        each = np.arange(HIDDEN // 2)
        for k, ids in enumerate(around):
            total = np.zeros((SIZE + 1) * HIDDEN // 2, np.complex64)
            np.add.at(total, np.add.outer(ids * (HIDDEN // 2), each).ravel(), pairs)
            self._move("e", k, total.view(np.float32).reshape(SIZE + 1, HIDDEN))


def _line(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some texts in a line, SIDE pads before, between and after; and where the tokens are."""
    sizes = np.array([len(r) for r in rows])
    starts = SIDE + np.cumsum(sizes + SIDE) - sizes - SIDE
    line = np.full(int(sizes.sum()) + SIDE * (len(rows) + 1), SIZE, np.int64)
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    line[at] = np.concatenate(rows)
    return line, at


def _due(rows: list[np.ndarray], round_: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts in a line, and where the tokens are whose windows a round learns from; each is due in one round."""
    line, at = _line(rows)
    sizes = np.array([len(r) for r in rows])
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return line, at[place % ROUNDS == round_]


def _pieces(rows: list[np.ndarray]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Numbers and tokens of rows, about BLOCK tokens at a time."""
    numbers: list[int] = []
    size = 0
    for i, r in enumerate(rows):
        numbers.append(i)
        size += len(r)
        if size >= BLOCK:
            yield numbers, [rows[j] for j in numbers]
            numbers, size = [], 0
    if numbers:
        yield numbers, [rows[j] for j in numbers]


def sums(w: dict, rows: list[np.ndarray]) -> np.ndarray:
    """Summed log-probability of each row of tokens."""
    out = np.zeros(len(rows))
    for numbers, part in _pieces(rows):
        line, at = _line(part)
        owner = np.repeat(numbers, [len(r) for r in part])
        for i in range(0, len(at), BLOCK):
            here = at[i : i + BLOCK]
            out += np.bincount(owner[i : i + BLOCK], log_probabilities(w, line[here[:, None] + _AROUND], line[here]), len(rows))
    return out


def _tokens(key: str, sent) -> Tokens:
    kept = sys.modules.setdefault("_docstruct_lm", types.ModuleType("_docstruct_lm"))
    if getattr(kept, "key", None) != key:
        kept.key, kept.tokens = key, Tokens(*sent.value)
    return kept.tokens


def encode(docs: DataFrame, named: list[str], text: str = "text", out: str = "_tokens", share: Shares | None = None, rest: str = "_rest") -> DataFrame:
    """docs and the token numbers of each whole text, two bytes each. Null and blank texts: none.

    With share also a struct rest, from which score makes probabilities of tokens instead of slots; it has a number of the
    row, so it must be written down before it is used. Worth writing down anyway before training and scoring, which read it
    several times. Columns named like out and rest are replaced.
    """
    sent, key = docs.sparkSession.sparkContext.broadcast((named,) if share is None else (named, share.totals, share.near)), uuid.uuid4().hex

    @F.pandas_udf("binary")
    def numbers(texts: pd.Series) -> pd.Series:
        tokens = _tokens(key, sent)
        return pd.Series([tokens(t).astype("<u2").tobytes() for t in texts], dtype=object)

    @F.pandas_udf("tokens binary, within double, far array<long>")
    def both(texts: pd.Series) -> pd.DataFrame:
        tokens = _tokens(key, sent)
        found = [tokens.both(t) for t in texts]
        return pd.DataFrame({"tokens": [c.astype("<u2").tobytes() for c, _, _ in found], "within": [w for _, w, _ in found], "far": [f for _, _, f in found]})

    if share is None:
        return docs.withColumn(out, numbers(F.col(text)))
    (made,) = fresh(docs, "_made")
    coded = docs.withColumn(made, both(F.col(text)))
    struct = F.struct(F.monotonically_increasing_id().alias("row"), F.col(made)["within"].alias("within"), F.col(made)["far"].alias("far"))
    return coded.withColumns({out: F.col(made)["tokens"], rest: struct}).drop(made)


def _decode(values) -> list[np.ndarray]:
    return [np.frombuffer(v, "<u2").astype(np.int64) for v in values]


def _learners(rows: DataFrame) -> tuple[DataFrame, int]:
    """(_learner, _order, _copies, _tokens) of all texts with tokens, and the number of learners.

    Equal texts are one row for each learner that gets some of them; so they are spread over all, however many there are.
    """
    each = rows.where(F.octet_length("_tokens") > 0).groupBy("_tokens").agg(F.count("*").alias("_n")).withColumn("_order", F.xxhash64("_tokens"))
    each = materialize(each)
    total = each.agg(F.sum(F.octet_length("_tokens") / 2 * F.col("_n"))).first()[0]
    n = max(1, min(LEARNERS, ceil((total or 0) / LEARNER)))
    share = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("_n"), F.lit(n)) - 1)).alias("_i")
    dealt = each.select("_tokens", "_order", "_n", share)
    return dealt.select(
        F.pmod(F.col("_order") + F.col("_i"), F.lit(n)).cast("int").alias("_learner"), "_order",
        (F.floor(F.col("_n") / n) + (F.col("_i") < F.col("_n") % n).cast("long")).cast("long").alias("_copies"), "_tokens",
    ), n


def _added(parts: DataFrame, n: int) -> DataFrame:
    """(at, windows, weights) of parts 0 to n - 1, added up FAN at a time until there are FAN at most."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        windows = int(rows["windows"].sum())
        summed = sum(np.frombuffer(x, np.float32).astype(np.float64) * (k / windows) for x, k in zip(rows["weights"], rows["windows"]))
        return pd.DataFrame({"at": [int(rows["at"].iloc[0]) // FAN], "windows": [windows], "weights": [summed.astype(np.float32).tobytes()]})

    while n > FAN:
        parts = parts.groupBy(F.floor(F.col("at") / FAN)).applyInPandas(add, "at int, windows long, weights binary")
        n = ceil(n / FAN)
    return parts


def train(encoded: DataFrame, counts: np.ndarray, tokens: str = "_tokens") -> dict[str, np.ndarray]:
    """Weights learned from all documents, whatever their order and partitions. Without any token: the starting weights."""
    sc = encoded.sparkSession.sparkContext
    w = start(counts)
    dealt, n = _learners(encoded.select(F.col(tokens).alias("_tokens")))
    # a learner's rows come to one task, in order; a task may have several learners
    placed = dealt.repartition(min(3 * n, LEARNERS), "_learner").sortWithinPartitions("_learner", "_order", "_tokens")
    for round_ in range(ROUNDS):
        sent = sc.broadcast(w)

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, round_=round_) -> Iterator[pa.RecordBatch]:
            trainer, learner, lines, size = None, None, [], 0

            def step() -> None:
                line, at = _due(lines, round_)
                at = np.random.default_rng(len(at)).permutation(at)
                for i in range(0, len(at), BATCH):
                    trainer.step(line[at[i : i + BATCH, None] + _AROUND], line[at[i : i + BATCH]])

            def done() -> pa.RecordBatch:
                if lines:
                    step()
                return pa.RecordBatch.from_arrays([pa.array([learner], pa.int32()), pa.array([trainer.windows], pa.int64()), pa.array([pack(trainer.w).tobytes()], pa.binary())], names=["at", "windows", "weights"])

            for batch in batches:
                for k, copies, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _decode(batch.column(2).to_pylist())):
                    if k != learner:
                        if trainer is not None:
                            yield done()
                        trainer, learner, lines, size = Trainer(sent.value), k, [], 0
                    for _ in range(copies):
                        lines.append(text)
                        size += len(text)
                        if size >= BLOCK:
                            step()
                            lines, size = [], 0
            if trainer is not None:
                yield done()

        parts = _added(placed.select("_learner", "_copies", "_tokens").mapInArrow(learn, "at int, windows long, weights binary"), n).collect()
        if parts:
            total = sum(p["windows"] for p in parts)
            w = unpack(sum(np.frombuffer(p["weights"], np.float32).astype(np.float64) * (p["windows"] / total) for p in sorted(parts, key=lambda p: p["at"])))
    return w


def score(encoded: DataFrame, weights: dict[str, np.ndarray], tokens: str = "_tokens", out: str = "_lm", share: Shares | None = None, rest: str = "_rest") -> DataFrame:
    """encoded and struct out(n_tokens, log_prob) of each whole text; log_prob is a sum of natural logs, 0 without tokens.

    share: that which encoded was made with; without it the logs are those of the tokens' slots.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("n_tokens long, log_prob double")
    def pseudo(values: pd.Series) -> pd.DataFrame:
        rows = _decode(values)
        return pd.DataFrame({"n_tokens": [len(r) for r in rows], "log_prob": sums(sent.value, rows)})

    found = encoded.withColumn(out, pseudo(F.col(tokens)))
    if share is None:
        return found
    if share.far is None:  # all that is counted twice is near, and the rest adds nothing
        log_prob = F.col(out)["log_prob"] + F.col(rest)["within"]
        return found.withColumn(out, F.struct(F.col(out)["n_tokens"].alias("n_tokens"), log_prob.alias("log_prob")))
    row, more = fresh(found, "_row_number", "_more")
    far = encoded.select(F.col(rest)["row"].alias(row), F.explode(F.col(rest)["far"]).alias("hash"))
    far = far.join(share.far, "hash").groupBy(row).agg(F.sum("log_n").alias(more))
    found = found.withColumn(row, F.col(rest)["row"]).join(far, row, "left")
    log_prob = F.col(out)["log_prob"] + F.col(rest)["within"] + F.coalesce(more, F.lit(0.0))
    return found.withColumn(out, F.struct(F.col(out)["n_tokens"].alias("n_tokens"), log_prob.alias("log_prob"))).drop(row, more)
