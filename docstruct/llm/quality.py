"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import sys
import types

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lot, part, sampled, small, trim

BITS = 18
#: Labelled documents learned from at most, and their UTF-8 bytes: these bound the driver's work.
SAMPLE_DOCS = 6_000
SAMPLE_BYTES = 16_000_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.05
#: Shares of n-grams are small numbers; this brings them to the size of ordinary features.
SCALE = 80.0
#: Words of a passage, in which an n-gram counts once.
PASSAGE = 64
MEMORY = 150_000

_PARTS = regex.compile(r"[\p{L}\p{M}]+|\p{N}+|[^\p{L}\p{M}\p{N}]+").findall
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _words(chunk: str) -> tuple[int, ...]:
    """Hashes of what a chunk between spaces consists of: letters, digits and runs of signs each make a word."""
    return tuple(xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) for p in _PARTS(chunk))


def features(text: str | None, memory: dict) -> np.ndarray:
    """Hashed slots of every word and word pair of the whole text, repeats included. Null or blank: none.

    memory keeps the hashes of short chunks; what it holds changes nothing but the time.
    """
    hashes: list[int] = []
    for c in (text or "").split():
        if (known := memory.get(c)) is None:
            known = _words(c)
            if len(c) < 64:
                if len(memory) > MEMORY:
                    memory.clear()
                memory[c] = known
        hashes += known
    one = np.array(hashes, dtype=np.uint64)
    two = (one[:-1] * _STEP + one[1:]) * _STEP
    return (np.concatenate([one, two]) >> np.uint64(64 - BITS)).astype(np.int64)


def vector(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots of features and their values: in how many passages of PASSAGE words each is, against all slots.

    A passage that says the same again and again gives little, whatever it says and however long the text goes on.
    """
    n = (len(slots) + 1) // 2
    place = np.concatenate([np.arange(n), np.arange(len(slots) - n)]) // PASSAGE
    once = np.unique(place << BITS | slots) & ((1 << BITS) - 1)
    at, counts = np.unique(once, return_counts=True)
    return at, counts * (SCALE / max(1, len(slots)))


def fit(examples: list[tuple[str, int]]) -> np.ndarray:
    """Weights, the bias last. No examples: zeros, so every score is one half."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    memory: dict = {}
    rows = []
    for text, label in examples:
        at, values = vector(features(text, memory))
        rows.append((np.append(at, 1 << BITS), np.append(values, 1.0), float(label)))

    def weights(at) -> np.ndarray:
        return np.where(np.abs(z[at]) <= L1, 0.0, (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, label in rows:
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(slice(None)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """Weights from at most SAMPLE_DOCS labelled documents, as many of either label at most, chosen by a hash of id and text.

    Other labels than 0 and 1 are left out. Rows that repeat id, text and label teach once, however many they are.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_kind")).where("_id is not null and _kind in (0, 1)").distinct()
    counts = {r["_kind"]: r["count"] for r in known.groupBy("_kind").count().collect()}
    if not counts:
        return fit([])
    # twice as many ids as needed, as some may be of no document
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, part((SAMPLE_DOCS + 64) / n))])
    few = known.where(lot(6, "_id") <= share[F.col("_kind")])
    few = F.broadcast(few) if small(few, SAMPLE_DOCS * 3) else few
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where("_text is not null")
    rows = texts.join(few, "_id").withColumn("_lot", lot(6, "_id", "_text"))
    drawn = sampled(rows, dict.fromkeys(counts, 1), SAMPLE_DOCS // 2, SAMPLE_BYTES)
    # the two labels in turn, so that neither has the last word
    order = sorted(((i + 0.5) / len(found), kind, t) for kind, found in drawn.items() for i, t in enumerate(found))
    weights = fit([(t, kind) for _, kind, t in order])
    del drawn, order
    trim()
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """docs and the probability (0 to 1) that each whole text is good. Null, empty and wordless texts: the bias alone. A column named like out is replaced."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        kept = sys.modules.setdefault("_docstruct_quality", types.ModuleType("_docstruct_quality"))
        memory = kept.__dict__.setdefault("memory", {})
        w = model.value
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            at, values = vector(features(t, memory))
            out[i] = w[at] @ values + w[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return docs.withColumn(out, probability(F.col(text)))
