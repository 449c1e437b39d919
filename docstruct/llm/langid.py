"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ORDER bytes, counted once and then frozen. A byte that its context has
not been followed by costs the context's escape (method C: distinct followers against all) and is looked for in the next
shorter context among the bytes not yet excluded, down to a uniform guess. The language whose tree gives a text the
shortest exact code wins. As the statistics are frozen, the code length of every (context, byte) is fixed: the trees are
flattened to a table with one row per known context, and scoring a text is a lookup per byte. Bytes that no tree knows
behave alike, so they share one symbol.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lot, sampled, trim

ORDER = 3
#: Contexts of two bytes and more are kept if all languages together saw them so often.
LEAST = 3
#: Documents learned from per language at most, and their UTF-8 bytes in all languages together.
SAMPLE_DOCS = 800
SAMPLE_BYTES = 16_000_000
#: Languages told apart at most; code lengths kept at most (with more languages, longer contexts are kept only if seen more often).
LANGUAGES = 2_000
CELLS = 1 << 25
#: Bytes scored at a time, for so many languages; with more, fewer.
BLOCK, AT_ONCE = 1 << 19, 8
UNKNOWN = "und"

_START = b"\n" * ORDER


class Model:
    """Code lengths in bits: table[row * symbols + symbol, language]; rows: context of ORDER symbols -> row."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.langs = sorted(samples)
        joined = [_START + _START.join(samples[x]) for x in self.langs]
        seen = np.flatnonzero(np.bincount(np.concatenate([np.frombuffer(b, np.uint8) for b in joined] or [np.empty(0, np.uint8)]), minlength=256))
        self.symbols = a = len(seen) + 1
        self.symbol = np.full(256, a - 1, np.int32)
        self.symbol[seen] = np.arange(a - 1)
        coded = [self.symbol[np.frombuffer(b, np.uint8)].astype(np.uint8) for b in joined]

        def grams(s: np.ndarray, k: int) -> np.ndarray:
            """(context of k symbols, next symbol) at every place past the start, as one number."""
            out = np.zeros(len(s) - ORDER, np.int64)
            for i in range(k + 1):
                out = out * a + s[ORDER - k + i : len(s) - k + i]
            return out

        unseen = 256 - (a - 1)
        uniform = np.full(a, 1 / 256)
        uniform[-1] = unseen / 256
        lengths = np.tile(uniform, (1, len(self.langs), 1)).astype(np.float32)  # row, language, symbol
        tables: list[np.ndarray] = []
        ids = np.zeros(1, np.int32)
        total = 0
        self.least: list[int] = []
        for k in range(ORDER + 1):
            counts = [np.unique(grams(s, k), return_counts=True) for s in coded]
            if k:
                contexts = np.concatenate([g // a for g, _ in counts] or [np.empty(0, np.int64)])
                weight = np.concatenate([c for _, c in counts] or [np.empty(0, np.int64)])
                names, where = np.unique(contexts, return_inverse=True)
                times = np.bincount(where, weight, minlength=len(names))
                least = LEAST if k > 1 else 1
                if (room := max(a, CELLS // (a * max(1, len(self.langs))) - total)) < np.count_nonzero(times >= least):
                    least = int(np.sort(times)[-room]) + 1
                self.least.append(least)
                names = names[times >= least]
            else:
                names = np.zeros(1, np.int64)
            # each starts from what its context without the first symbol says
            rows = np.empty((len(names), *lengths.shape[1:]), np.float32)
            up = ids[names % (a ** max(0, k - 1))]
            done = 0
            for t in tables:
                here = (up >= done) & (up < done + len(t))
                rows[here] = t[up[here] - done]
                done += len(t)
            if not tables:
                rows[:] = lengths
            for lang, (g, c) in enumerate(counts):
                at = np.searchsorted(names, g // a)
                ok = at < len(names)
                ok[ok] = names[at[ok]] == (g // a)[ok]
                dense = np.zeros((len(names), a), np.float32)
                dense[at[ok], (g % a)[ok]] = c[ok]
                n, d = dense.sum(1), (dense > 0).sum(1)
                has = n > 0
                rest = np.where(dense > 0, 0.0, rows[:, lang])
                left = rest.sum(1)
                # if nothing is left to escape to, the context's own counts share all
                base = np.where(left > 0, n + d, n)
                mixed = dense / np.maximum(base, 1)[:, None] + rest * (d / np.maximum(base * np.maximum(left, 1e-300), 1e-300))[:, None]
                rows[:, lang] = np.where(has[:, None], mixed, rows[:, lang])
            tables.append(rows)
            # every context of k symbols -> its own row, or that of its tail
            spread = np.tile(ids, a) if k else np.zeros(1, np.int32)
            spread[names] = total + np.arange(len(names))
            ids = spread
            total += len(names)
        self.rows = ids.astype(np.int32)
        self.table = np.empty((total * a, len(self.langs)), np.float32)
        done = 0
        for t in tables:
            t[:, :, -1] /= max(1, unseen)  # the share of one unseen byte
            self.table[done : done + len(t) * a] = -np.log2(np.maximum(t, 1e-30)).transpose(0, 2, 1).reshape(len(t) * a, len(self.langs))
            done += len(t) * a

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text (rows) in each language (columns)."""
        out = np.zeros((len(texts), len(self.langs)))
        block = max(1, BLOCK * AT_ONCE // max(AT_ONCE, len(self.langs)))
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if len(t) > block:
                for at in range(0, len(t), block):
                    before = t[max(0, at - ORDER) : at].rjust(ORDER, b"\n")
                    out[i] += self._sums([before + t[at : at + block]])[0]
                continue
            if size + len(t) > block:
                out[group] = self._sums([_START + texts[j] for j in group])
                group, size = [], 0
            if t:
                group.append(i)
                size += len(t)
        if group:
            out[group] = self._sums([_START + texts[j] for j in group])
        return out

    def _sums(self, texts: list[bytes]) -> np.ndarray:
        """texts: each with ORDER bytes of context before it."""
        if not texts:
            return np.zeros((0, len(self.langs)))
        c = self.symbol[np.frombuffer(b"".join(texts), np.uint8)]
        key = c[:-ORDER]
        for i in range(1, ORDER):
            key = key * self.symbols + c[i : len(c) - ORDER + i]
        bits = self.table[self.rows[key] * self.symbols + c[ORDER:]]
        ends = np.cumsum([len(t) for t in texts])
        starts = np.concatenate([[0], ends[:-1]])
        sums = np.concatenate([np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0, dtype=np.float64)])
        return sums[ends - ORDER] - sums[starts]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """A model of every language that docs name, from at most SAMPLE_DOCS documents of each, chosen by a hash of key and text.

    Rows without text or language teach nothing, rows that repeat key and text teach once. The model grows with the number
    of languages, not with the documents; more than LANGUAGES are an error.
    """
    known = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_kind")).where("_text is not null and _kind is not null")
    known = known.withColumn("_lot", lot(2, "_key", "_text"))
    counts = {r["_kind"]: r["n"] for r in known.groupBy("_kind").agg(F.approx_count_distinct("_lot").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages are named; a column of names of languages is needed")
    drawn = sampled(known, counts, SAMPLE_DOCS, SAMPLE_BYTES)
    model = Model({k: [t.encode("utf-8", "surrogatepass") for t in texts] for k, texts in drawn.items()})
    del drawn
    trim()
    return model


_LETTER = regex.compile(r"\p{L}").search


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "_lang") -> DataFrame:
    """docs and struct out(lang_pred, score, bits_per_byte) of each whole text.

    score is the chosen language's share if every language were as likely beforehand; ties go to the first name. Null
    texts, texts without a letter, and all texts under an empty model: und, 0.
    A column named like out is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits_per_byte double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        m = sent.value
        lang = np.full(len(texts), UNKNOWN, dtype=object)
        score, rate = np.zeros(len(texts)), np.zeros(len(texts))
        some = [i for i, t in enumerate(texts) if t and m.langs and _LETTER(t)]
        coded = [texts.iloc[i].encode("utf-8", "surrogatepass") for i in some]
        if some:
            bits = m.lengths(coded)
            best = bits.argmin(1)
            least = bits.min(1)
            lang[some] = np.array(m.langs, dtype=object)[best]
            score[some] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(1)
            rate[some] = least / np.array([len(b) for b in coded])
        return pd.DataFrame({"lang_pred": lang, "score": score, "bits_per_byte": rate})

    return docs.withColumn(out, identify(F.col(text)))
