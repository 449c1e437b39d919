"""Benchmark decontamination: the CGK embedding of edit distance into Hamming distance, bit-sampling LSH, exact verification.

Texts and items are sequences of words. A document holds an item if some run of its words is within an edit distance (in
words) of a fifth of the item's length, rounded down: items of fewer than five words must occur as they are. Items of more
than SPAN words are looked for by pieces of at most so many; an item within its bound has a piece within the piece's. The
search goes by windows as long as a piece:

1. Windows. A piece of L words that has at most t edits keeps a run of floor(L / (t + 1)) words, so only windows that are
   aligned with such a run (of up to GRAM words) of a piece are looked at. This loses nothing.
2. CGK. A window and the pieces walk through random step functions: at each of 1.8 L steps the current word is put out, and
   a coin that depends on step and word decides whether to go on to the next word. Sequences of small edit distance fall
   into step again after each edit, so their walks agree in many places.
3. LSH. TABLES samples of SAMPLE places of each of WALKS walks; a window meets the pieces of its length that agree in all
   places of any one sample. The places of a sample stand in different parts of the walk, so that items which share no more
   than their opening don't meet everything that begins alike. A piece without edits meets by the digest of its words.
4. Whatever meets and has enough words in common is verified by the exact edit distance of the piece, then of the item, to all runs of words about the
   window.

Equal windows and equal items are worked on once, and all pairs of a length together, CELLS numbers at a time: neither many
occurrences of a common run nor many items that share one make memory grow.

Words: maximal runs between ASCII white space and punctuation, lower case. Each sign of a script that is written without
spaces (Han, kana, Thai, Lao, Khmer, Burmese) is a word.
"""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of an item's words that may be edited.
EDITS = 0.2
GRAM = 4
#: Words of a piece at most; longer items are cut.
SPAN = 48
WALKS = 12
TABLES = 12
SAMPLE = 3
SEED = 7
#: Items and their UTF-8 bytes per pass over the documents; a larger benchmark is searched for in several passes.
ITEMS = 20_000
ITEM_BYTES = 16_000_000
#: Words searched at a time.
BLOCK = 1 << 18
#: Numbers in any one array of windows, pairs or distances, about.
CELLS = 1 << 21
#: Indexes that a worker process keeps.
KEPT = 4

_SPACE = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
#: Thai and Lao, Burmese, Khmer, signs and kana, Han, full-width signs, Han beyond the first plane.
_ALONE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uff0f\U00020000-\U0003ffff]")
_SIGN = re.compile(r"[\u3000-\u303f\uff00-\uff0f]")


def words(text: str | None) -> list[bytes]:
    low = (text or "").lower()
    if not low.isascii() and _ALONE.search(low):
        low = _ALONE.sub(r" \g<0> ", _SIGN.sub(" ", low))
    return low.encode("utf-8", "surrogatepass").translate(_SPACE).split()


def allowed(size: int) -> int:
    """Edits that an item of so many words may have."""
    return int(size * EDITS + 1e-9)


def hashes(text: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, text), np.uint64, len(text)).view(np.int64)


def distances(items: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Least edit distance of each row of items (or of one item) to any stretch of the same row of runs."""
    n, width = runs.shape
    steps = np.arange(width + 1, dtype=np.int32)
    row = np.zeros((n, width + 1), np.int32)
    for i, word in enumerate(np.atleast_2d(items).T):
        best = np.empty_like(row)
        best[:, 0] = i + 1
        best[:, 1:] = np.minimum(row[:, :-1] + (runs != word[:, None]), row[:, 1:] + 1)
        row = np.minimum.accumulate(best - steps, axis=1) + steps
    return row.min(axis=1)


def masks(rows: np.ndarray) -> np.ndarray:
    """256 bits of each row of words, those set that its words fall on: a bit that a run lacks is an edit at least."""
    out = np.zeros((len(rows), 4), np.uint64)
    each = np.arange(len(rows))
    for word in rows.T.view(np.uint64):
        out[each, word >> np.uint64(6) & np.uint64(3)] |= np.uint64(1) << (word & np.uint64(63))
    return out


def _shares(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Stretches of counts that sum to about most at the most, or are a single one."""
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield slice(at, to)
        at = to


def _unroll(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts of things of several owners: the owner of each, and its place among the owner's."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


class Pieces:
    """The distinct pieces of one length: their words, the items that they are of and where they stand in them, and the tables."""

    def __init__(self, size: int, found: list[tuple[bytes, int, int]], random: np.random.Generator):
        self.size, self.edits = size, allowed(size)
        distinct: dict[bytes, int] = {}
        owners = sorted((distinct.setdefault(b, len(distinct)), item, at) for b, item, at in found)
        self.words = np.stack([np.frombuffer(b, np.int64) for b in distinct])
        self.items, self.offsets = np.array([i for _, i, _ in owners]), np.array([at for _, _, at in owners])
        self.begins = np.searchsorted([p for p, _, _ in owners], np.arange(len(distinct) + 1))
        self.masks = masks(self.words)
        steps = int(1.8 * size)
        self.odd = random.integers(0, 1 << 62, (WALKS, steps), dtype=np.int64) * 2 + 1
        self.plus = random.integers(-(1 << 63), (1 << 63) - 1, (WALKS, steps), dtype=np.int64)
        self.mix = random.integers(0, 1 << 62, max(size, SAMPLE), dtype=np.int64) * 2 + 1
        # one place in each part of the walk
        edges = [steps * k // SAMPLE for k in range(SAMPLE + 1)]
        self.places = np.stack([random.integers(a, max(a + 1, b), (WALKS, TABLES)) for a, b in zip(edges, edges[1:])], axis=-1)
        keys = self.keys(self.words)
        order = np.argsort(keys, axis=1, kind="stable")
        self.known, self.numbers = np.take_along_axis(keys, order, 1), order.astype(np.int32)

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """Keys (a row per table) of windows: the words at the sampled places of each walk, or all words if none may differ."""
        n = len(windows)
        if not self.edits:
            return (windows * self.mix[: self.size]).sum(axis=1, keepdims=True).T
        out = np.empty((WALKS * TABLES, n), np.int64)
        flat = np.concatenate([windows, np.zeros((n, 1), np.int64)], axis=1).ravel()
        base = np.arange(n) * (self.size + 1)
        end = base + self.size
        for walk, wanted in enumerate(self.places):
            need = set(wanted.ravel().tolist())
            kept: dict[int, np.ndarray] = {}
            at = base.copy()
            for step in range(max(need) + 1):
                word = flat[at]
                if step in need:
                    kept[step] = word
                # the coin of this step for this word: the top bit of a product with a number of the step's own
                at = np.minimum(at + ((word * self.odd[walk, step] + self.plus[walk, step]) < 0), end)
            for t in range(TABLES):
                key = np.zeros(n, np.int64)
                for k in range(SAMPLE):
                    key = (key + kept[int(wanted[t, k])]) * self.mix[k]
                out[walk * TABLES + t] = key
        return out

    def meet(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of windows and pieces that agree in a sample of a walk, each pair once, about CELLS of them at a time."""
        mine = self.keys(windows)
        low = np.stack([np.searchsorted(k, m, "left") for k, m in zip(self.known, mine)], axis=1)
        count = np.stack([np.searchsorted(k, m, "right") for k, m in zip(self.known, mine)], axis=1) - low
        hit = np.flatnonzero(count.any(axis=1))
        for part in _shares(count[hit].sum(axis=1), CELLS):
            some = hit[part]
            each, k = _unroll(count[some].ravel())
            table = each % len(mine)
            piece = self.numbers[table, low[some].ravel()[each] + k].astype(np.int64)
            code = np.unique(some[each // len(mine)] * len(self.words) + piece)
            yield code // len(self.words), code % len(self.words)


class Index:
    """Items to search for."""

    def __init__(self, items: list[list[bytes]]):
        random = np.random.default_rng(SEED)
        classes: dict[bytes, int] = {}
        self.items: list[np.ndarray] = []
        self.members: list[list[int]] = []  # numbers of equal items
        by_size: dict[int, list[tuple[bytes, int, int]]] = {}
        for number, text in enumerate(items):
            if not text:
                continue
            coded = hashes(text)
            if (same := classes.setdefault(coded.tobytes(), len(self.items))) < len(self.items):
                self.members[same].append(number)
                continue
            self.items.append(coded)
            self.members.append([number])
            n = ceil(len(text) / SPAN)
            cuts = [len(text) * i // n for i in range(n + 1)]
            for a, b in zip(cuts, cuts[1:]):
                by_size.setdefault(b - a, []).append((coded[a:b].tobytes(), same, a))
        self.pieces = {size: Pieces(size, found, random) for size, found in sorted(by_size.items())}
        self.grams: dict[int, tuple] = {}
        by_gram: dict[int, list[np.ndarray]] = {}
        for size, p in self.pieces.items():
            g = min(GRAM, size // (p.edits + 1))
            keys = np.stack([self._grams(w, g) for w in p.words])
            at = np.broadcast_to(np.arange(keys.shape[1]), keys.shape)
            by_gram.setdefault(g, []).append(np.stack([keys.ravel(), at.ravel(), np.full(keys.size, size)], axis=1))
        for g, found in by_gram.items():
            # where a run stands in pieces of which length: however many pieces hold it there, once
            every = np.unique(np.concatenate(found), axis=0)
            seen = np.zeros(1 << 20, bool)
            seen[every[:, 0] >> 44 & 0xFFFFF] = True
            self.grams[g] = seen, *np.ascontiguousarray(every.T)

    @staticmethod
    def _grams(x: np.ndarray, g: int) -> np.ndarray:
        if len(x) < g:
            return np.empty(0, np.int64)
        out = x[: len(x) - g + 1].copy()
        for i in range(1, g):
            out = out * np.int64(6364136223846793005) + x[i : len(x) - g + 1 + i]
        return out ^ (out >> 29)

    def search(self, texts: Iterable[list[bytes]]) -> list[tuple[int, int, int, int]]:
        """(text, item, first word of the window, edits): the best window of every item in every text.

        texts may be a generator: about BLOCK words are held at a time.
        """
        found: list[tuple[int, int, int, int]] = []
        group: list[list[bytes]] = []
        first = size = 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= BLOCK:
                found += [(first + i, *rest) for i, *rest in self._search(group)]
                first += len(group)
                group, size = [], 0
        return found + ([(first + i, *rest) for i, *rest in self._search(group)] if group else [])

    def _search(self, texts: list[list[bytes]]) -> list[tuple[int, int, int, int]]:
        sizes = np.array([len(t) for t in texts])
        x = hashes([w for t in texts for w in t])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for g, (seen, keys, offsets, lengths) in self.grams.items():
            grams = self._grams(x, g)
            at = np.flatnonzero(seen[grams >> 44 & 0xFFFFF])
            low, high = np.searchsorted(keys, grams[at], "left"), np.searchsorted(keys, grams[at], "right")
            at, low, count = at[high > low], low[high > low], (high - low)[high > low]
            for part in _shares(count, CELLS):
                owner, k = _unroll(count[part])
                which = low[part][owner] + k
                here = at[part][owner]
                start, text, length = here - offsets[which], np.searchsorted(ends, here, "right"), lengths[which]
                order = np.argsort(length, kind="stable")
                cuts = np.flatnonzero(np.diff(length[order], prepend=-1))
                for rows in np.split(order, cuts[1:]) if len(order) else []:
                    self._windows(x, begins, ends, text[rows], start[rows], self.pieces[int(length[rows[0]])], best)
        return [(t, number, at, d) for (t, same), (d, at) in best.items() for number in self.members[same]]

    def _windows(self, x, begins, ends, text, start, p: Pieces, best: dict) -> None:
        """Looks at the windows of one length that begin at start, which may be before the text, as edits shorten items."""
        code = np.unique(text * (3 * len(x) + 1) + start + len(x))
        width = p.size + 2 * p.edits
        for at in range(0, len(code), max(1, CELLS // (2 * width))):
            text, start = np.divmod(code[at : at + max(1, CELLS // (2 * width))], 3 * len(x) + 1)
            start -= len(x)
            runs = self._cut(x, begins[text], ends[text], start - p.edits, width)
            # windows of the same words are one
            _, first, same = np.unique((runs * _MIX[np.arange(width) % len(_MIX)]).sum(axis=1), return_index=True, return_inverse=True)
            runs = runs[first]
            within = masks(runs)
            windows = np.argsort(same, kind="stable")
            begin = np.searchsorted(same[windows], np.arange(len(first) + 1))
            for w, piece in p.meet(runs[:, p.edits : p.edits + p.size]):
                may = np.bitwise_count(p.masks[piece] & ~within[w]).sum(axis=1, dtype=np.int32) <= p.edits
                w, piece = w[may], piece[may]
                for some in range(0, len(w), max(1, CELLS // width)):
                    a, b = w[some : some + max(1, CELLS // width)], piece[some : some + max(1, CELLS // width)]
                    d = distances(p.words[b], runs[a])
                    a, b, d = a[d <= p.edits], b[d <= p.edits], d[d <= p.edits]
                    # every item that has the piece, and every window that is such a run
                    for part in _shares((p.begins[b + 1] - p.begins[b]) * (begin[a + 1] - begin[a]), CELLS):
                        pair, k = _unroll((p.begins[b + 1] - p.begins[b])[part] * (begin[a + 1] - begin[a])[part])
                        a_, b_ = a[part][pair], b[part][pair]
                        n = begin[a_ + 1] - begin[a_]
                        owner, window = p.begins[b_] + k // n, windows[begin[a_] + k % n]
                        self._items(x, begins, ends, text[window], start[window], d[part][pair], p, owner, best)

    def _items(self, x, begins, ends, text, start, d, p: Pieces, owner, best: dict) -> None:
        """Keeps what the pieces (numbers of owners) found in windows, for items of several pieces after their own verification."""
        item, start = p.items[owner], start - p.offsets[owner]
        order = np.lexsort((start, d, item, text))
        item, start, d, text = item[order], start[order], d[order], text[order]
        whole = np.array([len(self.items[i]) == p.size for i in item.tolist()], bool)
        first = np.flatnonzero(whole & (np.diff(text * len(self.items) + item, prepend=-1) != 0))
        for i in first.tolist():
            self._keep(best, int(text[i]), int(item[i]), int(d[i]), int(start[i] - begins[text[i]]))
        rest = np.flatnonzero(~whole)
        for size in {len(self.items[i]) for i in item[rest].tolist()}:
            some = rest[[len(self.items[i]) == size for i in item[rest].tolist()]]
            most = allowed(size)
            width = size + 2 * most
            for at in range(0, len(some), max(1, CELLS // width)):
                rows = some[at : at + max(1, CELLS // width)]
                runs = self._cut(x, begins[text[rows]], ends[text[rows]], start[rows] - most, width)
                _, first, same = np.unique((runs * _MIX[np.arange(width) % len(_MIX)]).sum(axis=1) + item[rows], return_index=True, return_inverse=True)
                found = distances(np.stack([self.items[i] for i in item[rows[first]].tolist()]), runs[first])[same]
                for i, e in zip(rows[found <= most].tolist(), found[found <= most].tolist()):
                    self._keep(best, int(text[i]), int(item[i]), e, int(start[i] - begins[text[i]]))

    @staticmethod
    def _keep(best: dict, text: int, item: int, edits: int, at: int) -> None:
        value = edits, max(0, at)
        if (text, item) not in best or value < best[text, item]:
            best[text, item] = value

    @staticmethod
    def _cut(x: np.ndarray, begin: np.ndarray, end: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
        """Windows of x as rows; 0 outside of the text that a window belongs to."""
        at = start[:, None] + np.arange(size)
        inside = (at >= begin[:, None]) & (at < end[:, None])
        return np.where(inside, x[np.clip(at, 0, len(x) - 1)], 0)


#: Multipliers of the places of a run, for its digest; runs longer than this reuse them, which places beside them tell apart.
_MIX = np.random.default_rng(SEED).integers(0, 1 << 62, 4096, dtype=np.int64) * 2 + 1


def _index(key: str, sent) -> Index:
    """The worker process's index of a broadcast set of items; it outlives the task."""
    kept = sys.modules.setdefault("_docstruct_items", types.ModuleType("_docstruct_items"))
    held = kept.__dict__.setdefault("held", {})
    if key not in held:
        while len(held) >= KEPT:
            held.pop(next(iter(held)))
        held[key] = Index(sent.value)
    return held[key]


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of the items, ITEMS or ITEM_BYTES or so at a time. Null ids and texts: left out; repeated rows: once."""
    known = items.select(F.col(item_id).alias("_id"), F.col(text).alias("_text")).where("_id is not null and _text is not null").distinct()
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("bytes")).first()
    n = max(ceil(size["n"] / ITEMS), ceil(size["bytes"] / ITEM_BYTES)) if size["n"] else 0
    for i in range(n):
        rows = known.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(n)) == i).collect()
        rows.sort(key=lambda r: (r["_text"], str(r["_id"])))
        yield [r["_id"] for r in rows], [words(r["_text"]) for r in rows]


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, at, edits, similarity): every item that a document holds, once.

    at: word of the document about which the closest run begins; similarity: 1 - edits / the item's words. Null and empty
    texts hold nothing; items without words are held by nothing. Repeated documents are found repeatedly, repeated items once
    per id and text. Each task takes a batch of documents and the items of a pass; no join, no shuffle.
    """
    spark, out = docs.sparkSession, None
    few = docs.select(F.col(doc_id).alias(doc_id), F.col(text).alias("_text"))
    kind = {doc_id: docs.schema[doc_id].dataType.simpleString(), item_id: items.schema[item_id].dataType.simpleString()}
    schema = f"`{doc_id}` {kind[doc_id]}, `{item_id}` {kind[item_id]}, at long, edits int, similarity double"
    for ids, texts in _blocks(items, item_id, item_text):
        sent, key = spark.sparkContext.broadcast(texts), uuid.uuid4().hex
        sizes = [len(t) for t in texts]

        def run(batches: Iterator[pa.RecordBatch], ids=ids, sizes=sizes, sent=sent, key=key) -> Iterator[pa.RecordBatch]:
            index = _index(key, sent)
            for batch in batches:
                found = index.search(words(t.as_py()) for t in batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([t for t, _, _, _ in found], pa.int64())),
                        pa.array([ids[i] for _, i, _, _ in found]).cast(pa.array(ids).type),
                        pa.array([at for _, _, at, _ in found], pa.int64()),
                        pa.array([d for _, _, _, d in found], pa.int32()),
                        pa.array([1 - d / sizes[i] for _, i, _, d in found], pa.float64()),
                    ],
                    names=[doc_id, item_id, "at", "edits", "similarity"],
                )

        part = few.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def held(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", out: str = "_held") -> DataFrame:
    """docs and the number of items that each holds; all else stays as it is. A column named like out is replaced."""

    def counter(texts: list[list[bytes]]):
        sent, key = docs.sparkSession.sparkContext.broadcast(texts), uuid.uuid4().hex

        @F.pandas_udf("long")
        def count(column: pd.Series) -> pd.Series:
            numbers = np.zeros(len(column), np.int64)
            for t, _, _, _ in _index(key, sent).search(words(t) for t in column):
                numbers[t] += 1
            return pd.Series(numbers)

        return count(F.col(text))

    return docs.withColumn(out, sum((counter(texts) for _, texts in _blocks(items, item_id, item_text)), F.lit(0).cast("long")))
