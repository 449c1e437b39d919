"""Token counts by heap-and-linked-list byte-pair merging.

A piece starts as one symbol per byte (the last one marked as word end). A heap hands out the adjacent pair of lowest rank,
leftmost first; merging it links the new symbol with its neighbours and pushes the two pairs that appear. The piece's count
is its initial symbols minus its merges: no identifier is ever looked up or emitted.
"""

from __future__ import annotations

import heapq
import json
import sys
import types
import unicodedata

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks and pieces remembered by a Python worker before it starts anew.
MEMORY = 200_000
LIMIT = 2048


class Model:
    """What of a tokenizer file the counts need. Supports the BPE files with word-end suffix, lower case and byte alphabet."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError(f"{path}: only plain byte-level BPE is supported")
        self.end = model.get("end_of_word_suffix") or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.special = [t["content"] for t in file["added_tokens"]]
        self.pattern = next(p["pattern"]["Regex"] for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if visible in Latin-1, else the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(shown)))
    return [out[b] for b in range(256)]


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after all merges."""
    n = len(symbols)
    left = list(range(-1, n - 1))
    right = list(range(1, n + 1))
    heap = [(r, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get(pair)) is not None]
    heapq.heapify(heap)
    count = n
    while heap:
        _, i, (a, b) = heapq.heappop(heap)
        j = right[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = a + b, ""
        count -= 1
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            if (r := ranks.get(pair := (symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i, pair))
        if (h := left[i]) >= 0 and (r := ranks.get(pair := (symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h, pair))
    return count


class Counter:
    """Counts tokens of texts; remembers pieces and chunks between spaces."""

    def __init__(self, model: Model):
        self.ranks, self.end = model.ranks, model.end
        self.alphabet = byte_alphabet()
        self.find = regex.compile(model.pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.special = regex.compile("|".join(map(regex.escape, model.special))) if model.special else None
        self.control = regex.compile(r"[\x1c-\x1f]")
        self.space = regex.compile(r"\p{White_Space}+")
        self.chunks: dict[str, int] = {}
        self.pieces: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        symbols = [self.alphabet[b] for b in piece.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.end
        count = merged(symbols, self.ranks)
        if len(piece) < 64:
            self.pieces[piece] = count
        return count

    def chunk(self, chunk: str) -> int:
        # lower() of a capital sigma depends on its place; the tokenizer's case mapping goes by single characters
        text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        known = self.pieces
        count = sum(known[p] if p in known else self.piece(p) for p in self.find(text))
        if len(chunk) < 64:
            self.chunks[chunk] = count
        return count

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings. White space parts pieces whatever the pattern, so chunks add up."""
        if len(self.chunks) > MEMORY:
            self.chunks.clear()
        if len(self.pieces) > MEMORY:
            self.pieces.clear()
        known = self.chunks.get
        words = self.space.split(text) if self.control.search(text) else text.split()
        counts = list(map(known, words))
        try:
            return sum(counts)
        except TypeError:
            return sum(self.chunk(w) if c is None else c for w, c in zip(words, counts))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.special:
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


def _counter(key: str, model) -> Counter:
    """The worker process's counter for a broadcast model; it outlives the task."""
    kept = sys.modules.setdefault("_docstruct_bpe", types.ModuleType("_docstruct_bpe"))
    if getattr(kept, "key", None) != key:
        kept.key, kept.counter = key, Counter(model.value)
    return kept.counter


def token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """docs and the number of tokens of each whole text, without begin, end or other added tokens.

    path: the vocabulary file, read by the driver; its merges (some MB, whatever the data) are broadcast. A special string
    inside a text is one token, as in the library's default. Null and empty texts: 0. Other columns stay as they are.
    A column named like out is replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(Model(path))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        counter = _counter(path, model)
        return pd.Series([counter.count(t) for t in texts], dtype="int64")

    return docs.withColumn(out, count(F.col(text)))
