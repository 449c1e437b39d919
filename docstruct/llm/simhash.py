"""SimHash near-duplicate groups with pivot distance tables.

A fingerprint has one bit per bit of the shingles' hashes, by majority. Two documents are linked if their fingerprints
differ in at most a radius of bits. Equal fingerprints collapse first, so a group of copies of any size counts as one row
from then on. Candidate pairs meet in buckets of tables:

- narrow (groups): 64 bits of XXH64 over three words, radius 3. Each table keys a fingerprint by three of six bit blocks;
  of six blocks, three differing bits leave three untouched, so no link is missed.
- wide (representatives): 256 bits over the distinct runs of five words. A radius of WIDE_RADIUS bits is what a similarity
  of 0.8 of the shingle sets comes to, two deviations included. Each table keys a fingerprint by a sample of its bits. Width
  and number of the tables are fixed up to 2 ** (WIDTH + SHARE) fingerprints; beyond, the keys grow by a bit whenever the
  fingerprints double and the tables follow, so that pairs meet with the same probability at any size.

Pivot tables prune the pairs of a bucket. The Hamming distances of every distinct fingerprint to fixed reference
fingerprints are worked out once, written down beside it and travel with it: of the whole 64 bits to 16 references (narrow),
or of each 16 bits to two (wide, where whole distances hardly differ). By the triangle inequality the largest coordinate
difference is a lower bound of the distance, and those of several blocks add up. Survivors are verified bit by bit. Pairs
that links found before connect already are passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat
from math import ceil, log, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from .common import BROADCAST_PAIRS, fresh, materialize, maybe_broadcast, spread_join
from .components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Words per shingle, bits and radius of the wide fingerprint: at similarity 0.8 of the sets 39 bits differ on average, give or take 6.
WIDE_SHINGLE, WIDE_BITS, WIDE_RADIUS = 5, 256, 51
#: Share of bits that agree at similarity 0.8, less one deviation, and the probability that such a pair meets.
AGREE, RECALL = 0.824, 0.99
#: Bits of a wide key, at least; binary logarithm of the fingerprints that may share one by chance.
WIDTH, SHARE = 14, 8
#: Bits per block, and references per block, of the pivot tables of narrow and wide fingerprints.
NARROW_PIVOTS, WIDE_PIVOTS = (64, 16), (16, 2)
#: Widths of the bit blocks, lowest bits first.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: A bucket of more members is dealt out as pairs of chunks of about this size.
BUCKET = 8_192
#: Shingles hashed (wide: spread to bits) at a time, which bounds the memory that a long text takes.
CHUNK = 1 << 16

_LOWER = bytes(range(256)).lower()


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash. Null or no words: 0. Fewer words than a shingle: their whole sequence is the one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(words)
    if not n:
        return 0
    total = np.zeros(64, np.int64)
    shingles = 0
    for at in range(0, max(1, n - SHINGLE + 1), CHUNK):
        part = words[at : at + CHUNK + SHINGLE - 1]
        runs = map(b" ".join, zip(*(part[i:] for i in range(SHINGLE)))) if n >= SHINGLE else [b" ".join(part)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), dtype=np.uint64)
        shingles += len(hashes)
        total += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > shingles).tobytes(), "big")


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def wide(text: str | None) -> bytes:
    """WIDE_BITS bits of SimHash of the set of shingles, each counted once; null or no words: zeros."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(words)
    if not n:
        return bytes(WIDE_BITS // 8)
    runs = map(b" ".join, zip(*(words[i:] for i in range(WIDE_SHINGLE)))) if n >= WIDE_SHINGLE else [b" ".join(words)]
    every = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, runs)), np.uint64).reshape(-1, 2)
    every = every[np.unique(every[:, 0], return_index=True)[1]]
    total = np.zeros(WIDE_BITS, np.int64)
    shingles = len(every)
    for at in range(0, shingles, CHUNK // 4):
        first = every[at : at + CHUNK // 4]
        second = first * _ODD  # the other half, from the first
        second = (second ^ (second >> np.uint64(32))) * _ODD[::-1]
        bits = np.unpackbits(np.concatenate([first, second ^ (second >> np.uint64(29))], axis=1).view(np.uint8), axis=1)
        total += bits.sum(0, dtype=np.int32)
    return np.packbits(total * 2 > shingles).tobytes()


@F.pandas_udf(BinaryType())
def _wide(texts: pd.Series) -> pd.Series:
    return pd.Series([wide(t) for t in texts], dtype=object)


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter(map(fingerprint, texts), dtype=np.uint64, count=len(texts)).view(np.int64))


def _keys():
    """One expression per table: its number and the bits of its three blocks."""
    starts = np.cumsum((0, *BLOCKS))
    block = [F.shiftrightunsigned("_fp", int(s)).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(starts, BLOCKS)]
    for number, (i, j, k) in enumerate(combinations(range(len(BLOCKS)), 3)):
        bits = F.shiftleft(block[i], BLOCKS[j] + BLOCKS[k]) + F.shiftleft(block[j], BLOCKS[k]) + block[k]
        yield F.lit(number << 40).cast("long") + bits


def pivot_distances(prints: np.ndarray, block: int, references: int) -> np.ndarray:
    """Distances (row, block, reference) of fingerprints, rows of 64-bit words, to the fixed references of each block of so many bits."""
    kind = {16: np.uint16, 64: np.uint64}[block]
    parts = prints.view(kind)
    fixed = np.random.default_rng(SEED).integers(0, 1 << block, (parts.shape[1], references), dtype=np.uint64).astype(kind)
    return np.bitwise_count(parts[:, :, None] ^ fixed[None])


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int16)


def _bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What the rows' distances are at least, by their pivot distances."""
    apart = np.maximum(x, y) - np.minimum(x, y)
    return apart.max(axis=2).sum(axis=1, dtype=np.int16)


def linked(keys: np.ndarray, prints: np.ndarray, table: np.ndarray, radius: int) -> np.ndarray:
    """Pairs of places: a spanning forest of the links between members of the same bucket. keys must be sorted; table: pivot distances."""
    root = np.arange(len(keys))
    found: list[tuple[int, int]] = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first = np.arange(len(keys))
    lag = 1
    while len(first := first[: np.searchsorted(first, len(keys) - lag)]):
        first = first[keys[first] == keys[first + lag]]
        i = first[root[first] != root[first + lag]]
        i = i[_bound(table[i], table[i + lag]) <= radius]
        i = i[_apart(prints[i], prints[i + lag]) <= radius]
        for a in i.tolist():
            if (x := top(a)) != (y := top(a + lag)):
                root[max(x, y)] = min(x, y)
                found.append((a, a + lag))
        while len(i) and not np.array_equal(up := root[root], root):
            root[:] = up
        lag += 1
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def _bits(column: pa.Array) -> np.ndarray:
    """Fingerprints of a column of longs or of bytes as rows of 64-bit words."""
    if pa.types.is_integer(column.type):
        return column.to_numpy().view(np.uint64).reshape(-1, 1)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def links(members: DataFrame, radius: int, pivots: tuple[int, int]) -> DataFrame:
    """Links (a, b) between fingerprints of members(_key, _fp, _pivots) that share a key, enough of them to join all that are connected.

    Buckets over BUCKET members are dealt out as pairs of chunks, so no task gets a whole hot bucket and no pair is lost.
    A task holds a batch and the bucket at its end.
    """
    hot = members.groupBy("_key").count().where(F.col("count") > BUCKET)
    hot = materialize(hot.select("_key", F.ceil(F.col("count") / BUCKET).cast("int").alias("_chunks")))
    if hot.isEmpty():
        buckets = members.select(F.xxhash64("_key").alias("_bucket"), "_fp", "_pivots")
    else:
        own = F.pmod(F.xxhash64("_fp"), F.col("_chunks")).cast("int")
        cells = F.transform(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda c: F.xxhash64("_key", F.least(c, own), F.greatest(c, own)))
        split = members.join(maybe_broadcast(hot), "_key", "left")
        split = split.withColumn("_cells", F.when(F.col("_chunks").isNull(), F.array(F.xxhash64("_key"))).otherwise(cells))
        buckets = split.select(F.explode("_cells").alias("_bucket"), "_fp", "_pivots")
    kind = members.schema["_fp"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints, tables = np.empty(0, np.int64), None, None

        def out(k: np.ndarray, c: pa.Array, t: pa.Array) -> pa.RecordBatch:
            table = np.frombuffer(b"".join(t.to_pylist()), np.uint8).reshape(len(k), -1, pivots[1])
            pairs = linked(k, _bits(c), table, radius)
            return pa.RecordBatch.from_arrays([c.take(pa.array(pairs[:, 0])), c.take(pa.array(pairs[:, 1]))], names=["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints = batch.column(1) if prints is None else pa.concat_arrays([prints, batch.column(1)])
            tables = batch.column(2) if tables is None else pa.concat_arrays([tables, batch.column(2)])
            if (cut := int(np.searchsorted(keys, keys[-1]))) > 0:
                yield out(keys[:cut], prints[:cut], tables[:cut])
                keys, prints, tables = keys[cut:], prints[cut:], tables[cut:]
        if len(keys):
            yield out(keys, prints, tables)

    placed = buckets.repartition("_bucket").sortWithinPartitions("_bucket")
    return placed.mapInArrow(run, f"a {kind}, b {kind}")


def narrow_members(distinct: DataFrame) -> DataFrame:
    return distinct.select(F.explode(F.array(*_keys())).alias("_key"), "_fp", "_pivots")


def samples(n: int) -> np.ndarray:
    """Places of the bits that key each table, for n fingerprints."""
    width = min(38, max(WIDTH, ceil(log2(max(2, n))) - SHARE))
    tables = ceil(log(1 - RECALL) / log(1 - AGREE**width))
    random = np.random.default_rng(SEED)
    return np.stack([random.choice(WIDE_BITS, width, replace=False) for _ in range(tables)])


def wide_members(distinct: DataFrame) -> DataFrame:
    places = samples(distinct.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            bits = np.unpackbits(_bits(batch.column(0)).view(np.uint8), axis=1)
            for number, at in enumerate(places):
                packed = np.packbits(bits[:, at], axis=1)
                key = np.zeros(len(bits), np.int64)
                for i in range(packed.shape[1]):
                    key = key << 8 | packed[:, i]
                yield pa.RecordBatch.from_arrays([pa.array(key + (number << 40)), batch.column(0), batch.column(1)], names=["_key", "_fp", "_pivots"])

    return distinct.select("_fp", "_pivots").mapInArrow(run, "_key long, _fp binary, _pivots binary")


def _prints(docs: DataFrame, doc_id: str, text: str, print_: Column) -> DataFrame:
    """(_id, _hash, _fp) of every row, written down; _hash tells texts apart that share an id."""
    few = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    return materialize(few.select("_id", "_hash", print_.alias("_fp")))


def _components(prints: DataFrame, members: Callable[[DataFrame], DataFrame], radius: int, pivots: tuple[int, int]) -> DataFrame:
    """(_fp, first) of every fingerprint: the first row, by id (nulls last) and text, of all that its links lead to."""

    @F.pandas_udf(BinaryType())
    def distances(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype=object)
        found = pivot_distances(_bits(pa.Array.from_pandas(column)), *pivots)
        return pd.Series([x.tobytes() for x in found], dtype=object)

    first = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash"))
    distinct = prints.groupBy("_fp").agg(F.min(first).alias("_least"))
    distinct = materialize(distinct.withColumn("_pivots", distances("_fp")))
    roots = materialize(components(links(members(distinct), radius, pivots))).select(F.col("node").alias("_fp"), "root")
    named = materialize(distinct.drop("_pivots").join(roots, "_fp", "left"))
    alone, several = named.where("root is null"), named.where("root is not null")
    least = several.groupBy("root").agg(F.min("_least").alias("first"))
    several = spread_join(several, least, "root", ["_fp"])
    return materialize(several.select("_fp", "first").unionByName(alone.select("_fp", F.col("_least").alias("first"))))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, _fp, component): component is the smallest id of all documents that links lead to, the own included.

    Null texts count as empty. Documents without words share fingerprint zero and are linked like any other. Repeated rows
    come back repeated. Null ids are kept; they name a component only if all its ids are null. Other columns are not read.
    An empty table gives an empty one.
    """
    prints = _prints(docs, doc_id, text, _fingerprints(F.col("_text")))
    found = spread_join(prints, _components(prints, narrow_members, RADIUS, NARROW_PIVOTS), "_fp", ["_id", "_hash"])
    return found.select(F.col("_id").alias(doc_id), "_fp", F.col("first.id").alias("component"))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay when one of each group of near copies does: the one of the smallest id (nulls last).

    Near copies: similar to 0.8 or more in their sets of five words, by the wide fingerprint's estimate, or linked by others
    that are. Documents without words make one group. Of rows that share id and text one stays. Columns stay as they are.
    """
    prints = _prints(docs, doc_id, text, _wide(F.col("_text")))
    placed = spread_join(prints, _components(prints, wide_members, WIDE_RADIUS, WIDE_PIVOTS), "_fp", ["_id", "_hash"])
    own = F.col("_id").eqNullSafe(F.col("first.id")) & (F.col("_hash") == F.col("first.hash"))
    gone = materialize(placed.where(~own).select("_id", "_hash").distinct())
    again = not prints.groupBy("_id", "_hash").count().where("count > 1").join(gone, ["_id", "_hash"], "left_anti").isEmpty()
    i, h, own_hash = fresh(docs, "_i", "_h", "_text_hash")
    few = maybe_broadcast(gone.select(F.col("_id").alias(i), F.col("_hash").alias(h)), BROADCAST_PAIRS)
    marked = docs.withColumn(own_hash, F.xxhash64(text))
    kept = marked.join(few, F.col(doc_id).eqNullSafe(F.col(i)) & (F.col(own_hash) == F.col(h)), "left_anti")
    return (kept.dropDuplicates([doc_id, own_hash]) if again else kept).drop(own_hash)
