"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.store import materialize, shared_dir

__all__ = ["BROADCAST_PAIRS", "BROADCAST_ROWS", "HOT", "WORD", "crc_mod", "fresh", "lot", "materialize", "maybe_broadcast", "part", "sampled", "shared_dir", "small", "spread_join", "table", "trim"]

#: What separates words everywhere in this subpackage unless a docstring says otherwise.
WORD = r"[^\x20\x09-\x0D]+"

#: Tables of at most this many rows (each of bounded width) may be broadcast; of two numbers per row, so many.
BROADCAST_ROWS = 20_000
BROADCAST_PAIRS = 500_000
#: Rows of one key that a task may get in a join; the rows of others are dealt out.
HOT = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows. Only for narrow tables; reads no further than it must."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its checked size allows it; else as it is, for a shuffled (skew-splittable) join."""
    return F.broadcast(df) if small(df, rows) else df


def spread_join(left: DataFrame, right: DataFrame, key: str, by: list[str], how: str = "inner", hot: int | None = None) -> DataFrame:
    """left.join(right, key, how), right having a row per key: rows of left that share a key with more than hot others are dealt out by hash of by.

    The row of right is copied for each share of such a key, of which there are few. left is counted, so it should be a
    written table.
    """
    hot = HOT if hot is None else hot
    if left.count() <= hot:
        return left.join(right, key, how)
    heavy = materialize(left.groupBy(key).count().where(F.col("count") > hot).select(key, F.ceil(F.col("count") / hot).cast("int").alias("_shares")))
    if heavy.isEmpty():
        return left.join(right, key, how)
    heavy = maybe_broadcast(heavy, BROADCAST_PAIRS)
    one = F.coalesce("_shares", F.lit(1))
    dealt = left.join(heavy, key, "left").withColumn("_share", F.pmod(F.xxhash64(*by), one).cast("int")).drop("_shares")
    copied = right.join(heavy, key, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), one - 1))).drop("_shares")
    return dealt.join(copied, [key, "_share"], how).drop("_share")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """names, changed where df has columns called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def crc_mod(column, n: int):
    """crc32 of the value as text, modulo n; null values give null."""
    return F.crc32(column.cast("string").cast("binary")) % n


def trim() -> None:
    """Gives memory that training on the driver has freed back to the system, which the C library may otherwise keep."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lot(seed: int, *columns: str) -> Column:
    """A number of 63 bits that the values of columns draw."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def part(share: float) -> int:
    """The number that such a share of all lots don't exceed."""
    return min((1 << 63) - 1, int(share * (1 << 63)))


def sampled(rows: DataFrame, sizes: dict, n: int, most_bytes: int) -> dict:
    """kind -> texts of the n rows(_kind, _lot, _text) of the lowest lots, in that order; most_bytes bounds the sum of their UTF-8 bytes over all kinds.

    sizes: distinct lots of each kind, about, by which most rows are passed over before any sorting. Rows of equal lots are one, so neither a
    repeated row nor a repeated key adds to what comes to the driver. Which texts are drawn does not depend on their length;
    a kind's share of the bytes ends its draw after the text that reaches it, so every kind has a text.
    """
    if not sizes:
        return {}
    each = max(1, most_bytes // len(sizes))
    share = F.create_map(*[F.lit(x) for k, size in sizes.items() for x in (k, part((1.5 * n + 64) / max(1, size)))])
    drawn = rows.where(F.col("_lot") <= share[F.col("_kind")])
    order = Window.partitionBy("_kind").orderBy("_lot")
    bytes_ = drawn.groupBy("_kind", "_lot").agg(F.max(F.octet_length("_text")).alias("_bytes"))
    placed = bytes_.withColumn("_n", F.row_number().over(order)).withColumn("_upto", F.sum("_bytes").over(order))
    ends = placed.where((F.col("_n") <= n) & (F.col("_upto") - F.col("_bytes") < each)).groupBy("_kind").agg(F.max("_lot").alias("_end")).collect()
    if not ends:
        return {}
    end = F.create_map(*[F.lit(x) for r in ends for x in (r["_kind"], r["_end"])])
    found = drawn.where(F.col("_lot") <= end[F.col("_kind")]).groupBy("_kind", "_lot").agg(F.max("_text").alias("_text")).collect()
    out: dict = {}
    for r in sorted(found, key=lambda r: r["_lot"]):
        out.setdefault(r["_kind"], []).append(r["_text"])
    return out
