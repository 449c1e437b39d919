"""Document fingerprints: the exact digest of a text's canonical form. DataFrame and SQL functions only.

Canonical form: Unicode compatibility composition, full case folding, composition again, runs of white space to one space,
none at the ends. Its fingerprint is 128 bits of chained, differently seeded XXH64. Documents group by fingerprint, and
inside a bucket of equal fingerprints the canonical bytes are compared: two texts that collide get fingerprints of their own
(the bucket's digits, a hyphen and the text's place among the bucket's texts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import fresh, materialize, maybe_broadcast

#: Range buckets of the neighbour search, for so many rows each, up to so many.
ROWS = 2_000
RANGES = 20_000


def canonical(text: Column) -> Column:
    """Canonical form; null counts as empty. ICU, which Spark brings along for its collations, does the Unicode part."""

    def composed(x: Column) -> Column:
        return F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(True))

    folded = F.java_method(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), composed(F.coalesce(text, F.lit(""))), F.lit(True))
    return F.trim(F.regexp_replace(composed(folded), r"\p{IsWhite_Space}+", " "))


def digest(canon: Column) -> Column:
    """32 lowercase hex digits."""
    parts = [F.lpad(F.hex(F.xxhash64(F.lit(seed), canon)), 16, "0") for seed in (1, 2)]
    return F.lower(F.concat(*parts))


def colliding(docs: DataFrame, text: str = "text") -> DataFrame:
    """(digest, canon, place) of the texts that share a digest with other texts, by their bytes; empty unless two collide.

    Copies collapse before the shuffle, so a group of copies of any size comes to one row per task.
    """
    canon = docs.select(canonical(F.col(text)).alias("_canon")).withColumn("_digest", digest(F.col("_canon")))
    each = canon.groupBy("_digest", "_canon").agg(F.lit(1).alias("_one")).drop("_one")
    place = F.row_number().over(Window.partitionBy("_digest").orderBy("_canon"))
    several = F.max("_place").over(Window.partitionBy("_digest"))
    return materialize(each.withColumn("_place", place).withColumn("_several", several).where("_several > 1").drop("_several"))


def resolve(docs: DataFrame, clashes: DataFrame | None, canon: str, out: str) -> DataFrame:
    """docs and, in column out, the fingerprint of the canonical text in column canon."""
    docs = docs.withColumn(out, digest(F.col(canon)))
    if clashes is None:
        return docs
    d, c, p = fresh(docs, "_d", "_c", "_p")
    few = clashes.select(F.col("_digest").alias(d), F.col("_canon").alias(c), F.col("_place").alias(p))
    joined = docs.join(maybe_broadcast(few, 1_000), (F.col(out) == F.col(d)) & (F.col(canon) == F.col(c)), "left")
    return joined.withColumn(out, F.concat_ws("-", out, F.col(p).cast("string"))).drop(d, c, p)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """docs and the fingerprint of each whole text: equal exactly if the canonical texts are equal. Null counts as empty.

    Repeated rows have equal fingerprints; other columns stay as they are, but for one named like out, which is replaced; an
    empty table stays empty.
    """
    found = colliding(docs, text)
    (canon,) = fresh(docs, "_canon")
    return resolve(docs.withColumn(canon, canonical(F.col(text))), None if found.isEmpty() else found, canon, out).drop(canon)


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(fingerprint, n, first id) of each group of equal canonical texts."""
    return fingerprints(docs.select(doc_id, text), text).groupBy("fingerprint").agg(F.count("*").alias("n"), F.min(doc_id).alias(f"first_{doc_id}"))


def _cuts(ids: DataFrame, n: int, total: int) -> list:
    """Up to n ids, the least first, that cut ids(_key), none null, into about equal ranges."""
    least = ids.agg(F.min("_key")).first()[0]
    if n == 1:
        return [least]
    if isinstance(ids.schema["_key"].dataType, IntegralType):
        found = ids.agg(F.percentile_approx("_key", [i / n for i in range(1, n)], 20 * n)).first()[0]
    else:
        share = min(1.0, 20 * n / total)
        drawn = sorted(r[0] for r in ids.sample(share, seed=1).collect())
        found = [drawn[len(drawn) * i // n] for i in range(1, n)] if drawn else []
    return sorted({least, *found})


def beside(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, next text) in ascending order of id, which may be of any type that has one; the first document follows the last. Null ids come first.

    One shuffle: rows go to ranges of ids, and the first document of a range goes to the range before it as well. Equal ids
    stand in the order of their texts, and in one range.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType
    if isinstance(kind, IntegralType):
        rows = rows.withColumn("_key", F.struct(F.col("_id").isNotNull().alias("is"), F.col("_id").cast("long").alias("id")))
    else:
        rows = rows.withColumn("_key", F.struct(F.col("_id").isNotNull().alias("is"), F.col("_id").alias("id")))
    ids = docs.select(F.col(doc_id).alias("_key")).where("_key is not null")
    total, none = ids.count(), not rows.where("_id is null").isEmpty()
    if not total and not none:
        return rows.select("_id", "_text", F.col("_text").alias("_next"))
    cuts = _cuts(ids, max(1, min(RANGES, total // ROWS)), total) if total else []
    kind_ = rows.schema["_key"].dataType["id"].dataType
    start = lambda x: F.struct(F.lit(x is not None).alias("is"), F.lit(x).cast(kind_).alias("id"))
    starts = [start(x) for x in ([None] if none else []) + cuts]
    n = len(starts)
    known = F.array(*starts)
    # binary search: the last start that is not above the key
    steps = [1 << i for i in reversed(range(max(1, (n - 1).bit_length())))]
    place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(F.when(at + step < n, F.get(known, at + step) <= F.col("_key")).otherwise(False), at + step).otherwise(at))
    rows = rows.withColumn("_range", place)
    own = F.struct(F.col("_range").alias("range"), F.lit(0).alias("halo"))
    before = F.struct(F.pmod(F.col("_range") - 1, F.lit(n)).alias("range"), F.lit(1).alias("halo"))
    both = F.when(F.get(known, F.col("_range")) == F.col("_key"), F.array(own, before)).otherwise(F.array(own))
    dealt = rows.withColumn("_to", F.explode(both)).select("_id", "_text", "_key", "_to.range", "_to.halo")
    after = F.lead("_text").over(Window.partitionBy("range").orderBy("halo", "_key", "_text"))
    return dealt.withColumn("_next", after).where("halo = 0").select("_id", "_text", "_next")


def edited(text: Column, next_text: Column) -> Column:
    """The last quarter (rounded down) of the code points replaced by the first as many, or all, of the next text."""
    quarter = F.floor(F.char_length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - quarter), F.substring(next_text, F.lit(1), quarter))
