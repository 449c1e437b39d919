"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks. DataFrame functions only.

The mix has as many blocks of equal size as its words need. Sources that are small or that the mix takes as often as it may
get their share in single words, by the same rule, so none is lost because a block is too large for it. The other blocks go to sources by highest quotients target / (2 k + 1),
and each source's blocks go on to its shards (hash ranges of its documents) by the same rule, which makes an integer quota
per shard. In a shard the documents lie on a line in seeded order, cut into blocks: the quota takes the whole line as often
as it goes into it, and of what is left the blocks that a seeded permutation puts first. Every word of a document is taken
as often as the blocks over it are.

Only (id, source, size, hash) rows are shuffled, texts at most once and on demand, and no window spans more than a shard's
documents or a source's shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, maybe_broadcast

#: Times that the mix may take any word.
REPEATS = 3
#: Words per block at most; small mixes have BLOCKS blocks or single words.
BLOCK = 1024
BLOCKS = 1 << 20
#: Words per shard at least (smaller sources get single words instead of blocks), and shards of all sources together (about) at most.
SHARD = 1 << 16
SHARDS = 1 << 16
#: Weights of the sources by code point, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
SEED = 20


def _prime_from(n: int) -> int:
    while any(n % i == 0 for i in range(2, int(n**0.5) + 1)):
        n += 1
    return n


#: Primes, so prime to any number of blocks below themselves: a shard steps through its blocks by one that the seed draws.
STRIDES = [_prime_from(2_200_000_001 + i * 123_456_789) for i in range(12)]


def words(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _digits(digest: Column, first: int) -> Column:
    """A number of 60 bits from a hex digest's digits; SQL engines share MD5, but no faster hash."""
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def apportion(rows: DataFrame, by: list[str], order: list[Column], votes: str, seats: str, total: str, cap: str) -> DataFrame:
    """rows and a column seats: their share of total by highest quotients votes / (2 k + 1), none above its cap.

    total: a column that is the same in all rows of a group (by). The divisor method can't move a row further from its
    exact quota q than q * n / seats + 2, so only quotients in that range are ranked: a few per row.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    named = rows.withColumn("_all", F.sum(votes).over(group)).withColumn("_n", F.count("*").over(group))
    exact = F.when((F.col("_all") > 0) & (F.col(total) > 0), F.col(votes) / F.col("_all") * F.col(total)).otherwise(0.0)
    slack = F.when(F.col(total) > 0, exact * F.col("_n") / F.col(total)).otherwise(0.0) + 2
    named = named.withColumn("_low", F.least(F.col(cap), F.greatest(F.lit(0), F.floor(exact - slack))).cast("long"))
    named = named.withColumn("_high", F.greatest("_low", F.least(F.col(cap), F.ceil(exact + slack))).cast("long"))
    named = named.withColumn("_left", F.col(total) - F.sum("_low").over(group))
    numbers = F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1))
    named = named.withColumn("_k", F.explode_outer(numbers))
    quotient = F.when(F.col("_k").isNotNull(), F.col(votes) / (2 * F.col("_k") + 1))
    ranked = named.withColumn("_rank", F.row_number().over(group.orderBy(quotient.desc_nulls_last(), *order, "_k")))
    won = F.sum((F.col("_k").isNotNull() & (F.col("_rank") <= F.col("_left"))).cast("long"))
    keys = [c for c in rows.columns]
    return ranked.groupBy(*keys, "_low").agg(won.alias("_won")).select(*keys, (F.col("_low") + F.col("_won")).alias(seats))


def targets(sizes: DataFrame) -> DataFrame:
    """(_source, source_size) with weight, target and cap: the sum of all sizes shared by weight, none above REPEATS times its size.

    With sources in ascending order of cap / weight those that reach their cap come first, so one running sum finds the
    level at which the rest share what is left. One row per source.
    """
    every = Window.partitionBy(F.lit(1))
    rank = F.row_number().over(every.orderBy(F.col("_source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(rank - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    out = sizes.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(REPEATS)))
    order = every.orderBy(F.col("_cap") / F.col("weight"), F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    out = out.withColumn("_level", level)
    # the level of the first source that stays below its cap holds for all after it
    free = F.min(F.when(F.col("_cap") >= F.col("_level") * F.col("weight"), F.struct(F.col("_cap") / F.col("weight"), "_level"))).over(every)
    return out.withColumn("target", F.coalesce(F.least("_cap", free["_level"] * F.col("weight")), F.col("_cap"))).drop("_level", "_cap")


def plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", carry: bool = False) -> DataFrame:
    """(id, source, size, source_size, target, taken) of every document of the mix; with carry also a struct row of all columns.

    size: words of the text (null: 0). Null is a source of its own. taken: words that the mix takes of the document,
    repeats counted, at most REPEATS times its size; the sum over a source differs from its target by about a block, or by
    about a word if the source has at most SHARD words or the target is REPEATS times its size.
    Repeated rows count as documents each. A source without words has target 0. An empty table gives an empty one.
    Reruns agree: order and choice depend on the seed, the ids and the texts only.
    """
    digest = F.md5(F.concat_ws("\x01", F.lit(str(SEED)), _text(doc_id), _text(text)))
    narrow = [F.col(doc_id).alias("_id"), F.col(source).alias("_source"), words(F.col(text)).alias("_size"), _digits(digest, 1).alias("_lot"), _digits(digest, 16).alias("_turn")]
    sized = materialize(docs.select(*narrow))
    sizes = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    every = Window.partitionBy(F.lit(1))
    sources = targets(sizes).withColumn("_total", F.sum("source_size").over(every))
    sources = sources.withColumn("_block", F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.col("_total") / BLOCKS))).cast("long"))
    alone = (F.col("source_size") <= SHARD) | (F.col("target") >= F.col("source_size") * REPEATS)
    sources = sources.withColumn("_unit", F.when(alone, F.lit(1).cast("long")).otherwise(F.col("_block")))
    sources = sources.withColumn("_singles", F.coalesce(F.round(F.sum(F.when(alone, F.col("target"))).over(every)), F.lit(0)).cast("long"))
    sources = sources.withColumn("_alone", alone)
    sources = sources.withColumn("_units", F.when(F.col("_alone"), F.col("_singles")).otherwise(F.round((F.col("_total") - F.col("_singles")) / F.col("_block"))).cast("long"))
    sources = sources.withColumn("_most", F.ceil(F.col("source_size") * REPEATS / F.col("_unit")).cast("long"))
    sources = apportion(sources, ["_alone"], [F.col("_source").asc_nulls_last()], "target", "_quota", "_units", "_most")
    least = F.greatest(F.lit(SHARD), F.floor(F.col("_total") / SHARDS))
    sources = materialize(sources.withColumn("_shards", F.greatest(F.lit(1), F.floor(F.col("source_size") / least)).cast("long")))

    split = maybe_broadcast(sources.select(F.col("_source").alias("_s"), "_shards"))

    def placed(rows: DataFrame) -> DataFrame:
        joined = rows.join(split, F.col("_source").eqNullSafe(F.col("_s")))
        return joined.withColumn("_shard", F.pmod("_lot", F.col("_shards"))).drop("_s", "_shards")

    shards = placed(sized).groupBy("_source", "_shard").agg(F.sum("_size").alias("_words"))
    about = sources.select(F.col("_source").alias("_s"), "source_size", "target", "_block", "_unit", "_quota")
    shards = shards.join(maybe_broadcast(about), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    shards = shards.withColumn("_most", F.ceil(F.col("_words") * REPEATS / F.col("_unit")).cast("long"))
    shards = materialize(apportion(shards, ["_source"], [F.col("_shard")], "_words", "_seats", "_quota", "_most").drop("_quota", "_most"))

    line = Window.partitionBy("_source", "_shard").orderBy("_turn", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    rows = docs.select(*narrow, F.struct("*").alias("_row")) if carry else sized
    laid = placed(rows).withColumn("_end", F.sum("_size").over(line)).withColumn("_start", F.col("_end") - F.col("_size"))
    shards = shards.withColumn("_drawn", _digits(F.md5(F.concat_ws("\x01", F.lit(str(SEED)), _text("_source"), _text("_shard"))), 1)).withColumn("_stride", _stride())
    keys = shards.select(F.col("_source").alias("_s"), F.col("_shard").alias("_h"), "_words", "source_size", "target", "_block", "_unit", "_seats", "_drawn", "_stride")
    laid = laid.join(keys, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_h")))
    return laid.select(F.col("_id").alias(doc_id), F.col("_source").alias(source), F.col("_size").alias("size"), "source_size", "target", _taken().alias("taken"), *([F.col("_row").alias("row")] if carry else []))


def _stride() -> Column:
    """The step through a shard's full blocks: of the primes in an order that the shard draws, the first that isn't almost a multiple of their number, as such a step would take neighbours one after the other."""
    full = F.greatest(F.lit(1).cast("long"), F.floor(F.col("_words") / F.col("_block")).cast("long"))
    steps = F.transform(F.array(*[F.lit(x) for x in STRIDES]), lambda x: F.pmod(x, full))
    turned = F.transform(F.sequence(F.lit(0), F.lit(len(STRIDES) - 1)), lambda i: F.get(steps, F.pmod(i + F.col("_drawn"), F.lit(len(STRIDES))).cast("int")))
    scattered = F.filter(turned, lambda x: x.between(full / 6, full - full / 6))
    return F.coalesce(F.get(scattered, F.lit(0)), F.get(turned, F.lit(0)))


def _taken() -> Column:
    """Words taken of the document on [_start, _end) of a line of _words, of which _seats times _unit words are due."""
    block = F.col("_block")
    due = F.least(F.col("_seats") * F.col("_unit"), F.col("_words") * REPEATS)
    passes = F.when(F.col("_words") > 0, F.floor(due / F.col("_words"))).otherwise(0).cast("long")
    rest = due - passes * F.col("_words")
    full = F.floor(F.col("_words") / block).cast("long")  # blocks; what follows them on the line is the short last one
    some = F.floor(rest / block).cast("long")  # of the full blocks, so many are taken once more,
    extra = rest - some * block  # and so many words of the next one

    def overlap(j: Column) -> Column:
        at = j * block
        turn = F.when(j >= full, full).otherwise(F.pmod(F.pmod(j, full) * F.col("_stride") + F.pmod("_drawn", full), full))
        upto = F.when(turn < some, block).when(turn == some, extra).otherwise(F.lit(0))
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("_end"), at + upto) - F.greatest(F.col("_start"), at))

    touched = F.sequence(F.floor(F.col("_start") / block).cast("long"), F.floor((F.col("_end") - 1) / block).cast("long"))
    once_more = F.aggregate(F.transform(touched, overlap), F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(F.col("_size") == 0, F.lit(0).cast("long")).otherwise(passes * F.col("_size") + F.when(rest > 0, once_more).otherwise(F.lit(0).cast("long")))


def duckdb_sql() -> str:
    """The same in DuckDB for the documents table: every quotient is ranked, and every block laid out."""

    def shared(rows: str, by: str, votes: str, most: str, total: str, order: str) -> str:
        quotients = f"SELECT *, {votes} / (2 * k + 1) AS q FROM (SELECT *, unnest(range({most}::BIGINT)) AS k FROM {rows})"
        return f"SELECT * EXCLUDE (k, q) FROM ({quotients}) QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY q DESC, {order}, k) <= {total}"

    number = lambda x, first: f"('0x' || substr({x}, {first}, 15))::BIGINT"
    return f"""
WITH d AS (SELECT *, {number('h', 1)} AS lot, {number('h', 16)} AS turn FROM (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
  md5('{SEED}' || chr(1) || coalesce(doc_id::VARCHAR, '') || chr(1) || coalesce(text, '')) AS h FROM documents)),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, (ARRAY{list(WEIGHTS)})[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS weight FROM d GROUP BY source),
s1 AS (SELECT *, source_size * {float(REPEATS)}::DOUBLE AS cap, sum(source_size) OVER ()::BIGINT AS total, row_number() OVER (ORDER BY source_size * {float(REPEATS)}::DOUBLE / weight, source NULLS LAST) AS n FROM s0),
lv AS (SELECT a.n, a.cap, a.weight, (any_value(a.total)::DOUBLE - coalesce(sum(b.cap) FILTER (b.n < a.n), 0)) / sum(b.weight) FILTER (b.n >= a.n) AS level FROM s1 a, s1 b GROUP BY a.n, a.cap, a.weight),
fr AS (SELECT arg_min(level, n) AS level FROM lv WHERE cap >= level * weight),
s2 AS (SELECT s1.*, coalesce(least(cap, level * weight), cap) AS target, greatest(1, least({BLOCK}, total // {BLOCKS})) AS block FROM s1, fr),
s3 AS (SELECT *, source_size <= {SHARD} OR target >= source_size * {REPEATS} AS alone FROM s2),
s4 AS (SELECT *, CASE WHEN alone THEN 1 ELSE block END AS unit, coalesce(round(sum(target) FILTER (alone) OVER ()), 0)::BIGINT AS singles FROM s3),
s5 AS (SELECT *, CASE WHEN alone THEN singles ELSE round((total - singles) / block) END::BIGINT AS units, ceil(source_size * {REPEATS} / unit) AS most, greatest(1, source_size // greatest({SHARD}, total // {SHARDS})) AS shards FROM s4),
q AS (SELECT source, count(*) AS quota FROM ({shared('s5', 'alone', 'target', 'most', 'units', 'source NULLS LAST')}) GROUP BY source),
s6 AS (SELECT s5.*, coalesce(quota, 0) AS quota FROM s5 LEFT JOIN q ON q.source IS NOT DISTINCT FROM s5.source),
dd AS (SELECT d.*, lot % shards AS shard, source_size, target, block, unit, quota FROM d JOIN s6 ON s6.source IS NOT DISTINCT FROM d.source),
h0 AS (SELECT source, shard, quota, unit, block, sum(size)::BIGINT AS words, ceil(sum(size) * {REPEATS} / unit) AS most FROM dd GROUP BY source, shard, quota, unit, block),
hq AS (SELECT source, shard, count(*) AS seats FROM ({shared('h0', 'source', 'words', 'most', 'quota', 'shard')}) GROUP BY source, shard),
h1 AS (SELECT h0.*, coalesce(seats, 0) AS seats, words // block AS n_full, {number(f"md5('{SEED}' || chr(1) || coalesce(h0.source, '') || chr(1) || h0.shard::VARCHAR)", 1)} AS drawn FROM h0 LEFT JOIN hq ON hq.source IS NOT DISTINCT FROM h0.source AND hq.shard = h0.shard),
h2 AS (SELECT *, greatest(1, n_full) AS f, list_transform(range({len(STRIDES)}), lambda i: {STRIDES}[(i + drawn) % {len(STRIDES)} + 1] % greatest(1, n_full)) AS steps, least(seats * unit, words * {REPEATS}) AS due FROM h1),
h3 AS (SELECT *, coalesce(list_filter(steps, lambda x: x >= f / 6 AND x <= f - f / 6)[1], steps[1]) AS stride, CASE WHEN words > 0 THEN due // words ELSE 0 END AS passes FROM h2),
h4 AS (SELECT *, due - passes * words AS rest, (due - passes * words) // block AS some_full FROM h3),
l0 AS (SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM dd),
l1 AS (SELECT l0.doc_id, l0.source, l0.size, l0.source_size, l0.target, l0.turn, e - size AS b, e, h4.* EXCLUDE (source, shard, quota, unit, most), row_number() OVER () AS r FROM l0 JOIN h4 ON h4.source IS NOT DISTINCT FROM l0.source AND h4.shard = l0.shard),
bl AS (SELECT *, unnest(range(b // block, (e - 1) // block + 1)) AS j FROM l1 WHERE size > 0 AND rest > 0),
bt AS (SELECT *, CASE WHEN j >= n_full THEN n_full ELSE ((j % f) * stride + drawn % f) % f END AS t FROM bl),
bo AS (SELECT r, sum(greatest(0, least(e, j * block + CASE WHEN t < some_full THEN block WHEN t = some_full THEN rest - some_full * block ELSE 0 END) - greatest(b, j * block))) AS more FROM bt GROUP BY r)
SELECT doc_id, source, size::BIGINT AS size, source_size, target, (passes * size + coalesce(more, 0))::BIGINT AS taken FROM l1 LEFT JOIN bo USING (r)"""
