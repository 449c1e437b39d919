"""Where a document's content begins. Windows only.

Lines come with idx (0-based place in the document), heading (struct or null), visual, leader, toc (boolean) and code: what
the line means to a look-ahead, P prose, H a sub-heading, B an end of the view (region marker, named or top heading), N
anything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P

#: Three lines of prose in view, with nothing but neutral lines between them.
_HIT = "^[PHN]*" + "N*".join(["P"] * P.PROSE_RUN)


def code(heading: Column, region: Column, prose: Column) -> Column:
    top = heading.isNotNull() & ((heading["kind"] == "named") | (heading["level"] == 1))
    return F.when(region.isNotNull() | F.coalesce(top, F.lit(False)), "B").when(prose, "P").when(heading.isNotNull(), "H").otherwise("N")


def prose_ahead(lines: DataFrame, key: str = "doc_id", order: str = "idx", codes: str = "code") -> Column:
    """Whether enough running text follows a line before the view ends."""
    ahead = Window.partitionBy(key).orderBy(order).rowsBetween(1, P.LOOK_AHEAD)
    return F.array_join(F.collect_list(codes).over(ahead), "").rlike(_HIT)


def leader_islands(leaders: DataFrame, key: str = "doc_id", order: str = "idx", gap: int = P.TOC_CHAIN) -> DataFrame:
    """leaders and island: lines at most gap apart are of one island, numbered from 0."""
    by = Window.partitionBy(key).orderBy(order)
    jump = F.coalesce((F.col(order) - F.lag(order).over(by) > gap).cast("int"), F.lit(0))
    return leaders.withColumn("_jump", jump).withColumn("island", F.sum("_jump").over(by)).drop("_jump")


def toc_end(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, toc_end): last line of the table of contents, for documents where enough leaders stand near its head."""
    whole = Window.partitionBy(key)
    anchor = F.min(F.when(F.col("toc"), F.col("idx"))).over(whole)
    near = F.when(F.col("_anchor").isNotNull(), F.col("idx").between(F.col("_anchor"), F.col("_anchor") + P.TOC_NEAR)).otherwise(F.col("idx") <= P.TOC_HEAD)
    leaders = lines.select(key, "idx", "leader", anchor.alias("_anchor")).where("leader").withColumn("_near", near)
    leaders = leaders.withColumn("_n", F.count_if("_near").over(whole)).withColumn("_first", F.min(F.when(F.col("_near"), F.col("idx"))).over(whole))
    chained = leader_islands(leaders.where((F.col("_n") >= P.TOC_LEADERS) & (F.col("idx") >= F.col("_first"))), key)
    return chained.where("island = 0").groupBy(key).agg(F.max("idx").alias("toc_end"))


def content_start(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start): idx of the first line of the content.

    In order of preference: a heading with prose behind the table of contents; a visual one, if the document sets at least
    two top sections visually; any one; the first top section; the first number; the first line.
    """
    h = F.col("heading")
    numbered = F.coalesce(h["number"].isNotNull(), F.lit(False))
    rows = lines.withColumn("_hit", numbered & prose_ahead(lines, key))
    rows = rows.join(toc_end(lines, key), key, "left")

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, F.col("idx")))

    top = numbered & (h["level"] == 1)
    found = rows.groupBy(key).agg(
        first(F.col("_hit") & (F.col("idx") > F.col("toc_end"))).alias("behind"),
        F.count_if(top & F.col("visual")).alias("tops"),
        first(F.col("_hit") & F.col("visual")).alias("visual"),
        first(F.col("_hit")).alias("any"), first(top).alias("top"), first(numbered).alias("number"),
    )
    return found.select(key, F.coalesce("behind", F.when(F.col("tops") >= P.VISUAL_TOPS, F.col("visual")), "any", "top", "number", F.lit(0)).alias("start"))


def front_split(front: DataFrame, key: str = "doc_id", order: str = "idx") -> DataFrame:
    """front and bucket: front_matter up to the first toc marker, toc from it on; the markers themselves go."""
    by = Window.partitionBy(key).orderBy(order)
    seen = F.max(F.col("toc").cast("int")).over(by)
    return front.withColumn("bucket", F.when(seen > 0, "toc").otherwise("front_matter")).where("not toc")


def excluded_tail(body: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """body and tail (boolean), bucket and item of what follows the first references line.

    From there on every references or appendices line begins an item, and all else belongs to the last item.
    """
    by = Window.partitionBy(key).orderBy(order)
    rows = body.withColumn("tail", F.coalesce(F.max((F.col("region") == "references").cast("int")).over(by) > 0, F.lit(False)))
    opens = F.col("tail") & F.coalesce(F.col("region").isin("references", "appendices"), F.lit(False))
    rows = rows.withColumn("opens", opens)
    rows = rows.withColumn("bucket", F.last(F.when(F.col("opens"), F.col("region")), ignorenulls=True).over(by))
    return rows.withColumn("item", F.when(F.col("tail"), F.sum(F.col("opens").cast("int")).over(by)))
