"""Detected tables: validation, captions, and lines that lie in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T


def in_bounds(bbox: Column, width: Column, height: Column, sides: bool = True) -> Column:
    s = P.TABLE_SLACK
    ok = bbox["y0"].between(F.lit(-s), height + s) & bbox["y1"].between(F.lit(-s), height + s) & (bbox["y1"] > bbox["y0"]) & (bbox["x1"] > bbox["x0"])
    return ok & (bbox["x0"] >= -s) & (bbox["x1"] <= width + s) if sides else ok


def structured(grid: Column) -> Column:
    """At least two rows, two columns and four cells with content."""
    rows = F.coalesce(F.size(F.coalesce(grid, F.array().cast("array<array<string>>"))), F.lit(0))
    columns = F.coalesce(F.array_max(F.transform(grid, lambda r: F.size(r))), F.lit(0))
    cells = F.coalesce(F.size(F.filter(F.flatten(grid), lambda c: T.strip(F.coalesce(c, F.lit(""))) != "")), F.lit(0))
    return (rows >= P.TABLE_ROWS) & (columns >= P.TABLE_COLUMNS) & (cells >= P.TABLE_CELLS)


def verdict(bbox: Column, grid: Column, width: Column, height: Column, sides: bool = True) -> Column:
    """ok, junk (outside of the page) or small. sides=False: the predecessor, which doesn't look left and right."""
    inside = F.coalesce(in_bounds(bbox, width, height, sides), F.lit(False))
    return F.when(~inside, "junk").when(structured(grid), "ok").otherwise("small")


def judged(detected: DataFrame, pages: DataFrame, sides: bool = True) -> DataFrame:
    """detected and a column verdict."""
    sized = detected.join(pages.select("doc_id", "page", "width", "height"), ["doc_id", "page"], "left")
    zero = F.lit(0.0)
    return sized.withColumn("verdict", verdict(F.col("bbox"), F.col("grid"), F.coalesce("width", zero), F.coalesce("height", zero), sides)).drop("width", "height")


def rounded(bbox: Column) -> Column:
    return F.array(*[F.bround(bbox[c], 1) for c in ("x0", "y0", "x1", "y1")])


def captions(lines: DataFrame) -> DataFrame:
    """(doc_id, page, seq, number, caption, y1) of the lines that caption a table."""
    found = lines.where(F.col("text").rlike(P.TABLE_CAPTION))
    return found.select("doc_id", "page", "seq", F.regexp_extract("text", P.TABLE_CAPTION, 1).alias("number"), T.strip(F.col("text")).alias("caption"), F.col("bbox.y1").alias("y1"))


def nearest_caption(tables: DataFrame, captions: DataFrame) -> DataFrame:
    """tables with number and caption of the nearest caption above on the same page; the first of equally near ones."""
    caps = captions.select("doc_id", "page", F.col("seq").alias("_cap"), "number", "caption", F.col("y1").alias("_y1"))
    distance = F.col("bbox.y0") - F.col("_y1")
    near = (F.col("_y1") <= F.col("bbox.y0") + P.CAPTION_OVERLAP) & (distance <= P.CAPTION_DISTANCE)
    keyed = tables.select("doc_id", "page", "tbl_no", "bbox").join(caps, ["doc_id", "page"]).where(near)
    best = keyed.groupBy("doc_id", "page", "tbl_no").agg(F.min_by(F.struct("number", "caption"), F.struct(F.abs(distance), F.col("_cap"))).alias("_best"))
    joined = tables.join(best, ["doc_id", "page", "tbl_no"], "left")
    return joined.withColumn("number", F.col("_best.number")).withColumn("caption", F.col("_best.caption")).drop("_best")


def extracted(judged: DataFrame, lines: DataFrame) -> DataFrame:
    """tables(doc_id, tbl_no, page, number, caption, raw_text, bbox), numbered in reading order."""
    ok = nearest_caption(judged.where("verdict = 'ok'"), captions(lines))
    order = Window.partitionBy("doc_id").orderBy("page", "tbl_no")
    return ok.select("doc_id", (F.row_number().over(order) - 1).alias("tbl_no"), "page", "number", "caption", T.collapse(F.col("raw_text")).alias("raw_text"), rounded(F.col("bbox")).alias("bbox"))


def outside(lines: DataFrame, tables: DataFrame, keep: Column | None = None) -> DataFrame:
    """lines whose centre lies in no table of their page, and those that keep holds for.

    An equi-join on document and page with the geometry as residual condition: never a nested loop.
    """
    boxes = tables.select(F.col("doc_id").alias("_d"), F.col("page").alias("_p"), F.col("bbox").alias("_t"))
    x, y = (F.col("bbox.x0") + F.col("bbox.x1")) / 2, (F.col("bbox.y0") + F.col("bbox.y1")) / 2
    s = P.TABLE_SLACK
    within = (x >= F.col("_t.x0") - s) & (x <= F.col("_t.x1") + s) & (y >= F.col("_t.y0")) & (y <= F.col("_t.y1"))
    if keep is not None:
        within = within & ~F.coalesce(keep, F.lit(False))
    return lines.join(boxes, (F.col("doc_id") == F.col("_d")) & (F.col("page") == F.col("_p")) & within, "left_anti")
