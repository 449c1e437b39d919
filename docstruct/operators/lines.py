"""From spans to lines, and what a document's lines say about its layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T


def bold_span(flags: Column, font: Column) -> Column:
    flagged = F.coalesce(flags, F.lit(0)).bitwiseAND(F.lit(P.BOLD_FLAG)) != 0
    return flagged | F.coalesce(F.lower(font).rlike(P.BOLD_FONTS), F.lit(False))


def box(bbox: Column) -> Column:
    """The box with floats, zeros where there is none."""
    zero = F.lit(0.0)
    return F.struct(*[F.coalesce(bbox[c].cast("double"), zero).alias(c) for c in ("x0", "y0", "x1", "y1")])


def lines_from_spans(spans: DataFrame) -> DataFrame:
    """spans(doc_id, page, block_no, line_no, span_no, text, size, flags, font, bbox) -> lines with gap_before.

    Empty spans count for nothing, blank lines disappear. seq runs over the document in reading order.
    """
    kept = spans.where("text is not null and text <> ''")
    part = F.struct("span_no", "text")
    rows = kept.groupBy("doc_id", "page", "block_no", "line_no").agg(
        T.clean_line(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda s: s["text"]), "")).alias("text"),
        F.struct(*[f(f"bbox.{c}").alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]).alias("bbox"),
        F.coalesce(F.max("size"), F.lit(0.0)).alias("size"),
        F.coalesce(F.bool_or(bold_span(F.col("flags"), F.col("font"))), F.lit(False)).alias("bold"),
    )
    rows = rows.where("text <> ''").withColumn("bbox", box(F.col("bbox")))
    order = Window.partitionBy("doc_id").orderBy("page", "block_no", "line_no")
    rows = rows.withColumn("seq", F.row_number().over(order) - 1)
    return with_gaps(rows).select("doc_id", "seq", "page", "text", "bbox", "size", "bold", "gap_before")


def with_gaps(lines: DataFrame) -> DataFrame:
    """gap_before: distance to the top of the previous line of the page; 0 for its first line."""
    page = Window.partitionBy("doc_id", "page").orderBy("seq")
    return lines.withColumn("gap_before", F.coalesce(F.col("bbox.y0") - F.lag("bbox.y0").over(page), F.lit(0.0)))


def body_size(lines: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """(key, body): the most frequent rounded size of lines in range; ties go to the size seen first."""
    in_range = lines.where(F.col("size").between(*P.BODY_SIZES))
    counts = in_range.groupBy(key, F.bround("size", 1).alias("_s")).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(key).agg(F.max_by("_s", F.struct("n", -F.col("first"))).alias("body"))


def body_size_by_chars(spans: DataFrame, key: str = "doc_id", order: str = "seq", pages: int = P.V1_PAGES) -> DataFrame:
    """(key, body): the size of most characters on the first pages; ties go to the size seen first."""
    early = spans.where(F.col("page") <= pages)
    counts = early.groupBy(key, F.bround("size", 1).alias("_s")).agg(F.sum(F.length("text")).alias("n"), F.min(order).alias("first"))
    return counts.groupBy(key).agg(F.max_by("_s", F.struct("n", -F.col("first"))).alias("body"))


def blank_gap(lines: DataFrame, key: str = "doc_id", gap: str = "gap_before") -> DataFrame:
    """(key, blank_gap): the upper median of ordinary gaps, enlarged; practically infinite if there are too few."""
    low, high = P.GAP_RANGE
    gaps = F.sort_array(F.collect_list(F.when((F.col(gap) > low) & (F.col(gap) < high), F.col(gap))))
    median = F.element_at("_gaps", (F.floor(F.size("_gaps") / 2) + 1).cast("int"))
    found = lines.groupBy(key).agg(gaps.alias("_gaps"))
    return found.select(key, F.when(F.size("_gaps") < P.GAP_SAMPLES, P.NO_GAP).otherwise(median * P.GAP_FACTOR).alias("blank_gap"))


def with_body(lines: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """lines and body, as body_size has it; windows by document only, so lines partitioned by document stay where they are."""
    rows = lines.withColumn("_s", F.when(F.col("size").between(*P.BODY_SIZES), F.bround("size", 1)))
    same = Window.partitionBy(key, "_s")
    seen = F.when(F.col("_s").isNotNull(), F.struct(F.count("*").over(same).alias("n"), (-F.min(order).over(same)).alias("first"), F.col("_s").alias("size")))
    return rows.withColumn("_seen", seen).withColumn("body", F.max("_seen").over(Window.partitionBy(key))["size"]).drop("_s", "_seen")


def with_blank_gap(lines: DataFrame, key: str = "doc_id", gap: str = "gap_before") -> DataFrame:
    """lines and blank_gap, as blank_gap has it, by windows."""
    low, high = P.GAP_RANGE
    rows = lines.withColumn("_g", F.when((F.col(gap) > low) & (F.col(gap) < high), F.col(gap)))
    whole = Window.partitionBy(key)
    rows = rows.withColumn("_k", F.row_number().over(whole.orderBy(F.col("_g").asc_nulls_last()))).withColumn("_n", F.count("_g").over(whole))
    median = F.max(F.when(F.col("_k") == F.floor(F.col("_n") / 2) + 1, F.col("_g"))).over(whole)
    return rows.withColumn("blank_gap", F.when(F.col("_n") < P.GAP_SAMPLES, P.NO_GAP).otherwise(median * P.GAP_FACTOR)).drop("_g", "_k", "_n")


def page_texts(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, full_text): the pages' lines, a line break between lines and between pages, empty pages included."""
    per_page = lines.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), "\n").alias("_text"))
    joined = pages.select("doc_id", "page").join(per_page, ["doc_id", "page"], "left")
    parts = F.array_sort(F.collect_list(F.struct("page", F.coalesce("_text", F.lit("")).alias("text"))))
    return joined.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("full_text"))


def usable(text: Column) -> Column:
    """Neither blank nor a bare page number."""
    return (text != "") & ~text.rlike(P.PAGE_NUMBER)


def is_leader(text: Column) -> Column:
    return text.rlike(P.LEADER)


def is_prose(text: Column, heading: Column) -> Column:
    """A line of running text: no heading, page number or leader, and with a letter."""
    return heading.isNull() & usable(text) & ~is_leader(text) & text.rlike(P.LETTER)
