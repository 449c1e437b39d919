"""A document's result as nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import tree

KEPT = ("source_file", "document_type", "title", "id", "year", "end_year", "age_group", "mkb_codes")
FROM_REGISTRY = ("developer", "approval_status", "publication_date", "application_status")
OPTIONS = {"ignoreNullFields": "false"}


def section_trees(sections: DataFrame) -> DataFrame:
    """(doc_id, sections): JSON of the section tree.

    Sections stand in pre-order, so the brackets between two neighbours follow from their depths in the tree; one pass of
    windows and one ordered concatenation make the whole text.
    """
    by = Window.partitionBy("doc_id").orderBy("sec_no")
    rows = sections.withColumn("_depth", tree.depth())
    rows = rows.withColumn("_next", F.lead("_depth").over(by))
    head = F.to_json(F.struct("number", "title", "level", "text"), OPTIONS)
    opened = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"children":['))
    closed = F.when(F.col("_next").isNull(), F.repeat(F.lit("]}"), F.col("_depth")))
    closed = closed.when(F.col("_next") > F.col("_depth"), "").otherwise(F.concat(F.repeat(F.lit("]}"), F.col("_depth") - F.col("_next") + 1), F.lit(",")))
    placed = rows.withColumn("node", F.concat(opened, closed))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("sec_no", "node"))), lambda x: x["node"])
    return placed.groupBy("doc_id").agg(F.concat(F.lit("["), F.array_join(parts, ""), F.lit("]")).alias("sections"))


def documents_json(result) -> DataFrame:
    """(doc_id, source_file, json) of every document. Keys stand in a fixed order and nulls are kept; what only the registry
    knows is there only if it knows the document."""
    from .engine import BUCKETS

    base, extra = F.to_json(F.struct(*KEPT), OPTIONS), F.to_json(F.struct(*FROM_REGISTRY), OPTIONS)
    both = F.concat(F.substring(base, F.lit(1), F.length(base) - 1), F.lit(","), F.substring(extra, F.lit(2), F.length(extra) - 1))
    meta = result.metadata.select("doc_id", "source_file", F.when(F.col("registry_matched"), both).otherwise(base).alias("metadata"))
    in_order = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    item = F.struct(F.col("tbl_no"), F.struct("page", "number", "caption", "raw_text", "bbox").alias("v"))
    tables = result.tables.groupBy("doc_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]), OPTIONS).alias("tables"))
    buckets = result.excluded.groupBy("doc_id").agg(
        *[F.transform(F.array_sort(F.collect_list(F.when(F.col("bucket") == b, F.struct("item_no", "title", "text")))), lambda x: F.struct(x["title"].alias("title"), x["text"].alias("text"))).alias(b) for b in BUCKETS]
    )
    excluded = buckets.select("doc_id", F.to_json(F.struct(*BUCKETS)).alias("excluded"))
    stats = result.stats.select("doc_id", F.to_json(F.struct(*[c for c in result.stats.columns if c != "doc_id"]), OPTIONS).alias("stats"))
    warned = result.warnings.groupBy("doc_id").agg(F.to_json(F.transform(in_order("ord", "message"), lambda x: x["message"])).alias("warnings"))
    rows = meta
    for part in (section_trees(result.sections), tables, excluded, stats, warned):
        rows = rows.join(part, "doc_id", "left")
    empty = "{" + ",".join(f'"{b}":[]' for b in BUCKETS) + "}"
    parts = [("metadata", "{}"), ("sections", "[]"), ("tables", "[]"), ("excluded", empty), ("stats", "{}"), ("warnings", "[]")]
    text = F.concat(F.lit("{"), *[x for i, (c, d) in enumerate(parts) for x in (F.lit(("," if i else "") + f'"{c}":'), F.coalesce(c, F.lit(d)))], F.lit("}"))
    return rows.select("doc_id", "source_file", text.alias("json"))
