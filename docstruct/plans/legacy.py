"""The predecessor's pipeline end to end: flat sections with their tables, and its own JSON."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import patterns as P
from ..functions import text as T
from ..operators import legacy as V1
from ..operators import lines as L
from ..operators import stats as STATS
from ..operators import tables as TB
from ..sources.store import materialize

OPTIONS = {"ignoreNullFields": "false"}


class LegacyResult:
    """Relations of documents(doc_id, source_file, first_page_text), pages and spans, as the predecessor makes them.

    parsed_at is given, as a clock would make reruns differ.
    """

    def __init__(self, documents: DataFrame, pages: DataFrame, spans: DataFrame, detected: DataFrame | None = None, parsed_at: str = "1970-01-01T00:00:00", store: bool = True, failed: DataFrame | None = None):
        self.documents, self.pages, self.spans, self.parsed_at, self.failed = documents, pages, spans, parsed_at, failed
        self.detected = detected if detected is not None else documents.sparkSession.createDataFrame([], S.DETECTED)
        self._keep = materialize if store else lambda df: df

    @cached_property
    def lines(self) -> DataFrame:
        """Lines as they stand on the page, in the order of their blocks' tops."""
        parts = F.transform(F.array_sort(F.collect_list(F.struct("span_no", "text"))), lambda s: s["text"])
        rows = self.spans.groupBy("doc_id", "page", "block_no", "line_no").agg(
            T.strip(F.array_join(parts, "")).alias("text"), F.max("size").alias("size"), F.bool_or(F.col("flags").bitwiseAND(F.lit(P.BOLD_FLAG)) != 0).alias("bold"),
            F.struct(*[f(f"bbox.{c}").alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]).alias("bbox"),
        )
        tops = rows.groupBy("doc_id", "page", "block_no").agg(F.min("bbox.y0").alias("block_y0"))
        rows = V1.reading_order(rows.join(tops, ["doc_id", "page", "block_no"])).where("text <> ''")
        return self._keep(rows.withColumn("block", F.col("block_no")).withColumn("y", F.col("bbox.y0")))

    @cached_property
    def judged(self) -> DataFrame:
        return TB.judged(self.detected, self.pages, sides=False)

    @cached_property
    def tables(self) -> DataFrame:
        """tables(doc_id, tbl_no, page, page0, top, raw_text, bbox)."""
        ok = self.judged.where("verdict = 'ok'")
        box = TB.rounded(F.col("bbox"))
        order = F.struct("page", "tbl_no")
        return ok.select("doc_id", order.alias("tbl_no"), "page", (F.col("page") - 1).alias("page0"), box[1].alias("top"), T.collapse(F.col("raw_text")).alias("raw_text"), box.alias("bbox"))

    @cached_property
    def placed(self) -> DataFrame:
        # one number in reading order: the tie of two sizes goes to the one seen first
        order = self.spans.withColumn("seq", F.col("page").cast("long") * (1 << 40) + F.col("block_no") * (1 << 26) + F.col("line_no") * (1 << 12) + F.col("span_no"))
        rows = self.lines.join(L.body_size_by_chars(order), "doc_id", "left").withColumn("body", F.coalesce("body", F.lit(P.DEFAULT_BODY)))
        rows = TB.outside(rows, self.judged.where("verdict = 'ok'").select("doc_id", "page", "bbox"))
        rows = rows.withColumn("h", V1.classify(F.col("text"), F.col("size"), F.col("bold"), F.col("body"))).withColumn("page", F.col("page") - 1)
        return self._keep(V1.placed(V1.units(rows)))

    @cached_property
    def sections(self) -> DataFrame:
        return self._keep(V1.sections(self.placed))

    @cached_property
    def excluded(self) -> DataFrame:
        return self._keep(V1.excluded(self.placed))

    @cached_property
    def attached(self) -> DataFrame:
        return self._keep(V1.attach(self.sections, self.tables))

    @cached_property
    def metadata(self) -> DataFrame:
        largest = V1.largest_line(self.lines.withColumn("page", F.col("page") - 1))
        return self._keep(V1.metadata(self.documents.join(largest, "doc_id", "left")))

    @cached_property
    def stats(self) -> DataFrame:
        per_page = self.lines.groupBy("doc_id", "page").agg(F.length(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), "\n")).alias("n"))
        total = per_page.groupBy("doc_id").agg(F.sum("n").alias("total_chars"))
        texts = self.documents.select("doc_id").join(total, "doc_id", "left").na.fill(0)
        return self._keep(V1.stats(texts, self.sections, self.excluded, self.attached))

    @cached_property
    def warnings(self) -> DataFrame:
        found = self.judged.groupBy("doc_id").agg(F.count_if(F.col("verdict") == "junk").alias("junk"), F.count_if(F.col("verdict") == "small").alias("small"))
        stray = self.attached.groupBy("doc_id").agg(F.count_if(F.col("section_id").isNull()).alias("stray"))
        m = self.metadata.select("doc_id", "title", "approval_year", "icd_10")
        rows = self.stats.join(m, "doc_id", "left").join(found, "doc_id", "left").join(stray, "doc_id", "left")
        none = F.col("sections_found") == 0
        when = {
            "V1_NO_TITLE": (F.col("title").isNull(),), "V1_NO_YEAR": (F.col("approval_year").isNull(),), "V1_NO_ICD": (F.coalesce(F.size("icd_10"), F.lit(0)) < 1,),
            "W_JUNK": (F.col("junk") > 0, "junk"), "V1_SMALL": (F.col("small") > 0, "small"), "V1_NO_SECTIONS": (none,),
            "V1_UNATTACHED": (none & (F.col("stray") > 0), "stray"), "V1_DROPPED": (~none & (F.col("stray") > 0), "stray"),
            "V1_LOWCOV": (F.col("text_coverage_pct") < P.LOW_COVERAGE, F.col("text_coverage_pct").cast("string")),
        }
        return rows.select("doc_id", STATS.raised(when))

    @cached_property
    def json(self) -> DataFrame:
        """(doc_id, source_file, json)."""
        owned = self.attached.where("section_id is not null")
        table = F.struct("table_id", "page", F.lit(True).alias("raw"), "raw_text", "bbox")
        tables = owned.groupBy("doc_id", "section_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("tbl_no", table.alias("t")))), lambda x: x["t"]).alias("tables"))
        kind = tables.schema["tables"].dataType.simpleString()
        rows = self.sections.join(tables, ["doc_id", "section_id"], "left").withColumn("tables", F.coalesce("tables", F.array().cast(kind)))
        item = F.struct("section_id", "level", "title", "text", "page_start", "page_end", "tables")
        sections = rows.groupBy("doc_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("sec_no", item.alias("s")))), lambda x: x["s"]), OPTIONS).alias("sections"))
        warned = self.warnings.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "message"))), lambda x: x["message"]).alias("warnings"))
        m = self.metadata.withColumn("parsed_at", F.lit(self.parsed_at))
        meta = m.select("doc_id", "document", "source_file", F.to_json(F.struct("title", "approval_year", "revision_year", "icd_10", "age_category", "developers", "parsed_at"), OPTIONS).alias("metadata"))
        stats = self.stats.join(warned, "doc_id", "left").withColumn("warnings", F.coalesce("warnings", F.array().cast("array<string>")))
        stats = stats.select("doc_id", F.to_json(F.struct(*[c for c in stats.columns if c != "doc_id"])).alias("stats"))
        out = self.excluded.select("doc_id", F.to_json(F.struct("toc_text", "references_text", "appendices_text")).alias("excluded"))
        all_ = meta.join(sections, "doc_id", "left").join(stats, "doc_id", "left").join(out, "doc_id", "left")
        head = F.to_json(F.struct(F.col("document").alias("doc_id"), "source_file"), OPTIONS)
        empty = '{"toc_text":"","references_text":"","appendices_text":""}'
        text = F.concat(
            F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"metadata":'), "metadata", F.lit(',"sections":'), F.coalesce("sections", F.lit("[]")),
            F.lit(',"excluded":'), F.coalesce("excluded", F.lit(empty)), F.lit(',"parse_stats":'), "stats", F.lit("}"),
        )
        return all_.select("doc_id", "source_file", text.alias("json"))
