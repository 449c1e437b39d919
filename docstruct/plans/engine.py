"""The whole plan: from layout relations to sections, excluded regions, tables, metadata, statistics, warnings and JSON.

Every step takes and gives DataFrames and stays lazy. All windows and the fold are partitioned by doc_id, which one shuffle
provides; the registry and the tables of a document join on equal keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import patterns as P
from ..functions import text as T
from ..operators import fold as FO
from ..operators import lines as L
from ..operators import quality as Q
from ..operators import start as ST
from ..operators import stats as STATS
from ..operators import tables as TB
from ..operators import tree as TR
from ..sources.store import materialize
from . import clinical  # noqa: F401  registers its profile
from .profile import Profile, create_profile

BUCKETS = ("front_matter", "toc", "references", "appendices", "other")


@dataclass
class Layout:
    """What the sources give: documents, pages, lines and, where known, detected tables and files that couldn't be read.

    documents may have secs, the seconds that reading took; failed has doc_id, source_file, error and secs.
    """

    documents: DataFrame
    pages: DataFrame
    lines: DataFrame
    detected: DataFrame | None = None
    failed: DataFrame | None = None

    @classmethod
    def from_spans(cls, documents: DataFrame, pages: DataFrame, spans: DataFrame, detected: DataFrame | None = None, failed: DataFrame | None = None) -> Layout:
        return cls(documents, pages, L.lines_from_spans(spans), detected, failed)


class Result:
    """Relations of a parsed corpus, each worked out when asked for.

    With store, those that others build on are written down when they are first asked for (see sources.store): the fold and
    the windows before it run once, however many relations are read.
    """

    def __init__(self, layout: Layout, profile: Profile, registry: DataFrame | None, store: bool = True):
        self.layout, self.profile, self.registry = layout, profile, registry
        self._keep = materialize if store else lambda df: df
        spark: SparkSession = layout.lines.sparkSession
        self._detected = layout.detected if layout.detected is not None else spark.createDataFrame([], S.DETECTED)

    # --- tables ---------------------------------------------------------------------------------------------------------
    @cached_property
    def judged(self) -> DataFrame:
        return TB.judged(self._detected, self.layout.pages)

    @cached_property
    def tables(self) -> DataFrame:
        return TB.extracted(self.judged, self.layout.lines)

    @cached_property
    def counters(self) -> DataFrame:
        return self.judged.groupBy("doc_id").agg(F.count_if(F.col("verdict") == "junk").alias("junk"), F.count_if(F.col("verdict") == "small").alias("small"))

    # --- lines ----------------------------------------------------------------------------------------------------------
    @cached_property
    def classified(self) -> DataFrame:
        """Lines outside of tables with body, visual, heading, region and their place in the document.

        All windows are by document: one shuffle (and one more where tables are known) for all of it.
        """
        rows = L.with_body(self.layout.lines.withColumn("text", T.strip(F.col("text"))).repartition("doc_id")).withColumn("body", F.coalesce("body", F.lit(P.DEFAULT_BODY)))
        rows = rows.where(L.usable(F.col("text")))
        rows = rows.withColumn("visual", T.visual(F.col("size"), F.col("bold"), F.col("body")))
        rows = rows.withColumn("heading", self.profile.heading(F.col("text"), F.col("visual"))).withColumn("region", self.profile.region(F.col("text")))
        if self.layout.detected is not None:
            ok = self.judged.where("verdict = 'ok'").select("doc_id", "page", "bbox")
            rows = TB.outside(rows, ok, F.col("heading.level") == 1)
        rows = L.with_blank_gap(rows)
        return self._keep(rows.withColumn("idx", F.row_number().over(Window.partitionBy("doc_id").orderBy("seq")) - 1))

    @cached_property
    def started(self) -> DataFrame:
        """classified with start, the idx of the first line of the content. Only the starts, a row per document, are written down."""
        rows = self.classified
        prose = L.is_prose(F.col("text"), F.col("heading"))
        seen = rows.select(
            "doc_id", "idx", "heading", "visual", L.is_leader(F.col("text")).alias("leader"), (F.col("region") == "toc").alias("_toc"),
            ST.code(F.col("heading"), F.col("region"), prose).alias("code"),
        ).withColumn("toc", F.coalesce("_toc", F.lit(False)))
        return rows.join(self._keep(ST.content_start(seen)), "doc_id")

    @cached_property
    def front(self) -> DataFrame:
        rows = self.started.where("idx < start").withColumn("toc", F.coalesce(F.col("region") == "toc", F.lit(False)))
        return ST.front_split(rows)

    @cached_property
    def body(self) -> DataFrame:
        """Lines of the content, inline headings split off and classified anew, with the excluded tail marked and what the fold needs.

        All windows are by document and in its order: one shuffle for all of it.
        """
        rows = self.started.where("idx >= start").withColumn("_parts", self.profile.parts(F.col("text")))
        rows = rows.withColumn("_split", F.size("_parts") > 1).select("*", F.posexplode("_parts").alias("part", "_text"))
        rows = rows.withColumn("text", T.strip(F.col("_text"))).where("text <> ''")
        # lines that stay whole are what they were
        for name, again in (("heading", self.profile.heading(F.col("text"), F.col("visual"))), ("region", self.profile.region(F.col("text")))):
            rows = rows.withColumn(name, F.when(F.col("_split"), again).otherwise(F.col(name)))
        rows = rows.drop("_parts", "_text", "_split").withColumn("break_before", F.col("gap_before") >= F.col("blank_gap"))
        rows = rows.withColumn("seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("idx", "part")) - 1)
        return self._keep(FO.features(ST.excluded_tail(rows), self.profile))

    @cached_property
    def placed(self) -> DataFrame:
        """(doc_id, seq, text, heading, attach_title, action, sec_no) of the lines before the excluded tail."""
        return self._keep(FO.fold(self.body.where("not tail"), carry=("text", "number", "title", "level", "attach_title")))

    # --- sections -------------------------------------------------------------------------------------------------------
    @cached_property
    def sections(self) -> DataFrame:
        """sections(doc_id, sec_no, number, title, level, text, parent_sec_no)."""
        before = Window.partitionBy("doc_id").orderBy("seq")
        rows = self.placed.withColumn("_wait", F.lag(F.struct("number", "level")).over(before)).where("sec_no is not null")
        act = F.col("action")
        title = F.when(act.isin("open", "named"), F.col("title")).when(act == "attach", F.col("attach_title")).when(act == "cont", F.col("text"))
        head = F.when(act.isin("open", "named"), F.struct("number", "level")).when(act == "attach", F.struct(F.col("_wait.number").alias("number"), F.col("_wait.level").alias("level")))

        def joined(value):
            return F.transform(F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct("seq", value.alias("v"))))), lambda x: x["v"])

        grouped = rows.groupBy("doc_id", "sec_no").agg(
            joined(title).alias("_titles"), joined(F.when(act == "body", F.col("text"))).alias("_texts"), F.max(head).alias("_head"), F.bool_or(act == "named").alias("_named")
        )
        flat = grouped.select(
            "doc_id", "sec_no", F.col("_head.number").alias("number"),
            F.when(F.col("_named"), F.col("_titles")[0]).otherwise(T.join_title(F.col("_titles"))).alias("title"),
            F.col("_head.level").alias("level"), T.norm(F.array_join("_texts", " ")).alias("text"),
        )
        return self._keep(TR.with_parents(flat))

    @cached_property
    def excluded(self) -> DataFrame:
        """excluded(doc_id, bucket, item_no, title, text)."""
        ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ")
        name = F.when(F.col("bucket") == "toc", "Оглавление").otherwise("front_matter")
        front = self.front.groupBy("doc_id", "bucket").agg(ordered.alias("text")).select("doc_id", "bucket", F.lit(0).alias("item_no"), name.alias("title"), T.norm(F.col("text")).alias("text"))
        tail = self.body.where("tail").groupBy("doc_id", "bucket", "item").agg(F.min(F.when(F.col("opens"), F.col("text"))).alias("title"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("opens"), F.struct("seq", "text")))), lambda x: x["text"]), " ").alias("text"))
        nth = F.row_number().over(Window.partitionBy("doc_id", "bucket").orderBy("item")) - 1
        tail = tail.select("doc_id", "bucket", nth.alias("item_no"), "title", T.norm(F.col("text")).alias("text"))
        nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq")) - 1
        other = self.placed.where("action = 'other'").select("doc_id", F.lit("other").alias("bucket"), nth.alias("item_no"), F.lit("unassigned").alias("title"), T.norm(F.col("text")).alias("text"))
        return self._keep(front.unionByName(tail).unionByName(other))

    # --- documents ------------------------------------------------------------------------------------------------------
    @cached_property
    def texts(self) -> DataFrame:
        full = L.page_texts(self.layout.pages, self.layout.lines)
        return self._keep(self.layout.documents.join(full, "doc_id", "left").withColumn("full_text", F.coalesce("full_text", F.lit(""))))

    @cached_property
    def metadata(self) -> DataFrame:
        return self._keep(self.profile.metadata(self.texts, self.registry))

    @cached_property
    def stats(self) -> DataFrame:
        return self._keep(STATS.coverage(self.texts, self.sections, self.excluded, self.tables))

    @cached_property
    def warnings(self) -> DataFrame:
        return STATS.warnings(self.texts, self.counters, self.metadata, self.stats)

    @cached_property
    def quality(self) -> DataFrame:
        secs = self.layout.documents.select("doc_id", "secs") if "secs" in self.layout.documents.columns else None
        return Q.documents(self.sections, self.stats, self.metadata, self.warnings, self.layout.failed, secs)

    @cached_property
    def json(self) -> DataFrame:
        """(doc_id, source_file, json): one document's result as JSON, null fields kept."""
        from .export import documents_json

        return documents_json(self)


class Engine:
    """Engine(spark, "cr").parse(layout, registry).sections and so on."""

    def __init__(self, spark: SparkSession, profile: str | Profile = "cr"):
        self.spark = spark
        self.profile = create_profile(profile) if isinstance(profile, str) else profile

    def parse(self, layout: Layout, registry: DataFrame | None = None, store: bool = True) -> Result:
        return Result(layout, self.profile, registry, store)
