"""The profile of clinical guidelines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..operators import registry as R
from .profile import HEADING, Profile, register


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def body_fragment(title: Column) -> Column:
    """Citations, grades of evidence or a stray closing bracket: part of a sentence, no title."""
    return title.rlike(P.CITATION) | title.rlike(P.EVIDENCE) | (T.count_of(title, ")") > T.count_of(title, "("))


def valid_number(number: Column) -> Column:
    return ~number.rlike(P.DATE_LIKE) & T.top_int(number).between(1, P.MAX_TOP) & (T.level(number) <= P.MAX_DEPTH)


def valid_main_title(title: Column, top: Column) -> Column:
    """The first main section whose title matches, in whole or by its first words, decides by its numbers."""

    def decide(low: Column) -> Column:
        out = F.when(low.rlike(P.FORBIDDEN_START), False)
        for name, numbers in P.MAIN_SECTIONS:
            out = out.when(low.startswith(name) | F.lit(name).startswith(F.concat(low, F.lit(" "))), top.isin(*numbers))
        return out.otherwise(False)

    return T.let(F.lower(T.norm(title)), decide)


def number_of(text: Column, pattern: str) -> Column:
    """Group 1 without spaces; null if the pattern doesn't match."""
    return F.nullif(F.regexp_replace(F.regexp_extract(text, pattern, 1), r"(?U)\s+", ""), F.lit(""))


def _heading(kind: str, number: Column, title: Column, level: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), number.alias("number"), title.alias("title"), level.cast("int").alias("level"))


class ClinicalGuideline(Profile):
    document_type = "clinical_recommendation"

    def numbered(self, text: Column, visual: Column) -> Column:
        """text: normalised."""

        def decide(m: Column) -> Column:
            number, title = m["number"], m["title"]
            top = (F.length(title) <= P.TOP_TITLE) & valid_main_title(title, T.top_int(number))
            sub = (F.length(title) <= P.SUB_TITLE) & (visual | T.first_upper(title))
            ok = number.isNotNull() & (title != "") & ~title.rlike(P.FORBIDDEN_START) & ~body_fragment(title) & valid_number(number)
            return F.when(ok & F.when(T.level(number) == 1, top).otherwise(sub), _heading("numbered", number, title, T.level(number)))

        found = F.struct(number_of(text, P.NUMBERED).alias("number"), T.norm(F.regexp_extract(text, P.NUMBERED, 2)).alias("title"))
        return T.let(found, decide)

    def number_only(self, text: Column) -> Column:
        def decide(number: Column) -> Column:
            return F.when(number.isNotNull() & valid_number(number), _heading("number_only", number, F.lit(""), T.level(number)))

        return T.let(number_of(text, P.NUMBER_ONLY), decide)

    def named(self, text: Column, visual: Column) -> Column:
        ok = self.named_id(text).isNotNull() & visual & (F.length(text) <= P.NAMED_TITLE)
        return F.when(ok, _heading("named", F.lit(None).cast("string"), text, F.lit(1)))

    def heading(self, text: Column, visual: Column) -> Column:
        def decide(t: Column) -> Column:
            barred = (t == "") | t.rlike(P.FORBIDDEN_START) | t.rlike(P.LEADER) | t.rlike(P.CAPTION)
            return F.when(~barred, F.coalesce(self.numbered(t, visual), self.number_only(t), self.named(t, visual)))

        return T.let(T.norm(text), decide).cast(HEADING)

    def region(self, text: Column) -> Column:
        return F.when(text.rlike(P.TOC), "toc").when(text.rlike(P.REFERENCES), "references").when(text.rlike(P.APPENDICES), "appendices")

    def named_id(self, title: Column) -> Column:
        return F.coalesce(*[F.when(title.rlike(p), F.lit(name)) for p, name in P.NAMED])

    def continuation(self, text: Column) -> Column:
        def decide(t: Column) -> Column:
            low = F.lower(t)
            may = (t != "") & ~t.rlike(P.FORBIDDEN_START) & ~t.rlike(P.LEADER) & ~t.rlike(P.CONTINUATION_STOP) & (F.length(t) <= P.CONTINUATION_LINE)
            always = any_of(low.startswith(p) for p in P.CONTINUATION_STARTS) | (T.first_lower(t) & (F.length(t) < P.LOWER_LINE))
            at_top = (F.length(t) < P.KEYWORD_LINE) & any_of(low.contains(w) for w in P.CONTINUATION_WORDS)
            return F.struct(may.alias("may"), always.alias("always"), at_top.alias("at_top"), t.contains(")").alias("closes"))

        return T.let(T.norm(text), decide)

    def attaches(self, title: Column, visual: Column, number: Column, level: Column) -> Column:
        def decide(t: Column) -> Column:
            barred = (t == "") | t.rlike(P.FORBIDDEN_START) | t.rlike(P.LEADER) | t.rlike(P.ATTACH_STOP) | body_fragment(t)
            barred = barred | self.numbered(t, F.lit(True)).isNotNull() | self.number_only(t).isNotNull()
            sub = (F.length(t) <= P.SUB_TITLE) & (visual | T.first_upper(t))
            return F.coalesce(~barred & F.when(level == 1, valid_main_title(t, T.top_int(number))).otherwise(sub), F.lit(False))

        return T.let(T.norm(title), decide)

    def parts(self, text: Column) -> Column:
        def decide(found: Column) -> Column:
            return F.when(F.size(found) > 1, F.filter(F.transform(found, T.norm), lambda p: p != ""))

        return F.coalesce(T.let(F.split(T.norm(text), P.INLINE_SPLIT, -1), decide), F.array(text))

    # --- metadata -------------------------------------------------------------------------------------------------------
    def title_page(self, texts: DataFrame) -> DataFrame:
        """texts(doc_id, source_file, full_text, first_page_text) and what the title page says."""
        full, first = F.coalesce("full_text", F.lit("")), F.coalesce("first_page_text", F.lit(""))
        rows = texts.withColumn("_rows", F.filter(F.transform(T.split_lines(first), T.strip), lambda x: x != ""))
        mark = F.array_position(F.transform("_rows", lambda x: F.lower(x).contains(P.TITLE_MARK)), F.lit(True))
        after = F.when(mark > 0, F.slice("_rows", (mark + 1).cast("int"), F.lit(5)))
        titles = F.filter(after, lambda x: (F.length(x) > 5) & ~F.lower(x).startswith("год") & ~F.lower(x).startswith("id"))
        segment = F.when(full.rlike(P.CODES_BLOCK), F.regexp_extract(full, P.CODES_BLOCK, 1)).otherwise(F.regexp_extract(full, P.CODES_LINE, 1))
        return rows.select(
            "doc_id", "source_file",
            F.nullif(T.norm(F.get(titles, F.lit(0))), F.lit("")).alias("title"),
            self.document_id(F.col("source_file"), first).alias("id"),
            T.group(full, P.YEAR).alias("year"), T.group(full, P.END_YEAR).alias("end_year"),
            F.nullif(T.norm(F.regexp_extract(full, P.AGE, 1)), F.lit("")).alias("age_group"),
            T.icd_codes(segment).alias("mkb_codes"),
        )

    @staticmethod
    def document_id(source_file: Column, first_page: Column) -> Column:
        """From the file's name, marked or not, else from the title page."""
        stem = F.regexp_replace(source_file, r"(?iU)\.pdf$", "")
        return F.coalesce(T.group(stem, P.ID_IN_NAME), T.group(stem, P.ID_ANY), T.group(first_page, P.ID_ON_PAGE))

    @staticmethod
    def told(registry: DataFrame) -> DataFrame:
        """registry with what each row says about a document in place of the row itself."""
        value = R.values(F.col("row"), P.ALIASES)

        def says(v: Column) -> Column:
            return F.struct(
                v["title"].alias("title"), F.coalesce(v["year"], T.group(v["published"], P.PUBLICATION_YEAR)).alias("year"), v["age"].alias("age"),
                F.when(v["codes"].isNotNull(), T.icd_codes(v["codes"])).alias("codes"), F.regexp_replace(v["developer"], r"(?U)\.\s*,", ",").alias("developer"),
                v["approval"].alias("approval"), v["published"].alias("published"), v["application"].alias("application"),
            )

        return registry.select("ord", "id", F.when(F.col("row").isNotNull(), T.let(value, says)).alias("row"))

    def metadata(self, texts: DataFrame, registry: DataFrame | None = None) -> DataFrame:
        """Metadata of each document: the registry's word before the title page's, except for the year.

        A registry's row is read once and each distinct id looked up once; documents meet what was found by their id.
        """
        page = self.title_page(texts).withColumn("_p", T.norm(F.col("id")))
        if registry is None:
            empty = texts.sparkSession.range(0).selectExpr("cast(null as int) as ord", "cast(null as string) as id", "cast(null as map<string,string>) as row")
            row = self.told(empty).schema["row"].dataType
            known, joined = F.lit(False), page.withColumn("_rid", F.lit(None).cast("string")).withColumn("row", F.lit(None).cast(row))
        else:
            known = F.lit(not registry.isEmpty())
            found = R.best(page, self.told(registry)).withColumnRenamed("id", "_rid")
            joined = page.join(found, "_p", "left")
        said = F.col("row")
        return joined.select(
            "doc_id", "source_file", F.lit(self.document_type).alias("document_type"),
            F.coalesce(said["title"], "title").alias("title"), F.coalesce("_rid", "id").alias("id"),
            F.coalesce("year", said["year"]).alias("year"), "end_year",
            F.coalesce(said["age"], "age_group").alias("age_group"), F.coalesce(said["codes"], "mkb_codes").alias("mkb_codes"),
            said["developer"].alias("developer"), said["approval"].alias("approval_status"), said["published"].alias("publication_date"),
            said["application"].alias("application_status"), said.isNotNull().alias("registry_matched"), known.alias("registry_known"), F.col("id").alias("probe"),
        )


register("cr", ClinicalGuideline)
