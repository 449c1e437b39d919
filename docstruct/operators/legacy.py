"""The predecessor's pipeline (flat sections, other heuristics), by windows only.

Lines: doc_id, seq (reading order: page, top of the block, block, line), page (0-based), block, text, size, bold, y.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T


def reading_order(lines: DataFrame) -> DataFrame:
    """lines(doc_id, page, block_no, block_y0, line_no, ...) with seq: blocks by their top, equal tops as they come."""
    return lines.withColumn("seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "block_y0", "block_no", "line_no")) - 1)


def classify(text: Column, size: Column, bold: Column, body: Column) -> Column:
    """struct(htype, number): num or named headings, null for text."""
    number = F.regexp_extract(text, P.V1_NUMBERED, 1)
    num = F.struct(F.lit("num").alias("htype"), number.alias("number"))
    named = F.struct(F.lit("named").alias("htype"), F.lit(None).cast("string").alias("number"))
    big = (size >= body * P.V1_RATIO) & (F.length(text) < P.V1_BIG_LENGTH)
    sub = bold & (F.length(text) < P.V1_BOLD_LENGTH) & ~text.rlike(P.V1_LEADER) & text.rlike(P.V1_SUB)
    return F.when(big & (number != ""), num).when(big, named).when(sub, num)


def is_marker(title: Column) -> Column:
    return title.rlike(P.V1_REFERENCES) | title.rlike(P.V1_APPENDICES)


def named_id(title: Column) -> Column:
    return F.coalesce(*[F.when(title.rlike(p), F.lit(name)) for p, name in P.NAMED])


def title_clean(number: Column, title: Column) -> Column:
    bare = T.strip(F.regexp_replace(title, r"(?U)^\d+(?:\.\d+){0,2}\.?\s*", ""))
    return F.when(number.isNotNull() & (bare != ""), bare).otherwise(title)


def units(lines: DataFrame) -> DataFrame:
    """units(doc_id, unit, kind, htype, number, title, level, page, y, text) from lines with a column h (see classify).

    A named heading right below a heading on the same page goes on with its title, unless it marks a region; lines of text
    of a block make one paragraph.
    """
    by = Window.partitionBy("doc_id").orderBy("seq")
    head = F.col("h").isNotNull()
    before = F.lag(F.struct(head.alias("head"), "page", "block")).over(by)
    rows = lines.withColumn("_before", before)
    merges = (F.col("h.htype") == "named") & ~is_marker(F.col("text")) & F.col("_before.head") & (F.col("_before.page") == F.col("page"))
    same = F.when(head, merges).otherwise(~F.col("_before.head") & (F.col("_before.block") == F.col("block")) & (F.col("_before.page") == F.col("page")))
    rows = rows.withColumn("_unit", (~F.coalesce(same, F.lit(False))).cast("int"))
    rows = rows.withColumn("unit", F.sum("_unit").over(by) - 1)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ")
    first = F.min_by(F.struct("h", "page", "y"), "seq")
    grouped = rows.groupBy("doc_id", "unit").agg(text.alias("text"), first.alias("f"))
    heading = F.col("f.h").isNotNull()
    number = F.col("f.h.number")
    return grouped.select(
        "doc_id", "unit", F.when(heading, "heading").otherwise("text").alias("kind"), F.col("f.h.htype").alias("htype"), number.alias("number"),
        F.when(heading, F.col("text")).alias("title"), F.when(heading, F.coalesce(T.level(number), F.lit(1))).alias("level"),
        F.col("f.page").alias("page"), F.col("f.y").alias("y"), F.when(~heading, F.col("text")).alias("text"),
    )


def placed(units: DataFrame) -> DataFrame:
    """units and opens (id of the section a heading opens), sec_no and bucket (toc, refs or apps) of its text.

    What a unit says is carried forward: the mode by region markers and openings, the section by openings and, to none, by
    markers and by unknown named headings before the first number. The two are carried apart.
    """
    by = Window.partitionBy("doc_id").orderBy("unit")
    h = F.col("kind") == "heading"
    title = F.col("title")
    region = F.when(h & title.rlike(P.V1_REFERENCES), "refs").when(h & title.rlike(P.V1_APPENDICES), "apps").when(h & title.rlike(P.V1_TOC), "toc")
    rows = units.withColumn("_region", region)
    plain = h & F.col("_region").isNull()
    rows = rows.withColumn("_numbered", F.coalesce(plain & F.col("number").isNotNull(), F.lit(False)))
    rows = rows.withColumn("_seen", F.coalesce(F.max(F.col("_numbered").cast("int")).over(by) > 0, F.lit(False)))
    known = F.when(plain & F.col("number").isNull(), named_id(title))
    unknown = plain & F.col("number").isNull() & known.isNull()
    rows = rows.withColumn("_known", known).withColumn("_unknown", F.coalesce(unknown, F.lit(False)))
    fallback = F.when(F.col("_unknown") & F.col("_seen"), F.concat(F.lit("named"), F.sum((F.col("_unknown") & F.col("_seen")).cast("int")).over(by).cast("string")))
    rows = rows.withColumn("_base", F.coalesce(F.when(F.col("_numbered"), F.col("number")), "_known", fallback))
    nth = F.row_number().over(Window.partitionBy("doc_id", "_base").orderBy("unit"))
    rows = rows.withColumn("opens", F.when(F.col("_base").isNotNull(), F.when(nth == 1, F.col("_base")).otherwise(F.concat_ws("_", "_base", nth.cast("string")))))
    rows = rows.withColumn("_open", F.sum(F.col("_base").isNotNull().cast("int")).over(by) - 1)
    sets = F.when(F.col("_base").isNotNull(), F.col("_open")).when(h, F.lit(-1))
    mode = F.when(F.col("_base").isNotNull(), "section").otherwise(F.col("_region"))
    rows = rows.withColumn("_cur", F.coalesce(F.last(sets, ignorenulls=True).over(by), F.lit(-1))).withColumn("_mode", F.coalesce(F.last(mode, ignorenulls=True).over(by), F.lit("toc")))
    bucket = F.when(F.col("_mode").isin("refs", "apps"), F.col("_mode")).otherwise("toc")
    rows = rows.withColumn("sec_no", F.when(F.col("_cur") >= 0, F.col("_cur")))
    stray = F.when(h, F.when(F.col("_region") == "apps", "apps").when(F.col("_unknown") & ~F.col("_seen"), "toc")).when(F.col("_cur") < 0, bucket)
    return rows.withColumn("bucket", stray).drop(*[c for c in rows.columns if c.startswith("_")])


def _joined(value: Column) -> Column:
    return T.collapse(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct("unit", value.alias("v"))))), lambda x: x["v"]), "\n"))


def sections(placed: DataFrame) -> DataFrame:
    """(doc_id, sec_no, section_id, level, title, text, page_start, page_end, page0, y); pages 1-based but page0."""
    rows = placed.where("sec_no is not null").groupBy("doc_id", "sec_no").agg(
        F.max(F.when(F.col("opens").isNotNull(), F.struct("opens", "level", title_clean(F.col("number"), F.col("title")).alias("title"), "page", "y"))).alias("h"),
        _joined(F.when(F.col("kind") == "text", F.col("text"))).alias("text"), F.max(F.when(F.col("kind") == "text", F.col("page"))).alias("last"),
    )
    return rows.select(
        "doc_id", "sec_no", F.col("h.opens").alias("section_id"), F.col("h.level").alias("level"), F.col("h.title").alias("title"), "text",
        (F.col("h.page") + 1).alias("page_start"), (F.coalesce("last", "h.page") + 1).alias("page_end"), F.col("h.page").alias("page0"), F.col("h.y").alias("y"),
    )


def excluded(placed: DataFrame) -> DataFrame:
    """(doc_id, toc_text, references_text, appendices_text)."""
    value = F.coalesce("title", "text")
    return placed.groupBy("doc_id").agg(*[_joined(F.when(F.col("bucket") == b, value)).alias(name) for b, name in (("toc", "toc_text"), ("refs", "references_text"), ("apps", "appendices_text"))])


def attach(sections: DataFrame, tables: DataFrame) -> DataFrame:
    """tables(doc_id, tbl_no, page0, top, ...) with section_id and table_id; without owner: nulls.

    The owner is the last section before the first that begins after the table, if its text reaches the table's page. The
    largest beginning so far grows from section to section, so sections and tables merge into one order by it and the owner
    is the last section before the table: an as-of join without pairs.
    """
    so_far = Window.partitionBy("doc_id").orderBy("sec_no").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.max(F.struct(F.col("page0").cast("double").alias("page"), F.col("y").cast("double").alias("y"))).over(so_far)
    number = tables.schema["tbl_no"].dataType.simpleString()
    s = sections.select("doc_id", begins.alias("_at"), F.struct("sec_no", "section_id", "page_end").alias("_section"), F.lit(None).cast(number).alias("tbl_no"), F.lit(None).cast("int").alias("page0"))
    at = F.struct(F.col("page0").cast("double").alias("page"), F.col("top").cast("double").alias("y"))
    t = tables.select("doc_id", at.alias("_at"), F.lit(None).cast(s.schema["_section"].dataType).alias("_section"), "tbl_no", F.col("page0").cast("int").alias("page0"))
    order = Window.partitionBy("doc_id").orderBy("_at", F.col("_section").isNull(), "_section.sec_no").rowsBetween(Window.unboundedPreceding, 0)
    found = s.unionByName(t).withColumn("_owner", F.last("_section", ignorenulls=True).over(order)).where("tbl_no is not null")
    found = found.where(F.col("_owner.page_end") >= F.col("page0") + 1)
    nth = F.row_number().over(Window.partitionBy("doc_id", "_owner.section_id").orderBy("tbl_no"))
    named = found.select("doc_id", "tbl_no", F.col("_owner.section_id").alias("section_id"), F.concat(F.col("_owner.section_id"), F.lit("_t"), nth.cast("string")).alias("table_id"))
    return tables.join(named, ["doc_id", "tbl_no"], "left")


def developers(lines: Column, start: Column) -> Column:
    """Names after the line at start (1-based) up to one that begins with «одобрено»; lines that begin no name go on with the last."""
    after = F.slice(lines, start + 1, F.size(lines))
    stop = F.array_position(F.transform(after, lambda x: F.lower(x).startswith("одобрено")), F.lit(True)).cast("int")
    named = F.when(stop > 0, F.slice(after, 1, F.greatest(stop - 1, F.lit(0)))).otherwise(after)

    def add(done: Column, line: Column) -> Column:
        new = line.rlike(P.V1_DEVELOPER) | (F.size(done) == 0)
        rest = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        last = F.coalesce(F.get(done, F.size(done) - 1), F.lit(""))
        return F.when(new, F.concat(done, F.array(line))).otherwise(F.concat(rest, F.array(F.concat_ws(" ", last, line))))

    return F.aggregate(named, F.array().cast("array<string>"), add)


def metadata(texts: DataFrame) -> DataFrame:
    """texts(doc_id, source_file, first_page_text, largest) and the title page's fields; largest: its line of the largest size."""
    first = F.coalesce("first_page_text", F.lit(""))
    rows = texts.withColumn("_rows", F.filter(F.transform(T.split_lines(first), T.strip), lambda x: x != ""))

    def at(word: str) -> Column:
        return F.array_position(F.transform("_rows", lambda x: F.lower(x).startswith(word)), F.lit(True)).cast("int")

    title = F.when(at(P.TITLE_MARK) > 0, F.get("_rows", at(P.TITLE_MARK)))
    segment = F.when(first.rlike(P.V1_CODES_BLOCK), F.regexp_extract(first, P.V1_CODES_BLOCK, 1)).otherwise(F.regexp_extract(first, P.V1_CODES_LINE, 1))
    number = T.group(first, P.V1_ID)
    stem = F.regexp_replace("source_file", r"(?s)(.)\.[^.]*$", "$1")
    none = F.array().cast("array<string>")
    return rows.select(
        "doc_id", F.coalesce(F.concat(F.lit("КР"), number), stem).alias("document"), "source_file", F.coalesce(title, "largest").alias("title"),
        T.group(first, P.V1_YEAR).cast("int").alias("approval_year"), T.group(first, P.V1_REVISION).cast("int").alias("revision_year"), T.icd_codes(segment).alias("icd_10"),
        F.nullif(T.strip(F.regexp_extract(first, P.V1_AGE, 1)), F.lit("")).alias("age_category"),
        F.when(at("разработчик") > 0, developers(F.col("_rows"), at("разработчик"))).otherwise(none).alias("developers"),
    )


def largest_line(lines: DataFrame) -> DataFrame:
    """(doc_id, largest): the first line of the largest size on the first page, but for the title's mark."""
    rows = lines.where((F.col("page") == 0) & (F.col("text") != "") & ~F.lower("text").startswith("клинические") & (F.col("size") > 0))
    return rows.groupBy("doc_id").agg(F.max_by("text", F.struct("size", -F.col("seq"))).alias("largest"))


def stats(texts: DataFrame, sections: DataFrame, excluded: DataFrame, attached: DataFrame) -> DataFrame:
    """stats_v1(doc_id, sections_found, tables_found, text_coverage_pct, text_accounted_pct); texts has total_chars."""
    owned = attached.groupBy("doc_id").agg(F.count("*").alias("tables_found"), F.sum(F.when(F.col("section_id").isNotNull(), F.length("raw_text")).otherwise(0)).alias("_tables"))
    s = sections.groupBy("doc_id").agg(F.count("*").alias("sections_found"), F.sum(F.length("text")).alias("_text"), F.sum(F.length("title")).alias("_title"))
    x = excluded.select("doc_id", (F.length("toc_text") + F.length("references_text") + F.length("appendices_text")).alias("_out"))
    rows = texts.select("doc_id", "total_chars").join(s, "doc_id", "left").join(x, "doc_id", "left").join(owned, "doc_id", "left").na.fill(0)
    share = lambda part: F.when(F.col("total_chars") > 0, F.bround(part / F.col("total_chars") * 100, 1)).otherwise(0.0)
    return rows.select("doc_id", "sections_found", "tables_found", share(F.col("_text")).alias("text_coverage_pct"), share(F.col("_text") + F.col("_out") + F.col("_tables") + F.col("_title")).alias("text_accounted_pct"))
