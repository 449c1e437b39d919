"""Quality of results: a row per document, corpus figures, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T


def duplicates(numbers: Column) -> Column:
    """Values that occur more than once, sorted."""
    return F.array_sort(F.filter(F.array_distinct(numbers), lambda n: F.size(F.filter(numbers, lambda m: m == n)) > 1))


def disorder(numbers: Column) -> Column:
    return numbers != F.sort_array(numbers)


def leaks_toc(title: Column) -> Column:
    return title.rlike(r"\.{3,}")


def is_section_4(number: Column, title: Column) -> Column:
    return F.coalesce(number == "4", F.lit(False)) | F.coalesce(F.lower(title).startswith(P.SECTION_4), F.lit(False))


def dangles(title: Column) -> Column:
    """Ends in the middle: with a comma, dash or bracket, or on a word that wants another."""
    t = T.strip(F.coalesce(title, F.lit("")))
    low = F.lower(t)
    word = F.lit(False)
    for w in P.DANGLING:
        word = word | low.endswith(" " + w) | (low == w)
    end = F.lit(False)
    for e in P.DANGLING_ENDS:
        end = end | t.endswith(e)
    return (t != "") & (end | word)


def leaked(title: Column, text: Column) -> Column:
    """The title breaks off and the text goes on in lower case."""
    return ~F.lower(F.coalesce(title, F.lit(""))).contains("критери") & dangles(title) & T.first_lower(T.strip(F.coalesce(text, F.lit(""))))


def documents(sections: DataFrame, stats: DataFrame, metadata: DataFrame, warnings: DataFrame, failed: DataFrame | None = None, secs: DataFrame | None = None) -> DataFrame:
    """quality: one row per document of stats, and one per file of failed(doc_id, source_file, error, secs), which has nothing but its error.

    sections need parent_sec_no; secs(doc_id, secs): how long documents took.
    """
    top = F.col("parent_sec_no").isNull()
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.when(top, F.struct("sec_no", F.col(c).alias("v"))))), lambda x: x["v"])
    found = sections.groupBy("doc_id").agg(
        in_order("number").alias("top_numbers"), F.count_if(top).alias("n_top"), F.bool_or(top & is_section_4(F.col("number"), F.col("title"))).alias("has4"),
        F.bool_or(F.coalesce(leaks_toc(F.col("title")), F.lit(False))).alias("toc_leak"), F.bool_or(leaked(F.col("title"), F.col("text"))).alias("title_leak"),
    )
    warned = warnings.groupBy("doc_id").agg(F.count("*").alias("warns"), F.bool_or(F.col("code").isin("W_NO_REGISTRY", "W_NOT_FOUND")).alias("_fallback"))
    rows = stats.join(found, "doc_id", "left").join(metadata, "doc_id", "left").join(warned, "doc_id", "left")
    rows = rows.join(secs, "doc_id", "left") if secs is not None else rows.withColumn("secs", F.lit(None).cast("double"))
    numbers = F.filter(F.coalesce("top_numbers", F.array().cast("array<string>")), lambda n: n.rlike(r"^\d+$"))
    out = rows.select(
        "doc_id", F.col("source_file").alias("file"), F.lit(True).alias("ok"), "id", (F.coalesce("title", F.lit("")) != "").alias("title_ok"), "year",
        F.col("age_group").alias("age"), F.coalesce(F.size("mkb_codes"), F.lit(0)).alias("mkb_n"), (~F.coalesce("_fallback", F.lit(False))).alias("from_registry"),
        F.col("sections_found").alias("sections"), F.col("tables_found").alias("tables"), F.col("coverage_percent").alias("coverage"),
        F.coalesce("top_numbers", F.array().cast("array<string>")).alias("top_numbers"), F.coalesce("n_top", F.lit(0)).cast("int").alias("n_top"),
        F.coalesce("has4", F.lit(False)).alias("has4"), F.coalesce("toc_leak", F.lit(False)).alias("toc_leak"), duplicates(numbers).alias("dup"),
        disorder(F.transform(numbers, lambda n: n.cast("int"))).alias("disorder"), F.coalesce("title_leak", F.lit(False)).alias("title_leak"), F.coalesce("warns", F.lit(0)).cast("int").alias("warns"),
        F.lit(None).cast("string").alias("error"), "secs",
    )
    if failed is None:
        return out
    bad = failed.select("doc_id", F.col("source_file").alias("file"), F.lit(False).alias("ok"), "error", "secs")
    return out.unionByName(bad, allowMissingColumns=True)


def flags(quality: DataFrame) -> DataFrame:
    """quality and flags: the report's marks of a document."""
    marks = [(~F.col("has4"), "NO_SEC4"), (F.col("toc_leak"), "TOC_LEAK"), (F.col("coverage") < P.REPORT_COVERAGE, "LOWCOV"), (~F.col("from_registry"), "FALLBACK"), (~F.col("title_ok"), "NOTITLE")]
    return quality.withColumn("flags", F.concat_ws(" ", *[F.when(c, F.lit(name)) for c, name in marks]))


def summary(quality: DataFrame) -> DataFrame:
    """One row of figures over all documents."""
    c = F.col("coverage")
    return quality.agg(
        F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_bad"), F.avg(c).alias("coverage_mean"), F.percentile(c, 0.5).alias("coverage_median"), F.min(c).alias("coverage_min"),
        F.count_if(c < P.REPORT_COVERAGE).alias("below_80"), F.count_if(c < P.LOW_COVERAGE).alias("below_50"), F.count_if("from_registry").alias("from_registry"), F.count_if(~F.col("from_registry")).alias("from_title"),
        F.count_if("title_ok").alias("with_title"), F.count_if(F.col("mkb_n") > 0).alias("with_codes"), F.count_if("has4").alias("with_section_4"), F.count_if("toc_leak").alias("toc_leaks"),
        F.count_if(F.size("dup") > 0).alias("with_duplicates"), F.count_if("disorder").alias("in_disorder"), F.sum("tables").alias("tables"), F.count_if(F.col("tables") > 0).alias("with_tables"),
        F.avg("sections").alias("sections_mean"), F.min("sections").alias("sections_min"), F.max("sections").alias("sections_max"),
    )


def problems(quality: DataFrame, most: int = 25) -> DataFrame:
    """(problem, n, files): how many documents have each problem, and the first of them by name."""
    kinds = {"no_section_4": ~F.col("has4"), "toc_leak": F.col("toc_leak"), "low_coverage": F.col("coverage") < P.REPORT_COVERAGE, "duplicates": F.size("dup") > 0, "disorder": F.col("disorder"), "fallback": ~F.col("from_registry"), "error": ~F.col("ok")}
    each = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in kinds.items()])))
    rows = quality.select("file", each.alias("problem"))
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("problem").orderBy("file"))).where(F.col("_n") <= most)
    first = ranked.groupBy("problem").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "file"))), lambda x: x["file"]).alias("files"))
    return rows.groupBy("problem").agg(F.count("*").alias("n")).join(first, "problem")


def regression(quality: DataFrame) -> DataFrame:
    """(doc_id, passed): no duplicate or unordered top numbers, almost full coverage, no title that leaks into the text."""
    ok = (F.size("dup") == 0) & ~F.col("disorder") & (F.col("coverage") >= P.REGRESSION_COVERAGE) & ~F.col("title_leak")
    return quality.select("doc_id", F.coalesce(F.col("ok") & ok, F.lit(False)).alias("passed"))


def golden(sections: DataFrame, stats: DataFrame, criteria: dict) -> DataFrame:
    """(doc_id, check, passed) of documents that must come out in a known way. criteria: a document's id -> what is asked of it (see patterns.GOLDEN).

    sections need parent_sec_no. A document that isn't there has no rows.
    """
    wanted = list(criteria)
    rows = sections.where(F.col("doc_id").isin(wanted))
    parents = rows.select("doc_id", F.col("sec_no").alias("parent_sec_no"), F.col("number").alias("_parent"))
    rows = rows.join(parents, ["doc_id", "parent_sec_no"], "left")
    in_order = lambda c: F.array_sort(F.collect_list(F.when(c, F.struct("sec_no", "number", F.col("_parent").alias("parent"), "title", "text"))))
    found = rows.groupBy("doc_id").agg(
        in_order(F.col("parent_sec_no").isNull()).alias("tops"), in_order(F.col("parent_sec_no").isNotNull()).alias("subs"), F.bool_or(leaked(F.col("title"), F.col("text"))).alias("leak")
    )
    found = stats.where(F.col("doc_id").isin(wanted)).join(found, "doc_id", "left")

    def checks(c: dict) -> list[tuple[str, Column]]:
        numbers = F.transform("tops", lambda x: x["number"])
        of = lambda n: F.get(F.filter("tops", lambda x: x["number"] == n), F.lit(0))
        kids = lambda n: F.transform(F.filter("subs", lambda x: x["parent"] == n), lambda x: x["number"])
        listed = lambda xs: F.array(*map(F.lit, xs))
        out = [
            ("coverage", F.col("coverage_percent") == c["coverage"]), ("total_chars", F.col("total_chars") == c["total_chars"]), ("sections", F.col("sections_found") >= c["sections"]),
            ("duplicates", F.size(numbers) == F.size(F.array_distinct(numbers))), ("order", F.slice(numbers, 1, len(c["tops"])) == listed(c["tops"])), ("title_leak", ~F.col("leak")),
        ]
        out += [(f"children of {n}", kids(n) == listed(xs)) for n, xs in c["children"].items()]
        out += [(f"title of {n}", F.lower(of(n)["title"]).contains(x)) for n, xs in c["titles"].items() for x in xs]
        out += [(f"text of {n}", of(n)["text"].startswith(x)) for n, x in c["begins"].items()]
        return out + [(f"text of {n}", of(n)["text"] != x) for n, x in c["is_not"].items()]

    each = None
    for doc_id, c in criteria.items():
        these = F.array(*[F.struct(F.lit(name).alias("check"), F.coalesce(x, F.lit(False)).alias("passed")) for name, x in checks(c)])
        each = F.when(F.col("doc_id") == doc_id, these) if each is None else each.when(F.col("doc_id") == doc_id, these)
    return found.select("doc_id", F.inline(each))


def spread(rows: DataFrame, order: str, n: int) -> DataFrame:
    """n rows evenly spread over the order (all, if there are no more): those at floor(i * N / n).

    Places are counted in ranges of the order, so the whole table never goes through one task.
    """
    from .ranks import with_index

    total = rows.count()
    if total <= n:
        return rows
    places = sorted({int(i * (total / n)) for i in range(n)})
    wanted = rows.sparkSession.createDataFrame([(p,) for p in places], "_place long")
    return with_index(rows, order, "_i").join(F.broadcast(wanted), F.col("_i") == F.col("_place"), "left_semi").drop("_i")
