"""Layout relations from plain tables of texts, pages, events and the like."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt out to all cores by their key, for work that is much longer than the rows.

    A table of few bytes comes in few row groups, and so in few tasks, however many rows it has; adaptive execution would
    join small parts again, which it can't where their number is given.
    """
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, key)


def document_lines(documents: DataFrame) -> DataFrame:
    """DL: (doc_id, seq, text), a row per line of a text."""
    return documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("seq", "text"))


#: Fixed values of the adapter: sizes of titles and headings, elements set in bold.
HTML_SIZES = {"title": 18.0, "h1": 24.0, "h2": 20.0, "h3": 18.0, "h4": 16.0, "h5": 16.0, "h6": 16.0}
HTML_BOLD = ("h1", "h2", "h3", "h4", "h5", "h6", "b", "strong", "th")


def html_lines(pages: DataFrame) -> DataFrame:
    """PB: (doc_id, seq, tag, text, size, bold): every text between tags but those of scripts, styles and comments, with the tag before it."""
    shown = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->", "")
    tag = "<(/?[a-zA-Z][a-zA-Z0-9]*)"
    # one search of the page: of what was found, the tag stands at its head and the text behind its first bracket
    found = F.regexp_extract_all(F.concat(F.lit("<p>"), shown), F.lit(tag + "[^<>]*>[^<]*"), F.lit(0))
    rows = pages.select(F.col("page_id").alias("doc_id"), F.posexplode(found).alias("seq", "m"))
    rows = rows.withColumn("text", F.expr("substring(m, locate('>', m) + 1)")).where(F.trim("text") != "")
    rows = rows.select("doc_id", "seq", F.lower(F.regexp_extract("m", "^" + tag, 1)).alias("tag"), "text")
    size = F.lit(12.0)
    for tag, value in HTML_SIZES.items():
        size = F.when(F.col("tag") == tag, value).otherwise(size)
    return rows.withColumn("size", size).withColumn("bold", F.col("tag").isin(*HTML_BOLD))


def event_lines(events: DataFrame) -> DataFrame:
    """EL: a user's events as a document: twenty lines a page, the value as size, k as the line's top."""
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    top = F.get_json_object("props", "$.k").cast("double")
    rows = events.select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), nth.alias("idx"), "event_type", F.col("value").alias("size"), top.alias("y0"))
    level = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", 3)
    return rows.withColumn("page", F.floor(F.col("idx") / 20).cast("int")).withColumn("level", level)


def numbered_lines(part: DataFrame) -> DataFrame:
    """NL: (id, text, visual), lines with and without numbers and known titles, from the parts' names."""
    name, key = F.col("p_name"), F.col("p_partkey")
    n, m = (key % 12).cast("string"), (key % 7).cast("string")
    main = F.get(F.array(*map(F.lit, ("Краткая информация", "Диагностика", "Лечение", "Медицинская", "Реабилитация и", "Критерии оценки качества"))), (key % 6).cast("int"))
    kinds = [
        F.concat(n, F.lit("."), m, F.lit(" "), F.initcap(name)), F.concat(n, F.lit(" . "), m, F.lit(". "), name), F.concat(n, F.lit(". "), main, F.lit(" "), name), F.concat(n, F.lit(".")),
        F.concat(n, F.lit("."), m), F.concat(name, F.lit(" Список сокращений")), F.concat(n, F.lit("."), m, F.lit(" "), F.initcap(name), F.lit(" [3]")),
        F.concat(n, F.lit("."), m, F.lit(" "), F.initcap(name), F.lit(" ....... 12")), F.concat(F.lit("- "), name), F.concat(m, F.lit(". "), main),
    ]
    return part.select(key.alias("id"), F.get(F.array(*kinds), (key % 10).cast("int")).alias("text"), (F.col("p_size") > 25).alias("visual"))


def registry(customer: DataFrame) -> DataFrame:
    """RG: a registry with ids of base number and version."""
    base = (F.col("c_custkey") % 1000).cast("string")
    row = F.create_map(F.lit("Наименование"), F.col("c_name"), F.lit("возраст"), F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")), F.lit("Статус"), F.when(F.col("c_acctbal") > 0, "active").otherwise(" "))
    return customer.select(F.col("c_custkey").cast("int").alias("ord"), F.concat(base, F.lit("_"), (F.col("c_nationkey") % 4).cast("string")).alias("id"), row.alias("row"))
