"""Coverage statistics and warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.when(whole > 0, F.bround(part / whole * 100, digits)).otherwise(0.0)


def words(x: Column) -> Column:
    n = T.norm(x)
    return F.when(n == "", 0).otherwise(F.size(F.split(n, " ", -1)))


def _chars(*columns: str) -> Column:
    return sum((F.length(F.coalesce(F.col(c), F.lit(""))) for c in columns), F.lit(0)).cast("long")


def coverage(texts: DataFrame, sections: DataFrame, excluded: DataFrame, tables: DataFrame, key: str = "doc_id") -> DataFrame:
    """stats of every document of texts(key, full_text), those without any section or table included.

    The three kinds of contributions are appended, so one shuffle sums them all.
    """
    zero = F.lit(0).cast("long")

    def part(df: DataFrame, name: str, chars: Column) -> DataFrame:
        return df.select(key, *[(chars if n == name else zero).alias(f"{n}_chars") for n in ("included", "excluded", "table")], *[F.lit(int(n == name)).cast("long").alias(f"{n}_n") for n in ("included", "table")])

    parts = part(sections, "included", _chars("title", "text")).unionByName(part(excluded, "excluded", _chars("title", "text"))).unionByName(part(tables, "table", _chars("raw_text", "caption")))
    summed = parts.groupBy(key).agg(*[F.sum(c).alias(c) for c in parts.columns if c != key])
    total = F.length(F.coalesce("full_text", F.lit(""))).cast("long")
    rows = texts.select(key, total.alias("total_chars"), words(F.col("full_text")).cast("long").alias("total_words")).join(summed, key, "left")
    rows = rows.na.fill(0, [c for c in summed.columns if c != key])
    accounted = F.least(F.col("included_chars") + F.col("excluded_chars") + F.col("table_chars"), F.col("total_chars"))
    return rows.select(
        key, "total_chars", "total_words", F.col("included_n").alias("sections_found"), F.col("table_n").alias("tables_found"),
        "included_chars", "excluded_chars", "table_chars", accounted.alias("accounted_chars"), percent(accounted, F.col("total_chars")).alias("coverage_percent"),
    )


def warnings(texts: DataFrame, counters: DataFrame, metadata: DataFrame, stats: DataFrame) -> DataFrame:
    """warnings(doc_id, ord, code, message) in the order in which the steps find them.

    counters(doc_id, junk, small): detections that were left out.
    """
    rows = texts.select("doc_id", (T.strip(F.coalesce("full_text", F.lit(""))) == "").alias("_scan"))
    rows = rows.join(counters, "doc_id", "left").join(metadata, "doc_id", "left").join(stats.select("doc_id", "sections_found", "coverage_percent"), "doc_id", "left")
    none = F.coalesce("probe", F.lit("")) == ""
    when = {
        "W_SCAN": (F.col("_scan"),),
        "W_JUNK": (F.col("junk") > 0, "junk"),
        "W_SMALL": (F.col("small") > 0, "small"),
        "W_NO_ID": (none,),
        "W_NO_REGISTRY": (~F.col("registry_known"),),
        "W_NOT_FOUND": (F.col("registry_known") & ~none & ~F.col("registry_matched"), "probe"),
        "W_NO_TITLE": (F.coalesce("title", F.lit("")) == "",),
        "W_NO_ICD": (F.coalesce(F.size("mkb_codes"), F.lit(0)) < 1,),
        "W_NO_SECTIONS": (F.col("sections_found") == 0,),
        "W_LOWCOV": (F.col("coverage_percent") < P.LOW_COVERAGE, F.col("coverage_percent").cast("string")),
    }
    return rows.select("doc_id", raised(when))


def raised(when: dict[str, tuple]) -> Column:
    """ord, code and message of each code whose condition holds, as rows; when: code -> condition and the message's values."""
    found = [(code, c, F.format_string(P.MESSAGES[code], *values) if values else F.lit(P.MESSAGES[code])) for code, (c, *values) in when.items()]
    each = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(i).alias("ord"), F.lit(code).alias("code"), m.alias("message"))) for i, (code, c, m) in enumerate(found)])
    return F.inline(F.array_compact(each))
