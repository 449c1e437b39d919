"""Where results go: JSON lines, a JSON file per document, summaries."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stem(name: Column) -> Column:
    """A file's name without its last extension; a leading dot begins none."""
    return F.regexp_replace(name, r"(?s)^(.*[^/])\.[^./]*$", "$1")


def target(path: Column, out: str | None) -> Column:
    """<out>/<stem>.json, or the same beside the source."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.concat(F.lit(out.rstrip("/") + "/"), stem(name), F.lit(".json")) if out else F.concat(stem(path), F.lit(".json"))


def write_lines(documents: DataFrame, path: str) -> None:
    """One line of JSON per document: the form for large corpora."""
    documents.select(F.col("json").alias("value")).write.text(path)


def write_files(documents: DataFrame, out: str | None, path: str = "source_file") -> None:
    """documents(path, json) as files of their own, indented, non-ASCII kept. out must be a folder that all executors share; without it they go beside their sources.

    Each file is written beside its place and then moved there, so a repeated task leaves whole files only.
    """

    def write(rows: Iterator) -> None:
        for r in rows:
            where = unquote(r["target"].removeprefix("file://")) if r["target"].startswith("file:/") else r["target"]
            where = where.removeprefix("file:")
            folder = os.path.dirname(where)
            os.makedirs(folder, exist_ok=True)
            handle, made = tempfile.mkstemp(dir=folder)
            with os.fdopen(handle, "w", encoding="utf-8") as f:
                json.dump(json.loads(r["json"]), f, ensure_ascii=False, indent=2)
            os.replace(made, where)

    documents.select(target(F.col(path), out).alias("target"), "json").foreachPartition(write)


def summary(result) -> DataFrame:
    """(doc_id, summary): what the command line prints of a document."""
    m, s = result.metadata, result.stats.select("doc_id", "sections_found", "tables_found", "coverage_percent", "accounted_chars", "total_chars")
    warned = result.warnings.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "message"))), lambda x: x["message"]).alias("_w"))
    none = F.lit("—")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("✓ "), "source_file", F.lit("  [id="), F.coalesce("id", F.lit("None")), F.lit("]")),
        F.concat(F.lit("  Название : "), F.coalesce("title", F.lit("None"))),
        F.concat(F.lit("  Год / возраст : "), F.coalesce("year", F.lit("None")), F.lit(" / "), F.coalesce("age_group", F.lit("None"))),
        F.concat(F.lit("  МКБ : "), F.when(F.size("mkb_codes") > 0, F.array_join("mkb_codes", ", ")).otherwise(none)),
        F.format_string("  Разделов : %d   Таблиц : %d", "sections_found", "tables_found"),
        F.concat(F.lit("  Покрытие : "), F.col("coverage_percent").cast("string"), F.lit("%   (учтено "), F.col("accounted_chars").cast("string"), F.lit("/"), F.col("total_chars").cast("string"), F.lit(" симв.)")),
        F.when(F.size("_w") > 0, F.concat(F.format_string("  Предупреждения (%d):\n", F.size("_w")), F.array_join(F.transform("_w", lambda x: F.concat(F.lit("    - "), x)), "\n"))),
    )
    return m.join(s, "doc_id").join(warned, "doc_id", "left").select("doc_id", "source_file", text.alias("summary"))
