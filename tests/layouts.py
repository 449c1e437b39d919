"""Layout relations from short notations: a line ending in * is bold."""

from docstruct import schemas as S
from docstruct.plans.engine import Engine, Layout
from pyspark.sql import functions as F


def layout(spark, docs, first_page="", files=None, tables=(), gap=14.0):
    """docs: {doc_id: [line, ...] or [(page, line), ...]}"""
    lines, pages, documents = [], set(), []
    for doc, texts in docs.items():
        documents.append((doc, f"/in/{doc}.pdf", (files or {}).get(doc, f"{doc}.pdf"), first_page))
        pages.add((doc, 1, 600.0, 800.0))
        y, last = 0.0, 1
        for seq, x in enumerate(texts):
            page, text = x if isinstance(x, tuple) else (1, x)
            y, last = (0.0, page) if page != last else (y, page)
            pages.add((doc, page, 600.0, 800.0))
            bold = text.endswith("*")
            lines.append((doc, seq, page, text.rstrip("*"), (50.0, y, 250.0, y + 10), 12.0, bold, gap if y else 0.0))
            y += gap
    return Layout(
        spark.createDataFrame(documents, S.DOCUMENTS), spark.createDataFrame(sorted(pages), S.PAGES),
        spark.createDataFrame(lines, S.LINES), spark.createDataFrame(list(tables), S.DETECTED) if tables else None,
    )


def parsed(spark, docs, registry=None, body_only=False, **more):
    """body_only: the content begins with the first line."""
    found = Engine(spark).parse(layout(spark, docs, **more), registry)
    if body_only:
        found.started = found.classified.withColumn("start", F.lit(0))
    return found


def sections(result):
    out = {}
    for r in result.sections.orderBy("doc_id", "sec_no").collect():
        out.setdefault(r["doc_id"], []).append((r["number"], r["title"], r["text"], r["parent_sec_no"]))
    return out


def excluded(result):
    out = {}
    for r in result.excluded.orderBy("doc_id", "bucket", "item_no").collect():
        out.setdefault((r["doc_id"], r["bucket"]), []).append((r["title"], r["text"]))
    return out
