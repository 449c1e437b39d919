"""Files as relations: PDF documents (where the optional libraries are installed) and the xlsx registry."""

from __future__ import annotations

import io
import re
import time
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from .store import materialize

PDF_GLOB = "*.[pP][dD][fF]"


def paths(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """(path, name) of a PDF file, or of those directly in a folder, in order of name. prefix: what names begin with."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", PDF_GLOB).load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return found.withColumn("name", name).where(F.col("name").startswith(prefix)).orderBy("path")


def _layout_library():
    try:
        import fitz
    except ImportError as e:
        raise ImportError("reading PDF files needs PyMuPDF; layouts can also be read from Parquet or JSON (sources.files.layout)") from e
    return fitz


def read_pdf(content: bytes) -> dict:
    """Pages, spans and detected tables of a PDF file, and the text of its first page."""
    fitz = _layout_library()
    pages, spans, first = [], [], ""
    with fitz.open(stream=content, filetype="pdf") as doc:
        for p, page in enumerate(doc, 1):
            first = page.get_text() if p == 1 else first
            pages.append({"page": p, "width": float(page.rect.width), "height": float(page.rect.height)})
            for b, block in enumerate(page.get_text("dict", sort=True)["blocks"]):
                for n, line in enumerate(block.get("lines", []) if block.get("type") == 0 else []):
                    box = dict(zip(("x0", "y0", "x1", "y1"), map(float, line["bbox"])))
                    at = {"page": p, "block_no": b, "line_no": n, "bbox": box}
                    spans += [at | {"span_no": i, "text": s["text"], "size": float(s["size"]), "flags": int(s["flags"]), "font": s["font"]} for i, s in enumerate(line["spans"])]
    return {"pages": pages, "spans": spans, "detected": detect_tables(content), "first_page_text": first}


def detect_tables(content: bytes) -> list[dict]:
    try:
        import pdfplumber
    except ImportError as e:
        raise ImportError("finding tables in PDF files needs pdfplumber") from e
    rows = []
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for p, page in enumerate(pdf.pages, 1):
            for i, found in enumerate(page.find_tables()):
                x0, y0, x1, y1 = map(float, found.bbox)
                try:
                    text = page.crop((max(0, x0), max(0, y0), min(page.width, x1), min(page.height, y1))).extract_text() or ""
                except ValueError:  # a box outside of the page
                    text = ""
                rows.append({"page": p, "tbl_no": i, "bbox": {"x0": x0, "y0": y0, "x1": x1, "y1": y1}, "grid": found.extract() or [], "raw_text": text})
    return rows


#: A file as one row. error: why it couldn't be read; then there is nothing else of it but the seconds that it took.
FILE = (
    f"path string, error string, secs double, first_page_text string, pages array<struct<{', '.join(x.replace(' ', ': ', 1) for x in S.PAGES.split(', ')[1:])}>>, "
    f"spans array<struct<page: int, block_no: int, line_no: int, span_no: int, text: string, size: double, flags: int, font: string, bbox: {S.BBOX}>>, "
    f"detected array<struct<page: int, tbl_no: int, bbox: {S.BBOX}, grid: array<array<string>>, raw_text: string>>"
)


def read_files(spark: SparkSession, path: str, prefix: str = "", read=read_pdf) -> DataFrame:
    """FILE of every PDF file, each opened and parsed once and written down. What goes wrong with a file stays with its row.

    read: bytes of a file -> pages, spans, detected and first_page_text. Files are read where Spark runs the tasks.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(kind)
        for batch in batches:
            for place, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                began = time.monotonic()
                try:
                    found = {"error": None} | read(content.as_py())
                except Exception as e:  # whatever a library raises on a broken file
                    found = {"error": repr(e), "first_page_text": None, "pages": [], "spans": [], "detected": []}
                row = found | {"path": place, "secs": time.monotonic() - began}
                yield pa.RecordBatch.from_pylist([row], schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(FILE)
    files = spark.read.format("binaryFile").option("pathGlobFilter", PDF_GLOB).load(path).select("path", "content")
    return materialize(files.where(F.element_at(F.split("path", "/"), -1).startswith(prefix)).mapInArrow(rows, kind))


def _of_files(files: DataFrame) -> tuple[DataFrame, ...]:
    """documents, pages, spans, detected and failed of rows of FILE."""
    named = files.withColumn("doc_id", F.col("path")).withColumn("source_file", F.element_at(F.split("path", "/"), -1))
    good = named.where("error is null")

    def inner(column: str) -> DataFrame:
        return good.select("doc_id", F.explode(column).alias("x")).select("doc_id", "x.*")

    documents = good.select("doc_id", "path", "source_file", "first_page_text", "secs")
    return documents, inner("pages"), inner("spans"), inner("detected"), named.where("error is not null").select("doc_id", "source_file", "error", "secs")


def pdf_layout(spark: SparkSession, path: str, prefix: str = "", read=read_pdf):
    """The layout of PDF files, with a row in failed for each that couldn't be read. The driver opens no file."""
    from ..plans.engine import Layout

    if read is read_pdf:
        _layout_library()
    documents, pages, spans, detected, failed = _of_files(read_files(spark, path, prefix, read))
    return Layout.from_spans(documents, pages, spans, detected, failed)


def _relation(spark: SparkSession, path: str, format: str, name: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.format(format).schema(schema).load(f"{path}/{name}")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def legacy(spark: SparkSession, path: str, format: str | None = None, parsed_at: str = "1970-01-01T00:00:00", read=read_pdf):
    """What the predecessor's pipeline makes of PDF files, or of a layout of spans."""
    from ..plans.legacy import LegacyResult

    if format is None:
        if read is read_pdf:
            _layout_library()
        documents, pages, spans, detected, failed = _of_files(read_files(spark, path, read=read))
        return LegacyResult(documents, pages, spans, detected, parsed_at, failed=failed)
    parts = [_relation(spark, path, format, n, s) for n, s in (("documents", S.DOCUMENTS), ("pages", S.PAGES), ("spans", S.SPANS), ("detected_tables", S.DETECTED))]
    if any(p is None for p in parts[:3]):
        raise ValueError(f"{path} holds no layout of spans: documents, pages and spans are needed")
    return LegacyResult(*parts, parsed_at)


def layout(spark: SparkSession, path: str, format: str = "parquet"):
    """A layout stored as relations: folders documents, pages, spans or lines, and detected_tables if there are any."""
    from ..plans.engine import Layout

    def read(name: str, schema: str) -> DataFrame | None:
        return _relation(spark, path, format, name, schema)

    documents, pages = read("documents", S.DOCUMENTS), read("pages", S.PAGES)
    lines, spans, detected = read("lines", S.LINES), read("spans", S.SPANS), read("detected_tables", S.DETECTED)
    if documents is None or pages is None or (lines is None and spans is None):
        raise ValueError(f"{path} holds no layout: documents, pages and lines or spans are needed")
    return Layout(documents, pages, lines, detected) if lines is not None else Layout.from_spans(documents, pages, spans, detected)


# --- xlsx -----------------------------------------------------------------------------------------------------------------
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    out = 0
    for c in re.match("[A-Z]*", ref)[0]:
        out = out * 26 + ord(c) - 64
    return out - 1


def sheet_rows(content: bytes) -> list[list[str | None]]:
    """Values of the active sheet, as text; numbers as they are stored. Anything that is no workbook: no rows."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as book:
            names = set(book.namelist())
            root = ElementTree.fromstring(book.read("xl/workbook.xml"))
            view = root.find("m:bookViews/m:workbookView", _NS)
            active = int(view.get("activeTab", 0)) if view is not None else 0
            wanted = root.findall("m:sheets/m:sheet", _NS)[active].get(_REL)
            links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
            target = next(x.get("Target") for x in links if x.get("Id") == wanted).lstrip("/")
            shared = []
            if "xl/sharedStrings.xml" in names:
                shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
            sheet = ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}"))
            out = []
            for row in sheet.iterfind("m:sheetData/m:row", _NS):
                at = int(row.get("r", len(out) + 1)) - 1
                out += [[] for _ in range(at - len(out))]
                cells: list[str | None] = []
                for cell in row.iterfind("m:c", _NS):
                    where = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                    cells += [None] * (where - len(cells))
                    value, kind = cell.find("m:v", _NS), cell.get("t")
                    if kind == "inlineStr":
                        cells.append("".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t")))
                    elif value is None or value.text is None:
                        cells.append(None)
                    elif kind == "s":
                        cells.append(shared[int(value.text)])
                    elif kind == "b":
                        cells.append("True" if value.text == "1" else "False")
                    else:
                        cells.append(value.text)
                out.append(cells)
            return out
    except (zipfile.BadZipFile, KeyError, IndexError, StopIteration, ValueError, ElementTree.ParseError):
        return []


def registry(spark: SparkSession, path: str | None) -> DataFrame:
    """registry(ord, id, row) from an xlsx file; empty if there is none or it can't be read."""
    from ..operators.registry import from_sheet

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                cells = sheet_rows(content)
                yield pd.DataFrame({"ord": pd.Series(range(len(cells)), dtype="int32"), "cells": pd.Series(cells, dtype=object)})

    empty = spark.createDataFrame([], S.REGISTRY)
    if not path:
        return empty
    try:
        files = spark.read.format("binaryFile").load(path).select("content")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return empty
    return from_sheet(files.mapInPandas(rows, "ord int, cells array<string>"))
