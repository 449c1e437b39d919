"""Sources, sinks, command line and streaming."""

import io
import json
import os
import sys
import zipfile

import pytest
from pyspark import cloudpickle

from docstruct import cli
from docstruct import schemas as S
from docstruct.plans.engine import Engine
from docstruct.sources import files, sinks
from docstruct.streaming import incremental
from layouts import layout, sections

DOCS = {"КР1": ["1. Краткая информация*", "Тело.", "ещё.", "и ещё."], "КР2": ["Просто текст."]}


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have this module


def book(rows, active=0):
    """A workbook of two sheets; the active one holds rows."""
    strings = []

    def cell(r, c, v):
        ref = f"{chr(65 + c)}{r}"
        if isinstance(v, int):
            return f'<c r="{ref}"><v>{v}</v></c>'
        if v.startswith("i:"):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v[2:]}</t></is></c>'
        strings.append(v)
        return f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>'

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1) if row)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><bookViews><workbookView activeTab="{active}"/></bookViews><sheets><sheet name="a" r:id="r1"/><sheet name="b" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/></Relationships>')
        for i in (0, 1):
            z.writestr(f"xl/worksheets/s{i + 1}.xml", f"<worksheet {ns}><sheetData>{body if i == active else ''}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><r><t>{s}</t></r></si>" for s in strings) + "</sst>")
    return out.getvalue()


ROWS = [["Реестр"], [], ["i:ID", "Наименование"], ["1", "Первая"], [2, None, "x"], ["1", "Вторая"]]


@pytest.mark.parametrize("active", [0, 1])
def test_sheet(active):
    assert files.sheet_rows(book(ROWS, active)) == [["Реестр"], [], ["ID", "Наименование"], ["1", "Первая"], ["2", None, "x"], ["1", "Вторая"]]
    assert files.sheet_rows(b"no workbook") == []


def test_registry(spark, tmp_path):
    (tmp_path / "r.xlsx").write_bytes(book(ROWS))
    got = {r["id"]: r["row"]["Наименование"] for r in files.registry(spark, f"{tmp_path}/r.xlsx").collect()}
    assert got == {"1": "Вторая", "2": None}
    (tmp_path / "bad.xlsx").write_bytes(b"x")
    assert files.registry(spark, f"{tmp_path}/bad.xlsx").count() == files.registry(spark, f"{tmp_path}/none.xlsx").count() == files.registry(spark, None).count() == 0


def test_paths(spark, tmp_path):
    for name in ("b.PDF", "КР1.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    os.mkdir(tmp_path / "sub")
    (tmp_path / "sub" / "d.pdf").write_bytes(b"x")
    assert [r["name"] for r in files.paths(spark, str(tmp_path)).collect()] == ["b.PDF", "КР1.pdf"]
    assert [r["name"] for r in files.paths(spark, str(tmp_path), "КР").collect()] == ["КР1.pdf"]


def test_pdf_needs_its_library(spark, tmp_path):
    pytest.importorskip("builtins")
    try:
        import fitz  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="PyMuPDF"):
            files.pdf_layout(spark, str(tmp_path))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("layout")
    found = layout(spark, DOCS)
    for name in ("documents", "pages", "lines"):
        getattr(found, name).write.parquet(f"{where}/{name}")
    return str(where)


def test_stored_layout_and_files(spark, stored, tmp_path):
    found = Engine(spark).parse(files.layout(spark, stored))
    assert sections(found) == {"КР1": [("1", "Краткая информация", "Тело. ещё. и ещё.", None)]}
    sinks.write_files(found.json, f"{tmp_path}/out")
    assert sorted(os.listdir(f"{tmp_path}/out")) == ["КР1.json", "КР2.json"]
    text = open(f"{tmp_path}/out/КР1.json", encoding="utf-8").read()
    assert json.loads(text)["sections"][0]["title"] == "Краткая информация" and '\n  "sections"' in text and "Тело" in text
    sinks.write_lines(found.json, f"{tmp_path}/lines")
    assert {json.loads(r["value"])["metadata"]["source_file"] for r in spark.read.text(f"{tmp_path}/lines").collect()} == {"КР1.pdf", "КР2.pdf"}
    with pytest.raises(ValueError):
        files.layout(spark, str(tmp_path))


def test_targets(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("/a.b/КР1.x.pdf",), ("КР2.PDF",)], "p string")
    assert [r[0] for r in rows.select(sinks.target(F.col("p"), None)).collect()] == ["/a.b/КР1.x.json", "КР2.json"]
    assert [r[0] for r in rows.select(sinks.target(F.col("p"), "/o/")).collect()] == ["/o/КР1.x.json", "/o/КР2.json"]


def test_command_line(spark, stored, tmp_path, capsys):
    assert cli.main([stored, "--layout", "parquet", "--out", f"{tmp_path}/json"], spark) == 0
    out = capsys.readouterr().out
    assert "✓ КР1.pdf  [id=1]" in out and "Предупреждения" in out and sorted(os.listdir(f"{tmp_path}/json")) == ["КР1.json", "КР2.json"]
    assert cli.main([stored, "--layout", "parquet", "--report", "1", "head"], spark) == 0
    out = capsys.readouterr().out
    assert "КР1.pdf" in out and "КР2.pdf" not in out and "n_ok: 1" in out
    assert cli.main([stored, "--layout", "parquet", "--validate"], spark) == 1
    out = capsys.readouterr().out
    assert "[FAIL] КР2.pdf" in out or "[PASS] КР2.pdf" in out
    assert cli.main([stored, "--layout", "parquet", "--legacy"], spark) == 2  # lines only, no spans
    assert cli.main([], spark) == 2
    assert cli.main([str(tmp_path), "--layout", "parquet"], spark) == 2
    with pytest.raises(SystemExit):
        cli.main(["x", "--profile", "other"], spark)


def stub(content):
    """A reader of files whose bytes are lines of text; what isn't text is broken."""
    box = {"x0": 50.0, "x1": 250.0}
    lines = content.decode().split("\n")
    at = lambda i: {"page": 1, "block_no": i, "line_no": 0, "span_no": 0, "size": 12.0, "font": "Serif", "bbox": box | {"y0": 14.0 * i, "y1": 14.0 * i + 10}}
    spans = [at(i) | {"text": x.rstrip("*"), "flags": 16 if x.endswith("*") else 0} for i, x in enumerate(lines)]
    return {"pages": [{"page": 1, "width": 600.0, "height": 800.0}], "spans": spans, "detected": [], "first_page_text": lines[0]}


def test_a_broken_file_does_not_stop_the_others(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "READ", stub)
    where = tmp_path / "in"
    where.mkdir()
    for name, lines in DOCS.items():
        (where / f"{name}.pdf").write_text("\n".join(lines))
    (where / "КР3.pdf").write_bytes(b"\xff\xfe broken")
    found = Engine(spark).parse(files.pdf_layout(spark, str(where), read=stub))
    assert sections(found) and {k.split("/")[-1]: v for k, v in sections(found).items()} == {"КР1.pdf": [("1", "Краткая информация", "Тело. ещё. и ещё.", None)]}
    rows = {r["file"]: r for r in found.quality.collect()}
    assert {k: r["ok"] for k, r in rows.items()} == {"КР1.pdf": True, "КР2.pdf": True, "КР3.pdf": False}
    assert "UnicodeDecodeError" in rows["КР3.pdf"]["error"] and rows["КР1.pdf"]["error"] is None and all(r["secs"] >= 0 for r in rows.values())
    assert cli.main([str(where)], spark) == 1
    out = capsys.readouterr()
    assert "успешно 2, с ошибкой 1, всего 3" in out.out and "ОШИБКА на КР3.pdf" in out.err
    assert sorted(os.listdir(where)) == ["КР1.json", "КР1.pdf", "КР2.json", "КР2.pdf", "КР3.pdf"]
    assert cli.main([str(where), "--prefix", "КР1", "--quiet", "--out", f"{tmp_path}/out"], spark) == 0
    assert os.listdir(f"{tmp_path}/out") == ["КР1.json"]
    capsys.readouterr()
    assert cli.main([str(where), "--report", "--out", f"{tmp_path}/report"], spark) == 1
    out = capsys.readouterr().out
    assert "n_ok: 2" in out and "n_bad: 1" in out and "error (1): КР3.pdf" in out and "ОШИБКА: UnicodeDecodeError" in out
    stored = spark.read.json(f"{tmp_path}/report/quality").collect()
    assert sorted((r["file"], r["ok"], r["error"] is not None) for r in stored) == [("КР1.pdf", True, False), ("КР2.pdf", True, False), ("КР3.pdf", False, True)]
    assert cli.main([str(where), "--legacy", "--out", f"{tmp_path}/old"], spark) == 1
    assert sorted(os.listdir(f"{tmp_path}/old")) == ["КР1.json", "КР2.json"]


def test_golden_criteria(spark):
    from docstruct.functions import patterns as P
    from docstruct.operators import quality as Q

    c = P.GOLDEN["КР79_2"]
    flat = [("1", "a", "t", None), ("2", "b", "t", None), ("3", "Лечение", "t", None), *[(n, "x", "t", 2) for n in c["children"]["3"]], ("4", "Медицинская реабилитация, природных лечебных факторов, в том числе основанных", "Реабилитация идёт", None)]
    flat += [("5", "Профилактика к применению методов профилактики", "t", None), *[(n, "x", "t", 8) for n in c["children"]["5"]], ("6", "x", "t", None), ("7", "x", "t", None)]
    rows = spark.createDataFrame([("d", i, *r) for i, r in enumerate(flat)], "doc_id string, sec_no int, number string, title string, text string, parent_sec_no int")
    stats = spark.createDataFrame([("d", 100.0, 374984, 58)], "doc_id string, coverage_percent double, total_chars long, sections_found long")
    got = Q.golden(rows, stats, {"d": c}).collect()
    assert len(got) == 14 and all(r["passed"] for r in got)
    bad = Q.golden(rows.where("number <> '3.2'"), stats.withColumn("coverage_percent", stats.coverage_percent - 1), {"d": c}).where("not passed").collect()
    assert {r["check"] for r in bad} == {"children of 3", "coverage"}


def test_shared_folder(spark, monkeypatch):
    from docstruct.sources import store

    made = store.materialize(spark.range(3))
    assert made.count() == 3 and store._written
    path = store._written[-1]
    monkeypatch.setattr(store, "_written", [path])
    assert store.clean(spark) == 1 and not os.path.exists(path)

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(dict)

        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        store.shared_dir(Cluster)


def test_streaming(spark, tmp_path):
    from pyspark.sql import functions as F

    found = layout(spark, DOCS)
    inner = lambda df, name: df.groupBy("doc_id").agg(F.collect_list(F.struct(*[c for c in df.columns if c != "doc_id"])).alias(name))
    detected = spark.createDataFrame([], S.DETECTED)
    whole = found.documents.join(inner(found.pages, "pages"), "doc_id").join(inner(found.lines, "lines"), "doc_id").join(inner(detected, "detected"), "doc_id", "left")
    whole.write.parquet(f"{tmp_path}/in")
    seen = {}
    incremental.parse_stream(spark, f"{tmp_path}/in", f"{tmp_path}/cp", lambda result, n: seen.update(sections(result))).awaitTermination()
    assert seen == {"КР1": [("1", "Краткая информация", "Тело. ещё. и ещё.", None)]}
