"""Command line: parse, report, validate and a small web form.

    python -m docstruct.cli INPUT [--profile cr] [--registry FILE.xlsx] [--out DIR] [--quiet] [--layout parquet|json]
    python -m docstruct.cli INPUT --report [N] [head|spread] [--out DIR]
    python -m docstruct.cli INPUT --validate
    python -m docstruct.cli INPUT --legacy [--out DIR]
    python -m docstruct.cli --serve [PORT]

INPUT is a PDF file or a folder of them, or with --layout a folder of layout relations. Without --out the JSON of PDF files
goes beside them. Exit code: 0, or 1 if a document failed (the others are done all the same), or 2 if there is nothing to
read or no such profile.
"""

from __future__ import annotations

import argparse
import datetime
import html
import os
import sys
import traceback
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import patterns as P
from .operators import quality as Q
from .plans.engine import Engine, Layout, Result
from .plans.profile import available_profiles
from .sources import files, sinks


def parser() -> argparse.ArgumentParser:
    from .plans import clinical  # noqa: F401

    p = argparse.ArgumentParser(prog="docstruct", description="Documents to structured relations and JSON.")
    p.add_argument("input", nargs="?")
    p.add_argument("--profile", default="cr", choices=available_profiles())
    p.add_argument("--registry", default=None, help="xlsx file with metadata by id")
    p.add_argument("--out", default=None, help="folder for JSON files")
    p.add_argument("--prefix", default="", help="read only PDF files whose names begin so")
    p.add_argument("--quiet", action="store_true")
    p.add_argument("--layout", default=None, choices=("parquet", "json"), help="INPUT holds layout relations of this format")
    p.add_argument("--report", nargs="*", default=None, metavar="N", help="quality report over N documents, head or spread")
    p.add_argument("--validate", action="store_true", help="PASS or FAIL of each document: unique ordered numbers, coverage, whole titles")
    p.add_argument("--legacy", action="store_true", help="the predecessor's flat sections and JSON")
    p.add_argument("--serve", nargs="?", type=int, const=5000, default=None, metavar="PORT")
    return p


#: How a PDF file is read.
READ = files.read_pdf


def failures(failed) -> list[str]:
    """A line for each file that couldn't be read."""
    return [] if failed is None else [f"✗ ОШИБКА на {r['source_file']}: {r['error']}" for r in failed.orderBy("source_file").toLocalIterator()]


def result(spark: SparkSession, source: str, profile: str, registry: str | None, layout: str | None, documents=None, prefix: str = "") -> Result:
    found = files.layout(spark, source, layout) if layout else files.pdf_layout(spark, source, prefix, READ)
    if documents is not None:
        found = chosen(found, documents(found.documents))
    return Engine(spark, profile).parse(found, files.registry(spark, registry) if registry else None)


def chosen(layout: Layout, documents) -> Layout:
    keys = documents.select("doc_id")
    some = lambda df: None if df is None else df.join(keys, "doc_id", "left_semi")
    return Layout(documents, some(layout.pages), some(layout.lines), some(layout.detected), layout.failed)


def report(found: Result) -> list[str]:
    """Lines of the quality report."""
    rows = Q.flags(found.quality).orderBy("file")
    good = "  {file:<16} id={id} sec={sections} tab={tables} cov={coverage:.1f}% {flags}"
    out = [good.format(**r.asDict()) if r["ok"] else f"  {r['file']:<16} ОШИБКА: {r['error']}" for r in rows.toLocalIterator()]
    s = Q.summary(found.quality).first().asDict()
    out += [f"{k}: {v}" for k, v in s.items()]
    return out + [f"{r['problem']} ({r['n']}): {', '.join(r['files'])}" for r in Q.problems(found.quality).orderBy("problem").collect()]


def pick(n: int, mode: str):
    def of(documents):
        return Q.spread(documents, "source_file", n) if mode == "spread" else documents.orderBy("source_file").limit(n)

    return of


class Form(BaseHTTPRequestHandler):
    """One form; a request parses one batch. Local only."""

    spark: SparkSession

    def _page(self, rows: str = "", values: dict | None = None) -> None:
        v = {k: html.escape((values or {}).get(k, "")) for k in ("input", "registry", "out")}
        options = "".join(f"<option>{html.escape(p)}</option>" for p in available_profiles())
        body = (
            "<!doctype html><meta charset=utf-8><form method=post>"
            + "".join(f"<p><label>{k} <input name={k} value=\"{v[k]}\"></label>" for k in v)
            + f"<p><select name=profile>{options}</select> <select name=layout><option value=''>pdf<option>parquet<option>json</select> <button>parse</button></form><table>{rows}</table>"
        ).encode()
        self.send_response(200)
        self.send_header("Content-Type", "text/html; charset=utf-8")
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self) -> None:  # noqa: N802
        self._page()

    def do_POST(self) -> None:  # noqa: N802
        sent = parse_qs(self.rfile.read(int(self.headers.get("Content-Length", 0))).decode())
        v = {k: x[0].strip() for k, x in sent.items()}
        try:
            found = result(self.spark, v.get("input", ""), v.get("profile", "cr"), v.get("registry"), v.get("layout") or None)
            if v.get("out"):
                sinks.write_files(found.json, v["out"])
            cells = found.quality.select("file", "id", "year", "sections", "tables", "coverage", "warns").orderBy("file").toLocalIterator()
            rows = "".join("<tr>" + "".join(f"<td>{html.escape(str(c))}</td>" for c in r) + "</tr>" for r in cells)
        except Exception as e:
            rows = f"<tr><td>{html.escape(str(e)[:2000])}</td></tr>"
        self._page(rows, v)

    def log_message(self, *args) -> None:
        pass


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    for stream in (sys.stdout, sys.stderr):
        if hasattr(stream, "reconfigure"):
            stream.reconfigure(encoding="utf-8", errors="replace")
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("docstruct").getOrCreate()
    if args.serve is not None:
        Form.spark = spark
        HTTPServer(("127.0.0.1", args.serve), Form).serve_forever()
    if not args.input:
        print("no input", file=sys.stderr)
        return 2
    if args.legacy:
        try:
            found = files.legacy(spark, args.input, args.layout, datetime.datetime.now().isoformat(timespec="seconds"), READ)
            if args.out:
                sinks.write_files(found.json, args.out)
            else:
                for r in found.json.orderBy("source_file").toLocalIterator():
                    print(r["json"])
            bad = failures(found.failed)
            print("\n".join(bad), file=sys.stderr)
            return int(bool(bad))
        except ValueError as e:
            print(e, file=sys.stderr)
            return 2
    choose = None
    if args.report is not None:
        n = int(next((x for x in args.report if x.isdigit()), 150))
        choose = pick(n, "spread" if "spread" in args.report else "head")
    try:
        found = result(spark, args.input, args.profile, args.registry, args.layout, choose, args.prefix)
        bad = failures(found.layout.failed)
        if found.layout.documents.isEmpty() and not bad:
            print(f"nothing to read in {args.input}", file=sys.stderr)
            return 2
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    try:
        if args.validate:
            rows = Q.regression(found.quality).join(found.quality.select("doc_id", "file"), "doc_id").orderBy("file").collect()
            print("\n".join(f"  [{'PASS' if r['passed'] else 'FAIL'}] {r['file']}" for r in rows))
            # documents of which more is known, by their names
            stem = dict(found.layout.documents.select(sinks.stem(F.col("source_file")).alias("s"), "doc_id").where(F.col("s").isin(*P.GOLDEN)).collect())
            more = Q.golden(found.sections, found.stats, {d: P.GOLDEN[s] for s, d in stem.items()}).orderBy("doc_id", "check").collect() if stem else []
            print("\n".join(f"  [{'PASS' if r['passed'] else 'FAIL'}] {r['doc_id']}: {r['check']}" for r in more))
            return int(not all(r["passed"] for r in [*rows, *more]))
        if args.report is not None:
            print("\n".join(report(found)))
            if args.out:
                found.quality.write.mode("overwrite").json(f"{args.out}/quality")
            return int(bool(bad))
        if args.out:
            sinks.write_files(found.json, args.out)
        elif not args.layout:
            sinks.write_files(found.json, None, "doc_id")
        if not args.quiet:
            for r in sinks.summary(found).orderBy("source_file").toLocalIterator():
                print(r["summary"])
        if bad:
            print("\n".join(bad), file=sys.stderr)
        done = found.layout.documents.count()
        print(f"\nГотово: успешно {done}, с ошибкой {len(bad)}, всего {done + len(bad)}.")
        return int(bool(bad))
    except Exception as e:
        print(f"✗ {e}", file=sys.stderr)
        if os.environ.get("DOCSTRUCT_DEBUG"):
            traceback.print_exc()
        return 1


if __name__ == "__main__":
    sys.exit(main())
