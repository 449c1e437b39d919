"""Schemas of the relations that go in and out."""

BBOX = "struct<x0:double,y0:double,x1:double,y1:double>"
DOCUMENTS = "doc_id string, path string, source_file string, first_page_text string"
PAGES = "doc_id string, page int, width double, height double"
SPANS = f"doc_id string, page int, block_no int, line_no int, span_no int, text string, size double, flags int, font string, bbox {BBOX}"
LINES = f"doc_id string, seq int, page int, text string, bbox {BBOX}, size double, bold boolean, gap_before double"
DETECTED = f"doc_id string, page int, tbl_no int, bbox {BBOX}, grid array<array<string>>, raw_text string"
REGISTRY = "ord int, id string, row map<string,string>"
