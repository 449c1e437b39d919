"""Text helpers as Column expressions. Unicode-aware throughout: Spark's own trim, \\s and (?i) know ASCII only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), value being worked out once however often f names it (plain composition would repeat it in the plan)."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip(x: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def norm(x: Column) -> Column:
    """Runs of white space to one space, none at the ends; null to the empty string."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"(?U)\s+", " "), "^ | $", "")


def clean_line(x: Column) -> Column:
    """A line as it comes from a page: no-break spaces to spaces, invisible signs away, spaces and tabs collapsed."""
    return strip(F.regexp_replace(F.translate(F.translate(x, " ", " "), P.TRASH, ""), r"[ \t]+", " "))


def split_lines(x: Column) -> Column:
    return F.split(x, r"\R|[\x1c-\x1e]", -1)


def collapse(x: Column) -> Column:
    """Every line stripped, at most one blank line in a row, none at the ends; null to the empty string."""
    lines = F.transform(split_lines(F.coalesce(x, F.lit(""))), strip)
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def join_title(parts: Column) -> Column:
    """Parts of a title in one line: breaks after hyphens closed, no space before punctuation."""
    title = F.array_join(F.filter(F.transform(parts, strip), lambda p: p != ""), " ")
    title = F.regexp_replace(title, r"(?U)-\s+", "-")
    return norm(F.regexp_replace(title, r"(?U)\s+([,.;:])", "$1"))


def top_int(number: Column) -> Column:
    """First component of a dotted number; 0 if there is none."""
    return F.coalesce(F.split_part(number, F.lit("."), F.lit(1)).try_cast("int"), F.lit(0))


def level(number: Column) -> Column:
    return F.size(F.split(number, r"\.", -1))


def number_key(number: Column) -> Column:
    """A dotted number as integers, which compare like the number's places."""
    return F.transform(F.filter(F.split(number, r"\.", -1), lambda p: p.rlike(r"^\d+$")), lambda p: p.try_cast("int"))


def order_valid(new: Column, last: Column) -> Column:
    """Whether a number comes after the last one; true if either is missing."""
    return F.when(new.isNull() | last.isNull() | (new == "") | (last == ""), True).otherwise(number_key(new) > number_key(last))


def matches(x: Column, pattern: str) -> Column:
    return x.rlike(pattern)


def group(x: Column, pattern: str, n: int = 1) -> Column:
    """A group of the first match; null if there is no match or the group is empty."""
    return F.nullif(F.regexp_extract(x, pattern, n), F.lit(""))


def visual(size: Column, bold: Column, body: Column) -> Column:
    return (size >= body * P.VISUAL_RATIO) | bold


def icd_codes(segment: Column) -> Column:
    """Codes in order of first appearance, Cyrillic look-alikes read as Latin."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(segment, F.lit("")), *P.LOOKALIKES), F.lit(P.CODE), F.lit(0)))


def round_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def first_upper(x: Column) -> Column:
    return x.rlike(r"^\p{IsUppercase}")


def first_lower(x: Column) -> Column:
    return x.rlike(r"^\p{IsLowercase}")


def count_of(x: Column, sign: str) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(sign), F.lit("")))
