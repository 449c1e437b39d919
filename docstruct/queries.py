"""Driver queries of the engine's operators over the driver's tables, each with its DuckDB SQL.

The SQL is written from the operators' definitions, with other means where there are any (correlated subqueries, recursive
CTEs, list functions), not from the Spark plans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import patterns as P
from .functions import text as T
from .operators import fold as FO
from .operators import legacy as V1
from .operators import lines as L
from .operators import quality as Q
from .operators import registry as R
from .operators import start as ST
from .operators import stats as STATS
from .operators import tables as TB
from .operators import tree as TR
from .plans.clinical import ClinicalGuideline
from .plans.profile import Profile
from .sources import adapters as A
from .sources.store import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# --- the adapters in SQL ------------------------------------------------------------------------------------------------
DL = "dl AS (SELECT doc_id, (unnest(range(1, len(p) + 1)) - 1)::INT AS seq, unnest(p) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))"
PB = """pb AS (SELECT doc_id, seq, tag, text, CASE tag WHEN 'title' THEN 18.0 WHEN 'h1' THEN 24.0 WHEN 'h2' THEN 20.0 WHEN 'h3' THEN 18.0 WHEN 'h4' THEN 16.0 WHEN 'h5' THEN 16.0 WHEN 'h6' THEN 16.0 ELSE 12.0 END::DOUBLE AS size,
  tag IN ('h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'b', 'strong', 'th') AS bold FROM (
  SELECT page_id AS doc_id, (unnest(range(1, len(a) + 1)) - 1)::INT AS seq, lower(unnest(a)) AS tag, unnest(b) AS text
  FROM (SELECT page_id, regexp_extract_all(h, '<(/?[a-zA-Z][a-zA-Z0-9]*)[^<>]*>([^<]*)', 1) AS a, regexp_extract_all(h, '<(/?[a-zA-Z][a-zA-Z0-9]*)[^<>]*>([^<]*)', 2) AS b
    FROM (SELECT page_id, '<p>' || regexp_replace(html, '(?is)<(script|style)\\b.*?</(script|style)>|<!--.*?-->', '', 'g') AS h FROM pages))) WHERE trim(text, ' ') <> '')"""
EL = """el AS (SELECT *, idx // 20 AS page, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 END AS level FROM (
  SELECT user_id AS doc_id, event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS idx, event_type, value AS size, (props->>'$.k')::DOUBLE AS y0 FROM events))"""
NL = """nl AS (SELECT p_partkey AS id, p_size > 25 AS visual, CASE p_partkey % 10
  WHEN 0 THEN n || '.' || m || ' ' || cap WHEN 1 THEN n || ' . ' || m || '. ' || p_name WHEN 2 THEN n || '. ' || main || ' ' || p_name WHEN 3 THEN n || '.' WHEN 4 THEN n || '.' || m
  WHEN 5 THEN p_name || ' Список сокращений' WHEN 6 THEN n || '.' || m || ' ' || cap || ' [3]' WHEN 7 THEN n || '.' || m || ' ' || cap || ' ....... 12' WHEN 8 THEN '- ' || p_name ELSE m || '. ' || main END AS text
  FROM (SELECT *, (p_partkey % 12)::VARCHAR AS n, (p_partkey % 7)::VARCHAR AS m, array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS cap,
    ['Краткая информация', 'Диагностика', 'Лечение', 'Медицинская', 'Реабилитация и', 'Критерии оценки качества'][p_partkey % 6 + 1] AS main FROM part))"""
RG = """rg AS (SELECT c_custkey AS ord, (c_custkey % 1000)::VARCHAR || '_' || (c_nationkey % 4) AS id, c_name AS name, c_mktsegment AS age, CASE WHEN c_acctbal > 0 THEN 'active' ELSE ' ' END AS status FROM customer)"""
DEDUP = "reg AS (SELECT id, min(ord) AS ord, arg_max(name, ord) AS name, arg_max(age, ord) AS age, arg_max(status, ord) AS status FROM rg GROUP BY id)"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# --- lines --------------------------------------------------------------------------------------------------------------
@query("line_explode", f"WITH {DL} SELECT doc_id, seq, text FROM dl")
def line_explode(spark, sf):
    return A.document_lines(A.table(spark, sf, "documents"))


@query("line_clean", f"WITH {DL} SELECT doc_id, seq, trim(regexp_replace(text, '[ \\t]+', ' ', 'g'), ' ' || chr(9) || chr(13)) AS clean, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS norm FROM dl")
def line_clean(spark, sf):
    return A.document_lines(A.table(spark, sf, "documents")).select("doc_id", "seq", T.clean_line(F.col("text")).alias("clean"), T.norm(F.col("text")).alias("norm"))


@query("line_filter_prose", f"""WITH {DL}, s AS (SELECT doc_id, trim(text) AS t FROM dl)
SELECT doc_id, count(*) FILTER (t <> '' AND NOT regexp_full_match(t, '[0-9]{{1,3}}')) AS usable, count(*) FILTER (regexp_matches(t, '\\.{{3,}}|_{{3,}}')) AS leaders,
  count(*) FILTER (t <> '' AND NOT regexp_full_match(t, '[0-9]{{1,3}}') AND NOT regexp_matches(t, '\\.{{3,}}|_{{3,}}') AND regexp_matches(t, '[А-Яа-яA-Za-z]')) AS prose FROM s GROUP BY doc_id""")
def line_filter_prose(spark, sf):
    rows = A.document_lines(A.table(spark, sf, "documents")).withColumn("t", T.strip(F.col("text")))
    t = F.col("t")
    return rows.groupBy("doc_id").agg(F.count_if(L.usable(t)).alias("usable"), F.count_if(L.is_leader(t)).alias("leaders"), F.count_if(L.is_prose(t, F.lit(None))).alias("prose"))


@query("text_collapse", "SELECT doc_id, trim(regexp_replace(array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x)), chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), chr(10) || ' ') AS collapsed FROM documents")
def text_collapse(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", T.collapse(F.col("text")).alias("collapsed"))


@query("word_counts", "SELECT doc_id, length(text)::BIGINT AS total_chars, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''))::BIGINT AS total_words FROM documents")
def word_counts(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", F.length("text").cast("long").alias("total_chars"), STATS.words(F.col("text")).cast("long").alias("total_words"))


@query("html_layout_lines", f"WITH {PB} SELECT doc_id, seq, tag, text, size, bold FROM pb")
def html_layout_lines(spark, sf):
    return A.html_lines(A.table(spark, sf, "pages"))


@query("span_to_line_rollup", f"""WITH {PB} SELECT doc_id, page, block_no, line_no, trim(regexp_replace(string_agg(text, '' ORDER BY seq), '[ \\t]+', ' ', 'g')) AS text, max(size) AS size, bool_or(bold) AS bold
FROM (SELECT *, (seq // 60)::INT AS page, (seq // 12)::INT AS block_no, (seq // 3)::INT AS line_no FROM pb) GROUP BY ALL HAVING trim(string_agg(text, '')) <> ''""")
def span_to_line_rollup(spark, sf):
    seq = F.col("seq")
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("x0", "y0", "x1", "y1")])
    spans = A.html_lines(A.table(spark, sf, "pages")).select(
        "doc_id", F.floor(seq / 60).cast("int").alias("page"), F.floor(seq / 12).cast("int").alias("block_no"), F.floor(seq / 3).cast("int").alias("line_no"), seq.alias("span_no"),
        "text", "size", F.when(F.col("bold"), P.BOLD_FLAG).otherwise(4).alias("flags"), F.lit("Serif").alias("font"), zero.alias("bbox"),
    )
    rows = L.lines_from_spans(spans)
    lines = spans.where("text <> ''").select("doc_id", "page", "block_no", "line_no").distinct()
    # lines_from_spans numbers what stays; the keys come back by the same order
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "block_no", "line_no")) - 1
    blank = spans.groupBy("doc_id", "page", "block_no", "line_no").agg(T.clean_line(F.array_join(F.collect_list("text"), "")).alias("t")).where("t <> ''").drop("t")
    return lines.join(blank, ["doc_id", "page", "block_no", "line_no"], "left_semi").withColumn("seq", nth).join(rows.drop("page"), ["doc_id", "seq"]).select("doc_id", "page", "block_no", "line_no", "text", "size", "bold")


@query("visual_flag", f"WITH {PB} SELECT doc_id, count(*) FILTER (size >= 16.2 OR bold) AS visual, count(*) AS n FROM pb GROUP BY doc_id")
def visual_flag(spark, sf):
    rows = A.html_lines(A.table(spark, sf, "pages"))
    return rows.groupBy("doc_id").agg(F.count_if(T.visual(F.col("size"), F.col("bold"), F.lit(P.DEFAULT_BODY))).alias("visual"), F.count("*").alias("n"))


@query("body_size_mode", f"""WITH {EL}, c AS (SELECT doc_id, round_even(size, 1) AS body, count(*) AS n, min(seq) AS first FROM el WHERE size BETWEEN 6 AND 20 GROUP BY ALL)
SELECT doc_id, body FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1""")
def body_size_mode(spark, sf):
    return L.body_size(A.event_lines(A.table(spark, sf, "events")))


@query("body_size_char_weighted", f"""WITH {PB}, c AS (SELECT doc_id, round_even(size, 1) AS body, sum(length(text)) AS n, min(seq) AS first FROM pb WHERE seq // 20 <= 40 GROUP BY ALL)
SELECT doc_id, body FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1""")
def body_size_char_weighted(spark, sf):
    return L.body_size_by_chars(A.html_lines(A.table(spark, sf, "pages")).withColumn("page", F.floor(F.col("seq") / 20)))


@query("gap_before", f"WITH {EL} SELECT doc_id, seq, page::INT AS page, coalesce(y0 - lag(y0) OVER (PARTITION BY doc_id, page ORDER BY seq), 0.0) AS gap_before FROM el")
def gap_before(spark, sf):
    rows = A.event_lines(A.table(spark, sf, "events")).withColumn("bbox", F.struct("y0"))
    return L.with_gaps(rows).select("doc_id", "seq", "page", "gap_before")


@query("blank_gap_upper_median", f"""WITH {EL}, g AS (SELECT doc_id, coalesce(y0 - lag(y0) OVER (PARTITION BY doc_id, page ORDER BY seq), 0.0) AS gap FROM el),
l AS (SELECT doc_id, list_sort(list(gap) FILTER (gap > 2 AND gap < 60)) AS gs FROM g GROUP BY doc_id)
SELECT doc_id, CASE WHEN len(gs) < 5 OR gs IS NULL THEN 1e9 ELSE gs[len(gs) // 2 + 1] * 1.85::DOUBLE END AS blank_gap FROM l""")
def blank_gap_upper_median(spark, sf):
    rows = A.event_lines(A.table(spark, sf, "events")).withColumn("bbox", F.struct("y0"))
    return L.blank_gap(L.with_gaps(rows))


# --- tables -------------------------------------------------------------------------------------------------------------
EB = f"""{EL}, eb AS (SELECT *, floor(size)::INT % 160 / 4.0::DOUBLE - 4 AS x0, floor(size)::INT % 160 / 4.0::DOUBLE + 60 AS x1, y0 + 8 AS y1,
  list_transform(range(seq % 4), lambda r: list_transform(range(idx % 3 + 1), lambda c: CASE WHEN (r + c + seq) % 3 = 0 THEN '' ELSE 'v' || r END)) AS grid FROM el)"""


def _boxes(spark, sf) -> DataFrame:
    rows = A.event_lines(A.table(spark, sf, "events"))
    left = F.floor("size") % 160 / F.lit(4.0)
    box = F.struct((left - 4).alias("x0"), F.col("y0").alias("y0"), (left + 60).alias("x1"), (F.col("y0") + 8).alias("y1"))
    cell = lambda r: lambda c: F.when((r + c + F.col("seq")) % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("v"), r.cast("string")))
    counted = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).otherwise(F.array().cast("array<long>"))
    grid = F.transform(counted(F.col("seq") % 4), lambda r: F.transform(counted(F.col("idx") % 3 + 1), cell(r)))
    return rows.withColumn("bbox", box).withColumn("grid", grid).withColumn("tbl_no", F.col("seq"))


@query("table_validity", f"""WITH {EB} SELECT doc_id, seq AS tbl_no, CASE
  WHEN NOT (y0 BETWEEN -2 AND 92 AND y1 BETWEEN -2 AND 92 AND x0 >= -2 AND x1 <= 97) THEN 'junk'
  WHEN len(grid) >= 2 AND coalesce(list_max(list_transform(grid, lambda r: len(r))), 0) >= 2 AND len(list_filter(flatten(grid), lambda c: c <> '')) >= 4 THEN 'ok' ELSE 'small' END AS verdict,
  round_even(x0, 1) AS x0, round_even(y1, 1) AS y1 FROM eb WHERE event_type = 'view'""")
def table_validity(spark, sf):
    rows = _boxes(spark, sf).where("event_type = 'view'")
    pages = rows.select("doc_id", "page").distinct().withColumn("width", F.lit(95.0)).withColumn("height", F.lit(90.0))
    box = TB.rounded(F.col("bbox"))
    return TB.judged(rows, pages).select("doc_id", "tbl_no", "verdict", box[0].alias("x0"), box[3].alias("y1"))


@query("table_validity_v1", f"""WITH {EB} SELECT doc_id, seq AS tbl_no, CASE WHEN NOT (y0 BETWEEN -2 AND 92 AND y1 BETWEEN -2 AND 92) THEN 'junk'
  WHEN len(grid) >= 2 AND coalesce(list_max(list_transform(grid, lambda r: len(r))), 0) >= 2 AND len(list_filter(flatten(grid), lambda c: c <> '')) >= 4 THEN 'ok' ELSE 'small' END AS verdict FROM eb WHERE event_type = 'view'""")
def table_validity_v1(spark, sf):
    rows = _boxes(spark, sf).where("event_type = 'view'")
    pages = rows.select("doc_id", "page").distinct().withColumn("width", F.lit(95.0)).withColumn("height", F.lit(90.0))
    return TB.judged(rows, pages, sides=False).select("doc_id", "tbl_no", "verdict")


@query("table_subtraction_antijoin", f"""WITH {EB} SELECT doc_id, seq FROM eb l WHERE event_type <> 'view' AND (level = 1 OR NOT EXISTS (
  SELECT 1 FROM eb t WHERE t.event_type = 'view' AND t.doc_id = l.doc_id AND t.page = l.page AND (l.x0 + l.x1) / 2 BETWEEN t.x0 - 2 AND t.x1 + 2 AND (l.y0 + l.y1) / 2 BETWEEN t.y0 AND t.y1))""")
def table_subtraction_antijoin(spark, sf):
    rows = _boxes(spark, sf)
    kept = TB.outside(rows.where("event_type <> 'view'"), rows.where("event_type = 'view'").select("doc_id", "page", "bbox"), F.col("level") == 1)
    return kept.select("doc_id", "seq")


@query("table_subtraction_v1", f"""WITH {EB} SELECT doc_id, seq FROM eb l WHERE event_type <> 'view' AND NOT EXISTS (
  SELECT 1 FROM eb t WHERE t.event_type = 'view' AND t.doc_id = l.doc_id AND t.page = l.page AND (l.x0 + l.x1) / 2 BETWEEN t.x0 - 2 AND t.x1 + 2 AND (l.y0 + l.y1) / 2 BETWEEN t.y0 AND t.y1)""")
def table_subtraction_v1(spark, sf):
    rows = _boxes(spark, sf)
    return TB.outside(rows.where("event_type <> 'view'"), rows.where("event_type = 'view'").select("doc_id", "page", "bbox")).select("doc_id", "seq")


@query("caption_nearest", f"""WITH {EB}, p AS (SELECT t.doc_id, t.seq AS tbl_no, c.seq AS caption, row_number() OVER (PARTITION BY t.doc_id, t.seq ORDER BY abs(t.y0 - c.y1), c.seq) AS n
  FROM eb t LEFT JOIN eb c ON c.event_type = 'click' AND c.doc_id = t.doc_id AND c.page = t.page AND c.y1 <= t.y0 + 10 AND t.y0 - c.y1 <= 120 WHERE t.event_type = 'view')
SELECT doc_id, tbl_no, caption::VARCHAR AS caption FROM p WHERE n = 1""")
def caption_nearest(spark, sf):
    rows = _boxes(spark, sf)
    caps = rows.where("event_type = 'click'").select("doc_id", "page", "seq", F.lit("").alias("number"), F.col("seq").cast("string").alias("caption"), F.col("bbox.y1").alias("y1"))
    return TB.nearest_caption(rows.where("event_type = 'view'").select("doc_id", "page", "tbl_no", "bbox"), caps).select("doc_id", "tbl_no", "caption")


@query("table_counters", f"""WITH {EB} SELECT doc_id, count(*) FILTER (v = 'junk') AS junk, count(*) FILTER (v = 'small') AS small FROM (SELECT doc_id, CASE WHEN NOT (y0 BETWEEN -2 AND 92 AND y1 BETWEEN -2 AND 92 AND x0 >= -2 AND x1 <= 97) THEN 'junk'
  WHEN len(grid) >= 2 AND idx % 3 >= 1 AND len(list_filter(flatten(grid), lambda c: c <> '')) >= 4 THEN 'ok' ELSE 'small' END AS v FROM eb WHERE event_type = 'view') GROUP BY doc_id""")
def table_counters(spark, sf):
    rows = _boxes(spark, sf).where("event_type = 'view'")
    pages = rows.select("doc_id", "page").distinct().withColumn("width", F.lit(95.0)).withColumn("height", F.lit(90.0))
    return TB.judged(rows, pages).groupBy("doc_id").agg(F.count_if(F.col("verdict") == "junk").alias("junk"), F.count_if(F.col("verdict") == "small").alias("small"))


# --- headings -----------------------------------------------------------------------------------------------------------
_MAIN = [
    ("краткая информация", "1"), ("диагностика", "2"), ("лечение", "3"), ("медицинская реабилитация", "4"), ("реабилитация", "4"), ("профилактика", "5"),
    ("организация оказания медицинской помощи", "6"), ("организация медицинской помощи", "6"), ("дополнительная информация", "7"), ("критерии оценки качества", "7, 8, 9"),
]
_CASES = " ".join(f"WHEN starts_with(low, '{p}') OR starts_with('{p}', low || ' ') THEN top IN ({n})" for p, n in _MAIN)
HEADS = f"""{NL}, t0 AS (SELECT id, visual, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM nl),
t1 AS (SELECT *, t = '' OR regexp_matches(t, '^[+\\-•▪□✓*−–]') OR regexp_matches(t, '\\.{{3,}}|_{{3,}}') OR regexp_matches(t, '(?i)^(таблица|рисунок|табл\\.|рис\\.)($|[^\\p{{L}}\\p{{N}}_])') AS barred,
  replace(regexp_extract(t, '^(\\d+(?:\\s*\\.\\s*\\d+){{0,4}})\\s*\\.?\\s+(.+)$', 1), ' ', '') AS num, regexp_extract(t, '^(\\d+(?:\\s*\\.\\s*\\d+){{0,4}})\\s*\\.?\\s+(.+)$', 2) AS title,
  replace(regexp_extract(t, '^(\\d+(?:\\s*\\.\\s*\\d+){{0,4}})\\s*\\.?$', 1), ' ', '') AS alone FROM t0),
t2 AS (SELECT *, lower(title) AS low, TRY_CAST(split_part(num, '.', 1) AS INT) AS top, len(string_split(num, '.'))::INT AS lvl, TRY_CAST(split_part(alone, '.', 1) AS INT) AS otop, len(string_split(alone, '.'))::INT AS olvl FROM t1),
t3 AS (SELECT *, num <> '' AND title <> '' AND NOT regexp_matches(title, '^[+\\-•▪□✓*−–]') AND NOT regexp_matches(title, '\\[\\s*\\d') AND NOT regexp_matches(title, '\\(\\s*\\d+\\s*[А-СA-Cа-сa-c]\\s*\\)')
  AND len(title) - len(replace(title, ')', '')) <= len(title) - len(replace(title, '(', '')) AND top BETWEEN 1 AND 9
  AND CASE WHEN lvl = 1 THEN length(title) <= 500 AND CASE {_CASES} ELSE false END ELSE length(title) <= 300 AND (visual OR regexp_matches(title, '^\\p{{Lu}}')) END AS is_num,
  alone <> '' AND otop BETWEEN 1 AND 9 AS is_only, CASE WHEN regexp_matches(t, '(?i)список\\s+сокращ') THEN 'abbreviations' WHEN regexp_matches(t, '(?i)критери[\\p{{L}}\\p{{N}}_]*\\s+оценки\\s+качеств') THEN 'criteria_quality' END AS section,
  section IS NOT NULL AND visual AND length(t) <= 90 AS is_named FROM t2)"""


def _heads(spark, sf) -> tuple[DataFrame, ClinicalGuideline]:
    return A.numbered_lines(A.table(spark, sf, "part")).withColumn("t", T.norm(F.col("text"))), ClinicalGuideline()


@query("heading_numbered", f"WITH {HEADS} SELECT id, num AS number, title, lvl AS level FROM t3 WHERE is_num")
def heading_numbered(spark, sf):
    rows, profile = _heads(spark, sf)
    return rows.withColumn("h", profile.numbered(F.col("t"), F.col("visual"))).where("h is not null").select("id", "h.number", "h.title", "h.level")


@query("heading_number_only", f"WITH {HEADS} SELECT id, alone AS number, olvl AS level FROM t3 WHERE is_only")
def heading_number_only(spark, sf):
    rows, profile = _heads(spark, sf)
    return rows.withColumn("h", profile.number_only(F.col("t"))).where("h is not null").select("id", "h.number", "h.level")


@query("heading_named", f"WITH {HEADS} SELECT id, t AS title, section FROM t3 WHERE is_named")
def heading_named(spark, sf):
    rows, profile = _heads(spark, sf)
    return rows.withColumn("h", profile.named(F.col("t"), F.col("visual"))).where("h is not null").select("id", "h.title", profile.named_id(F.col("t")).alias("section"))


@query("heading_coalesce", f"""WITH {HEADS} SELECT id, CASE WHEN barred THEN NULL WHEN is_num THEN 'numbered' WHEN is_only THEN 'number_only' WHEN is_named THEN 'named' END AS kind,
  CASE WHEN barred THEN NULL WHEN is_num THEN num WHEN is_only THEN alone END AS number, CASE WHEN barred THEN 0 WHEN is_num THEN lvl WHEN is_only THEN olvl WHEN is_named THEN 1 ELSE 0 END AS level FROM t3""")
def heading_coalesce(spark, sf):
    rows, profile = _heads(spark, sf)
    return rows.withColumn("h", profile.heading(F.col("text"), F.col("visual"))).select("id", "h.kind", "h.number", F.coalesce("h.level", F.lit(0)).alias("level"))


@query("inline_split", f"""WITH {NL}, j AS (SELECT id, trim(regexp_replace(string_agg(text, ' ' ORDER BY id) OVER (ORDER BY id ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING), '\\s+', ' ', 'g')) AS t FROM nl),
s AS (SELECT id, string_split(regexp_replace(t, '\\s+((?:[1-7](?:\\.\\d+){{0,4}})\\.?\\s+(?:Краткая|Диагностика|Лечение|Медицинская|Профилактика|Организация|Дополнительная|Критерии)($|[^\\p{{L}}\\p{{N}}_]))', chr(1) || '\\1', 'g'), chr(1)) AS p FROM j)
SELECT id, (unnest(range(1, len(p) + 1)) - 1)::INT AS part, trim(unnest(p)) AS text FROM s""")
def inline_split(spark, sf):
    # two lines joined, so that headings stand inside of lines; neighbours by key, which has no gaps
    rows = A.numbered_lines(A.table(spark, sf, "part")).select("id", "text")
    after = rows.select((F.col("id") - 1).alias("id"), F.col("text").alias("next"))
    joined = rows.join(after, "id", "left").withColumn("text", F.concat_ws(" ", "text", "next"))
    return joined.select("id", F.posexplode(ClinicalGuideline().parts(F.col("text"))).alias("part", "text"))


@query("title_join", f"WITH {NL} SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(text || ' - end , of . it', '-\\s+', '-', 'g'), '\\s+([,.;:])', '\\1', 'g'), '\\s+', ' ', 'g')) AS title FROM nl")
def title_join(spark, sf):
    return A.numbered_lines(A.table(spark, sf, "part")).select("id", T.join_title(F.array("text", F.lit(" - end "), F.lit(" "), F.lit(", of . it"))).alias("title"))


# --- where the content begins ---------------------------------------------------------------------------------------------
@query("leader_islands", f"""WITH {EL}, l AS (SELECT doc_id, idx, coalesce((idx - lag(idx) OVER (PARTITION BY doc_id ORDER BY idx) > 4)::INT, 0) AS jump FROM el WHERE event_type = 'view')
SELECT doc_id, idx::INT AS idx, (sum(jump) OVER (PARTITION BY doc_id ORDER BY idx))::BIGINT AS island FROM l""")
def leader_islands(spark, sf):
    rows = A.event_lines(A.table(spark, sf, "events")).where("event_type = 'view'").select("doc_id", "idx")
    return ST.leader_islands(rows, gap=4)


CODES = f"""{EL}, cd AS (SELECT *, CASE event_type WHEN 'signup' THEN 'B' WHEN 'purchase' THEN 'H' WHEN 'error' THEN 'N' ELSE 'P' END AS code, level IN (1, 2) AS numbered FROM el),
ah AS (SELECT *, coalesce(string_agg(code, '') OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND 23 FOLLOWING), '') AS view FROM cd),
hit AS (SELECT *, regexp_matches(split_part(view, 'B', 1), 'PN*PN*P') AS ahead FROM ah)"""


def _codes(spark, sf) -> DataFrame:
    code = F.when(F.col("event_type") == "signup", "B").when(F.col("event_type") == "purchase", "H").when(F.col("event_type") == "error", "N").otherwise("P")
    heading = F.when(F.col("level") < 3, F.struct(F.lit("numbered").alias("kind"), F.col("seq").cast("string").alias("number"), F.col("level")))
    rows = A.event_lines(A.table(spark, sf, "events")).withColumn("code", code).withColumn("heading", heading)
    return rows.withColumn("visual", F.col("size") > 60).withColumn("leader", F.col("event_type") == "view").withColumn("toc", F.col("size") > 120)


@query("prose_lookahead", f"WITH {CODES} SELECT doc_id, idx::INT AS idx, ahead FROM hit")
def prose_lookahead(spark, sf):
    rows = _codes(spark, sf)
    return rows.select("doc_id", "idx", ST.prose_ahead(rows).alias("ahead"))


@query("content_start", f"""WITH RECURSIVE {CODES}, an AS (SELECT doc_id, min(idx) FILTER (size > 120) AS a FROM hit GROUP BY doc_id),
ld AS (SELECT h.doc_id, h.idx, CASE WHEN a IS NULL THEN h.idx <= 400 ELSE h.idx BETWEEN a AND a + 60 END AS near FROM hit h JOIN an USING (doc_id) WHERE event_type = 'view'),
ok AS (SELECT doc_id, min(idx) FILTER (near) AS s FROM ld GROUP BY doc_id HAVING count(*) FILTER (near) >= 4),
walk AS (SELECT doc_id, s AS e FROM ok UNION ALL SELECT w.doc_id, (SELECT min(idx) FROM ld WHERE ld.doc_id = w.doc_id AND ld.idx > w.e) FROM walk w WHERE (SELECT min(idx) FROM ld WHERE ld.doc_id = w.doc_id AND ld.idx > w.e) - w.e <= 40),
te AS (SELECT doc_id, max(e) AS e FROM walk GROUP BY doc_id)
SELECT doc_id, coalesce(min(idx) FILTER (numbered AND ahead AND idx > e), CASE WHEN count(*) FILTER (level = 1 AND size > 60) >= 2 THEN min(idx) FILTER (numbered AND ahead AND size > 60) END,
  min(idx) FILTER (numbered AND ahead), min(idx) FILTER (level = 1), min(idx) FILTER (numbered), 0)::INT AS start FROM hit LEFT JOIN te USING (doc_id) GROUP BY doc_id""")
def content_start(spark, sf):
    return ST.content_start(_codes(spark, sf))


@query("front_split", f"""WITH {EL} SELECT doc_id, bucket, string_agg(event_type, ' ' ORDER BY idx) AS text FROM (
  SELECT *, CASE WHEN max((size > 120)::INT) OVER (PARTITION BY doc_id ORDER BY idx) > 0 THEN 'toc' ELSE 'front_matter' END AS bucket FROM el) WHERE NOT size > 120 GROUP BY ALL""")
def front_split(spark, sf):
    rows = ST.front_split(A.event_lines(A.table(spark, sf, "events")).withColumn("toc", F.col("size") > 120))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "event_type"))), lambda x: x["event_type"]), " ")
    return rows.groupBy("doc_id", "bucket").agg(text.alias("text"))


@query("region_tail", f"""WITH {EL}, r AS (SELECT doc_id, idx, CASE WHEN event_type = 'error' AND size > 40 THEN 'references' WHEN event_type = 'view' AND size > 60 THEN 'appendices' END AS region FROM el),
s AS (SELECT doc_id, min(idx) FILTER (region = 'references') AS s FROM r GROUP BY doc_id)
SELECT doc_id, idx::INT AS idx, (SELECT arg_max(x.region, x.idx) FROM r x WHERE x.doc_id = r.doc_id AND x.region IS NOT NULL AND x.idx BETWEEN s.s AND r.idx) AS bucket,
  (SELECT count(*) FROM r x WHERE x.doc_id = r.doc_id AND x.region IS NOT NULL AND x.idx BETWEEN s.s AND r.idx)::BIGINT AS item FROM r JOIN s USING (doc_id) WHERE r.idx >= s.s""")
def region_tail(spark, sf):
    region = F.when((F.col("event_type") == "error") & (F.col("size") > 40), "references").when((F.col("event_type") == "view") & (F.col("size") > 60), "appendices")
    rows = A.event_lines(A.table(spark, sf, "events")).withColumn("region", region)
    return ST.excluded_tail(rows, order="idx").where("tail").select("doc_id", "idx", "bucket", "item")


# --- sections -----------------------------------------------------------------------------------------------------------
#: Order-only fold: signups and purchases are numbered headings with their k as number (a top one, or one of top 1), values over 60 visual.
FOLD = f"""{EL}, hd AS (SELECT *, CASE level WHEN 1 THEN (y0 % 9 + 1)::INT WHEN 2 THEN (y0 % 7)::INT END AS n, size > 60 AS visual FROM el),
st AS (
  SELECT doc_id, idx, level, n, 0 AS top, NULL::INT[] AS last, NULL::INT[] AS open, false AS took FROM hd WHERE false UNION ALL SELECT DISTINCT doc_id, -1::BIGINT, NULL, NULL, 0, NULL::INT[], NULL::INT[], false FROM hd
  UNION ALL
  SELECT h.doc_id, h.idx, h.level, h.n, CASE WHEN h.level = 1 AND o THEN greatest(top, h.n) ELSE top END, CASE WHEN o OR h.level IS NULL OR h.level = 3 OR NOT o THEN coalesce(open, last) ELSE last END,
    CASE WHEN o THEN CASE h.level WHEN 1 THEN [h.n] ELSE [1, h.n] END END, o
  FROM (SELECT s.*, s.idx + 1 AS nxt FROM st s) s JOIN hd h ON h.doc_id = s.doc_id AND h.idx = s.nxt,
    LATERAL (SELECT coalesce(CASE h.level WHEN 1 THEN h.n = top + 1 OR (h.n > top AND h.visual) WHEN 2 THEN last IS NULL OR [1, h.n] > last END, false) AS o))"""


class _OrderOnly(Profile):
    """Headings come classified, nothing continues or attaches."""

    document_type = "events"

    def heading(self, text, visual):
        return F.col("heading")

    def region(self, text):
        return F.lit(None).cast("string")

    def named_id(self, title):
        return F.lit(None).cast("string")

    def metadata(self, texts, registry):
        return texts


def _folded(spark, sf) -> DataFrame:
    n = F.when(F.col("level") == 1, (F.col("y0") % 9 + 1).cast("int")).when(F.col("level") == 2, (F.col("y0") % 7).cast("int"))
    number = F.when(F.col("level") == 1, n.cast("string")).when(F.col("level") == 2, F.concat(F.lit("1."), n.cast("string")))
    kind = "struct<kind: string, number: string, title: string, level: int>"
    heading = F.when(F.col("level") < 3, F.struct(F.lit("numbered").alias("kind"), number.alias("number"), F.col("event_type").alias("title"), F.col("level").alias("level"))).cast(kind)
    rows = A.event_lines(A.table(spark, sf, "events")).withColumn("heading", heading).withColumn("visual", F.col("size") > 60)
    rows = rows.select("doc_id", "idx", F.col("event_type").alias("text"), "heading", "visual", F.lit(None).cast("string").alias("region"), F.lit(False).alias("break_before"))
    profile = _OrderOnly()
    rows = FO.features(rows, profile, order="idx")
    return rows.select("doc_id", "idx", "text", "number", "level").join(FO.fold(rows, order="idx"), ["doc_id", "idx"])


@query("section_fold", f"WITH RECURSIVE {FOLD} SELECT doc_id, idx::INT AS idx, (count(*) FILTER (took) OVER (PARTITION BY doc_id ORDER BY idx) - 1)::INT AS sec_no FROM st WHERE idx >= 0 QUALIFY took")
def section_fold(spark, sf):
    return _folded(spark, sf).where("action = 'open'").select("doc_id", "idx", "sec_no")


@query("section_text", f"""WITH RECURSIVE {FOLD}, g AS (SELECT doc_id, idx, took, count(*) FILTER (took) OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS sec FROM st WHERE idx >= 0)
SELECT doc_id, sec::INT AS sec_no, string_agg(event_type, ' ' ORDER BY idx) FILTER (NOT took) AS text FROM g JOIN el USING (doc_id, idx) WHERE sec >= 0 GROUP BY ALL""")
def section_text(spark, sf):
    rows = _folded(spark, sf).where("sec_no is not null")
    body = F.when(F.col("action") == "body", F.struct("idx", "text"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda x: x["text"]), " ")
    return rows.groupBy("doc_id", "sec_no").agg(F.nullif(text, F.lit("")).alias("text"))


@query("section_order_guard", f"WITH RECURSIVE {FOLD} SELECT doc_id, count(*) FILTER (took) AS opened, count(*) FILTER (level < 3 AND NOT took) AS refused FROM st WHERE idx >= 0 GROUP BY doc_id")
def section_order_guard(spark, sf):
    return _folded(spark, sf).groupBy("doc_id").agg(F.count_if(F.col("action") == "open").alias("opened"), F.count_if((F.col("level") < 3) & (F.col("action") != "open")).alias("refused"))


@query("number_order", f"""WITH {NL}, k AS (SELECT id, list_transform(string_split(id % 12 || '.' || id % 7, '.'), lambda x: x::INT) AS a, list_transform(string_split(id % 5 || CASE WHEN id % 3 = 0 THEN '' ELSE '.' || id % 4 END, '.'), lambda x: x::INT) AS b FROM nl)
SELECT id, a > b AS after FROM k""")
def number_order(spark, sf):
    i = A.numbered_lines(A.table(spark, sf, "part")).select("id")
    a = F.concat_ws(".", (F.col("id") % 12).cast("string"), (F.col("id") % 7).cast("string"))
    b = F.concat_ws(".", (F.col("id") % 5).cast("string"), F.when(F.col("id") % 3 != 0, (F.col("id") % 4).cast("string")))
    return i.select("id", T.order_valid(a, b).alias("after"))


PARENT = f"{EL}, pt AS (SELECT doc_id, idx, level, (SELECT max(p.idx) FROM el p WHERE p.doc_id = e.doc_id AND p.idx < e.idx AND p.level < e.level) AS parent FROM el e WHERE level IS NOT NULL)"


def _tree(spark, sf) -> DataFrame:
    rows = A.event_lines(A.table(spark, sf, "events")).where("level is not null")
    return TR.with_parents(rows.select("doc_id", F.col("idx").alias("sec_no"), F.col("level"), F.col("seq").cast("string").alias("number")))


@query("hierarchy_parent", f"WITH {PARENT} SELECT doc_id, idx::INT AS sec_no, parent::INT AS parent FROM pt")
def hierarchy_parent(spark, sf):
    return _tree(spark, sf).select("doc_id", "sec_no", F.col("parent_sec_no").alias("parent"))


@query("tree_depth", f"WITH {PARENT} SELECT doc_id, max(1 + (parent IS NOT NULL)::INT + ((SELECT q.parent FROM pt q WHERE q.doc_id = pt.doc_id AND q.idx = pt.parent) IS NOT NULL)::INT)::INT AS depth, count(*) FILTER (parent IS NULL) AS roots FROM pt GROUP BY doc_id")
def tree_depth(spark, sf):
    rows = _tree(spark, sf)
    up = rows.select("doc_id", F.col("sec_no").alias("parent_sec_no"), F.col("parent_sec_no").alias("_g"))
    joined = rows.join(up, ["doc_id", "parent_sec_no"], "left")
    depth = 1 + F.col("parent_sec_no").isNotNull().cast("int") + F.col("_g").isNotNull().cast("int")
    return joined.groupBy("doc_id").agg(F.max(depth).alias("depth"), F.count_if(F.col("parent_sec_no").isNull()).alias("roots"))


@query("child_numbers", f"""WITH {PARENT} SELECT s.doc_id, s.idx::INT AS sec_no, coalesce(string_agg(c.idx::VARCHAR, ',' ORDER BY c.idx), '') AS children
FROM pt s LEFT JOIN pt c ON c.doc_id = s.doc_id AND c.parent = s.idx WHERE s.parent IS NULL GROUP BY ALL""")
def child_numbers(spark, sf):
    rows = _tree(spark, sf).withColumn("number", F.col("sec_no").cast("string"))
    return TR.child_numbers(rows).select("doc_id", "sec_no", F.array_join("children", ",").alias("children"))


# --- registry and metadata ------------------------------------------------------------------------------------------------
@query("registry_dedup", f"WITH {RG}, {DEDUP} SELECT id, ord::INT AS ord, name FROM reg")
def registry_dedup(spark, sf):
    return R.dedup(A.registry(A.table(spark, sf, "customer"))).select("id", "ord", F.col("row")["Наименование"].alias("name"))


PROBE = "pr AS (SELECT o_orderkey AS doc_id, CASE o_orderkey % 3 WHEN 0 THEN (o_custkey % 1100)::VARCHAR WHEN 1 THEN (o_custkey % 1100) || '_' || o_orderkey % 6 ELSE (o_custkey % 1100) || '_1_2' END AS probe FROM orders)"


def _probes(spark, sf) -> DataFrame:
    base = (F.col("o_custkey") % 1100).cast("string")
    key = F.col("o_orderkey")
    probe = F.when(key % 3 == 0, base).when(key % 3 == 1, F.concat_ws("_", base, (key % 6).cast("string"))).otherwise(F.concat(base, F.lit("_1_2")))
    return A.spread(A.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").select(key.alias("doc_id"), probe.alias("probe"))


@query("registry_priority_lookup", f"""WITH {RG}, {DEDUP}, {PROBE} SELECT doc_id, id FROM pr JOIN reg ON split_part(id, '_', 1) = split_part(probe, '_', 1)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN id = probe THEN 0 WHEN starts_with(id, probe || '_') OR starts_with(probe, id || '_') THEN 1 ELSE 2 END, ord) = 1""")
def registry_priority_lookup(spark, sf):
    return R.lookup(_probes(spark, sf), R.dedup(A.registry(A.table(spark, sf, "customer")))).select("doc_id", "id")


@query("registry_alias", f"WITH {RG} SELECT ord::INT AS ord, nullif(trim(age), '') AS age, nullif(trim(status), '') AS application FROM rg")
def registry_alias(spark, sf):
    rows = A.registry(A.table(spark, sf, "customer"))
    return rows.select("ord", R.value(F.col("row"), ("Возрастная категория", "Возраст")).alias("age"), R.value(F.col("row"), P.ALIASES["application"]).alias("application"))


@query("metadata_merge", f"""WITH {RG}, {DEDUP}, {PROBE}, m AS (SELECT doc_id, id, name, age, status FROM pr JOIN reg ON split_part(id, '_', 1) = split_part(probe, '_', 1)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN id = probe THEN 0 WHEN starts_with(id, probe || '_') OR starts_with(probe, id || '_') THEN 1 ELSE 2 END, ord) = 1)
SELECT doc_id, coalesce(m.name, 'Название по титулу') AS title, coalesce(m.id, probe) AS id, (2000 + doc_id % 24)::VARCHAR AS year, m.age AS age_group, nullif(trim(m.status), '') AS application_status, m.id IS NOT NULL AS registry_matched FROM pr LEFT JOIN m USING (doc_id)""")
def metadata_merge(spark, sf):
    probes = _probes(spark, sf)
    texts = probes.select(
        "doc_id", F.concat(F.lit("КР"), "probe", F.lit(".PDF")).alias("source_file"), F.concat(F.lit("Год утверждения: "), (2000 + F.col("doc_id") % 24).cast("string")).alias("full_text"),
        F.lit("Клинические рекомендации\nГод 2020\nНазвание по титулу").alias("first_page_text"),
    )
    # a file's name holds a number and one version at most: the probe with two keeps the first
    found = ClinicalGuideline().metadata(texts, R.dedup(A.registry(A.table(spark, sf, "customer"))))
    return found.select("doc_id", "title", "id", "year", "age_group", "application_status", "registry_matched")


SQL["metadata_merge"] = SQL["metadata_merge"].replace(PROBE, PROBE.replace("'_1_2'", "'_1'"))


@query("doc_id_extract", r"SELECT page_id, coalesce(nullif(regexp_extract(url, '(?i)КР\s*(\d+(?:_\d+)?)', 1), ''), nullif(regexp_extract(url, '(\d+(?:_\d+)?)', 1), ''), nullif(regexp_extract(html, '(?i)(?:^|[^\p{L}\p{N}_])ID[:\s]+(\d+(?:_\d+)?)', 1), '')) AS id FROM pages")
def doc_id_extract(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", ClinicalGuideline.document_id(F.col("url"), F.col("html")).alias("id"))


@query("year_extract", f"WITH {NL} SELECT id, nullif(regexp_extract('ГОД  утверждения: ' || text || ' ' || (1990 + id % 40) || ' Год окончания действия - ' || (2020 + id % 9), '(?i)год\\s+утвержд[\\p{{L}}\\p{{N}}_]*[^\\d]{{0,20}}(\\d{{4}})', 1), '') AS year, nullif(regexp_extract('Год окончания действия - ' || (2020 + id % 9), '(\\d{{4}})', 1), '') AS end_year FROM nl")
def year_extract(spark, sf):
    rows = A.numbered_lines(A.table(spark, sf, "part"))
    text = F.concat(F.lit("ГОД  утверждения: "), "text", F.lit(" "), (1990 + F.col("id") % 40).cast("string"), F.lit(" Год окончания действия - "), (2020 + F.col("id") % 9).cast("string"))
    return rows.select("id", T.group(text, P.YEAR).alias("year"), T.group(text, P.END_YEAR).alias("end_year"))


@query("icd_codes", """WITH s AS (SELECT p_partkey AS id, p_type || ' С' || (p_partkey % 90 + 10) || ', Е11.' || p_partkey % 10 || ', А00, M' || (p_size + 10) || '.1, С' || (p_partkey % 90 + 10) AS t FROM part),
c AS (SELECT id, regexp_extract_all(translate(t, 'СABЕКМНОРТХ', 'CABEKMHOPTX'), '[A-Z]\\d{2}(?:\\.\\d+)?') AS c FROM s)
SELECT id, array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: NOT list_contains(c[1:i - 1], c[i])), lambda i: c[i]), ' ') AS codes FROM c""")
def icd_codes(spark, sf):
    key = F.col("p_partkey")
    n = (key % 90 + 10).cast("string")
    text = F.concat("p_type", F.lit(" С"), n, F.lit(", Е11."), (key % 10).cast("string"), F.lit(", А00, M"), (F.col("p_size") + 10).cast("string"), F.lit(".1, С"), n)
    return A.table(spark, sf, "part").select(key.alias("id"), F.array_join(T.icd_codes(text), " ").alias("codes"))


# --- statistics and quality -------------------------------------------------------------------------------------------------
@query("coverage_stats", """WITH t AS (SELECT conv_id AS doc_id, string_agg(text, chr(10) ORDER BY turn) AS x FROM conversations GROUP BY conv_id),
p AS (SELECT conv_id AS doc_id, sum(length(text)) FILTER (turn % 3 = 1) AS a, sum(length(text)) FILTER (turn % 3 = 2) AS b, sum(length(text)) FILTER (turn % 3 = 0 AND turn > 0) AS c, count(*) FILTER (turn % 3 = 1) AS n, count(*) FILTER (turn % 3 = 0 AND turn > 0) AS m FROM conversations GROUP BY conv_id)
SELECT doc_id, length(x)::BIGINT AS total_chars, len(list_filter(string_split_regex(x, '\\s+'), lambda w: w <> ''))::BIGINT AS total_words, n::BIGINT AS sections_found, m::BIGINT AS tables_found, coalesce(a, 0)::BIGINT AS included_chars, coalesce(b, 0)::BIGINT AS excluded_chars, coalesce(c, 0)::BIGINT AS table_chars,
  least(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0), length(x))::BIGINT AS accounted_chars, CASE WHEN length(x) > 0 THEN round_even(least(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0), length(x))::BIGINT / length(x) * 100, 2) ELSE 0.0 END AS coverage_percent FROM t JOIN p USING (doc_id)""")
def coverage_stats(spark, sf):
    rows = A.table(spark, sf, "conversations").withColumnRenamed("conv_id", "doc_id").withColumn("title", F.lit("")).withColumn("caption", F.lit(None).cast("string")).withColumn("raw_text", F.col("text"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n")
    third = F.col("turn") % 3
    return STATS.coverage(rows.groupBy("doc_id").agg(text.alias("full_text")), rows.where(third == 1), rows.where(third == 2), rows.where((third == 0) & (F.col("turn") > 0)))


_REGION = "CASE WHEN event_type = 'error' AND size > 40 THEN 'references' WHEN event_type = 'view' AND size > 60 THEN 'appendices' END"


@query("excluded_items", f"""WITH {EL}, r AS (SELECT *, {_REGION} AS region FROM el WHERE idx >= 20), s AS (SELECT doc_id, min(idx) FILTER (region = 'references') AS s FROM r GROUP BY doc_id),
t AS (SELECT r.*, region IS NOT NULL AS opens, sum((region IS NOT NULL)::INT) OVER (PARTITION BY r.doc_id ORDER BY idx) AS item FROM r JOIN s USING (doc_id) WHERE idx >= s),
i AS (SELECT doc_id, item, max(region) AS bucket, min(event_type) FILTER (opens) AS title, coalesce(string_agg(event_type, ' ' ORDER BY idx) FILTER (NOT opens), '') AS text FROM t GROUP BY ALL),
f AS (SELECT *, max((size > 120)::INT) OVER (PARTITION BY doc_id ORDER BY idx) > 0 AS toc FROM el WHERE idx < 20)
SELECT doc_id, bucket, (row_number() OVER (PARTITION BY doc_id, bucket ORDER BY item) - 1)::INT AS item_no, title, text FROM i
UNION ALL SELECT doc_id, CASE WHEN toc THEN 'toc' ELSE 'front_matter' END, 0, CASE WHEN toc THEN 'Оглавление' ELSE 'front_matter' END, string_agg(event_type, ' ' ORDER BY idx) FROM f WHERE NOT size > 120 GROUP BY ALL
UNION ALL SELECT r.doc_id, 'other', (row_number() OVER (PARTITION BY r.doc_id ORDER BY idx) - 1)::INT, 'unassigned', event_type FROM r JOIN s USING (doc_id) WHERE (idx < s OR s IS NULL) AND idx < 25""")
def excluded_items(spark, sf):
    from .plans.engine import Layout, Result

    region = F.when((F.col("event_type") == "error") & (F.col("size") > 40), "references").when((F.col("event_type") == "view") & (F.col("size") > 60), "appendices")
    rows = A.event_lines(A.table(spark, sf, "events")).withColumn("text", F.col("event_type")).withColumn("region", region).withColumn("toc", F.col("size") > 120).withColumn("seq", F.col("idx"))
    found = Result(Layout(rows, rows, rows), _OrderOnly(), None, store=False)
    found.front = ST.front_split(rows.where("idx < 20"))
    found.body = ST.excluded_tail(rows.where("idx >= 20"))
    found.placed = found.body.where("not tail and idx < 25").withColumn("action", F.lit("other"))
    return found.excluded.withColumn("item_no", F.col("item_no").cast("int"))


NUMS = f"{EL}, nm AS (SELECT doc_id, list((y0 % 9)::INT ORDER BY idx) AS ns FROM el WHERE level = 1 GROUP BY doc_id)"


def _numbers(spark, sf) -> DataFrame:
    rows = A.event_lines(A.table(spark, sf, "events")).where("level = 1")
    numbers = F.transform(F.array_sort(F.collect_list(F.struct("idx", (F.col("y0") % 9).cast("int").alias("n")))), lambda x: x["n"])
    return rows.groupBy("doc_id").agg(numbers.alias("ns"))


@query("dup_numbers", f"WITH {NUMS}, u AS (SELECT doc_id, unnest(ns) AS n FROM nm), d AS (SELECT doc_id, n FROM u GROUP BY ALL HAVING count(*) > 1) SELECT doc_id, string_agg(n::VARCHAR, ',' ORDER BY n) AS dup FROM d GROUP BY doc_id")
def dup_numbers(spark, sf):
    return _numbers(spark, sf).select("doc_id", F.array_join(Q.duplicates(F.col("ns")), ",").alias("dup")).where("dup <> ''")


@query("disorder", f"WITH {NUMS} SELECT doc_id, ns <> list_sort(ns) AS disorder FROM nm")
def disorder(spark, sf):
    return _numbers(spark, sf).select("doc_id", Q.disorder(F.col("ns")).alias("disorder"))


@query("toc_leak", f"WITH {NL} SELECT id, regexp_matches(text, '\\.{{3,}}') AS leak FROM nl")
def toc_leak(spark, sf):
    return A.numbered_lines(A.table(spark, sf, "part")).select("id", Q.leaks_toc(F.col("text")).alias("leak"))


_DANGLING = ["в том", "к применению", "и противопоказания", "включая", "на основе", "в том числе", "и", "или", "к", "по", "при", "с", "для", "на", "о", "методов", "медицинские"]


@query("title_dangles", f"WITH {NL}, d AS (SELECT id, text || [' и', ',', ' методов', ' –', '', ' текст', ' ПО'][id % 7 + 1] AS t FROM nl) SELECT id, t <> '' AND (right(t, 1) IN (',', '-', '–', '(') OR {' OR '.join(f'''ends_with(lower(t), ' {w}') OR lower(t) = '{w}' ''' for w in _DANGLING)}) AS dangles FROM (SELECT id, trim(t) AS t FROM d)")
def title_dangles(spark, sf):
    end = F.get(F.array(*map(F.lit, (" и", ",", " методов", " –", "", " текст", " ПО"))), (F.col("id") % 7).cast("int"))
    return A.numbered_lines(A.table(spark, sf, "part")).select("id", Q.dangles(F.concat("text", end)).alias("dangles"))


QR = f"""{EL}, sx AS (SELECT doc_id, idx, level, CASE level WHEN 1 THEN y0::INT::VARCHAR ELSE level || '.' || y0::INT END AS number, event_type || CASE WHEN size > 120 THEN ' ....' WHEN size > 110 THEN ' и' ELSE '' END AS title,
  CASE WHEN y0 > 50 THEN 'Текст' ELSE 'текст' END AS text FROM el WHERE level IS NOT NULL AND doc_id % 11 <> 0),
tp AS (SELECT s.*, NOT EXISTS (SELECT 1 FROM sx p WHERE p.doc_id = s.doc_id AND p.idx < s.idx AND p.level < s.level) AS top FROM sx s),
st AS (SELECT doc_id, count(*) FILTER (level IS NOT NULL) AS sections, count(*) FILTER (event_type = 'view') AS tables, round_even(least(count(*) FILTER (event_type <> 'click') * 105.0 / count(*), 100.0)::DOUBLE, 2) AS coverage FROM el WHERE doc_id % 11 <> 0 GROUP BY doc_id),
sq AS (SELECT doc_id, list(number::INT ORDER BY idx) FILTER (top AND regexp_full_match(number, '\\d+')) AS ns, bool_or(top AND number = '4') AS has4, bool_or(regexp_matches(title, '\\.{{3,}}')) AS toc_leak, bool_or(ends_with(title, ' и') AND text = 'текст') AS title_leak, count(*) FILTER (top) AS n_top FROM tp GROUP BY doc_id),
q AS (SELECT doc_id, true AS ok, sections, tables, coverage, doc_id % 3 <> 0 AS from_registry, doc_id % 5 <> 0 AS title_ok, doc_id % 4 AS mkb_n, (doc_id % 3 = 0)::INT + (doc_id % 4 = 0)::INT AS warns, coalesce(ns, []) AS ns, coalesce(has4, false) AS has4,
  coalesce(toc_leak, false) AS toc_leak, coalesce(title_leak, false) AS title_leak, coalesce(n_top, 0) AS n_top, NULL::VARCHAR AS error FROM st LEFT JOIN sq USING (doc_id)
  UNION ALL SELECT DISTINCT doc_id, false, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'broken' FROM el WHERE doc_id % 11 = 0),
qd AS (SELECT *, len(list_distinct(ns)) < len(ns) AS dup, ns <> list_sort(ns) AS disorder FROM q)"""


def _quality(spark, sf) -> DataFrame:
    every = A.event_lines(A.table(spark, sf, "events"))
    d, y = F.col("doc_id"), F.col("y0").cast("int").cast("string")
    rows = every.where(d % 11 != 0)
    number = F.when(F.col("level") == 1, y).otherwise(F.concat(F.col("level").cast("string"), F.lit("."), y))
    title = F.concat("event_type", F.when(F.col("size") > 120, " ....").when(F.col("size") > 110, " и").otherwise(""))
    flat = rows.where("level is not null").select("doc_id", F.col("idx").alias("sec_no"), "level", number.alias("number"), title.alias("title"), F.when(F.col("y0") > 50, "Текст").otherwise("текст").alias("text"))
    share = F.bround(F.least(F.count_if(F.col("event_type") != "click") * 105.0 / F.count("*"), F.lit(100.0)), 2)
    stats = rows.groupBy("doc_id").agg(F.count("level").alias("sections_found"), F.count_if(F.col("event_type") == "view").alias("tables_found"), share.alias("coverage_percent"))
    codes = F.slice(F.array(*map(F.lit, ("A00", "B00", "C00"))), F.lit(1), (d % 4).cast("int"))
    metadata = stats.select("doc_id", d.cast("string").alias("source_file"), d.cast("string").alias("id"), F.when(d % 5 != 0, "Название").alias("title"), F.lit("2020").alias("year"), F.lit("Дети").alias("age_group"), codes.alias("mkb_codes"))
    warned = F.array_compact(F.array(F.when(d % 3 == 0, F.when(d % 2 == 0, "W_NO_REGISTRY").otherwise("W_NOT_FOUND")), F.when(d % 4 == 0, "W_NO_ICD")))
    failed = every.where(d % 11 == 0).select("doc_id", d.cast("string").alias("source_file"), F.lit("broken").alias("error"), F.lit(0.0).alias("secs")).distinct()
    return Q.documents(TR.with_parents(flat), stats, metadata, stats.select("doc_id", F.explode(warned).alias("code")), failed)


@query("quality_rows", f"""WITH {QR} SELECT doc_id, ok, error, sections, tables, coverage, n_top::INT AS n_top, has4, toc_leak, title_leak, dup, disorder, mkb_n::INT AS mkb_n, warns::INT AS warns, from_registry, title_ok, array_to_string(list_filter([CASE WHEN NOT has4 THEN 'NO_SEC4' END, CASE WHEN toc_leak THEN 'TOC_LEAK' END, CASE WHEN coverage < 80 THEN 'LOWCOV' END,
  CASE WHEN NOT from_registry THEN 'FALLBACK' END, CASE WHEN NOT title_ok THEN 'NOTITLE' END], lambda x: x IS NOT NULL), ' ') AS flags FROM qd""")
def quality_rows(spark, sf):
    return Q.flags(_quality(spark, sf)).select("doc_id", "ok", "error", "sections", "tables", "coverage", "n_top", "has4", "toc_leak", "title_leak", (F.size("dup") > 0).alias("dup"), "disorder", "mkb_n", "warns", "from_registry", "title_ok", "flags")


@query("quality_summary", f"""WITH {QR} SELECT count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_bad, round(avg(coverage), 6) AS coverage_mean, quantile_cont(coverage, 0.5) AS coverage_median, min(coverage) AS coverage_min, count(*) FILTER (coverage < 80) AS below_80, count(*) FILTER (coverage < 50) AS below_50,
  count(*) FILTER (from_registry) AS from_registry, count(*) FILTER (NOT from_registry) AS from_title, count(*) FILTER (title_ok) AS with_title, count(*) FILTER (mkb_n > 0) AS with_codes, count(*) FILTER (has4) AS with_section_4, count(*) FILTER (toc_leak) AS toc_leaks,
  count(*) FILTER (dup) AS with_duplicates, count(*) FILTER (disorder) AS in_disorder, sum(tables)::BIGINT AS tables, count(*) FILTER (tables > 0) AS with_tables, round(avg(sections), 6) AS sections_mean, min(sections) AS sections_min, max(sections) AS sections_max FROM qd""")
def quality_summary(spark, sf):
    found = Q.summary(_quality(spark, sf))
    return found.withColumns({c: F.round(c, 6) for c in ("coverage_mean", "sections_mean")})


@query("quality_problems", f"""WITH {QR}, p AS (SELECT doc_id::VARCHAR AS file, unnest(list_filter([CASE WHEN NOT has4 THEN 'no_section_4' END, CASE WHEN toc_leak THEN 'toc_leak' END, CASE WHEN coverage < 80 THEN 'low_coverage' END, CASE WHEN dup THEN 'duplicates' END,
  CASE WHEN disorder THEN 'disorder' END, CASE WHEN NOT from_registry THEN 'fallback' END, CASE WHEN NOT ok THEN 'error' END], lambda x: x IS NOT NULL)) AS problem FROM qd)
SELECT problem, count(*) AS n, array_to_string(list(file ORDER BY file)[1:25], ',') AS files FROM p GROUP BY problem""")
def quality_problems(spark, sf):
    return Q.problems(_quality(spark, sf)).select("problem", "n", F.array_join("files", ",").alias("files"))


@query("quality_regression", f"WITH {QR} SELECT doc_id, coalesce(ok AND NOT dup AND NOT disorder AND coverage >= 99 AND NOT title_leak, false) AS passed FROM qd")
def quality_regression(spark, sf):
    return Q.regression(_quality(spark, sf))


@query("spread_sample", "WITH n AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i, count(*) OVER () AS total FROM part), w AS (SELECT DISTINCT floor(k * (SELECT max(total) FROM n) / 150.0)::BIGINT AS i FROM range(150) t(k)) SELECT p_partkey FROM n JOIN w USING (i)")
def spread_sample(spark, sf):
    return Q.spread(A.table(spark, sf, "part").select("p_partkey"), "p_partkey", 150)


# --- the predecessor -----------------------------------------------------------------------------------------------------
V1U = f"""{EL}, v0 AS (SELECT doc_id, idx, page, idx // 4 AS block, y0, event_type, CASE WHEN event_type IN ('signup', 'error') THEN 'num' WHEN event_type = 'purchase' THEN 'named' END AS htype,
  CASE event_type WHEN 'signup' THEN (y0 % 9)::INT::VARCHAR WHEN 'error' THEN (y0 % 9)::INT || '.' || (y0 % 4)::INT END AS number,
  CASE event_type WHEN 'signup' THEN (y0 % 9)::INT || ' Title' WHEN 'error' THEN (y0 % 9)::INT || '.' || (y0 % 4)::INT || '. Sub' WHEN 'purchase' THEN ['Список литературы', 'Приложение А', 'Оглавление', 'Список сокращений', 'Прочее', 'Термины и определения'][(y0 % 6)::INT + 1] ELSE event_type END AS text FROM el),
v1 AS (SELECT *, CASE WHEN htype IS NOT NULL THEN htype = 'named' AND NOT regexp_matches(text, '^(Список литературы|Приложение)') AND ph IS NOT NULL AND pp = page ELSE started AND ph IS NULL AND pb = block AND pp = page END AS same FROM (
  SELECT *, lag(htype) OVER w AS ph, lag(page) OVER w AS pp, lag(block) OVER w AS pb, row_number() OVER w > 1 AS started FROM v0 WINDOW w AS (PARTITION BY doc_id ORDER BY idx))),
v2 AS (SELECT *, sum((NOT coalesce(same, false))::INT) OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS unit FROM v1),
u AS (SELECT doc_id, unit, arg_min(htype, idx) AS htype, arg_min(number, idx) AS number, string_agg(text, ' ' ORDER BY idx) AS text, min(page) AS page, arg_min(y0, idx) AS y FROM v2 GROUP BY ALL)"""


def _v1(spark, sf) -> DataFrame:
    rows = A.event_lines(A.table(spark, sf, "events"))
    a, b = (F.col("y0") % 9).cast("int").cast("string"), (F.col("y0") % 4).cast("int").cast("string")
    names = F.array(*map(F.lit, ("Список литературы", "Приложение А", "Оглавление", "Список сокращений", "Прочее", "Термины и определения")))
    kind = F.col("event_type")
    text = F.when(kind == "signup", F.concat(a, F.lit(" Title"))).when(kind == "error", F.concat(a, F.lit("."), b, F.lit(". Sub"))).when(kind == "purchase", F.get(names, (F.col("y0") % 6).cast("int"))).otherwise(kind)
    size = F.when(kind.isin("signup", "purchase"), 20.0).otherwise(12.0)
    rows = rows.select("doc_id", F.col("idx").alias("seq"), "page", F.floor(F.col("idx") / 4).alias("block"), text.alias("text"), size.alias("size"), (kind == "error").alias("bold"), F.col("y0").alias("y"))
    return V1.placed(V1.units(rows.withColumn("h", V1.classify(F.col("text"), F.col("size"), F.col("bold"), F.lit(P.DEFAULT_BODY)))))


#: Walks the units one by one, as the state machine does.
V1S = f"""{V1U}, w AS (SELECT DISTINCT doc_id, -1::HUGEINT AS unit, 'toc' AS mode, -1 AS cur, -1 AS made, false AS seen, 0 AS fb, NULL::VARCHAR AS base, NULL::VARCHAR AS stray FROM u
  UNION ALL SELECT u.doc_id, u.unit,
    CASE WHEN reg IS NOT NULL THEN reg WHEN b IS NOT NULL THEN 'section' ELSE mode END, CASE WHEN b IS NOT NULL THEN made + 1 WHEN u.htype IS NOT NULL THEN -1 ELSE cur END, CASE WHEN b IS NOT NULL THEN made + 1 ELSE made END,
    seen OR (reg IS NULL AND u.number IS NOT NULL), CASE WHEN starts_with(b, 'named') THEN fb + 1 ELSE fb END, b,
    CASE WHEN reg = 'apps' THEN 'apps' WHEN u.htype IS NOT NULL AND reg IS NULL AND b IS NULL THEN 'toc' WHEN u.htype IS NULL AND cur < 0 THEN CASE WHEN mode IN ('refs', 'apps') THEN mode ELSE 'toc' END END
  FROM w JOIN u ON u.doc_id = w.doc_id AND u.unit = w.unit + 1,
    LATERAL (SELECT CASE WHEN u.htype IS NULL THEN NULL WHEN starts_with(u.text, 'Список литературы') THEN 'refs' WHEN starts_with(u.text, 'Приложение') THEN 'apps' WHEN starts_with(u.text, 'Оглавлен') THEN 'toc' END AS reg) r,
    LATERAL (SELECT CASE WHEN u.htype IS NULL OR reg IS NOT NULL THEN NULL WHEN u.number IS NOT NULL THEN u.number WHEN contains(u.text, 'Список сокращ') THEN 'abbreviations' WHEN contains(u.text, 'Термины и определ') THEN 'terms' WHEN seen THEN 'named' || (fb + 1) END AS b) bb),
sec AS (SELECT w.doc_id, made AS sec_no, base || CASE WHEN n > 1 THEN '_' || n ELSE '' END AS section_id, number, u.text AS title, page, y FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY unit) AS n FROM w WHERE base IS NOT NULL) w JOIN u USING (doc_id, unit)),
tx AS (SELECT doc_id, cur AS sec_no, string_agg(u.text, chr(10) ORDER BY unit) AS text, max(u.page) AS last FROM w JOIN u USING (doc_id, unit) WHERE cur >= 0 AND u.htype IS NULL GROUP BY ALL)"""


@query("legacy_sections", f"""WITH RECURSIVE {V1S} SELECT doc_id, sec_no::BIGINT AS sec_no, section_id, CASE WHEN number IS NULL THEN title ELSE regexp_replace(title, '^\\d+(?:\\.\\d+){{0,2}}\\.?\\s*', '') END AS title, coalesce(text, '') AS text,
  (page + 1)::INT AS page_start, (coalesce(last, page) + 1)::INT AS page_end FROM sec LEFT JOIN tx USING (doc_id, sec_no)""")
def legacy_sections(spark, sf):
    return V1.sections(_v1(spark, sf)).select("doc_id", "sec_no", "section_id", "title", "text", "page_start", "page_end")


@query("legacy_excluded", f"""WITH RECURSIVE {V1S} SELECT doc_id, coalesce(string_agg(u.text, chr(10) ORDER BY unit) FILTER (stray = 'toc'), '') AS toc_text, coalesce(string_agg(u.text, chr(10) ORDER BY unit) FILTER (stray = 'refs'), '') AS references_text,
  coalesce(string_agg(u.text, chr(10) ORDER BY unit) FILTER (stray = 'apps'), '') AS appendices_text FROM w JOIN u USING (doc_id, unit) GROUP BY doc_id""")
def legacy_excluded(spark, sf):
    return V1.excluded(_v1(spark, sf))


@query("legacy_unique_ids", f"WITH RECURSIVE {V1S} SELECT doc_id, count(DISTINCT section_id) AS ids, count(*) AS sections FROM sec GROUP BY doc_id")
def legacy_unique_ids(spark, sf):
    return V1.sections(_v1(spark, sf)).groupBy("doc_id").agg(F.count_distinct("section_id").alias("ids"), F.count("*").alias("sections"))


@query("legacy_table_asof", f"""WITH RECURSIVE {V1S}, tb AS (SELECT doc_id, idx AS tbl_no, page, y0 AS top FROM el WHERE event_type = 'view'),
st AS (SELECT tb.*, (SELECT min(sec_no) FROM sec s WHERE s.doc_id = tb.doc_id AND (s.page > tb.page OR (s.page = tb.page AND s.y > tb.top))) AS stop, (SELECT max(sec_no) FROM sec s WHERE s.doc_id = tb.doc_id) AS most FROM tb),
ow AS (SELECT st.doc_id, tbl_no, section_id FROM st JOIN sec s ON s.doc_id = st.doc_id AND s.sec_no = coalesce(stop - 1, most) LEFT JOIN tx ON tx.doc_id = s.doc_id AND tx.sec_no = s.sec_no WHERE coalesce(tx.last, s.page) >= st.page)
SELECT tb.doc_id, tb.tbl_no::INT AS tbl_no, section_id, section_id || '_t' || row_number() OVER (PARTITION BY tb.doc_id, section_id ORDER BY tb.tbl_no) AS table_id FROM tb LEFT JOIN ow USING (doc_id, tbl_no)""")
def legacy_table_asof(spark, sf):
    tables = A.event_lines(A.table(spark, sf, "events")).where("event_type = 'view'").select("doc_id", F.col("idx").alias("tbl_no"), F.col("page").alias("page0"), F.col("y0").alias("top"))
    return V1.attach(V1.sections(_v1(spark, sf)), tables).select("doc_id", "tbl_no", "section_id", "table_id")


@query("legacy_developers", f"""WITH {EL}, r AS (SELECT doc_id, idx, CASE event_type WHEN 'signup' THEN 'Союз ' || idx WHEN 'purchase' THEN 'Фонд ' || idx WHEN 'error' THEN 'Одобрено' ELSE event_type || idx END AS t FROM el),
e AS (SELECT doc_id, coalesce(min(idx) FILTER (idx > 0 AND t = 'Одобрено'), 1000000000) AS stop FROM r GROUP BY doc_id),
g AS (SELECT doc_id, idx, t, sum((regexp_matches(t, '^(Союз|Фонд)') OR idx = 1)::INT) OVER (PARTITION BY doc_id ORDER BY idx) AS g FROM r JOIN e USING (doc_id) WHERE idx > 0 AND idx < stop),
n AS (SELECT doc_id, g, string_agg(t, ' ' ORDER BY idx) AS name FROM g GROUP BY ALL)
SELECT doc_id, coalesce(string_agg(name, '; ' ORDER BY g), '') AS developers FROM (SELECT DISTINCT doc_id FROM el) LEFT JOIN n USING (doc_id) GROUP BY doc_id""")
def legacy_developers(spark, sf):
    kind, i = F.col("event_type"), F.col("idx").cast("string")
    text = F.when(kind == "signup", F.concat(F.lit("Союз "), i)).when(kind == "purchase", F.concat(F.lit("Фонд "), i)).when(kind == "error", F.lit("Одобрено")).otherwise(F.concat(kind, i))
    rows = A.event_lines(A.table(spark, sf, "events")).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", text.alias("t")))), lambda x: x["t"]).alias("rows"))
    return rows.select("doc_id", F.array_join(V1.developers(F.col("rows"), F.lit(1)), "; ").alias("developers"))


# --- more of the line-local operators ---------------------------------------------------------------------------------------
@query("bold_span", "SELECT p_partkey AS id, (p_size & 16) <> 0 OR regexp_matches(lower(f), 'bold|black|heavy') AS bold FROM (SELECT *, p_name || ['-SemiBold', '', '-BLACK', '-Light', '-Heavy'][p_partkey % 5 + 1] AS f FROM part)")
def bold_span(spark, sf):
    ends = F.get(F.array(*map(F.lit, ("-SemiBold", "", "-BLACK", "-Light", "-Heavy"))), (F.col("p_partkey") % 5).cast("int"))
    return A.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), L.bold_span(F.col("p_size"), F.concat("p_name", ends)).alias("bold"))


_STARTS = ["или ", "и ", "в том числе", "показания", "медицинские показания", "противопоказания", "и противопоказания", "к применению", "применению", "методов", "метода", "диагностики", "лечения", "профилактики", "реабилитации", "инфекция", "инфекции", "заболевания", "заболеваний", "состояний", "состояния"]
CONT = f"""{NL}, cn AS (SELECT id, visual, trim(regexp_replace(CASE id % 4 WHEN 0 THEN text WHEN 1 THEN lower(text) || ' (и показания)' WHEN 2 THEN ['и ', 'Методов ', 'Приложение ', 'Таблица'][id // 4 % 4 + 1] || text ELSE text || repeat(' длинная строка', (id % 30)::INT) END, '\\s+', ' ', 'g')) AS t FROM nl)"""


def _continued(spark, sf) -> DataFrame:
    i = F.col("id")
    before = F.get(F.array(*map(F.lit, ("и ", "Методов ", "Приложение ", "Таблица"))), (F.floor(i / 4) % 4).cast("int"))
    long = F.concat("text", F.repeat(F.lit(" длинная строка"), (i % 30).cast("int")))
    text = F.when(i % 4 == 0, F.col("text")).when(i % 4 == 1, F.concat(F.lower("text"), F.lit(" (и показания)"))).when(i % 4 == 2, F.concat(before, F.col("text"))).otherwise(long)
    return A.numbered_lines(A.table(spark, sf, "part")).withColumn("t", text)


@query("title_continuation", f"""WITH {CONT} SELECT id, t <> '' AND NOT regexp_matches(t, '^[+\\-•▪□✓*−–]') AND NOT regexp_matches(t, '\\.{{3,}}|_{{3,}}') AND length(t) <= 320
  AND NOT regexp_matches(t, '(?i)^(Таблица|Рисунок|Список литературы|Приложение|Ключевые слова|Список сокращений|Оглавление)($|[^\\p{{L}}\\p{{N}}_])') AS may,
  ({' OR '.join(f"starts_with(lower(t), '{w}')" for w in _STARTS)}) OR (regexp_matches(t, '^\\p{{Ll}}') AND length(t) < 220) AS always,
  length(t) < 260 AND (contains(lower(t), 'показания') OR contains(lower(t), 'применению') OR contains(lower(t), 'методов')) AS at_top, contains(t, ')') AS closes FROM cn""")
def title_continuation(spark, sf):
    return _continued(spark, sf).select("id", F.inline(F.array(ClinicalGuideline().continuation(F.col("t")))))


_ATTACH = HEADS.replace("FROM nl)", "FROM nl UNION ALL SELECT id + 100000000, visual, ['Краткая информация', 'Диагностика ' || id, 'Лечение [3]', 'приложение А', 'Медицинская'][id % 5 + 1] FROM nl)", 1).replace("(visual OR regexp_matches", "(true OR regexp_matches")


@query("title_attach", f"""WITH {_ATTACH} SELECT id, NOT (barred AND NOT regexp_matches(t, '(?i)^(рисунок|табл\\.|рис\\.)')) AND NOT regexp_matches(t, '(?i)^(таблица|рисунок|список литературы|приложение|оглавление)($|[^\\p{{L}}\\p{{N}}_])')
  AND NOT regexp_matches(t, '\\[\\s*\\d') AND NOT regexp_matches(t, '\\(\\s*\\d+\\s*[А-СA-Cа-сa-c]\\s*\\)') AND NOT is_num AND NOT is_only
  AND CASE WHEN id % 2 = 0 THEN CASE {_CASES.replace('low', 'lower(t)').replace('top IN', '(id % 7 + 1) IN')} ELSE false END ELSE length(t) <= 300 AND (visual OR regexp_matches(t, '^\\p{{Lu}}')) END AS attaches FROM t3""")
def title_attach(spark, sf):
    rows = A.numbered_lines(A.table(spark, sf, "part")).select("id", "text", "visual")
    i = F.col("id")
    titles = F.get(F.array(F.lit("Краткая информация"), F.concat(F.lit("Диагностика "), i.cast("string")), F.lit("Лечение [3]"), F.lit("приложение А"), F.lit("Медицинская")), (i % 5).cast("int"))
    rows = rows.unionByName(rows.select((i + 100_000_000).alias("id"), titles.alias("text"), "visual"))
    level = F.when(i % 2 == 0, 1).otherwise(2)
    return rows.select("id", ClinicalGuideline().attaches(F.col("text"), F.col("visual"), (i % 7 + 1).cast("string"), level).alias("attaches"))


@query("legacy_classify", f"""WITH {NL} SELECT id, CASE WHEN big AND num <> '' THEN 'num' WHEN big THEN 'named' WHEN bold AND NOT regexp_matches(text, '\\.{{4,}}') AND regexp_matches(text, '^\\d+\\.\\d+(?:\\.\\d+)?\\.?\\s+\\S') THEN 'num' END AS htype,
  CASE WHEN (big AND num <> '') OR (NOT big AND bold AND NOT regexp_matches(text, '\\.{{4,}}') AND regexp_matches(text, '^\\d+\\.\\d+(?:\\.\\d+)?\\.?\\s+\\S')) THEN num END AS number,
  CASE WHEN num <> '' THEN coalesce(nullif(trim(regexp_replace(text, '^\\d+(?:\\.\\d+){{0,2}}\\.?\\s*', '')), ''), text) ELSE text END AS title
FROM (SELECT *, id % 3 = 0 AS big, id % 2 = 0 AS bold, regexp_extract(text, '^(\\d+(?:\\.\\d+){{0,2}})\\.?\\s+\\S', 1) AS num FROM nl)""")
def legacy_classify(spark, sf):
    i = F.col("id")
    rows = A.numbered_lines(A.table(spark, sf, "part")).withColumn("h", V1.classify(F.col("text"), F.when(i % 3 == 0, 17.0).otherwise(12.0), i % 2 == 0, F.lit(P.DEFAULT_BODY)))
    number = F.nullif(F.regexp_extract("text", P.V1_NUMBERED, 1), F.lit(""))
    return rows.select("id", "h.htype", "h.number", V1.title_clean(number, F.col("text")).alias("title"))


@query("output_path", "SELECT page_id, '/out/' || regexp_replace(list_last(string_split(url, '/')), '^(.*[^/])\\.[^./]*$', '\\1') || '.json' AS target FROM pages")
def output_path(spark, sf):
    from .sources import sinks

    return A.table(spark, sf, "pages").select("page_id", sinks.target(F.col("url"), "/out").alias("target"))


@query("title_page", """WITH t AS (SELECT doc_id, list_filter(list_transform(list_concat(string_split(text, chr(10))[1:2], ['КЛИНИЧЕСКИЕ РЕКОМЕНДАЦИИ', 'Год 2020', 'ID: ' || doc_id], string_split(text, chr(10))[3:]), lambda x: trim(x)), lambda x: x <> '') AS l FROM documents),
m AS (SELECT doc_id, l[list_position(list_transform(l, lambda x: contains(lower(x), 'клинические рекомендации')), true) + 1:][1:5] AS a FROM t)
SELECT doc_id, list_filter(a, lambda x: length(x) > 5 AND NOT starts_with(lower(x), 'год') AND NOT starts_with(lower(x), 'id'))[1] AS title, doc_id::VARCHAR AS id FROM m""")
def title_page(spark, sf):
    rows = F.split("text", "\n", -1)
    first = F.concat(F.slice(rows, 1, 2), F.array(F.lit("КЛИНИЧЕСКИЕ РЕКОМЕНДАЦИИ"), F.lit("Год 2020"), F.concat(F.lit("ID: "), F.col("doc_id").cast("string"))), F.slice(rows, 3, 1_000_000))
    texts = A.table(spark, sf, "documents").select("doc_id", F.lit("файл.pdf").alias("source_file"), F.lit("").alias("full_text"), F.array_join(first, "\n").alias("first_page_text"))
    return ClinicalGuideline().title_page(texts).select("doc_id", "title", "id")


# --- texts, sheets, boxes -----------------------------------------------------------------------------------------------
@query("full_text", "SELECT doc_id, text || chr(10) AS full_text FROM documents WHERE text IS NOT NULL")
def full_text(spark, sf):
    # seven lines a page, and an empty page at the end
    lines = A.document_lines(A.table(spark, sf, "documents")).withColumn("page", F.floor(F.col("seq") / 7).cast("int"))
    last = lines.groupBy("doc_id").agg((F.max("page") + 1).alias("page"))
    return L.page_texts(lines.select("doc_id", "page").distinct().unionByName(last), lines)


@query("line_box", f"WITH {EL} SELECT doc_id, seq, CASE WHEN idx % 3 = 0 THEN 0.0 ELSE size END AS x0, y0, 0.0::DOUBLE AS x1, (y0 + 10)::DOUBLE AS y1 FROM el")
def line_box(spark, sf):
    rows = A.event_lines(A.table(spark, sf, "events"))
    box = F.struct(F.when(F.col("idx") % 3 != 0, F.col("size")).alias("x0"), F.col("y0").alias("y0"), F.lit(None).cast("double").alias("x1"), (F.col("y0") + 10).cast("int").alias("y1"))
    return rows.select("doc_id", "seq", F.inline(F.array(L.box(box))))


@query("registry_sheet", """WITH r AS (SELECT 3 + c_custkey AS ord, CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE (c_custkey % 1000)::VARCHAR END AS id, c_name AS name, c_mktsegment AS status FROM customer)
SELECT id, min(ord)::INT AS ord, arg_max(name, ord) AS name, arg_max(status, ord) AS status FROM r WHERE id <> ' ' GROUP BY id""")
def registry_sheet(spark, sf):
    key = F.col("c_custkey").cast("int")
    cells = F.array(F.when(key % 7 == 0, " ").otherwise((key % 1000).cast("string")), "c_name", "c_mktsegment")
    head = spark.createDataFrame([(0, ["Реестр рекомендаций"]), (1, []), (2, [" id ", "Наименование  рекомендации", "Статус"])], "ord int, cells array<string>")
    found = R.from_sheet(head.unionByName(A.table(spark, sf, "customer").select((key + 3).alias("ord"), cells.alias("cells"))))
    return found.select("id", "ord", F.col("row")["Наименование рекомендации"].alias("name"), F.col("row")["Статус"].alias("status"))


@query("region_markers", f"""WITH {NL}, r AS (SELECT id, ['Оглавление', ' СОДЕРЖАНИЕ ', 'Список литературы' || ['', ':', ' и ещё'][id // 7 % 3 + 1], 'Приложение А' || id, 'приложения ' || id, 'Содержание ' || id, text][id % 7 + 1] AS t FROM nl)
SELECT id, CASE WHEN regexp_matches(t, '(?i)^\\s*(оглавление|содержание)\\s*$') THEN 'toc' WHEN regexp_matches(t, '(?i)^\\s*список\\s+литературы\\s*[.:]?\\s*$') THEN 'references' WHEN regexp_matches(t, '(?i)^\\s*приложение($|[^\\p{{L}}\\p{{N}}_])') THEN 'appendices' END AS region FROM r""")
def region_markers(spark, sf):
    i = F.col("id")
    end = F.get(F.array(*map(F.lit, ("", ":", " и ещё"))), (F.floor(i / 7) % 3).cast("int"))
    key = i.cast("string")
    texts = F.array(F.lit("Оглавление"), F.lit(" СОДЕРЖАНИЕ "), F.concat(F.lit("Список литературы"), end), F.concat(F.lit("Приложение А"), key), F.concat(F.lit("приложения "), key), F.concat(F.lit("Содержание "), key), F.col("text"))
    return A.numbered_lines(A.table(spark, sf, "part")).select("id", ClinicalGuideline().region(F.get(texts, (i % 7).cast("int"))).alias("region"))


@query("title_leaked", f"""WITH {NL}, d AS (SELECT id, text || [' и', ',', ' методов', ' –', '', ' критериев к', ' ПО'][id % 7 + 1] AS t, ['продолжение ', ' Текст', '1 текст', ''][id % 4 + 1] AS x FROM nl)
SELECT id, NOT contains(lower(t), 'критери') AND (right(t, 1) IN (',', '-', '–', '(') OR {' OR '.join(f'''ends_with(lower(t), ' {w}') OR lower(t) = '{w}' ''' for w in _DANGLING)}) AND regexp_matches(trim(x), '^\\p{{Ll}}') AS leaked FROM (SELECT id, trim(t) AS t, x FROM d)""")
def title_leaked(spark, sf):
    end = F.get(F.array(*map(F.lit, (" и", ",", " методов", " –", "", " критериев к", " ПО"))), (F.col("id") % 7).cast("int"))
    text = F.get(F.array(*map(F.lit, ("продолжение ", " Текст", "1 текст", ""))), (F.col("id") % 4).cast("int"))
    return A.numbered_lines(A.table(spark, sf, "part")).select("id", Q.leaked(F.concat("text", end), text).alias("leaked"))


# --- metadata, warnings, summaries ----------------------------------------------------------------------------------------
@query("metadata_full", """WITH r AS (SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE 'I10; Е11.' || c_custkey % 10 END AS codes, CASE c_custkey % 3 WHEN 0 THEN (1990 + c_custkey % 30)::VARCHAR END AS year,
  CASE c_custkey % 3 WHEN 1 THEN '12.05.' || (2000 + c_custkey % 20) END AS published FROM customer WHERE c_custkey % 5 <> 0),
t AS (SELECT o_orderkey AS doc_id, o_custkey AS probe, CASE WHEN o_orderkey % 2 = 0 THEN (2000 + o_orderkey % 24)::VARCHAR END AS year, 'N13.' || o_orderkey % 10 || ' C50' AS codes FROM orders)
SELECT doc_id, coalesce(name, 'Название титула') AS title, probe::VARCHAR AS id, CASE WHEN name IS NULL THEN t.year ELSE coalesce(t.year, r.year, right(published, 4)) END AS year,
  CASE WHEN name IS NULL THEN 'взрослые и дети' ELSE 'Дети' END AS age_group, CASE WHEN trim(r.codes) <> '' THEN 'I10 ' || right(r.codes, 5).replace('Е', 'E') ELSE t.codes END AS mkb_codes,
  CASE WHEN name IS NOT NULL THEN 'Союз врачей, Фонд ' || probe END AS developer, CASE WHEN name IS NOT NULL THEN 'Да' END AS approval_status, published AS publication_date, name IS NOT NULL AS registry_matched FROM t LEFT JOIN r ON r.id = t.probe""")
def metadata_full(spark, sf):
    key = F.col("c_custkey")
    k = key.cast("string")
    pairs = {
        "Наименование": F.col("c_name"), "возрастная  категория": F.lit(" Дети "), "Разработчик": F.concat(F.lit("Союз врачей. , Фонд "), k), "Статус одобрения": F.lit("Да"),
        "МКБ 10": F.when(key % 4 == 0, " ").otherwise(F.concat(F.lit("I10; Е11."), (key % 10).cast("string"))), "Год": F.when(key % 3 == 0, (1990 + key % 30).cast("string")),
        "Дата публикации": F.when(key % 3 == 1, F.concat(F.lit("12.05."), (2000 + key % 20).cast("string"))),
    }
    row = F.create_map(*[x for name, value in pairs.items() for x in (F.lit(name), value)])
    customers = A.spread(A.table(spark, sf, "customer").select("c_custkey", "c_name").where(key % 5 != 0), "c_custkey")
    registry = customers.select(key.cast("int").alias("ord"), k.alias("id"), row.alias("row"))
    o = F.col("o_orderkey")
    year = F.when(o % 2 == 0, F.concat(F.lit("Год утверждения (частота): "), (2000 + o % 24).cast("string"), F.lit("\n"))).otherwise("")
    full = F.concat(year, F.lit("Возрастная категория - взрослые и дети\nМКБ-10: N13."), (o % 10).cast("string"), F.lit(", С50 и N13."), (o % 10).cast("string"))
    orders = A.spread(A.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    texts = orders.select(o.alias("doc_id"), F.concat(F.lit("кр "), F.col("o_custkey").cast("string"), F.lit(".pdf")).alias("source_file"), full.alias("full_text"), F.lit("КЛИНИЧЕСКИЕ РЕКОМЕНДАЦИИ\nID: 5\n Название  титула").alias("first_page_text"))
    found = ClinicalGuideline().metadata(texts, registry)
    return found.select("doc_id", "title", "id", "year", "age_group", F.array_join("mkb_codes", " ").alias("mkb_codes"), "developer", "approval_status", "publication_date", "registry_matched")


def _message(code: str, value: str | None = None) -> str:
    """The message in SQL, with a value in its place."""
    text = P.MESSAGES[code].replace("'", "''")
    return "'" + text.replace("%d", f"' || {value} || '").replace("%s", f"' || {value} || '").replace("%%", "%") + "'"


WARN = f"""{EL}, wd AS (SELECT DISTINCT doc_id, doc_id % 7 = 0 AS scan, doc_id % 3 AS junk, doc_id % 2 AS small, CASE WHEN doc_id % 5 <> 0 THEN doc_id::VARCHAR END AS probe, doc_id % 4 <> 0 AS known, doc_id % 8 = 1 AS matched, doc_id % 6 AS sections, (doc_id % 100 + 0.5)::DOUBLE AS coverage FROM el),
wn AS (SELECT doc_id, unnest([{', '.join(f"CASE WHEN {c} THEN {{'ord': {i}, 'code': '{code}', 'message': {_message(code, v)}}} END" for i, (code, c, v) in enumerate((
  ("W_SCAN", "scan", None), ("W_JUNK", "junk > 0", "junk"), ("W_SMALL", "small > 0", "small"), ("W_NO_ID", "probe IS NULL", None), ("W_NO_REGISTRY", "NOT known", None), ("W_NOT_FOUND", "known AND probe IS NOT NULL AND NOT matched", "probe"),
  ("W_NO_TITLE", "doc_id % 9 = 0", None), ("W_NO_ICD", "doc_id % 10 = 0", None), ("W_NO_SECTIONS", "sections = 0", None), ("W_LOWCOV", "coverage < 50", "coverage"))))}]) AS w FROM wd)"""


def _warned(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """texts, counters, metadata and stats of the events' users."""
    d = F.col("doc_id")
    rows = A.event_lines(A.table(spark, sf, "events")).select("doc_id").distinct()
    texts = rows.select("doc_id", F.when(d % 7 == 0, " \n").otherwise("текст").alias("full_text"))
    counters = rows.select("doc_id", (d % 3).alias("junk"), (d % 2).alias("small")).where("junk > 0 or small > 0")
    codes = F.when(d % 10 != 0, F.array(F.lit("A00"), F.lit("B01"))).otherwise(F.array().cast("array<string>"))
    metadata = rows.select(
        "doc_id", F.concat(d.cast("string"), F.lit(".pdf")).alias("source_file"), F.when(d % 9 != 0, "Название").otherwise("").alias("title"), F.when(d % 5 != 0, d.cast("string")).alias("id"), F.when(d % 5 != 0, d.cast("string")).alias("probe"),
        F.when(d % 3 != 0, "2020").alias("year"), F.lit("Дети").alias("age_group"), codes.alias("mkb_codes"), (d % 4 != 0).alias("registry_known"), (d % 8 == 1).alias("registry_matched"),
    )
    stats = rows.select("doc_id", (d % 6).cast("long").alias("sections_found"), (d % 3).cast("long").alias("tables_found"), (d % 100 + 0.5).cast("double").alias("coverage_percent"), (d * 2).cast("long").alias("accounted_chars"), (d * 3).cast("long").alias("total_chars"))
    return texts, counters, metadata, stats


@query("warnings_raised", f"WITH {WARN} SELECT doc_id, w.ord AS ord, w.code AS code, w.message AS message FROM wn WHERE w IS NOT NULL")
def warnings_raised(spark, sf):
    return STATS.warnings(*_warned(spark, sf))


@query("low_coverage", f"WITH {WARN} SELECT doc_id, coverage FROM wd WHERE coverage < 50")
def low_coverage(spark, sf):
    texts, counters, metadata, stats = _warned(spark, sf)
    return STATS.warnings(texts, counters, metadata, stats).where("code = 'W_LOWCOV'").join(stats, "doc_id").select("doc_id", F.col("coverage_percent").alias("coverage"))


@query("document_summary", f"""WITH {WARN}, m AS (SELECT doc_id, count(*) AS n, string_agg('    - ' || w.message, chr(10) ORDER BY w.ord) AS list FROM wn WHERE w IS NOT NULL GROUP BY doc_id)
SELECT doc_id, '✓ ' || doc_id || '.pdf  [id=' || coalesce(probe, 'None') || ']' || chr(10) || '  Название : ' || CASE WHEN doc_id % 9 <> 0 THEN 'Название' ELSE '' END || chr(10) || '  Год / возраст : ' || CASE WHEN doc_id % 3 <> 0 THEN '2020' ELSE 'None' END || ' / Дети' || chr(10)
  || '  МКБ : ' || CASE WHEN doc_id % 10 <> 0 THEN 'A00, B01' ELSE '—' END || chr(10) || '  Разделов : ' || sections || '   Таблиц : ' || doc_id % 3 || chr(10) || '  Покрытие : ' || coverage || '%   (учтено ' || doc_id * 2 || '/' || doc_id * 3 || ' симв.)'
  || coalesce(chr(10) || '  Предупреждения (' || n || '):' || chr(10) || list, '') AS summary FROM wd LEFT JOIN m USING (doc_id)""")
def document_summary(spark, sf):
    from types import SimpleNamespace

    from .sources import sinks

    texts, counters, metadata, stats = _warned(spark, sf)
    return sinks.summary(SimpleNamespace(metadata=metadata, stats=stats, warnings=STATS.warnings(texts, counters, metadata, stats))).select("doc_id", "summary")


# --- the predecessor's metadata, order and statistics -----------------------------------------------------------------------
@query("legacy_metadata", """SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 5 <> 0 THEN 'КР' || p_partkey ELSE 'файл.' || p_partkey END AS document, CASE WHEN p_partkey % 4 <> 0 THEN p_name ELSE 'крупно ' || p_partkey END AS title,
  CASE WHEN p_partkey % 3 <> 0 THEN 2000 + p_partkey % 24 END::INT AS approval_year, (2025 + p_partkey % 5)::INT AS revision_year, 'C' || (p_partkey % 90 + 10) || ' E11.' || p_partkey % 10 AS icd_10,
  CASE WHEN p_partkey % 2 = 0 THEN 'Взрослые и дети' END AS age_category, CASE WHEN p_partkey % 6 <> 0 THEN 'Союз А Москвы; Фонд ' || p_partkey ELSE '' END AS developers FROM part""")
def legacy_metadata(spark, sf):
    k = F.col("p_partkey")
    key = k.cast("string")
    rows = [
        F.when(k % 4 != 0, F.lit("Клинические рекомендации:")), F.col("p_name"), F.concat(F.lit("проблем, связанных со здоровьем: С"), (k % 90 + 10).cast("string"), F.lit(", Е11."), (k % 10).cast("string")),
        F.when(k % 3 != 0, F.concat(F.lit("Год утверждения (частота пересмотра): "), (2000 + k % 24).cast("string"))), F.concat(F.lit("Пересмотр не позднее: "), (2025 + k % 5).cast("string")),
        F.when(k % 2 == 0, F.lit("Возрастная категория: Взрослые и дети ")), F.when(k % 5 != 0, F.concat(F.lit("ID: "), key)),
        F.when(k % 6 != 0, F.concat(F.lit("Разработчик клинической рекомендации\nСоюз А\nМосквы\nФонд "), key, F.lit("\nОдобрено НПС\nСоюз Б"))),
    ]
    texts = A.spread(A.table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey").select(k.alias("doc_id"), F.concat(F.lit("файл."), key, F.lit(".pdf")).alias("source_file"), F.concat_ws("\n", *rows).alias("first_page_text"))
    # the first page's lines: the largest is the second; the mark is larger but no title
    lines = texts.select("doc_id", F.posexplode(F.array(F.lit("Клинические рекомендации"), F.lit("мелко"), F.concat(F.lit("крупно "), F.col("doc_id").cast("string")), F.lit("так же крупно"))).alias("seq", "text"))
    lines = lines.withColumn("page", F.lit(0)).withColumn("size", F.when(F.col("seq") == 0, 30.0).when(F.col("seq") >= 2, 20.0).otherwise(10.0))
    found = V1.metadata(texts.join(V1.largest_line(lines), "doc_id", "left"))
    return found.select("doc_id", "document", "title", "approval_year", "revision_year", F.array_join("icd_10", " ").alias("icd_10"), "age_category", F.array_join("developers", "; ").alias("developers"))


@query("legacy_reading_order", f"WITH {EL} SELECT doc_id, idx::INT AS idx, (row_number() OVER (PARTITION BY doc_id ORDER BY page, (idx // 3) * 7 % 5, idx // 3, idx) - 1)::INT AS seq FROM el")
def legacy_reading_order(spark, sf):
    block = F.floor(F.col("idx") / 3)
    rows = A.event_lines(A.table(spark, sf, "events")).select("doc_id", "idx", "page", block.alias("block_no"), (block * 7 % 5).cast("double").alias("block_y0"), F.col("idx").alias("line_no"))
    return V1.reading_order(rows).select("doc_id", "idx", "seq")


@query("legacy_stats", f"""WITH RECURSIVE {V1S}, s AS (SELECT doc_id, sec_no, section_id, CASE WHEN number IS NULL THEN title ELSE regexp_replace(title, '^\\d+(?:\\.\\d+){{0,2}}\\.?\\s*', '') END AS title, coalesce(text, '') AS text FROM sec LEFT JOIN tx USING (doc_id, sec_no)),
x AS (SELECT doc_id, string_agg(u.text, chr(10) ORDER BY unit) AS t FROM w JOIN u USING (doc_id, unit) WHERE stray IS NOT NULL GROUP BY doc_id, stray),
tb AS (SELECT doc_id, idx AS tbl_no, page, y0 AS top FROM el WHERE event_type = 'view'),
tl AS (SELECT tb.*, (SELECT min(sec_no) FROM sec s WHERE s.doc_id = tb.doc_id AND (s.page > tb.page OR (s.page = tb.page AND s.y > tb.top))) AS stop, (SELECT max(sec_no) FROM sec s WHERE s.doc_id = tb.doc_id) AS most FROM tb),
ow AS (SELECT tl.doc_id, tbl_no FROM tl JOIN sec s ON s.doc_id = tl.doc_id AND s.sec_no = coalesce(stop - 1, most) LEFT JOIN tx ON tx.doc_id = s.doc_id AND tx.sec_no = s.sec_no WHERE coalesce(tx.last, s.page) >= tl.page),
n AS (SELECT doc_id, sum(length(text) + 1)::BIGINT AS total FROM v0 GROUP BY doc_id),
a AS (SELECT n.doc_id, total, (SELECT count(*) FROM s WHERE s.doc_id = n.doc_id) AS sections, (SELECT count(*) FROM tb WHERE tb.doc_id = n.doc_id) AS tables, coalesce((SELECT sum(length(text)) FROM s WHERE s.doc_id = n.doc_id), 0)::BIGINT AS body,
  coalesce((SELECT sum(length(title)) FROM s WHERE s.doc_id = n.doc_id), 0)::BIGINT AS titles, coalesce((SELECT sum(length(t)) FROM x WHERE x.doc_id = n.doc_id), 0)::BIGINT AS out, 5 * (SELECT count(*) FROM ow WHERE ow.doc_id = n.doc_id) AS raw FROM n)
SELECT doc_id, sections AS sections_found, tables AS tables_found, round_even(body / total * 100, 1) AS text_coverage_pct, round_even((body + out + raw + titles) / total * 100, 1) AS text_accounted_pct FROM a""")
def legacy_stats(spark, sf):
    placed = materialize(_v1(spark, sf))
    events = A.event_lines(A.table(spark, sf, "events"))
    tables = events.where("event_type = 'view'").select("doc_id", F.col("idx").alias("tbl_no"), F.col("page").alias("page0"), F.col("y0").alias("top"), F.lit("сырое").substr(1, 5).alias("raw_text"))
    sections = materialize(V1.sections(placed))
    texts = placed.groupBy("doc_id").agg(F.sum(F.length(F.coalesce("title", "text")) + 1).alias("total_chars"))
    return V1.stats(texts, sections, V1.excluded(placed), V1.attach(sections, tables))


# --- the whole fold: pending numbers, titles over several lines ---------------------------------------------------------------
FT = f"""{EL}, k0 AS (SELECT *, CASE WHEN event_type IN ('signup', 'purchase') THEN 'numbered' WHEN event_type = 'error' THEN CASE WHEN idx % 4 = 0 THEN 'named' ELSE 'number_only' END END AS kind,
  CASE WHEN event_type = 'purchase' OR (event_type = 'error' AND idx % 4 = 1) THEN 2 WHEN event_type IN ('signup', 'error') THEN 1 END AS lvl FROM el),
k1 AS (SELECT doc_id, idx, kind, CASE WHEN kind = 'named' THEN NULL WHEN lvl = 1 THEN [(y0 % 9 + 1)::INT] WHEN lvl = 2 THEN [1, (y0 % 7)::INT] END AS num, lvl, size > 60 AS visual, idx % 11 = 0 AS brk, idx % 3 <> 0 AS may, size > 100 AS always, idx % 5 = 0 AS at_top, idx % 4 = 1 AS closes,
  CASE WHEN lag(kind) OVER (PARTITION BY doc_id ORDER BY idx) = 'number_only' AND coalesce(kind, 'named') = 'named' AND idx % 2 = 0 THEN 1 + (idx % 3 = 0)::INT END AS attach, (idx % 90 * 2)::INT AS length, idx % 7 = 0 AS sign, idx % 9 = 0 AS hyphen, idx % 6 = 0 AS open, idx % 8 = 0 AS word, (idx % 3 - 1)::INT AS balance FROM k0),
st AS (SELECT DISTINCT doc_id, -1::BIGINT AS idx, '' AS action, NULL::INT AS sec, 0 AS sections, NULL::INT AS cur, NULL::INT[] AS last, 0 AS top, false AS titled, 0 AS len, 0 AS bal, false AS hyph, false AS op, NULL::INT[] AS onum, 0 AS olvl, false AS waiting, NULL::INT[] AS wnum, 0 AS wlvl, 0 AS skip FROM k1
  UNION ALL
  SELECT h.doc_id, h.idx, CASE WHEN a = 'text' THEN CASE WHEN cur1 IS NULL THEN 'other' ELSE 'body' END ELSE a END,
    CASE a WHEN 'word' THEN s.sections - 1 WHEN 'cont' THEN s.sections - 1 WHEN 'pending' THEN NULL WHEN 'text' THEN cur1 ELSE sec1 - 1 END, sec1, CASE WHEN a = 'named' THEN sec1 - 1 ELSE cur1 END, last1,
    CASE WHEN begins AND blvl = 1 THEN greatest(s.top, bnum[1]) ELSE s.top END, CASE WHEN begins THEN true WHEN a IN ('cont', 'word') THEN s.titled ELSE false END,
    CASE WHEN begins THEN h.length WHEN a = 'cont' AND h.length > 0 THEN s.len + h.length + space::INT ELSE s.len END, CASE WHEN begins THEN CASE WHEN h.length > 0 THEN h.balance ELSE 0 END WHEN a = 'cont' AND h.length > 0 THEN s.bal + h.balance ELSE s.bal END,
    CASE WHEN begins THEN h.length > 0 AND h.hyphen WHEN a = 'cont' AND h.length > 0 THEN h.hyphen ELSE s.hyph END, CASE WHEN begins THEN h.length > 0 AND h.open WHEN a = 'cont' AND h.length > 0 THEN h.open OR (h.word AND space) ELSE s.op END,
    CASE WHEN begins THEN bnum ELSE s.onum END, CASE WHEN begins THEN blvl ELSE s.olvl END, a = 'pending', CASE WHEN a = 'pending' THEN h.num ELSE s.wnum END, CASE WHEN a = 'pending' THEN h.lvl ELSE s.wlvl END,
    CASE WHEN a = 'attach' THEN h.attach - 1 WHEN a = 'word' THEN s.skip - 1 ELSE 0 END
  FROM (SELECT st.*, st.idx + 1 AS nxt FROM st) s JOIN k1 h ON h.doc_id = s.doc_id AND h.idx = s.nxt,
    LATERAL (SELECT coalesce(CASE WHEN h.lvl = 1 THEN h.num[1] = s.top + 1 OR (h.num[1] > s.top AND h.visual) ELSE s.last IS NULL OR h.num > s.last END, false) AS fits) f,
    LATERAL (SELECT CASE WHEN s.skip > 0 THEN 'word' WHEN s.waiting AND h.attach IS NOT NULL THEN 'attach'
      WHEN s.titled AND NOT h.brk AND h.may AND h.kind IS NULL AND s.len <= 320 AND (s.op OR h.always OR (h.at_top AND s.olvl = 1) OR (h.closes AND s.bal > 0)) THEN 'cont'
      WHEN h.kind = 'numbered' AND fits THEN 'open' WHEN h.kind = 'number_only' AND (h.lvl = 1 OR h.visual) AND fits THEN 'pending' WHEN h.kind = 'named' THEN 'named' ELSE 'text' END AS a) x,
    LATERAL (SELECT a IN ('open', 'attach') AS begins, a IN ('open', 'pending', 'named', 'text') AND s.titled AS ends, CASE WHEN a = 'open' THEN h.num ELSE s.wnum END AS bnum, CASE WHEN a = 'open' THEN h.lvl ELSE s.wlvl END AS blvl, s.len > 0 AND NOT s.hyph AND NOT h.sign AS space) y,
    LATERAL (SELECT s.sections + (a IN ('open', 'attach', 'named'))::INT AS sec1, CASE WHEN ends THEN s.sections - 1 ELSE s.cur END AS cur1, CASE WHEN ends THEN coalesce(s.onum, s.last) ELSE s.last END AS last1) z)"""


@query("fold_actions", f"WITH RECURSIVE {FT} SELECT doc_id, idx::INT AS idx, action, sec::INT AS sec_no FROM st WHERE idx >= 0")
def fold_actions(spark, sf):
    i, kind = F.col("idx"), F.col("event_type")
    y = F.col("y0")
    rows = A.event_lines(A.table(spark, sf, "events")).select("doc_id", "idx", "size", "y0", "event_type")
    rows = rows.withColumn("kind", F.when(kind.isin("signup", "purchase"), "numbered").when(kind == "error", F.when(i % 4 == 0, "named").otherwise("number_only")))
    rows = rows.withColumn("level", F.when((kind == "purchase") | ((kind == "error") & (i % 4 == 1)), 2).when(kind.isin("signup", "error"), 1))
    number = F.when(F.col("level") == 1, (y % 9 + 1).cast("int").cast("string")).when(F.col("level") == 2, F.concat(F.lit("1."), (y % 7).cast("int").cast("string")))
    before = F.lag("kind").over(Window.partitionBy("doc_id").orderBy("idx"))
    waits = (before == "number_only") & (F.coalesce("kind", F.lit("named")) == "named") & (i % 2 == 0)
    rows = rows.select(
        "doc_id", "idx", "kind", F.when(F.col("kind") != "named", number).alias("number"), "level", (F.col("size") > 60).alias("visual"), (i % 11 == 0).alias("break_before"), (i % 3 != 0).alias("may"), (F.col("size") > 100).alias("always"),
        (i % 5 == 0).alias("at_top"), (i % 4 == 1).alias("closes"), F.when(waits, F.lit(1) + (i % 3 == 0).cast("int")).alias("attach_lines"), (i % 90 * 2).cast("int").alias("length"), (i % 7 == 0).alias("sign"), (i % 9 == 0).alias("hyphen"),
        (i % 6 == 0).alias("open"), (i % 8 == 0).alias("word"), (i % 3 - 1).cast("int").alias("balance"),
    )
    return FO.fold(rows, order="idx").select("doc_id", "idx", "action", "sec_no")


# --- end to end -----------------------------------------------------------------------------------------------------------
def page_layout(pages: DataFrame):
    """The web pages as a layout: every heading, paragraph, bold run and title is a line; one page a document."""
    from .plans.engine import Layout

    rows = A.html_lines(pages).withColumn("doc_id", F.col("doc_id").cast("string"))
    # before every ninth line one of the sections' titles in turn, so that there are sections to find
    main = F.array(*[F.lit(f"{numbers[0]}. {title.capitalize()}") for title, numbers in P.MAIN_SECTIONS])
    own = F.struct((F.col("seq") * 2).alias("seq"), "text", "size", "bold")
    planted = F.struct((F.col("seq") * 2 - 1).alias("seq"), F.get(main, F.floor(F.col("seq") / 9).cast("int") % len(P.MAIN_SECTIONS)).alias("text"), F.lit(18.0).alias("size"), F.lit(True).alias("bold"))
    rows = rows.select("doc_id", F.inline(F.when(F.col("seq") % 9 == 4, F.array(planted, own)).otherwise(F.array(own))))
    box = F.struct(F.lit(50.0).alias("x0"), (F.col("seq") * 14.0).alias("y0"), F.lit(250.0).alias("x1"), (F.col("seq") * 14.0 + 10).alias("y1"))
    lines = rows.select("doc_id", "seq", F.lit(1).alias("page"), T.clean_line(F.col("text")).alias("text"), box.alias("bbox"), "size", "bold", F.when(F.col("seq") > 0, 14.0).otherwise(0.0).alias("gap_before"))
    documents = pages.select(F.col("page_id").cast("string").alias("doc_id"), F.col("url").alias("path"), F.concat(F.lit("КР"), F.col("page_id").cast("string"), F.lit(".pdf")).alias("source_file"), F.lit("").alias("first_page_text"))
    sizes = documents.select("doc_id", F.lit(1).alias("page"), F.lit(600.0).alias("width"), F.lit(800.0).alias("height"))
    return Layout(documents, sizes, materialize(lines.where("text <> ''")))


@query("result_json")
def result_json(spark, sf):
    from .plans.engine import Engine

    return Engine(spark).parse(page_layout(A.table(spark, sf, "pages"))).json


@query("page_sections")
def page_sections(spark, sf):
    from .plans.engine import Engine

    return Engine(spark).parse(page_layout(A.table(spark, sf, "pages"))).sections


@query("page_quality")
def page_quality(spark, sf):
    from .plans.engine import Engine

    return Engine(spark).parse(page_layout(A.table(spark, sf, "pages"))).quality
