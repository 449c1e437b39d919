"""Operators of the engine on small layouts, expected values worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from docstruct import schemas as S
from docstruct.functions import patterns as P
from docstruct.functions import text as T
from docstruct.operators import legacy as V1
from docstruct.operators import lines as L
from docstruct.operators import quality as Q
from docstruct.operators import ranks
from docstruct.operators import registry as R
from docstruct.operators import start as ST
from docstruct.operators import tables as TB
from docstruct.operators import tree as TR
from docstruct.plans.clinical import ClinicalGuideline
from docstruct.plans.profile import available_profiles, create_profile
from docstruct.sources import adapters as A
from layouts import excluded, layout, parsed, sections


def values(spark, f, *rows, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).withColumn("_n", F.monotonically_increasing_id())
    return [r[0] for r in df.withColumn("_o", f(df)).orderBy("_n").select("_o").collect()]


# --- text -----------------------------------------------------------------------------------------------------------------
def test_clean_norm_collapse(spark):
    assert values(spark, lambda d: T.clean_line(d.x), " a  b\t c ", "со­ль", "﻿x​", " ") == ["a b c", "соль", "x", ""]
    assert values(spark, lambda d: T.norm(d.x), " a \n  b ", None, " ") == ["a b", "", ""]
    assert values(spark, lambda d: T.collapse(d.x), " a \n\n\n\n b\r\nc ", None, "a\x0cb") == ["a\n\nb\nc", "", "a\nb"]


def test_join_title(spark):
    assert values(spark, lambda d: T.join_title(F.split(d.x, "[|]")), "ВИЧ-| инфекция", "a | |b", " one , two", "-") == ["ВИЧ-инфекция", "a b", "one, two", "-"]


def test_numbers(spark):
    assert values(spark, lambda d: T.top_int(d.x), "3.1", "x", None, "12") == [3, 0, 0, 12]
    order = lambda d: T.order_valid(d.x, d.y)
    assert values(spark, order, ("3.1", "3"), ("1.10", "1.9"), ("1.2", "1.2"), ("2", "10"), (None, "1"), ("1", None), schema="x string, y string") == [True, True, False, False, True, True]


def test_icd_codes_keep_cyrillic_a(spark):
    assert values(spark, lambda d: T.icd_codes(d.x), "С50, Е11.9, А00", "C50 С50 N13.0,N13.1", None, "c50") == [["C50", "E11.9"], ["C50", "N13.0", "N13.1"], [], []]


def test_round_even(spark):
    assert values(spark, lambda d: T.round_even(d.x, 1), 0.25, 0.35, 13.85, schema="x double") == [0.2, 0.4, 13.8]


# --- lines ----------------------------------------------------------------------------------------------------------------
def test_lines_from_spans(spark):
    box = (1.0, 2.0, 3.0, 4.0)
    rows = [
        ("d", 1, 0, 0, 1, "б", 12.0, 0, "Serif", box), ("d", 1, 0, 0, 0, "а ", 14.0, 0, "Serif-SemiBold", box), ("d", 1, 0, 1, 0, "", 20.0, 16, "x", box),
        ("d", 1, 0, 2, 0, " ", 20.0, 16, "x", box), ("d", 1, 1, 0, 0, "c", 9.0, 20, None, (1.0, 30.0, 3.0, 40.0)), ("d", 2, 0, 0, 0, "e", 9.0, None, "Mono", None),
    ]
    got = L.lines_from_spans(spark.createDataFrame(rows, S.SPANS)).orderBy("seq").collect()
    assert [(r["seq"], r["page"], r["text"], r["size"], r["bold"], r["gap_before"]) for r in got] == [(0, 1, "а б", 14.0, True, 0.0), (1, 1, "c", 9.0, True, 28.0), (2, 2, "e", 9.0, False, 0.0)]
    assert got[2]["bbox"]["x0"] == 0.0


def test_body_size(spark):
    rows = [("a", i, s) for i, s in enumerate((12.0, 14.0, 12.0, 14.0))] + [("b", i, 22.0) for i in range(3)] + [("c", 0, 20.04), ("c", 1, 6.0)]
    got = {r["doc_id"]: r["body"] for r in L.body_size(spark.createDataFrame(rows, "doc_id string, seq int, size double")).collect()}
    assert got == {"a": 12.0, "c": 6.0}


def test_blank_gap(spark):
    rows = [("few", float(g)) for g in (10, 12, 14, 16)] + [("some", float(g)) for g in (10, 12, 14, 16, 18, 20, 1, 61)] + [("none", None)]
    got = {r["doc_id"]: r["blank_gap"] for r in L.blank_gap(spark.createDataFrame(rows, "doc_id string, gap_before double")).collect()}
    assert got == {"few": 1e9, "some": pytest.approx(29.6), "none": 1e9}


def test_full_text_counts_empty_pages(spark):
    found = layout(spark, {"d": [(1, "a"), (1, "b"), (3, "c")]})
    pages = found.pages.unionByName(spark.createDataFrame([("d", 2, 1.0, 1.0)], S.PAGES)).distinct()
    assert L.page_texts(pages, found.lines).first()["full_text"] == "a\nb\n\nc"


# --- tables ---------------------------------------------------------------------------------------------------------------
FULL = [["a", "b"], ["c", "d"]]


def test_verdicts(spark):
    rows = [("d", 1, i, b, g, "") for i, (b, g) in enumerate([((0.0, 0.0, 100.0, 100.0), FULL), ((0.0, 0.0, 100.0, 100.0), [["a", " "], ["c", "d"]]), ((0.0, 0.0, 602.1, 100.0), FULL), ((0.0, 0.0, 602.0, 802.0), FULL), ((0.0, 5.0, 10.0, 5.0), FULL), ((0.0, 0.0, 9.0, 9.0), [["a", "b", "c", "d"]]), ((0.0, 0.0, 9.0, 9.0), None), (None, FULL)])]
    detected, pages = spark.createDataFrame(rows, S.DETECTED), spark.createDataFrame([("d", 1, 600.0, 800.0)], S.PAGES)
    got = [r["verdict"] for r in TB.judged(detected, pages).orderBy("tbl_no").collect()]
    assert got == ["ok", "small", "junk", "ok", "junk", "small", "small", "junk"]
    assert [r["verdict"] for r in TB.judged(detected, pages, sides=False).orderBy("tbl_no").collect()][2] == "ok"


def test_nearest_caption(spark):
    tables = spark.createDataFrame([("d", 1, 0, (0.0, 200.0, 1.0, 300.0), FULL, "")], S.DETECTED)
    caps = [("d", 1, i, str(i), f"Таблица {i}", y) for i, y in enumerate((190.0, 205.0, 79.0))]
    found = TB.nearest_caption(tables, spark.createDataFrame(caps, "doc_id string, page int, seq int, number string, caption string, y1 double"))
    assert found.first()["caption"] == "Таблица 1"
    tie = [("d", 1, 4, "4", "b", 195.0), ("d", 1, 3, "3", "a", 205.0)]
    assert TB.nearest_caption(tables, spark.createDataFrame(tie, "doc_id string, page int, seq int, number string, caption string, y1 double")).first()["number"] == "3"
    none = TB.nearest_caption(tables, spark.createDataFrame([("d", 2, 0, "1", "x", 199.0)], "doc_id string, page int, seq int, number string, caption string, y1 double"))
    assert none.first()["caption"] is None


def test_a_top_number_stays_inside_a_table(spark):
    table = ("d", 1, 0, (0.0, 0.0, 300.0, 60.0), FULL, " raw \n\n\n\n x ")
    found = parsed(spark, {"d": ["5.", "Ячейка", "Таблица 2. Дозы", "1. Краткая информация*", "после", "таблицы", "проза"]}, tables=[table], gap=14.0)
    kept = [r["text"] for r in found.classified.orderBy("seq").collect()]
    assert "5." in kept and "Ячейка" not in kept and "1. Краткая информация" in kept
    t = found.tables.first()
    assert (t["raw_text"], t["bbox"], t["number"]) == ("raw\n\nx", [0.0, 0.0, 300.0, 60.0], None)


# --- headings -------------------------------------------------------------------------------------------------------------
CASES = [
    ("1. Краткая информация по заболеванию", False, ("numbered", "1", 1)), ("2. Краткая информация", False, None), ("3. Лечением занимается", False, ("numbered", "3", 1)), ("4. Медицинская", False, ("numbered", "4", 1)),
    ("4. Мед", True, None), ("8. Критерии оценки качества", False, ("numbered", "8", 1)), ("3.1 затем", False, None), ("3.1 затем", True, ("numbered", "3.1", 2)), ("3 . 1 Затем", False, ("numbered", "3.1", 2)),
    ("2. 5 мг", False, None), ("2. 5 мг", True, ("numbered", "2.5", 2)), ("1.1.1.1.1.1 Foo", True, None), ("10.1 Foo", True, None), ("0.1 Foo", True, None), ("1.1 Жалобы [3,4]", True, None), ("1.1 Метод (5С)", True, None),
    ("1.1 Хвост)", True, None), ("1.1 Альфа ..... 7", True, None), ("1.1 Альфа ___", True, None), ("Таблица 1.1 Дозы", True, None), ("- 1.1 Альфа", True, None), ("4.", False, ("number_only", "4", 1)), ("4", False, ("number_only", "4", 1)),
    ("01.02.2020", False, None), ("1.2.3", False, ("number_only", "1.2.3", 3)), ("Список сокращений", True, ("named", None, 1)), ("СПИСОК  СОКРАЩЕНИЙ", True, ("named", None, 1)), ("Список сокращений", False, None),
    ("Термины и определения", True, ("named", None, 1)), ("Термины и определения " + "о" * 90, True, None), ("", True, None), ("1.1 " + "А" * 301, True, None), ("1.1 Альфа", False, ("numbered", "1.1", 2)),
]


def test_headings(spark):
    rows = spark.createDataFrame([(i, t, v) for i, (t, v, _) in enumerate(CASES)], "i int, t string, v boolean")
    got = {r["i"]: r["h"] for r in rows.select("i", ClinicalGuideline().heading(F.col("t"), F.col("v")).alias("h")).collect()}
    for i, (text, visual, want) in enumerate(CASES):
        assert (None if got[i] is None else (got[i]["kind"], got[i]["number"], got[i]["level"])) == want, (text, visual)


def test_regions_and_inline_headings(spark):
    profile = ClinicalGuideline()
    assert values(spark, lambda d: profile.region(d.x), "ОГЛАВЛЕНИЕ", "Список литературы:", "Список литературы [1]", "Приложение А1", "Приложения к", " содержание ") == ["toc", "references", None, "appendices", None, "toc"]
    assert values(spark, lambda d: profile.parts(d.x), "Текст [75]. 4. Медицинская реабилитация", "Нет", "а 2 Лечение и 5.1 Профилактика") == [["Текст [75].", "4. Медицинская реабилитация"], ["Нет"], ["а", "2 Лечение и", "5.1 Профилактика"]]


def test_profiles():
    assert available_profiles() == ["cr"] and isinstance(create_profile("cr"), ClinicalGuideline)
    with pytest.raises(ValueError):
        create_profile("other")


# --- content start ----------------------------------------------------------------------------------------------------------
def starts(spark, docs):
    found = parsed(spark, docs)
    return {r["doc_id"]: r["start"] for r in found.started.select("doc_id", "start").distinct().collect()}, found


PROSE = ["Первая строка.", "Вторая строка.", "Третья строка."]


def test_content_start(spark):
    toc = ["Оглавление", *[f"{i}. Раздел ........ {i}" for i in range(1, 6)]]
    docs = {
        "leaders": ["Титул", *toc, "Список сокращений*", "КР — рекомендация", "1. Краткая информация*", *PROSE],
        "visual": ["1. Краткая информация", *PROSE, "2. Диагностика*", *PROSE, "3. Лечение*", *PROSE],
        "plain": ["Титул", "1. Краткая информация", "1.1 Альфа", "1.2 Бета", "2. Диагностика", *PROSE],
        "top": ["Титул", "2. Диагностика", "конец"], "number": ["Титул", "1.1 Альфа", "конец"], "nothing": ["Титул", "конец"],
        "few": ["Оглавление", "1. Раздел .... 1", "2. Диагностика", *PROSE],
        "fall": ["Титул", "1. Краткая информация", *PROSE, *[f"слово .... {i}" for i in range(4)]],
        "gap": ["Титул", "2. Диагностика", *PROSE[:2], "1.1 Альфа", "2.1 Бета", PROSE[0], ". . .", *PROSE[1:]],
        "reset": ["1. Краткая информация", *PROSE[:2], "1.1 Альфа", *PROSE[:2], "2. Диагностика", *PROSE],
    }
    got, found = starts(spark, docs)
    assert got == {"leaders": 9, "visual": 4, "plain": 4, "top": 1, "number": 1, "nothing": 0, "few": 2, "fall": 1, "gap": 1, "reset": 6}
    out = excluded(found)
    assert out["leaders", "front_matter"] == [("front_matter", "Титул")]
    assert out["leaders", "toc"][0][1].endswith("5. Раздел ........ 5 Список сокращений КР — рекомендация")


def test_leader_islands(spark):
    rows = spark.createDataFrame([("d", i) for i in (0, 40, 81, 90)], "doc_id string, idx int")
    assert [r["island"] for r in ST.leader_islands(rows).orderBy("idx").collect()] == [0, 0, 1, 1]


# --- tree -------------------------------------------------------------------------------------------------------------------
def test_parents_and_depth(spark):
    rows = spark.createDataFrame([("d", i, l, str(i)) for i, l in enumerate((1, 2, 3, 2, 1, 3, 5, 4))], "doc_id string, sec_no int, level int, number string")
    got = TR.with_parents(rows).withColumn("depth", TR.depth()).orderBy("sec_no").collect()
    assert [r["parent_sec_no"] for r in got] == [None, 0, 1, 0, None, 4, 5, 5]
    assert [r["depth"] for r in got] == [1, 2, 3, 2, 1, 2, 3, 3]
    kids = {r["sec_no"]: r["children"] for r in TR.child_numbers(TR.with_parents(rows)).collect()}
    assert kids == {0: ["1", "3"], 4: ["5"]}


# --- registry and metadata ----------------------------------------------------------------------------------------------------
def test_lookup_tiers(spark):
    rows = spark.createDataFrame([(0, "79_1", {"a": "1"}), (1, "79_2", {"a": "2"}), (2, "790", {"a": "3"})], S.REGISTRY)
    probes = spark.createDataFrame([(p, p) for p in ("79", "79_3", "790_2", "7", "79_2", "")], "doc_id string, probe string")
    assert {r["doc_id"]: r["id"] for r in R.lookup(probes, rows).collect()} == {"79": "79_1", "79_3": "79_1", "790_2": "790", "79_2": "79_2"}


SHEET = [["Реестр"], [None], ["ID", "Наименование", "МКБ-10", "Статус", None, "ID"], ["79_1", "Первая", "С50", None, "x", "79_1"], [" ", "нет"], ["79_1", " Вторая  версия ", "E11.9", "действует"], ["80", None]]


def test_registry_from_sheet(spark):
    got = {r["id"]: (r["ord"], r["row"]) for r in R.from_sheet(spark.createDataFrame(list(enumerate(SHEET)), "ord int, cells array<string>")).collect()}
    assert set(got) == {"79_1"} and got["79_1"][0] == 3
    headless = spark.createDataFrame([(0, ["a", "b"])], "ord int, cells array<string>")
    assert R.from_sheet(headless).count() == 0


def test_value_by_alias(spark):
    rows = spark.createDataFrame([({"статус ПРИМЕНЕНИЯ": " ", "Статус": " да "},), (None,), ({},)], "row map<string,string>")
    assert [r[0] for r in rows.select(R.value(F.col("row"), P.ALIASES["application"])).collect()] == ["да", None, None]


def test_a_registry_row_is_read_once_and_a_probe_looked_up_once(spark):
    registry = spark.createDataFrame([(i, f"7_{i}", {"Год": str(2000 + i), "название": " А  б ", "Наименование": " "}) for i in range(3)], S.REGISTRY)
    texts = spark.createDataFrame([(f"{i}", f"КР{p}.pdf", "", "") for i, p in enumerate(("7_2", "7_9", "7_2", "8", "7"))], "doc_id string, source_file string, full_text string, first_page_text string")
    found = ClinicalGuideline().metadata(texts, registry)
    rows = {r.doc_id: (r.id, r.title, r.year, r.registry_matched) for r in found.collect()}
    assert rows == {"0": ("7_2", "А б", "2002", True), "1": ("7_0", "А б", "2000", True), "2": ("7_2", "А б", "2002", True), "3": ("8", None, None, False), "4": ("7_0", "А б", "2000", True)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_entries") == 1
    (best,) = [line for line in plan.splitlines() if "min_by" in line]
    assert "Aggregate [_p#" in best  # by what is asked for, not by document


def test_metadata_without_a_registry(spark):
    texts = spark.createDataFrame([("a", "КР7.pdf", "Год утверждения: 2020", "")], "doc_id string, source_file string, full_text string, first_page_text string")
    found = ClinicalGuideline().metadata(texts)
    assert [(r.id, r.year, r.registry_matched, r.registry_known, r.probe, r.developer) for r in found.collect()] == [("7", "2020", False, False, "7", None)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_few_row_groups_are_dealt_out(spark):
    rows = A.spread(spark.range(1000).coalesce(1), "id")
    assert rows.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_metadata_of_few_row_groups_takes_all_cores(spark, tmp_path):
    from docstruct.queries import QUERIES

    spark.range(200).selectExpr("id as o_orderkey", "id % 20 as o_custkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(20).selectExpr("id as c_custkey", "'n' || id as c_name", "id as c_nationkey", "1.0D as c_acctbal", "'X' as c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    found = QUERIES["metadata_merge"](spark, str(tmp_path))
    assert found.count() == 200 and "hashpartitioning(o_orderkey#" in found._jdf.queryExecution().executedPlan().toString()


def test_predecessor_metadata_of_few_row_groups_takes_all_cores(spark, tmp_path):
    from docstruct.queries import QUERIES

    spark.range(200).selectExpr("id as p_partkey", "'name ' || id as p_name").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = QUERIES["legacy_metadata"](spark, str(tmp_path))
    assert found.count() == 200 and "hashpartitioning(p_partkey#" in found._jdf.queryExecution().executedPlan().toString()


def test_title_page(spark):
    first = "Клинические рекомендации\nID: 5\nГод\nРак молочной железы\n"
    full = "Кодирование по статистической классификации проблем, связанных со здоровьем: С50, Е11.9\nГод утверждения: 2024\nГод окончания действия: 2026\nВозрастная категория: Взрослые и  дети"
    texts = [("a", "КР379_4.pdf", full, first), ("b", "doc.PDF", "Год утверждения (частота пересмотра): 2024\nМКБ-10: C50.1", "ID: 12_3"), ("c", "x12.pdf", None, None), ("d", "x.pdf", "", "")]
    got = {r["doc_id"]: r for r in ClinicalGuideline().title_page(spark.createDataFrame(texts, "doc_id string, source_file string, full_text string, first_page_text string")).collect()}
    a = got["a"]
    assert (a["title"], a["id"], a["year"], a["end_year"], a["age_group"], a["mkb_codes"]) == ("Рак молочной железы", "379_4", "2024", "2026", "Взрослые и дети", ["C50", "E11.9"])
    assert (got["b"]["id"], got["b"]["year"], got["b"]["mkb_codes"]) == ("12_3", None, ["C50.1"])
    assert got["c"]["id"] == "12" and got["d"]["id"] is None and got["d"]["title"] is None


# --- whole documents ----------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def whole(spark):
    docs = {
        "G1": ["Титул", "1. Краткая информация*", *PROSE, "1.1 Альфа", "Тело.", "2. Диагностика*", *PROSE, "Список литературы", "1. Иванов", "Приложение А", "Текст"],
        "G2": [],
    }
    known = spark.createDataFrame([(0, "77", {"Наименование": "Из реестра", "МКБ-10": "С50", "Дата размещения": "01.02.2021", "Разработчик": "Ассоциация., Москва"})], S.REGISTRY)
    return parsed(spark, docs, known, files={"G1": "КР5.pdf", "G2": "КР77_2.pdf"}, tables=[("G1", 1, 0, (0.0, 700.0, 1.0, 720.0), FULL, "a b"), ("G1", 1, 1, (0.0, 700.0, 1.0, 900.0), FULL, "x")])


def test_statistics(whole):
    got = {r["doc_id"]: r for r in whole.stats.collect()}
    g = got["G1"]
    assert (g["sections_found"], g["tables_found"], g["table_chars"]) == (3, 1, 3)
    assert g["included_chars"] == sum(len(t) + len(x) for _, t, x, _ in sections(whole)["G1"])
    assert 0 < g["coverage_percent"] <= 100 and g["accounted_chars"] <= g["total_chars"]
    assert (got["G2"]["total_chars"], got["G2"]["coverage_percent"], got["G2"]["total_words"]) == (0, 0.0, 0)


def test_metadata_and_warnings(whole):
    m = {r["doc_id"]: r for r in whole.metadata.collect()}
    assert (m["G2"]["title"], m["G2"]["id"], m["G2"]["year"], m["G2"]["mkb_codes"], m["G2"]["developer"]) == ("Из реестра", "77", "2021", ["C50"], "Ассоциация, Москва")
    assert not m["G1"]["registry_matched"]
    codes = {}
    for r in whole.warnings.orderBy("doc_id", "ord").collect():
        codes.setdefault(r["doc_id"], []).append(r["code"])
    assert codes == {"G1": ["W_JUNK", "W_NOT_FOUND", "W_NO_TITLE", "W_NO_ICD"], "G2": ["W_SCAN", "W_NO_SECTIONS", "W_LOWCOV"]}


def test_json(whole):
    got = {r["doc_id"]: json.loads(r["json"]) for r in whole.json.collect()}
    g = got["G1"]
    assert list(g) == ["metadata", "sections", "tables", "excluded", "stats", "warnings"]
    assert [s["number"] for s in g["sections"]] == ["1", "2"] and g["sections"][0]["children"] == [{"number": "1.1", "title": "Альфа", "level": 2, "text": "Тело.", "children": []}]
    assert list(g["excluded"]) == ["front_matter", "toc", "references", "appendices", "other"] and g["excluded"]["references"] == [{"title": "Список литературы", "text": "1. Иванов"}]
    assert g["tables"] == [{"page": 1, "number": None, "caption": None, "raw_text": "a b", "bbox": [0.0, 700.0, 1.0, 720.0]}]
    assert "developer" not in g["metadata"] and g["metadata"]["title"] is None
    assert got["G2"]["metadata"]["developer"] == "Ассоциация, Москва" and got["G2"]["sections"] == [] and len(got["G2"]["warnings"]) == 3


def test_quality(whole):
    got = {r["file"]: r for r in Q.flags(whole.quality).collect()}
    g = got["КР5.pdf"]
    assert (g["top_numbers"], g["n_top"], g["has4"], g["dup"], g["disorder"], g["from_registry"]) == (["1", "2"], 2, False, [], False, False)
    assert "NO_SEC4" in g["flags"] and "FALLBACK" in g["flags"] and got["КР77_2.pdf"]["from_registry"]
    s = Q.summary(whole.quality).first()
    assert (s["n_ok"], s["below_50"], s["tables"], s["from_registry"]) == (2, 1, 1, 1)
    assert {r["problem"]: r["n"] for r in Q.problems(whole.quality).collect()}["no_section_4"] == 2


def test_dangling_titles(spark):
    assert values(spark, lambda d: Q.dangles(d.x), "Лечение и", "и", "Лечение,", "Лечение", "Медицинские", None, "Показания к применению ", "Тип") == [True, True, True, False, True, False, True, False]
    leaked = lambda d: Q.leaked(d.x, d.y)
    assert values(spark, leaked, ("Лечение и", "профилактика"), ("Лечение и", "Профилактика"), ("Критерии и", "оценка"), ("Лечение и", None), schema="x string, y string") == [True, False, False, False]


def test_spread_and_index(spark, monkeypatch):
    rows = spark.createDataFrame([(f"{i:03d}",) for i in range(50)], "k string")
    assert sorted(r["k"] for r in Q.spread(rows, "k", 7).collect()) == [f"{int(i * 50 / 7):03d}" for i in range(7)]
    assert Q.spread(rows, "k", 50).count() == 50
    monkeypatch.setattr(ranks, "ROWS", 10)
    assert sorted((r["idx"], r["k"]) for r in ranks.with_index(rows, "k").collect()) == [(i, f"{i:03d}") for i in range(50)]


# --- predecessor ----------------------------------------------------------------------------------------------------------------
def test_predecessor(spark):
    rows = [
        ("Титул", 12.0), ("ОГЛАВЛЕНИЕ", 20.0), ("Введение", 20.0), ("1. Раз", 12.0), ("Введение", 12.0), ("1 Первый раздел", 20.0), ("продолжение", 20.0), ("Текст а", 12.0), ("Текст б", 12.0), ("1.1 Под", 20.0), ("Текст в", 12.0),
        ("1 Первый снова", 20.0), ("Неизвестный", 12.0), ("Нечто", 20.0), ("Хвост", 12.0), ("Список литературы", 20.0), ("1. Иванов", 12.0), ("Приложение А", 20.0), ("Форма", 12.0), ("Критерии оценки качества", 20.0), ("Таблица", 12.0),
    ]
    lines = spark.createDataFrame([("d", i, i // 10, i // 3, t, s, False, float(i)) for i, (t, s) in enumerate(rows)], "doc_id string, seq int, page int, block int, text string, size double, bold boolean, y double")
    placed = V1.placed(V1.units(lines.withColumn("h", V1.classify(F.col("text"), F.col("size"), F.col("bold"), F.lit(12.0)))))
    got = [(r["section_id"], r["title"], r["text"], r["page_start"], r["page_end"]) for r in V1.sections(placed).orderBy("sec_no").collect()]
    assert got == [
        ("1", "Первый раздел продолжение", "Текст а Текст б", 1, 1), ("1.1", "Под", "Текст в", 1, 2), ("1_2", "Первый снова", "Неизвестный", 2, 2),
        ("named1", "Нечто", "Хвост", 2, 2), ("criteria_quality", "Критерии оценки качества", "Таблица", 2, 3),
    ]
    out = V1.excluded(placed).first()
    assert out["references_text"] == "1. Иванов" and out["appendices_text"] == "Приложение А\nФорма"
    assert out["toc_text"].startswith("Титул\n")
    tables = spark.createDataFrame([("d", 0, 0, 8.5, "x"), ("d", 1, 0, 0.0, "y"), ("d", 2, 1, 18.5, "z"), ("d", 3, 0, 8.6, "w")], "doc_id string, tbl_no int, page0 int, top double, raw_text string")
    owned = {r["tbl_no"]: r["table_id"] for r in V1.attach(V1.sections(placed), tables).collect()}
    assert owned == {0: "1_t1", 1: None, 2: "named1_t1", 3: "1_t2"}
    stats = V1.stats(spark.createDataFrame([("d", 500), ("e", 0)], "doc_id string, total_chars int"), V1.sections(placed), V1.excluded(placed), V1.attach(V1.sections(placed), tables)).collect()
    assert {r["doc_id"]: (r["sections_found"], r["tables_found"]) for r in stats} == {"d": (5, 4), "e": (0, 0)}


def test_predecessor_metadata(spark):
    first = "Клинические рекомендации\nАстма\nГод утверждения (частота пересмотра): 2021\nПересмотр не позднее: 2023\nсвязанных со здоровьем: С50, Е11.9\nГод утверждения\nВозрастная категория: Дети \nID: 359\nРазработчик клинической рекомендации\nСоюз врачей\nРоссии\nФонд\nОдобрено советом"
    rows = spark.createDataFrame([("a", "f.pdf", first, None), ("b", "КР.v2.pdf", "", "Крупная строка")], "doc_id string, source_file string, first_page_text string, largest string")
    got = {r["doc_id"]: r for r in V1.metadata(rows).collect()}
    a = got["a"]
    assert (a["document"], a["title"], a["approval_year"], a["revision_year"], a["icd_10"], a["age_category"], a["developers"]) == ("КР359", "Астма", 2021, 2023, ["C50", "E11.9"], "Дети", ["Союз врачей России", "Фонд"])
    assert (got["b"]["document"], got["b"]["title"], got["b"]["developers"]) == ("КР.v2", "Крупная строка", [])


def test_predecessor_end_to_end(spark):
    from docstruct.plans.legacy import LegacyResult

    texts = [("Оглавление", 20.0), ("1 Раз .... 2", 12.0), ("1 Первый раздел", 20.0), ("Текст а, который намного длиннее.", 12.0), ("Ячейка", 12.0), ("Список литературы", 20.0), ("Иванов", 12.0)]
    spans = [("d", 1, i, 0, 0, t, s, 0, "Serif", (10.0, 20.0 * i, 100.0, 20.0 * i + 10)) for i, (t, s) in enumerate(texts)]
    documents = spark.createDataFrame([("d", "/d.pdf", "d.pdf", "Клинические рекомендации\nАстма\nID: 7"), ("e", "/e.pdf", "e.pdf", "")], S.DOCUMENTS)
    pages = spark.createDataFrame([("d", 1, 600.0, 800.0), ("e", 1, 600.0, 800.0)], S.PAGES)
    tables = [("d", 1, 0, (0.0, 79.0, 200.0, 95.0), FULL, "raw"), ("d", 1, 1, (0.0, 79.0, 9.0, 900.0), FULL, "x")]
    found = LegacyResult(documents, pages, spark.createDataFrame(spans, S.SPANS), spark.createDataFrame(tables, S.DETECTED))
    got = {r["doc_id"]: json.loads(r["json"]) for r in found.json.collect()}
    d = got["d"]
    assert list(d) == ["doc_id", "source_file", "metadata", "sections", "excluded", "parse_stats"] and d["doc_id"] == "КР7"
    assert d["sections"] == [{"section_id": "1", "level": 1, "title": "Первый раздел", "text": "Текст а, который намного длиннее.", "page_start": 1, "page_end": 1, "tables": [{"table_id": "1_t1", "page": 1, "raw": True, "raw_text": "raw", "bbox": [0.0, 79.0, 200.0, 95.0]}]}]
    assert d["excluded"] == {"toc_text": "1 Раз .... 2", "references_text": "Иванов", "appendices_text": ""}
    assert d["metadata"]["title"] == "Астма" and d["metadata"]["approval_year"] is None and d["parse_stats"]["tables_found"] == 1
    assert got["e"]["sections"] == [] and got["e"]["parse_stats"]["text_coverage_pct"] == 0.0 and len(got["e"]["parse_stats"]["warnings"]) == 5


def test_shapes_add_up_to_the_joined_title(spark):
    """Length, end and brackets of a title grown part by part are those of the joined one."""
    import random

    from docstruct.operators import fold as FO

    r = random.Random(3)
    bits = ["ВИЧ-", "инфекция", ", и", "или", " (первая", "вторая)", ";", "по", "", " ", "лечение к", "a  b", "- c", "/", "и"]
    cases = [[r.choice(bits) for _ in range(r.randint(1, 6))] for _ in range(300)]
    rows = spark.createDataFrame([(i, j, x) for i, c in enumerate(cases) for j, x in enumerate(c)], "i int, j int, x string")
    shapes = {(r["i"], r["j"]): r for r in rows.select("i", "j", *[c.alias(k) for k, c in FO.shape(F.col("x")).items()]).collect()}
    titles = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, parts array<string>").select("i", T.join_title(F.col("parts")).alias("t"))
    for r in titles.collect():
        f = FO.Fold()
        f.begin("1", 1, shapes[r["i"], 0])
        for j in range(1, len(cases[r["i"]])):
            f.grow(shapes[r["i"], j])
        t = r["t"]
        assert (f.length, f.open, f.balance) == (len(t), t.endswith(P.OPEN_ENDS), t.count("(") - t.count(")")), (cases[r["i"]], t)


def test_windows_agree_with_groups(spark):
    import random

    r = random.Random(5)
    rows = [(d, i, r.choice([5.0, 10.04, 10.05, 12.0, 12.04, 30.0]) if d else 40.0, r.choice([0.0, 1.0, 5.5, 14.0, 14.5, 70.0])) for d in range(12) for i in range(3 + d * 3)]
    df = spark.createDataFrame(rows, "doc_id int, seq int, size double, gap_before double")
    body = {x["doc_id"]: x["body"] for x in L.body_size(df).collect()}
    gap = {x["doc_id"]: x["blank_gap"] for x in L.blank_gap(df).collect()}
    got = L.with_blank_gap(L.with_body(df)).collect()
    assert len(got) == len(rows) and all(x["body"] == body.get(x["doc_id"]) and x["blank_gap"] == gap[x["doc_id"]] for x in got)


def test_classified_takes_one_shuffle(spark):
    found = parsed(spark, {"d": ["1. Краткая информация*", "Тело."]})
    found._keep = lambda df: df
    plan = found.classified._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_page_texts_are_put_together_once(spark):
    found = parsed(spark, {"d": ["1. Краткая информация*", "Тело."]})
    written = []
    keep = found._keep
    found._keep = lambda df: (written.append(df.columns), keep(df))[1]
    assert found.stats.count() == found.metadata.count() == 1 and found.warnings.count() >= 0
    assert sum("full_text" in c for c in written) == 1
    assert "collect_list" not in found.texts._jdf.queryExecution().optimizedPlan().toString()
