"""Segmentation: the order-dependent rules, one document per case in one run."""

import pytest

from layouts import excluded, parsed, sections

TOP = "1. Краткая информация*"
DOCS = {
    "M1": [TOP, "Тело.", "1.1 Альфа", "1.1 Бета", "Тело.", "1.1 Гамма"],
    "M2": [TOP, "Тело.", "2.*", "Что-то иное", "Тело два."],
    "M3": ["1.*", "Краткая*", "информация*", "Тело."],
    "M4": [TOP, "Тело.", "5.1 ХОБЛ", "Тело.", "1.2 Этиология", "Тело.", "2. Диагностика", "Тело."],
    "M5": [TOP, "Тело.", "6. Организация оказания медицинской помощи", "2. Диагностика", "Тело."],
    "M6": [TOP, "Тело.", "6. Организация оказания медицинской помощи*", "2. Диагностика", "Тело."],
    "M7": [TOP, "Тело.", "Приложение А", "Тело два.", "Список литературы", "1. Иванов", "Приложение А1", "Текст"],
    "M8": ["3. Лечение, включая*", "медикаментозную терапию", "Тело."],
    "M9": [TOP, "Текст [75]. 4. Медицинская реабилитация", "Тело."],
    "M10": ["4", "4.*", "Медицинская реабилитация", "Тело."],
    "named": [TOP, "Тело.", "Критерии оценки качества медицинской помощи*", "Тело два."],
    "lost": ["Тело до разделов.", TOP, "Тело."],
    "none": ["Просто текст.", "И ещё."],
    "bracket": ["2. Диагностика (первая*", "Вторая часть)", "Тело."],
    "colon": ["2. Диагностика (первая", "2.1 Осмотр", "Тело."],
    "hyphen": ["2. Диагностика ВИЧ-*", "инфекции", "Тело ."],
}


@pytest.fixture(scope="module")
def result(spark):
    return parsed(spark, DOCS, body_only=True)


@pytest.fixture(scope="module")
def found(result):
    return sections(result)


@pytest.fixture(scope="module")
def out(result):
    return excluded(result)


def test_adjacent_equal_numbers_pass_but_not_after_a_body_line(found):
    assert found["M1"] == [("1", "Краткая информация", "Тело.", None), ("1.1", "Альфа", "", 0), ("1.1", "Бета", "Тело. 1.1 Гамма", 0)]


def test_a_number_whose_title_is_refused_vanishes(found):
    assert found["M2"] == [("1", "Краткая информация", "Тело. Что-то иное Тело два.", None)]


def test_title_word_by_word(found):
    assert found["M3"] == [("1", "Краткая информация", "Тело.", None)]


def test_a_foreign_sub_number_blocks_smaller_ones_until_the_next_top(found):
    assert found["M4"] == [("1", "Краткая информация", "Тело.", None), ("5.1", "ХОБЛ", "Тело. 1.2 Этиология Тело.", 0), ("2", "Диагностика", "Тело.", None)]


def test_a_top_section_out_of_order_needs_to_be_visual(found):
    assert found["M5"] == [("1", "Краткая информация", "Тело. 6. Организация оказания медицинской помощи", None), ("2", "Диагностика", "Тело.", None)]
    assert found["M6"] == [("1", "Краткая информация", "Тело.", None), ("6", "Организация оказания медицинской помощи", "2. Диагностика Тело.", None)]


def test_appendices_count_after_references_only(found, out):
    assert found["M7"] == [("1", "Краткая информация", "Тело. Приложение А Тело два.", None)]
    assert out["M7", "references"] == [("Список литературы", "1. Иванов")]
    assert out["M7", "appendices"] == [("Приложение А1", "Текст")]


def test_a_lower_case_line_goes_on_with_the_title(found):
    assert found["M8"] == [("3", "Лечение, включая медикаментозную терапию", "Тело.", None)]


def test_inline_heading(found):
    assert found["M9"] == [("1", "Краткая информация", "Текст [75]. 4. Медицинская реабилитация Тело.", None)]


def test_bare_number_is_a_page_number(found):
    assert found["M10"] == [("4", "Медицинская реабилитация", "Тело.", None)]


def test_named_section_has_no_number(found):
    assert found["named"][1] == (None, "Критерии оценки качества медицинской помощи", "Тело два.", None)


def test_text_before_any_section(found, out):
    assert out["lost", "other"] == [("unassigned", "Тело до разделов.")]
    assert found["lost"] == [("1", "Краткая информация", "Тело.", None)]
    assert "none" not in found and len(out["none", "other"]) == 2


def test_open_bracket(found):
    assert found["bracket"] == [("2", "Диагностика (первая Вторая часть)", "Тело.", None)]
    assert [s[0] for s in found["colon"]] == ["2.1"]  # the top one is not next in order and not visual


def test_hyphen_in_title(found):
    assert found["hyphen"] == [("2", "Диагностика ВИЧ-инфекции", "Тело .", None)]


def test_lines_are_neither_lost_nor_doubled(result):
    placed = result.placed.count() + result.body.where("tail").count()
    assert placed == result.body.count()


def test_same_result_on_other_partitions(spark, found):
    few = {k: DOCS[k] for k in ("M1", "M3", "M4", "M7")}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert sections(parsed(spark, few, body_only=True)) == {k: found[k] for k in few}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_lines_are_dealt_by_document_once_for_all_that_the_fold_needs(spark):
    result = parsed(spark, {"d": ["1. Краткая информация*", "Тело.", "2. Диагностика*", "Тело."]}, body_only=True)
    kept, result._keep = result._keep, lambda df: df
    body = result.body._jdf.queryExecution().executedPlan().toString()
    result.body = kept(result.body)
    placed = result.placed._jdf.queryExecution().executedPlan().toString()
    # the fold takes lines from the table of the body and gives them back with their text: nothing is joined to them again
    assert "attach_lines" in body and placed.count("Exchange") == 1 and "Join" not in placed


def test_a_document_over_many_batches_is_folded_as_one(spark):
    from docstruct.operators import fold as FO

    asked = FO.FEATURES.replace("kind string", "doc_id string, seq int, kind string, text string")
    rows = []
    for d, n in (("a", 7), ("b", 23), ("c", 1), ("d", 8)):
        for i in range(n):
            number = {0: "1", n // 2: "2"}.get(i)
            rows.append((d, i, number and "numbered", f"{d}{i}", number, number and 1, True, True, False, False, False, False, None, 3, False, False, False, False, 0))
    df = spark.createDataFrame(rows, asked)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = []
    try:
        for size in ("3", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            out.append(sorted(tuple(r) for r in FO.fold(df, carry=("text",)).select("doc_id", "seq", "text", "action", "sec_no").collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert out[0] == out[1] and len(out[0]) == len(rows) and all(t == f"{d}{i}" for d, i, t, *_ in out[0])
    assert [x[3:] for x in out[0] if x[0] == "a"] == [("open", 0), ("body", 0), ("body", 0), ("open", 1), ("body", 1), ("body", 1), ("body", 1)]
