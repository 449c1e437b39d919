"""Patterns, word lists and thresholds that results depend on.

Patterns are Java regular expressions. (?U) makes classes Unicode-aware, (?iU) case-insensitivity as well.
"""

# --- layout ---------------------------------------------------------------------------------------------------------
BOLD_FLAG = 16
BOLD_FONTS = "bold|black|heavy"  # semibold and demibold contain the first
TRASH = "\u00ad\ufffe\uffff\u200b\ufeff"
BODY_SIZES = (6.0, 20.0)
DEFAULT_BODY = 12.0
VISUAL_RATIO = 1.35
GAP_RANGE = (2.0, 60.0)
GAP_SAMPLES = 5
GAP_FACTOR = 1.85
NO_GAP = 1e9

# --- lines and headings ---------------------------------------------------------------------------------------------
PAGE_NUMBER = r"^(?U)\d{1,3}$"
LEADER = r"\.{3,}|_{3,}"
LETTER = r"[А-Яа-яA-Za-z]"
FORBIDDEN_START = r"^[+\-•▪□✓*−–]"
NUMBERED = r"(?U)^(\d+(?:\s*\.\s*\d+){0,4})\s*\.?\s+(.+)$"
NUMBER_ONLY = r"(?U)^(\d+(?:\s*\.\s*\d+){0,4})\s*\.?$"
DATE_LIKE = r"(?U)^\d{1,2}\.\d{1,2}\.\d{4}$"
CITATION = r"(?U)\[\s*\d"
EVIDENCE = r"(?U)\(\s*\d+\s*[А-СA-Cа-сa-c]\s*\)"
CAPTION = r"(?iU)^(Таблица|Рисунок|Табл\.|Рис\.)\b"
TABLE_CAPTION = r"(?iU)^\s*Таблица\s+(\d+(?:\.\d+)?)\.?\s*(.*)$"
TOC = r"(?iU)^\s*(оглавление|содержание)\s*$"
REFERENCES = r"(?iU)^\s*список\s+литературы\s*[.:]?\s*$"
APPENDICES = r"(?iU)^\s*приложение\b"
MAX_TOP, MAX_DEPTH = 9, 5
TOP_TITLE, SUB_TITLE, NAMED_TITLE = 500, 300, 90

#: Titles of top sections in the order they are tried, and the numbers each may have.
MAIN_SECTIONS = (
    ("краткая информация", (1,)),
    ("диагностика", (2,)),
    ("лечение", (3,)),
    ("медицинская реабилитация", (4,)),
    ("реабилитация", (4,)),
    ("профилактика", (5,)),
    ("организация оказания медицинской помощи", (6,)),
    ("организация медицинской помощи", (6,)),
    ("дополнительная информация", (7,)),
    ("критерии оценки качества", (7, 8, 9)),
)
NAMED = (
    (r"(?iU)список\s+сокращ", "abbreviations"),
    (r"(?iU)термин\w*\s+и\s+определ", "terms"),
    (r"(?iU)критери\w*\s+оценки\s+качеств", "criteria_quality"),
)

# --- titles over several lines --------------------------------------------------------------------------------------
CONTINUATION_STARTS = (
    "или ", "и ", "в том числе", "показания", "медицинские показания", "противопоказания", "и противопоказания", "к применению", "применению",
    "методов", "метода", "диагностики", "лечения", "профилактики", "реабилитации", "инфекция", "инфекции", "заболевания", "заболеваний", "состояний", "состояния",
)
CONTINUATION_STOP = r"(?iU)^(Таблица|Рисунок|Список литературы|Приложение|Ключевые слова|Список сокращений|Оглавление)\b"
ATTACH_STOP = r"(?iU)^(Таблица|Рисунок|Список литературы|Приложение|Оглавление)\b"
CONTINUATION_WORDS = ("показания", "противопоказания", "применению", "методов")
OPEN_ENDS = ("-", ",", "(", "/", " к", " и", " или", " по", " при", " с", " в", " для")
CONTINUATION_LINE, KEYWORD_LINE, LOWER_LINE, OPEN_TITLE = 320, 260, 220, 320
PENDING_FIRST, PENDING_LINES = 25, 15
INLINE_SPLIT = r"(?U)\s+(?=(?:[1-7](?:\.\d+){0,4})\.?\s+(?:Краткая|Диагностика|Лечение|Медицинская|Профилактика|Организация|Дополнительная|Критерии)\b)"

# --- start of the content -------------------------------------------------------------------------------------------
TOC_NEAR, TOC_HEAD, TOC_LEADERS, TOC_CHAIN = 60, 400, 4, 40
LOOK_AHEAD, PROSE_RUN, VISUAL_TOPS = 23, 3, 2

# --- tables ---------------------------------------------------------------------------------------------------------
TABLE_SLACK, TABLE_ROWS, TABLE_COLUMNS, TABLE_CELLS = 2.0, 2, 2, 4
CAPTION_OVERLAP, CAPTION_DISTANCE = 10.0, 120.0

# --- metadata -------------------------------------------------------------------------------------------------------
TITLE_MARK = "клинические рекомендации"
YEAR = r"(?iU)Год\s+утвержд\w*[^\d]{0,20}(\d{4})"
END_YEAR = r"(?iU)Год\s+окончани\w*\s+действия\s*[:\-]?\s*(\d{4})"
AGE = r"(?iU)Возрастная\s+категория\s*[:\-]?\s*(Взрослые\s+и\s+дети|Взрослые|Дети)"
CODES_BLOCK = r"(?isU)здоровь\w*\s*:?\s*(.*?)\s*Год\s+утвержд"
CODES_LINE = r"(?iU)(?:МКБ[- ]?10|код\w*\s+по\s+МКБ)[^\n:]*:?\s*([^\n]+)"
CODE = r"[A-Z](?U:\d{2}(?:\.\d+)?)"
#: Cyrillic look-alikes and what they stand for; the second and third are Latin already, so А and В stay Cyrillic.
LOOKALIKES = ("СABЕКМНОРТХ", "CABEKMHOPTX")
ID_IN_NAME = r"(?iU)КР\s*(\d+(?:_\d+)?)"
ID_ANY = r"(?U)(\d+(?:_\d+)?)"
ID_ON_PAGE = r"(?iU)\bID[:\s]+(\d+(?:_\d+)?)"
PUBLICATION_YEAR = r"(?U)\b(20\d{2})\b"
HEADER_ROWS, HEADER_ID, HEADER_NAME = 30, "id", "наименование"
ALIASES = {
    "title": ("Наименование", "Название", "Клиническая рекомендация"),
    "codes": ("МКБ-10", "МКБ 10", "Код МКБ", "Коды МКБ"),
    "age": ("Возрастная категория", "Возраст"),
    "developer": ("Разработчик",),
    "approval": ("Статус одобрения НПС", "Статус одобрения"),
    "published": ("Дата размещения", "Дата публикации", "Дата утверждения"),
    "application": ("Статус применения", "Статус"),
    "year": ("Год утверждения", "Год"),
}

# --- quality --------------------------------------------------------------------------------------------------------
LOW_COVERAGE, REPORT_COVERAGE, REGRESSION_COVERAGE = 50, 80, 99.0
SECTION_4 = "медицинская реабилитация"
DANGLING_ENDS = (",", "-", "–", "(")

# --- the predecessor ------------------------------------------------------------------------------------------------
V1_RATIO, V1_BIG_LENGTH, V1_BOLD_LENGTH, V1_PAGES = 1.35, 200, 140, 40
V1_NUMBERED = r"(?U)^(\d+(?:\.\d+){0,2})\.?\s+\S"
V1_SUB = r"(?U)^\d+\.\d+(?:\.\d+)?\.?\s+\S"
V1_LEADER = r"\.{4,}"
V1_REFERENCES = r"(?iU)^\s*Список\s+литературы"
V1_APPENDICES = r"(?iU)^\s*Приложени[ея]\b"
V1_TOC = r"(?iU)^\s*оглавлен"
V1_DEVELOPER = r"(?iU)^(Ассоциац|Общероссийск|Союз|Национальн|Российск|Федерац|Межрегиональн|Ассоц|Общество|Фонд)"
V1_YEAR = r"(?U)Год\s+утвержд\w*[^\d]*(\d{4})"
V1_REVISION = r"(?U)Пересмотр[^\n\d]*(\d{4})"
V1_CODES_BLOCK = r"(?sU)здоровь\w*\s*:?\s*(.*?)\s*Год\s+утвержд"
V1_CODES_LINE = r"(?U)здоровь\w*\s*:?\s*([^\n]+)"
V1_AGE = r"(?U)Возрастная\s+категория\s*:?\s*([^\n]+)"
V1_ID = r"(?U)\bID[:\s]+(\d+)"
DANGLING = (
    "в том", "к применению", "и противопоказания", "включая", "на основе", "в том числе", "и", "или", "к", "по", "при", "с", "для", "на", "о", "методов", "медицинские",
)

#: What a known document must come out as, by its name.
GOLDEN = {
    "КР79_2": {
        "coverage": 100.0, "total_chars": 374984, "sections": 58, "tops": ("1", "2", "3", "4", "5", "6", "7"),
        "children": {"3": ("3.1", "3.2", "3.3", "3.4"), "5": ("5.1", "5.2")},
        "titles": {"4": ("медицинская реабилитация", "природных лечебных факторов", "в том числе основанных"), "5": ("к применению методов профилактики",)},
        "begins": {"4": "Реабилитация"}, "is_not": {"5": "методов профилактики"},
    },
}

# --- messages -------------------------------------------------------------------------------------------------------
MESSAGES = {
    "W_SCAN": "PDF без текстового слоя (вероятно скан) — разделы и таблицы не извлечены; метаданные взяты только из реестра",
    "W_JUNK": "отфильтровано %d полностраничных ложных детекций (векторный мусор, bbox вне страницы)",
    "W_SMALL": "%d мелких/одностолбцовых детекций не сохранены как таблицы — их текст остался в прозе раздела",
    "W_NO_ID": "ID не извлечён из имени файла/титула",
    "W_NO_REGISTRY": "реестр недоступен — метаданные взяты из титульного листа PDF",
    "W_NOT_FOUND": "КР '%s' не найдена в реестре — метаданные из титульного листа PDF",
    "W_NO_TITLE": "название КР не извлечено",
    "W_NO_ICD": "коды МКБ не извлечены",
    "W_NO_SECTIONS": "не найдено ни одного раздела — проверьте структуру PDF / эвристики",
    "W_LOWCOV": "низкое покрытие (%s%%) — текст мог уйти в исключения или не распознались заголовки",
    "V1_NO_TITLE": "название КР не извлечено (эвристика не сработала)",
    "V1_NO_YEAR": "год утверждения не извлечён",
    "V1_NO_ICD": "коды МКБ-10 не извлечены",
    "V1_SMALL": "%d мелких/одностолбцовых детекций не сохранены как таблицы — их текст остался в прозе раздела/приложения",
    "V1_NO_SECTIONS": "не найдено ни одного раздела — проверьте структуру PDF / эвристики заголовков",
    "V1_UNATTACHED": "%d таблиц(ы) не привязаны — нет разделов",
    "V1_DROPPED": "%d таблиц(ы) вне разделов (оглавление/литература/приложения) — пропущены",
    "V1_LOWCOV": "низкое покрытие разделами (%s%%) — основной текст мог уйти в исключения или не распознались заголовки",
}
