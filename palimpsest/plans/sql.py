"""DuckDB SQL snippets for the oracle: the same text rules and derived inputs as the
Spark side, written independently as SQL (see ``plans/fixtures.py``)."""

from __future__ import annotations

from ..functions import constants as K

NL = "chr(10)"
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def extract(x: str, start: str, end: str | None) -> str:
    s = f"strpos({x}, {q(start)})"
    p = f"({s} + {len(start)})"
    if end is None:
        return f"(CASE WHEN {s} = 0 THEN '' ELSE {strip(f'substr({x}, {p})')} END)"
    e = f"strpos(substr({x}, {p}), {q(end)})"
    return f"(CASE WHEN {s} = 0 OR {e} = 0 THEN '' ELSE {strip(f'substr({x}, {p}, {e} - 1)')} END)"


def bool_word(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 'True' ELSE 'False' END)"


def tagged_content(text: str, summary: str, date: str, printed: str, legible: str) -> str:
    return (f"('OCR Text: ' || {text} || {NL} || 'Summary: ' || {summary} || {NL} || 'Date: ' || {date} || {NL}"
            f" || 'Printed: ' || {bool_word(printed)} || {NL} || 'Legible: ' || {bool_word(legible)})")


def parsed(x: str) -> dict[str, str]:
    return {
        "ocr_text": extract(x, K.MARKER_OCR, K.MARKER_SUMMARY),
        "summary": extract(x, K.MARKER_SUMMARY, K.MARKER_DATE),
        "date": extract(x, K.MARKER_DATE, K.MARKER_PRINTED),
        "printed": f"contains({extract(x, K.MARKER_PRINTED, K.MARKER_LEGIBLE)}, 'True')",
        "legible": f"contains({extract(x, K.MARKER_LEGIBLE, None)}, 'True')",
    }


def escape_newlines(x: str) -> str:
    return strip(f"replace({x}, {NL}, '\\n')")


# ------------------------------------------------------------------ derived inputs

CTE = {}

CTE["gold"] = "SELECT 'd' || doc_id AS id, text AS gold, lang FROM documents"

CTE["tagged"] = (
    "SELECT 'd' || d.doc_id || '.jpg.txt' AS name, "
    + tagged_content("d.text", "d.source", q(K.DEFAULT_DATE), "l.quality = 1", "l.toxic = 0")
    + " AS content FROM documents d JOIN labels l USING (doc_id)"
)

_p = parsed("content")
CTE["tagged_parsed"] = (
    f"SELECT name, content, {_p['ocr_text']} AS ocr_text, {_p['summary']} AS summary, {_p['date']} AS date, "
    f"{_p['printed']} AS printed, {_p['legible']} AS legible FROM tagged"
)

CTE["silver"] = (
    f"SELECT replace(name, '.txt', '') AS ID, {escape_newlines('ocr_text')} AS ocr FROM tagged_parsed "
    f"WHERE printed AND legible AND ocr_text <> ''"
)

CTE["engine"] = (
    "SELECT 'd' || doc_id || '.txt.pyte' AS name, translate(text, 'ilo', '110') AS content "
    "FROM documents WHERE lang <> 'de'"
)

CTE["training"] = (
    "SELECT g.id, g.gold, s.ocr AS silver, coalesce(e.content, '') AS pyte "
    "FROM gold g JOIN silver s ON g.id = replace(s.ID, '.jpg', '') "
    "LEFT JOIN engine e ON g.id = replace(e.name, '.txt.pyte', '') "
    "WHERE g.gold <> '' AND s.ocr <> '' AND coalesce(e.content, '') <> ''"
)

CTE["listing"] = "SELECT 'd' || page_id || '.jpg' AS name FROM pages"

DEPENDS = {
    "tagged_parsed": ["tagged"],
    "silver": ["tagged", "tagged_parsed"],
    "training": ["gold", "tagged", "tagged_parsed", "silver", "engine"],
}


def with_ctes(names: list[str], body: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, in dependency order."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in order) + "\n" + body


# ------------------------------------------------------------------ responses


def answer_text(text: str, source: str, lang: str, quality: str, toxic: str) -> str:
    esc = f"replace(replace({text}, '\"', '\\\"'), {NL}, '\\n')"
    sep = f"(CASE WHEN {lang} = 'es' THEN ':' ELSE ': ' END)"
    printed = f"(CASE WHEN {quality} = 1 THEN 'true' ELSE 'false' END)"
    legible = f"(CASE WHEN {toxic} = 0 THEN 'true' ELSE 'false' END)"
    body = (f"('{{' || {NL} || '  \"ocr_text\"' || {sep} || '\"' || {esc} || '\",' || {NL} || '  \"summary\"' || {sep}"
            f" || '\"' || {source} || '\",' || {NL} || '  \"date\"' || {sep} || '\"1919-05-01\",' || {NL}"
            f" || '  \"is_printed\"' || {sep} || {printed} || ',' || {NL} || '  \"is_legible\"' || {sep} || {legible}"
            f" || {NL} || '}}')")
    return f"(CASE WHEN {lang} = 'fr' THEN '```json' || {NL} || {body} || {NL} || '```' ELSE {body} END)"


def path_to_key(x: str) -> str:
    return f"replace(replace({x}, '/', '|'), '\\', '|')"


CTE["responses"] = (
    "SELECT d.doc_id AS line_no, "
    + path_to_key("d.lang || '/' || d.source || '/' || substr(md5(d.text), 1, 12) || '.jpg'")
    + " AS custom_id, d.lang <> 'de' AS has_choices, CASE WHEN d.lang <> 'de' THEN "
    + answer_text("d.text", "d.source", "d.lang", "l.quality", "l.toxic")
    + " END AS content FROM documents d LEFT JOIN labels l USING (doc_id)"
)


def strip_fence(x: str) -> str:
    return (f"(CASE WHEN starts_with({x}, '```json') AND ends_with({x}, '```') "
            f"THEN {strip(f'substr({x}, 8, length({x}) - 10)')} ELSE {x} END)")


def answer_field(x: str, name: str) -> str:
    return f"regexp_extract({x}, {q(K.ANSWER_PATTERNS[name])}, 1)"


CTE["last_answers"] = (
    "SELECT custom_id, max(line_no) AS line_no, arg_max(content, line_no) AS content, "
    "arg_max(has_choices, line_no) AS has_choices FROM responses GROUP BY custom_id"
)

_s = strip_fence("content")
CTE["answer_fields"] = (
    "SELECT custom_id, line_no, has_choices, "
    f"CASE WHEN has_choices THEN {answer_field(_s, 'ocr_text')} END AS ocr_text, "
    f"CASE WHEN has_choices THEN {answer_field(_s, 'summary')} END AS summary, "
    f"CASE WHEN has_choices THEN coalesce(nullif({answer_field(_s, 'date')}, ''), {q(K.DEFAULT_DATE)}) END AS date, "
    f"CASE WHEN has_choices THEN {answer_field(_s, 'is_printed')} = 'true' END AS is_printed, "
    f"CASE WHEN has_choices THEN {answer_field(_s, 'is_legible')} = 'true' END AS is_legible, "
    f"CASE WHEN has_choices THEN (CASE WHEN json_valid({_s}) THEN {q(K.METHOD_JSON)} ELSE {q(K.METHOD_REGEX)} END) END"
    " AS method, replace(custom_id, '|', '/') || '.txt' AS sidecar_path FROM last_answers"
)

DEPENDS["last_answers"] = ["responses"]
DEPENDS["answer_fields"] = ["responses", "last_answers"]

_BR = r"\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}"
FIVE_LINES_RE2 = rf"(?s)^((?:[^{_BR}]*(?:\r\n|[{_BR}])){{5}})(.*)$"


def clean_fenced(x: str) -> str:
    """O-63 in DuckDB terms (string lists instead of look-behind)."""
    fl = f"split_part({x}, {NL}, 1)"
    c1 = f"(CASE WHEN {strip(fl)} = '```json' THEN substr({x}, length({fl}) + 2) ELSE {x} END)"
    lst = f"string_split({c1}, {NL})"
    last = (f"(CASE WHEN ends_with({c1}, {NL}) THEN {lst}[len({lst}) - 1] || {NL} "
            f"ELSE {lst}[len({lst})] END)")
    c2 = f"(CASE WHEN {strip(last)} = '```' THEN substr({c1}, 1, length({c1}) - length({last})) ELSE {c1} END)"
    c3 = f"(CASE WHEN strpos({c2}, '{{') = 0 THEN NULL ELSE substr({c2}, strpos({c2}, '{{')) END)"
    p = q(FIVE_LINES_RE2)
    return (f"(CASE WHEN regexp_matches({c3}, {p}) THEN replace(regexp_extract({c3}, {p}, 1), '\\', '|') "
            f"|| regexp_extract({c3}, {p}, 2) ELSE replace({c3}, '\\', '|') END)")


# ------------------------------------------------------------------ generation stubs


def stub_output(prompt: str, arm: str) -> str:
    """SQL mirror of ``generate.stub_factory`` (before the blank guard)."""
    base = f"translate({prompt}, 'aeiou', 'AEIOU')"
    tuned = f"(CASE WHEN {arm} = 'untuned' OR length({prompt}) % 3 = 0 THEN {base} ELSE {base} || ' [' || {arm} || ']' END)"
    return f"(CASE WHEN length({prompt}) % 11 = 0 THEN '' ELSE {tuned} END)"


def parts_cte(max_tokens: int) -> str:
    return f"""w AS (SELECT doc_id, text, {words('text')} AS ws FROM documents),
n AS (SELECT *, len(ws) AS n FROM w),
parts AS (
  SELECT doc_id, 0 AS part, text AS part_text, 1 AS n_parts FROM n WHERE n <= {max_tokens}
  UNION ALL
  SELECT doc_id, i::INT AS part, array_to_string(ws[i * {max_tokens} + 1 : (i + 1) * {max_tokens}], ' ') AS part_text,
         ceil(n / {max_tokens})::INT AS n_parts
  FROM (SELECT *, unnest(range(0, ceil(n / {max_tokens})::BIGINT)) AS i FROM n WHERE n > {max_tokens}))"""


# ------------------------------------------------------------------ conversations


def token_ids(toks: str) -> str:
    return f"list_transform({toks}, lambda t: ((('0x' || substr(md5(t), 1, 6))::BIGINT % 50000) + 4)::INT)"


def repeat_list(value: str, n: str) -> str:
    return f"list_transform(range(greatest({n}, 0)), lambda _x: {value})"


def signal_role(f: str) -> str:
    return f"(CASE lower({f}) WHEN 'human' THEN 'Human' WHEN 'gpt' THEN 'Assistant' ELSE 'unknown' END)"


def signal_sentence(x: str) -> str:
    return f"('### ' || {signal_role(x + chr(91) + chr(39) + 'from' + chr(39) + chr(93))} || ': ' || {x}['value'] || {NL})"


CTE["turns"] = ("SELECT conv_id, turn, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END"
                " AS \"from\", text AS value FROM conversations")
CTE["convs"] = ("SELECT conv_id, list({'turn': turn, 'from': \"from\", 'value': value} ORDER BY turn) AS turns "
                "FROM turns GROUP BY conv_id")
CTE["prepared"] = """SELECT conv_id, turns, turns[1]['from'] <> 'human' AS leading_dropped,
  CASE WHEN turns[1]['from'] = 'system' THEN turns[1]['value'] END AS system,
  CASE WHEN turns[1]['from'] <> 'human' THEN turns[2:] ELSE turns END AS dialog FROM convs"""
CTE["checked"] = """SELECT *, CASE WHEN len(dialog) = 0 THEN 'empty'
  WHEN len(list_filter(dialog, lambda x: x['from'] NOT IN ('human', 'gpt'))) > 0 THEN 'bad_role'
  WHEN NOT coalesce(list_bool_and(list_transform(dialog, lambda x, i: x['from'] =
       CASE WHEN (i - 1) % 2 = 0 THEN 'human' ELSE 'gpt' END)), true) THEN 'bad_alternation'
  ELSE 'ok' END AS status FROM prepared"""
DEPENDS["convs"] = ["turns"]
DEPENDS["prepared"] = ["turns", "convs"]
DEPENDS["checked"] = ["turns", "convs", "prepared"]

SFT_DEFAULT_SYSTEM = "A chat between a curious human and an artificial intelligence assistant."


def signal_header(system: str) -> str:
    return f"(coalesce({system}, {q(SFT_DEFAULT_SYSTEM)}) || {NL} || {NL})"


def render_signal(dialog: str, system: str) -> str:
    return (f"({signal_header(system)} || array_to_string(list_transform({dialog}, lambda x: "
            f"{signal_sentence('x')}), '') || '### ')")


def label_mask_ids(dialog: str, system: str, max_len: int) -> tuple[str, str]:
    head = token_ids(words(signal_header(system)))
    per = f"list_transform({dialog}, lambda x: {{'f': x['from'], 'ids': {token_ids(words(signal_sentence('x')))}}})"
    closing = token_ids(words("'### '"))
    ids = f"list_concat(list_concat({head}, flatten(list_transform({per}, lambda p: p['ids']))), {closing})"
    masked = (f"list_transform({per}, lambda p: CASE WHEN p['f'] = 'human' THEN "
              f"list_concat(p['ids'][1:2], {repeat_list('-100', 'len(p[' + chr(39) + 'ids' + chr(39) + ']) - 2')}) "
              f"ELSE p['ids'] END)")
    labels = f"list_concat(list_concat({repeat_list('-100', 'len(' + head + ')')}, flatten({masked})), {closing})"
    return f"({ids})[1:{max_len}]", f"({labels})[1:{max_len}]"


def template_prompt(dialog: str, system: str) -> str:
    return (f"(coalesce({system}, {q(SFT_DEFAULT_SYSTEM)}) || ' ' || array_to_string(list_transform({dialog}, "
            "lambda x, i: CASE WHEN x['value'] IS NULL OR x['value'] = '' "
            "THEN (CASE x['from'] WHEN 'human' THEN 'USER' ELSE 'ASSISTANT' END) || ':' "
            "ELSE (CASE x['from'] WHEN 'human' THEN 'USER' ELSE 'ASSISTANT' END) || ': ' || x['value'] || "
            "CASE WHEN (i - 1) % 2 = 0 THEN ' ' ELSE '</s>' END END), ''))")


def template_tokens(x: str) -> str:
    return words(f"replace({x}, '</s>', ' </s> ')")


def rounds_prompt(dialog: str, system: str) -> str:
    return (f"('<|im_start|>system' || {NL} || coalesce({system}, {q(SFT_DEFAULT_SYSTEM)}) || '<|im_end|>' || array_to_string(list_transform({dialog}, "
            f"lambda x: CASE x['from'] WHEN 'human' THEN '<|im_start|>user' ELSE '<|im_start|>assistant' END || {NL} || "
            "CASE WHEN x['value'] IS NULL OR x['value'] = '' THEN '' ELSE x['value'] || '<|im_end|>' END), ''))")


def rounds_tokens(x: str) -> str:
    return words(f"replace({x}, '<|im_end|>', ' <|im_end|> ')")
