"""Text column expressions (O-51..O-58, O-61, O-63..O-65).

All functions build native Catalyst expressions; nothing here runs Python per row.
Arguments named ``c`` accept a Column or a column name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as K

# Line boundaries of Python's str.splitlines().
_LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
_NOT_BREAK = "[^\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The code points Python's str.isspace() accepts (29 of them), derived by rule: Unicode
# White_Space plus the information separators 0x1c..0x1f.
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WS_CLASS = "[" + "".join(f"\\u{ord(ch):04x}" for ch in PY_WHITESPACE) + "]"


def pystrip(c) -> Column:
    """Python ``str.strip()`` as a column expression (``btrim`` over the 29 Python
    whitespace code points: no regex)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def words(c) -> Column:
    """Python ``str.split()`` (no argument) as an array column: every Python whitespace
    character mapped to a space (``translate``), split on the space, empties dropped.
    (3.7x faster than a regex split on the whitespace class.)"""
    spaced = F.translate(_col(c), PY_WHITESPACE, " " * len(PY_WHITESPACE))
    return F.filter(F.split(spaced, " "), lambda x: x != "")


def word_count(c) -> Column:
    return F.size(words(c))


def is_blank(c) -> Column:
    """Null, or empty after Python strip."""
    c = _col(c)
    return c.isNull() | (pystrip(c) == "")


# ---------------------------------------------------------------- O-51 / O-52

def extract_field(c, start: str, end: str | None) -> Column:
    """Text between the first ``start`` marker and the next ``end`` marker, stripped.

    Empty string when ``start`` is missing, or when ``end`` is given and absent
    after ``start``. With ``end=None`` the field runs to the end of the text.
    """
    c = _col(c)
    s = F.locate(start, c)
    p = s + F.lit(len(start))
    if end is None:
        return F.when(s == 0, F.lit("")).otherwise(pystrip(c.substr(p, F.lit(_MAX_LEN))))
    # first end marker anywhere; only if it lies before the field start, search the tail
    e_any = F.locate(end, c)
    e = F.when((e_any == 0) | (e_any >= p), e_any).otherwise(_locate_from(end, c, p))
    return F.when((s == 0) | (e == 0), F.lit("")).otherwise(pystrip(c.substr(p, e - p)))


_MAX_LEN = 2**31 - 1


def _locate_from(needle: str, c: Column, pos: Column) -> Column:
    """1-based position of ``needle`` in ``c`` at or after 1-based ``pos`` (0 if none)."""
    rel = F.instr(c.substr(pos, F.lit(_MAX_LEN)), needle)
    return F.when(rel == 0, F.lit(0)).otherwise(rel + pos - 1)


def parse_tagged_fields(c) -> dict[str, Column]:
    """The five fields of :func:`parse_tagged` as separate columns (projecting them as
    columns lets Catalyst evaluate each field once when several expressions use it)."""
    c = _col(c)
    return {
        "ocr_text": extract_field(c, K.MARKER_OCR, K.MARKER_SUMMARY),
        "summary": extract_field(c, K.MARKER_SUMMARY, K.MARKER_DATE),
        "date": extract_field(c, K.MARKER_DATE, K.MARKER_PRINTED),
        "printed": extract_field(c, K.MARKER_PRINTED, K.MARKER_LEGIBLE).contains(K.TRUE_WORD),
        "legible": extract_field(c, K.MARKER_LEGIBLE, None).contains(K.TRUE_WORD),
    }


def parse_tagged(c) -> Column:
    """Five fields of a tagged sidecar as a struct (O-52).

    ``printed`` / ``legible`` are substring tests for ``True``; ``legible`` runs to
    the end of the text, so any later ``True`` counts.
    """
    c = _col(c)
    return F.struct(
        extract_field(c, K.MARKER_OCR, K.MARKER_SUMMARY).alias("ocr_text"),
        extract_field(c, K.MARKER_SUMMARY, K.MARKER_DATE).alias("summary"),
        extract_field(c, K.MARKER_DATE, K.MARKER_PRINTED).alias("date"),
        extract_field(c, K.MARKER_PRINTED, K.MARKER_LEGIBLE).contains(K.TRUE_WORD).alias("printed"),
        extract_field(c, K.MARKER_LEGIBLE, None).contains(K.TRUE_WORD).alias("legible"),
    )


def bool_word(c) -> Column:
    """Boolean as Python prints it: ``True`` / ``False``."""
    return F.when(_col(c), F.lit(K.TRUE_WORD)).otherwise(F.lit(K.FALSE_WORD))


def format_tagged(ocr_text, summary, date, printed, legible) -> Column:
    """Inverse of :func:`parse_tagged`: five labelled lines (O-53)."""
    return F.concat(
        F.lit(K.MARKER_OCR + " "), _col(ocr_text), F.lit("\n"),
        F.lit(K.MARKER_SUMMARY + " "), _col(summary), F.lit("\n"),
        F.lit(K.MARKER_DATE + " "), _col(date), F.lit("\n"),
        F.lit(K.MARKER_PRINTED + " "), bool_word(printed), F.lit("\n"),
        F.lit(K.MARKER_LEGIBLE + " "), bool_word(legible),
    )


def escape_newlines(c) -> Column:
    """Newline to backslash + n, then strip (O-54)."""
    return pystrip(F.replace(_col(c), F.lit("\n"), F.lit("\\n")))


# ---------------------------------------------------------------- O-55 / O-56

def doc_key(c, mode: str) -> Column:
    """Document key from a file name (O-55).

    modes: ``drop_txt`` removes every ``.txt``; ``drop_ext`` removes the last
    extension; ``drop_pyte`` removes every ``.txt.pyte``; ``drop_jpg`` removes every
    ``.jpg``; ``basename`` keeps the text up to the first period; ``pyte_name`` maps
    an image name to its engine sidecar name (``.jpg`` -> ``.txt.pyte``).
    """
    c = _col(c)
    if mode == "drop_txt":
        return F.replace(c, F.lit(".txt"), F.lit(""))
    if mode == "drop_ext":
        return F.regexp_replace(c, r"\.[^./]*$", "")
    if mode == "drop_pyte":
        return F.replace(c, F.lit(".txt.pyte"), F.lit(""))
    if mode == "drop_jpg":
        return F.replace(c, F.lit(".jpg"), F.lit(""))
    if mode == "basename":
        return F.substring_index(F.substring_index(c, "/", -1), ".", 1)
    if mode == "pyte_name":
        return F.replace(F.substring_index(c, "/", -1), F.lit(".jpg"), F.lit(".txt.pyte"))
    raise ValueError(f"unknown doc_key mode {mode!r}")


def path_to_key(c) -> Column:
    """Slash and backslash to ``|`` (O-56)."""
    return F.translate(_col(c), "/\\", "||")


def key_to_path(c) -> Column:
    """``|`` back to ``/`` (O-56)."""
    return F.translate(_col(c), "|", "/")


def key_to_sidecar(c) -> Column:
    """Struct of directory, file name and ``<name>.txt`` sidecar path for a key."""
    p = key_to_path(c)
    d = F.regexp_extract(p, r"^(.*)/[^/]*$", 1)
    name = F.substring_index(p, "/", -1)
    side = F.when(d == "", F.concat(name, F.lit(".txt"))).otherwise(F.concat(d, F.lit("/"), name, F.lit(".txt")))
    return F.struct(d.alias("dir"), name.alias("name"), side.alias("sidecar_path"))


# ---------------------------------------------------------------- O-57 / O-58

def mime_type(c) -> Column:
    """Lower-cased last extension; jpg/jpeg -> image/jpeg, else image/<ext>."""
    ext = F.lower(F.substring_index(_col(c), ".", -1))
    return F.when(ext.isin("jpg", "jpeg"), F.lit("image/jpeg")).otherwise(F.concat(F.lit("image/"), ext))


def b64_size(length) -> Column:
    """Length of the base64 text for ``length`` bytes: 4 * ceil(n / 3)."""
    n = _col(length).cast("long")
    return (F.lit(4) * ((n + F.lit(2)) / F.lit(3)).cast("long")).cast("long")


def base64_text(content) -> Column:
    """Unbroken base64 (Spark may insert CRLF every 76 characters)."""
    return F.regexp_replace(F.base64(_col(content)), "[\\r\\n]", "")


def data_url(content, mime) -> Column:
    return F.concat(F.lit("data:"), _col(mime), F.lit(";base64,"), base64_text(content))


# ---------------------------------------------------------------- O-61 / O-63

def strip_fence(c) -> Column:
    """Drop a json code fence only if it both opens and closes the text, then strip."""
    c = _col(c)
    fenced = c.startswith(K.JSON_FENCE_OPEN) & c.endswith(K.JSON_FENCE_CLOSE)
    inner = c.substr(F.lit(len(K.JSON_FENCE_OPEN) + 1), F.length(c) - len(K.JSON_FENCE_OPEN) - len(K.JSON_FENCE_CLOSE))
    return F.when(fenced, pystrip(inner)).otherwise(c)


_CF_STEPS = ("_cf_a", "_cf_last", "_cf_body", "_cf_fb", "_cf_lead", "_cf_out")


def _clean_step(name: str, c: Column, v: dict[str, Column], legacy: bool) -> Column:
    """One O-63 step; ``v`` maps earlier step names to columns (or expressions)."""
    esc = lambda x: F.replace(x, F.lit("\\"), F.lit("|"))
    if name == "_cf_a":
        first = F.substring_index(c, "\n", 1)
        return F.when(pystrip(first) == K.JSON_FENCE_OPEN,
                      c.substr(F.length(first) + 2, F.lit(_MAX_LEN))).otherwise(c)
    a = v.get("_cf_a")
    if name == "_cf_last":
        # last line in readlines() terms: after the last newline, or the line before a
        # final newline (with that newline)
        return F.when(a.endswith("\n"), F.concat(F.substring_index(a.substr(F.lit(1), F.length(a) - 1), "\n", -1),
                                                 F.lit("\n"))).otherwise(F.substring_index(a, "\n", -1))
    if name == "_cf_body":
        last = v["_cf_last"]
        return F.when(pystrip(last) == K.JSON_FENCE_CLOSE,
                      a.substr(F.lit(1), F.length(a) - F.length(last))).otherwise(a)
    if name == "_cf_fb":
        body = v["_cf_body"]
        brace = F.instr(body, "{")
        none = F.substring(body, -1, 1) if legacy else F.lit(None).cast("string")
        return F.when(brace == 0, none).otherwise(body.substr(brace, F.lit(_MAX_LEN)))
    fb = v["_cf_fb"]
    if name == "_cf_lead":
        # the first five lines with their line ends (empty when there are fewer than five)
        return F.regexp_extract(fb, rf"^((?:{_NOT_BREAK}*(?:{_LINE_BREAK})){{5}})", 1)
    lead = v["_cf_lead"]
    return F.when(F.length(lead) > 0, F.concat(esc(lead), fb.substr(F.length(lead) + 1, F.lit(_MAX_LEN)))
                  ).otherwise(esc(fb))


def clean_fenced(df: DataFrame, c: str, out: str, legacy: bool = False) -> DataFrame:
    """O-63 as projections: each intermediate text is a column computed once.

    1. drop the first line if it is exactly the json fence (after strip),
    2. drop the last line if it is exactly the closing fence,
    3. drop everything before the first ``{`` (none: null; ``legacy``: keep the last
       character, as a -1 slice does),
    4. backslash -> ``|`` within the first five lines (``splitlines`` boundaries).
    """
    cur = df
    cols = {n: F.col(n) for n in _CF_STEPS}
    for name in _CF_STEPS:
        cur = cur.withColumn(name, _clean_step(name, F.col(c), cols, legacy))
    return cur.withColumn(out, F.col("_cf_out")).drop(*_CF_STEPS)


def clean_fenced_text(c, legacy: bool = False) -> Column:
    """O-63 as one column expression (same steps as :func:`clean_fenced`; prefer that on
    large texts, since Spark does not share subexpressions across ``CASE`` branches)."""
    c = _col(c)
    env: dict[str, Column] = {}
    for name in _CF_STEPS:
        env[name] = _clean_step(name, c, env, legacy)
    return env["_cf_out"]


# ---------------------------------------------------------------- O-64 / O-65

def correction_prompt(c, template: str = K.CORRECTION_PROMPT) -> Column:
    """Prompt text from a template with one ``{text}`` slot; null input -> null."""
    before, _, after = template.partition("{text}")
    c = _col(c)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.concat(F.lit(before), c, F.lit(after)))


def blank_guard(output, has_input=None, has_image=None) -> Column:
    """Struct(output, status) for a generated text (O-65).

    status: ``no_input`` (input null -> output null), ``no_image`` (own error text),
    ``blank`` (empty after strip -> error text), else ``ok``.
    """
    out = _col(output)
    status = F.when(is_blank(out), F.lit("blank")).otherwise(F.lit("ok"))
    value = F.when(is_blank(out), F.lit(K.BLANK_ERROR)).otherwise(out)
    if has_image is not None:
        status = F.when(~_col(has_image), F.lit("no_image")).otherwise(status)
        value = F.when(~_col(has_image), F.lit(K.NO_IMAGE_ERROR)).otherwise(value)
    if has_input is not None:
        status = F.when(~_col(has_input), F.lit("no_input")).otherwise(status)
        value = F.when(~_col(has_input), F.lit(None).cast("string")).otherwise(value)
    return F.struct(value.alias("output"), status.alias("status"))
