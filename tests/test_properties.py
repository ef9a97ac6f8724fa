"""Property tests: the text rules equal their Python definitions on random strings."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from palimpsest.functions import text as X

# alphabet with every whitespace / line-break kind, markers' letters and JSON punctuation
ALPHABET = st.sampled_from(list(X.PY_WHITESPACE) + list("abcOCRTextSummaryDate:{}\\\"`json é") + ["\r\n"])
TEXT = st.lists(ALPHABET, max_size=40).map("".join)
# a field's text, and a line: without markers, line ends or braces of their own
FIELD = st.text(alphabet="abc xyz\n\t0", max_size=15)
LINE = st.text(alphabet="ab \\\\\"'0", max_size=10)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "c string")


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_strip_and_split(spark, vals):
    got = frame(spark, vals).select(X.pystrip("c").alias("s"), X.words("c").alias("w")).collect()
    assert [r.s for r in got] == [v.strip() for v in vals]
    assert [list(r.w) for r in got] == [v.split() for v in vals]


@SETTINGS
@given(st.lists(st.tuples(FIELD, FIELD, FIELD, FIELD, FIELD, st.booleans()), min_size=1, max_size=30))
def test_fields_come_back_stripped(spark, rows):
    vals = [f"{pre}OCR Text:{o}Summary:{m}Date:{d}Printed: False Legible:{x}{'True' if yes else 'no'}" for pre, o, m, d, x, yes in rows]
    got = frame(spark, vals).select(X.parse_tagged("c").alias("p")).collect()
    assert [(r.p.ocr_text, r.p.summary, r.p.date, r.p.printed, r.p.legible) for r in got] == [
        (o.strip(), m.strip(), d.strip(), False, yes) for _, o, m, d, _, yes in rows]


@SETTINGS
@given(st.lists(st.tuples(st.booleans(), FIELD, st.lists(LINE, min_size=1, max_size=8)), min_size=1, max_size=30))
def test_clean_fenced_takes_the_object_and_bars_five_lines(spark, rows):
    vals, want = [], []
    for fenced, pre, lines in rows:
        body = ["{" + lines[0], *lines[1:], "}"]
        vals.append(("```json\n" if fenced else "") + pre + "\n".join(body) + ("\n```" if fenced else ""))
        want.append("\n".join([x.replace("\\", "|") for x in body[:5]] + body[5:]) + ("\n" if fenced else ""))
    got = frame(spark, vals).select(X.clean_fenced_text("c").alias("c")).collect()
    assert [r.c for r in got] == want
