import hashlib

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.llm import fill_middle as M
from palimpsest.llm.queries import QUERIES
from palimpsest.plans.check import compare, duck

from .helpers import SF, empty_documents, odd_documents


def plain_form(doc_id, text):
    """By slices, straight from the contract."""
    text = text or ""
    digest = hashlib.sha256(b"1:" + ("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>" + suf + "<P>" + pre + "<M>" + mid
    return n, "psm", a, b - a, "<P>" + pre + "<S>" + suf + "<M>" + mid


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=40), st.integers(0, 1 << 32), st.integers(0, 1 << 32), st.integers(2, 9))
def test_cuts_of_pieces_are_those_of_the_whole(text, a, b, piece):
    n = len(text)
    for unit in (M.CODE_POINT, r"(?s:..?)", r"\S+\s*|\s+"):
        units = regex.compile(f"({unit})*")
        assert M.cuts(text, units, a, b, piece) == M.cuts(text, units, a, b, 1000)
    assert M.cuts(text, regex.compile(f"({M.CODE_POINT})*"), a, b) == (n, *sorted((a % (n + 1), b % (n + 1))))


def test_a_text_of_other_units_is_plain():
    assert M.cuts("ab1", regex.compile("([a-z])*"), 1, 2) is None
    assert M.cuts("ab" * 40 + "1", regex.compile("([a-z])*"), 1, 2, 10) is None


def test_odd_rows_by_slices_and_back(spark):
    extra = spark.createDataFrame([(100, "has <S> in it"), (101, "<P"), (102, "<P>"), (103, "a<" * 50), (104, "é" * 500_000 + "\n" * 700_000)], "doc_id long, text string")
    docs = odd_documents(spark).withColumn("n", F.lit("clash")).unionByName(extra, allowMissingColumns=True)
    for piece in (7_000, M.PIECE):
        got = M.transform(docs, piece=piece).withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
        want = [(r["doc_id"], *plain_form(r["doc_id"], r["text"]), r["text"] or "") for r in docs.collect()]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert M.transform(empty_documents(spark)).count() == 0


def test_words_as_units(spark):
    docs = spark.createDataFrame([(i, "one two  three\nfour " * 3) for i in range(40)], "doc_id long, text string")
    rows = M.transform(docs, unit=r"\S+\s*").withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert {r["n"] for r in rows} == {12} and all(r["back"] == "one two  three\nfour " * 3 for r in rows)
    ends = {m.end() for m in regex.finditer(r"\S+\s*", "one two  three\nfour " * 3)} | {0}
    cut = [r for r in rows if r["form"] != "plain"]
    assert cut and all({r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= ends for r in cut)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_its_sql(spark, sf):
    fn, sql = QUERIES["op11_fill_in_middle"]
    assert compare(spark, duck(sf), "op11", fn, sql, sf)["status"] == "match"
