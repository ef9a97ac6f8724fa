"""Folders listed and read by tasks: the driver's plans name no file of them, and rows are those of Spark's readers."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from palimpsest.sources import readers as RD


def put(base, **files):
    for name, body in files.items():
        path = os.path.join(base, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(body)
    return base


def many(base, n=120):
    return put(base, **{f"{k % 10}/{k}{s}": f"text {k}".encode() for k in range(n) for s in (".jpg", ".jpg.txt", ".txt.pyte")})


def held(df, base):
    """Files of the folder that the driver has in the plan."""
    return [p for p in df.inputFiles() if base in p]


def test_texts_are_listed_and_read_by_tasks(spark, scratch):
    folder = many(os.path.join(scratch, "many"))
    texts = RD.scan_text_sidecars(spark, folder, ".txt", recursive=True)
    assert held(texts, folder) == []
    assert {(r["name"], r["content"]) for r in texts.collect()} == {(f"{k}.jpg.txt", f"text {k}") for k in range(120)}


def test_texts_are_those_of_sparks_reader(spark, scratch):
    folder = put(scratch, **{"a b.txt": b"x", "p%20q.txt": b"p", "h#1.txt": b"h", "q?1.txt": b"q", "[z]{1}'.txt": b"z", "é ü.txt": "é".encode(),
                             "bad.txt": b"\xff\xfe", "bom.txt": b"\xef\xbb\xbfb", "crlf.txt": b"a\r\nb\n", "empty.txt": b"", "_h.txt": b"h", ".d.txt": b"d",
                             "_x=1.txt": b"e", "sub/s.txt": b"s", "sub/deep.txt/t.txt": b"t", "_hid/i.txt": b"i", "_metadata1/m.txt": b"m", "o.TXT": b"o"})
    for recursive in (True, False):
        plain = (spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", recursive).text(folder, wholetext=True)
                 .select("_metadata.file_name", "_metadata.file_path", F.hex("value")))
        got = RD.scan_text_sidecars(spark, folder, ".txt", recursive).select("name", "path", F.hex("content"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        RD.scan_text_sidecars(spark, os.path.join(scratch, "none"))
    one = RD.scan_text_sidecars(spark, os.path.join(scratch, "sub/s.txt"))
    assert [r["content"] for r in one.collect()] == ["s"]


def test_files_are_listed_by_tasks(spark, scratch):
    folder = many(os.path.join(scratch, "many"))
    listed = RD.scan_listing(spark, folder, recursive=True)
    assert held(listed, folder) == []
    assert {(r["name"], r["length"]) for r in listed.collect()} == {(f"{k}.jpg", len(f"text {k}")) for k in range(120)}


def test_listing_is_that_of_sparks_reader(spark, scratch):
    folder = put(scratch, **{"a b.jpg": b"x", "h#1.jpg": b"hh", "p%20q.jpg": b"p", "e.jpg": b"", "_h.jpg": b"h", ".d.jpg": b"d", "B.JPG": b"b",
                             "sub/k.jpg": b"k", "_hid/i.jpg": b"i", "other.txt": b"o", "sub.jpg/t.jpg": b"t"})
    cols = ["path", "length", "modificationTime"]
    for recursive in (True, False):
        for pattern, lower in (("*.jpg", False), ("*.[jJ][pP][gG]", True)):
            plain = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(folder).select(cols)
            got = RD.scan_listing(spark, folder, [".jpg"], lower, recursive).select(cols)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    pattern = RD.scan_listing(spark, os.path.join(scratch, "su*"), [".jpg"])
    assert sorted(r["name"] for r in pattern.collect()) == ["k.jpg", "t.jpg"]


def test_folders_of_a_partition_column_are_entered(spark, scratch):
    put(scratch, **{"k=1/a.jpg": b"a", "k=2/b.jpg": b"b"})
    assert sorted(r["name"] for r in RD.scan_listing(spark, scratch).collect()) == ["a.jpg", "b.jpg"]


def test_what_is_transcribed_is_not_sent_through_the_driver(spark, scratch):
    from palimpsest.operators import requests as RQ
    from palimpsest.plans import stubs

    folder = many(os.path.join(scratch, "many"))
    listing = RD.scan_listing(spark, folder, recursive=True).select(F.regexp_extract("name", r"^([0-9]+)\.jpg$", 1).alias("id"), "path")
    done = spark.range(100).select(F.col("id").cast("string").alias("id"))
    found = RQ.transcribe_paths(listing, done, stubs.stub_engine_factory)
    assert sorted((r["id"], r["error"]) for r in found.collect()) == [(str(k), "ValueError: unreadable image") for k in range(100, 120)]
    assert held(found, folder) == [] and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
