"""Global row numbers on one exchange, reports that read their inputs once, listings by pattern."""

import itertools
import os

from pyspark.sql import functions as F

from palimpsest.operators import assemble as A
from palimpsest.operators import ordered as O
from palimpsest.sources import readers as RD


def test_global_row_number(spark):
    keys = [None, "a", "a", "b"] + ["hot"] * 500 + [f"k{i:03}" for i in range(300)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int").repartition(7)
    want = sorted(((k, i) for i, k in enumerate(keys)), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    for blocks in (1, 3, 40):
        got = O.row_number(df, ["k", "i"], name="rn", totals=True, blocks=blocks)
        assert got.columns == ["k", "i", "rn", "rn_total"]
        assert [(r["k"], r["i"]) for r in got.orderBy("rn").collect()] == want
        assert {r["rn_total"] for r in got.collect()} == {len(keys)}
        assert sorted(r["rn"] for r in got.collect()) == list(range(1, len(keys) + 1))
    down = O.row_number(df, [F.col("i").desc()]).filter("rn <= 2").orderBy("rn").collect()
    assert [r["i"] for r in down] == [len(keys) - 1, len(keys) - 2]
    assert O.row_number(df.limit(0), ["i"], totals=True).collect() == []


def test_global_row_number_moves_rows_once(spark):
    frame = O.sorted_blocks(spark.range(1000).withColumn("text", F.lit("x")), ["id"], 8)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_attrition_equals_the_joins_with_null_and_repeated_keys(spark):
    ids, texts = [None, "a", "a", "b", "c", "d", "e"], ["x", "", None]
    gold = spark.createDataFrame(list(itertools.product(ids, texts[:2])) + [("z", None)], "Asset string, Transcription string")
    silver = spark.createDataFrame([(None, "s"), ("a.jpg", "s"), ("a.jpg", ""), ("a.jpg", None), ("b.jpg", None), ("c.jpg", "s"), ("q.jpg", "s"), ("e.jpg", "")],
                                   "ID string, ocr string")
    engine = spark.createDataFrame([(f"{i}.txt.pyte", t) for i in ("a", "b", "c", "e") for t in texts] + [(None, "x"), ("a.txt.pyte", "y")],
                                   "name string, content string")
    for checked in (False, True):
        some = silver.filter("ocr <> ''") if checked else silver
        got = A.attrition_report(gold, some, engine, silver_checked=checked).collect()[0]
        left = A.join_gold_silver(A.project_rename(gold, {"Asset": "id", "Transcription": "gold"}), some)
        assert got["gold_rows"] == gold.count() and got["silver_rows"] == some.count()
        assert got["merged_rows"] == left.filter("silver is not null").count()
        assert got["dropped_failed_merge"] == left.filter("silver is null").count()
        assert got["final_rows"] == A.training_table(gold, some, engine, silver_checked=checked).count() > 0
        assert got["duplicate_gold_keys"] == gold.groupBy("Asset").count().filter("count > 1").count()
    assert set(A.attrition_report(gold.limit(0), silver.limit(0), engine.limit(0)).collect()[0]) == {0}


def test_reports_read_their_table_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(f"d{i:02}", None if i % 3 == 0 else "" if i % 3 == 1 else "t", "c" if i else "", i % 2 == 0, i % 5 == 0) for i in range(20)]
    kind = "id string, pyte_ocr string, chatgpt_ocr string, _miss_pyte boolean, _miss_chatgpt boolean"
    testing = spark.createDataFrame(rows, kind).mapInArrow(count, kind)
    missing = A.missing_report(testing, k=3).collect()[0].asDict()
    assert seen.value == 20
    assert missing == {"missing_total": 14, "missing_pyte": 10, "missing_chatgpt": 4, "examples": "d00,d00,d02"}
    blank = {r["column"]: (r["n_blank"], r["examples"]) for r in A.blank_report(testing, k=2).collect()}
    assert seen.value == 40
    assert blank == {"pyte_ocr": (14, "d00,d01"), "chatgpt_ocr": (1, "d00")}
    whole = {r["column"]: (r["n_blank"], r["examples"]) for r in A.blank_report(testing.filter("id = 'd02'")).collect()}
    assert whole == {"pyte_ocr": (0, ""), "chatgpt_ocr": (0, "")}


def test_listing_by_pattern(spark, scratch):
    folder = os.path.join(scratch, "listing")
    os.makedirs(folder)
    for name in ("a.jpg", "b.JpG", "c.png", "d.p[n]g", "e.txt", "f.jpg.txt"):
        with open(os.path.join(folder, name), "w") as f:
            f.write("img")

    def names(*suffixes, lower=False):
        return sorted(r["name"] for r in RD.scan_listing(spark, folder, suffixes, lower).collect())

    assert names(".jpg", ".png") == ["a.jpg", "c.png"] and names(".jpg", lower=True) == ["a.jpg", "b.JpG"]
    assert names(".p[n]g") == ["d.p[n]g"] and names(".gif") == [] and names() == []


def test_small_files_are_few_tasks(spark, scratch):
    for k in range(400):
        os.makedirs(os.path.join(scratch, "many", str(k % 40)), exist_ok=True)
        for suffix in (".jpg", ".jpg.txt"):
            with open(os.path.join(scratch, "many", str(k % 40), f"{k}{suffix}"), "w") as f:
                f.write(f"text {k}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a split for each file
    try:
        listed = RD.scan_listing(spark, os.path.join(scratch, "many"), recursive=True)
        texts = RD.scan_text_sidecars(spark, os.path.join(scratch, "many"), recursive=True)
        most = 4 * spark.sparkContext.defaultParallelism
        assert all(df.rdd.getNumPartitions() <= most < 400 for df in (listed, texts))
        assert {(r["name"], r["length"]) for r in listed.collect()} == {(f"{k}.jpg", len(f"text {k}")) for k in range(400)}
        assert sorted(r["content"] for r in texts.collect()) == sorted(f"text {k}" for k in range(400))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_folders_are_made_once(monkeypatch):
    import io

    from palimpsest.sources import files

    class Store:
        made, there = [], set()

        def create_dir(self, path, recursive):
            self.made.append(path)
            self.there.add(path)

        def open_output_stream(self, path):
            if path.rsplit("/", 1)[0] not in self.there:
                raise FileNotFoundError(path)
            return io.BytesIO()

    store = Store()
    monkeypatch.setattr(files, "_place", lambda path: (store, path))
    for k in range(10):
        files.write_bytes(f"/a/b/{k}", b"x")
    assert store.made == ["/a/b"]


def test_pending_images_are_dealt_out(spark, scratch):
    from palimpsest.operators import requests as RQ
    from palimpsest.plans import stubs

    listing = spark.createDataFrame([(f"i{k}", os.path.join(scratch, f"i{k}")) for k in range(200)], "id string, path string")
    done = spark.createDataFrame([("i0",)], "id string")
    found = RQ.transcribe_paths(listing, done, stubs.stub_engine_factory, reader=lambda path: b"one two three")
    assert found.rdd.getNumPartitions() >= 8 and found.count() == 199
