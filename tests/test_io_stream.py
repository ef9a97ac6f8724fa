"""Sources / sinks round trips in scratch folders and stream = batch checks."""

import os

import pytest

from pyspark.sql import functions as F

from palimpsest.functions import constants as K
from palimpsest.operators import results as RS
from palimpsest.operators import streaks as SK
from palimpsest.plans import fixtures as FX
from palimpsest.plans import queries as Q
from palimpsest.sinks import writers as W
from palimpsest.sources import readers as RD
from palimpsest.streaming import ingest as ST

from .conftest import SF


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_csv_roundtrip_multiline_quotes(spark, scratch):
    t = Q.training(spark, SF)
    out = os.path.join(scratch, "training_csv")
    W.write_csv(t, out)
    back = RD.scan_csv(spark, out, "id string, gold string, silver string, pyte string")
    assert rows(back, "id", "gold", "silver", "pyte") == rows(t, "id", "gold", "silver", "pyte")


def test_csv_null_tokens(spark, scratch):
    p = os.path.join(scratch, "m.csv")
    with open(p, "w") as f:
        f.write('Asset,Transcription\na,NA\nb,"two\nlines, ""quoted"""\nc,\n')
    raw = RD.scan_csv(spark, p, "Asset string, Transcription string")
    assert rows(raw, "Asset", "Transcription") == [("a", "NA"), ("b", 'two\nlines, "quoted"'), ("c", None)]
    norm = RD.scan_csv(spark, p, "Asset string, Transcription string", null_tokens=K.PANDAS_NULL_TOKENS)
    assert rows(norm, "Asset", "Transcription")[0] == ("a", None)


def test_sidecars_and_listing(spark, scratch):
    d = os.path.join(scratch, "images")
    os.makedirs(d)
    for name, body in [("a.jpg", "img"), ("a.jpg.txt", "OCR Text: x\nSummary: y"), ("b.txt.pyte", "engine b"),
                       ("c.JPG", "img"), ("notes.md", "-")]:
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    side = RD.scan_text_sidecars(spark, d, ".txt")
    assert rows(side, "name") == [("a.jpg.txt",)]
    pyte = RD.scan_text_sidecars(spark, d, ".txt.pyte")
    assert rows(pyte, "name", "content") == [("b.txt.pyte", "engine b")]
    listing = RD.scan_listing(spark, d)
    assert rows(listing, "name") == [("a.jpg",)]
    assert rows(RD.scan_listing(spark, d, lower=True), "name") == [("a.jpg",), ("c.JPG",)]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1][:200]


def test_splits_and_conversations_roundtrip(spark, scratch):
    from palimpsest.operators import ladder as L
    from palimpsest.operators import sft as SF_

    lad = Q.ladder(spark, SF).select("arm", "id", "target")
    sp = L.split_80_10_10(lad, "id", ["arm"])
    out = os.path.join(scratch, "splits")
    W.write_splits(sp, out)
    back = RD.scan_splits(spark, out, split="val", arm="gold_100")
    assert back.count() == 10
    docs = SF_.to_conversations(lad, "id", F.concat(F.col("id"), F.lit(".jpg")), "target").withColumn(
        "arm", F.lit("gold_100"))
    cout = os.path.join(scratch, "convs")
    W.write_conversations(docs, cout)
    assert RD.scan_conversation_lines(spark, cout + "/arm=gold_100").count() == docs.count()


def test_result_stream_equals_batch(spark, scratch):
    lines = FX.responses(spark, SF)
    src = os.path.join(scratch, "results")
    os.makedirs(src)
    pdf = lines.orderBy("line_no").toPandas()
    # two result files; the second one repeats keys, so later lines must win
    half = len(pdf) // 2
    for i, part in enumerate([pdf.iloc[:half], pdf.iloc[half:]]):
        with open(os.path.join(src, f"batch_{i}_output.jsonl"), "w") as f:
            f.write("\n".join(part["line"]) + "\nnot json\n")
    table = os.path.join(scratch, "ingested")
    q = ST.ingest_results_stream(spark, src, table, os.path.join(scratch, "ckpt"), max_files=1)
    q.awaitTermination()
    got = ST.current_results(spark, table)
    exp = RS.collect_results(lines)
    cols = ["custom_id", "ocr_text", "summary", "date", "is_printed", "is_legible", "has_choices"]
    assert rows(got, *cols) == rows(exp, *cols)
    assert spark.read.parquet(table + "_quarantine").count() == 2
    # restart from the checkpoint adds nothing
    q2 = ST.ingest_results_stream(spark, src, table, os.path.join(scratch, "ckpt"))
    q2.awaitTermination()
    assert spark.read.parquet(table + "/places").select("epoch").distinct().count() == 2
    plan = ST.current_rows(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan and "Aggregate" not in plan


def test_merged_epochs_rewrite_only_touched_buckets_and_may_run_again(spark, scratch):
    import json

    from palimpsest.sources.lines import numbered_lines

    def lines(name, keys):
        path = os.path.join(scratch, name)
        with open(path, "w") as f:
            for k, v in keys:
                f.write(json.dumps({"custom_id": k, "response": {"body": {"choices": [{"message": {"content": v}}]}}}) + "\n")
            f.write("broken\n")
        return numbered_lines(spark, path)

    table = os.path.join(scratch, "t")
    now = lambda: {r.custom_id: r.content for r in ST.current_rows(spark, table).collect()}
    assert ST.current_rows(spark, table).count() == 0
    ST.merge_results(spark, lines("a.jsonl", [(f"k{i}", "old") for i in range(50)] + [("k1", "later line")]), table, 0, buckets=8)
    first = {f"k{i}": "old" for i in range(50)} | {"k1": "later line"}
    assert now() == first
    for _ in range(2):  # the second time is a rerun
        ST.merge_results(spark, lines("b.jsonl", [("k2", "new"), ("fresh", "x")]), table, 1, buckets=8)
        assert now() == first | {"k2": "new", "fresh": "x"}
        assert len([d for d in os.listdir(table + "/data/epoch=1") if d.startswith("bucket=")]) <= 2
        assert spark.read.parquet(table + "_quarantine").count() == 2
    # a rerun that was stopped before its last step leaves the table as it was
    ST.RS.parse_result_lines(lines("c.jsonl", [("k3", "never")])).write.parquet(table + "/parsed/epoch=2")
    assert now() == first | {"k2": "new", "fresh": "x"}


def test_one_large_file_is_numbered_by_many_tasks(spark, scratch):
    from palimpsest.sources import lines as LN

    d = os.path.join(scratch, "large")
    os.makedirs(d)
    texts = [[f"{'x' * (i * 7 % 400)} line {i}" if i % 11 else "" for i in range(n)] for n in (5_000, 3, 1_200)]
    for k, t in enumerate(texts):
        with open(os.path.join(d, f"f{k}.jsonl"), "w") as f:
            f.write("\n".join(t) + ("\n" if k else ""))
    want = sorted((f"f{k}.jsonl", i, x) for k, t in enumerate(texts) for i, x in enumerate(t) if x)
    for size in ("20000", "7777", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = RD.scan_result_jsonl(spark, d)
            assert rows(got, "file", "line_no", "line") == want
            if size != "128m":
                assert got.rdd.getNumPartitions() > 20
            # the join taken with very many blocks gives the same
            sent, LN.BLOCKS_SENT = LN.BLOCKS_SENT, 0
            assert rows(RD.scan_result_jsonl(spark, d), "file", "line_no", "line") == want
            LN.BLOCKS_SENT = sent
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_file_that_changes_between_the_passes_stops_the_read(spark, scratch):
    path = os.path.join(scratch, "one.jsonl")
    with open(path, "w") as f:
        f.write("a\nb\n")
    got = RD.scan_result_jsonl(spark, scratch, suffix="one.jsonl")
    with open(path, "w") as f:
        f.write("a\nb\nc\nd\n")
    spark.catalog.refreshByPath(path)
    with pytest.raises(Exception, match="blocks changed"):
        got.collect()


def test_ledger_stream_equals_batch(spark, scratch):
    ev = FX.status_events(spark, SF).select("batch_id", "ts", "event_id", "status")
    src = os.path.join(scratch, "polls")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    out = ST.batch_ledger_stream(stream, retry_limit=1)
    q = out.writeStream.format("memory").queryName("ledger_out").outputMode("append").trigger(
        availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("SELECT batch_id, outcome, attempts, polls FROM ledger_out")
    exp = SK.batch_ledger(ev, retry_limit=1).filter("outcome <> 'pending'")
    assert rows(got, "batch_id", "outcome", "attempts", "polls") == rows(exp, "batch_id", "outcome", "attempts",
                                                                           "polls")


def test_result_jsonl_reader_line_numbers(spark, scratch):
    d = os.path.join(scratch, "res")
    os.makedirs(d)
    with open(os.path.join(d, "batch_x_output.jsonl"), "w") as f:
        f.write('{"custom_id": "k", "n": 1}\n\n{"custom_id": "k", "n": 2}\n{"custom_id": "j"}\n')
    with open(os.path.join(d, "other.jsonl"), "w") as f:
        f.write('{"custom_id": "z"}\n')
    got = RD.scan_result_jsonl(spark, d, batch_id="x")
    assert rows(got, "line_no") == [(0,), (2,), (3,)]
    last = RS.last_per_key(RS.parse_result_lines(got).select("custom_id", "line_no", "line"), "custom_id", "line_no")
    assert dict(rows(last, "custom_id", "line_no")) == {"k": 2, "j": 3}


def test_conversation_json_array_reader(spark, scratch):
    import json

    p = os.path.join(scratch, "convs.json")
    docs = [{"id": "d1", "image": "d1.jpg", "conversations": [{"from": "human", "value": "q"},
                                                             {"from": "gpt", "value": "a"}]},
            {"id": "d2", "conversations": [{"from": "gpt", "value": "x"}]}]
    with open(p, "w") as f:
        json.dump(docs, f, indent=4)
    got = RD.scan_conversation_json(spark, p)
    assert rows(got, "id", "image") == [("d1", "d1.jpg"), ("d2", None)]


def test_first_arrival_dedupe_with_watermark(spark, scratch):
    src = os.path.join(scratch, "dedupe")
    os.makedirs(src)
    lines = [('{"custom_id": "a", "n": %d}' % i) for i in range(3)] + ['{"custom_id": "b"}']
    with open(os.path.join(src, "batch_1.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")
    parsed = ST._parsed_stream(spark, src, None).withColumn("ts", F.current_timestamp())
    out = ST.dedupe_first_arrival(parsed, "ts").select("custom_id")
    q = out.writeStream.format("memory").queryName("dedupe_out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.custom_id for r in spark.sql("SELECT * FROM dedupe_out").collect()) == ["a", "b"]


def test_path_based_transcription_and_requests(spark, scratch):
    import json

    from palimpsest.operators import packing as PK
    from palimpsest.operators import requests as RQ
    from palimpsest.plans import stubs

    d = os.path.join(scratch, "imgs")
    os.makedirs(d)
    texts = {"a": "one two three", "b": "x", "c": "alpha beta gamma delta", "d": "done already here"}
    for k, t in texts.items():
        with open(os.path.join(d, f"{k}.jpg"), "wb") as f:
            f.write(t.encode())
    listing = RD.scan_listing(spark, d).withColumn("id", F.regexp_extract("name", r"^(.*)\.jpg$", 1))
    done = spark.createDataFrame([("d",)], "id string")
    got = {r.id: (r.text, r.error) for r in RQ.transcribe_paths(listing, done, stubs.stub_engine_factory).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"] == ("one two three".translate(str.maketrans("ilo", "110")), None)
    assert got["b"][0] is None and "unreadable" in got["b"][1]
    sized = listing.withColumn("size", F.expr("4 * ((length + 2) div 3)")).withColumn("shard", F.lit("s"))
    packed = PK.pack_batches(sized.select("name", "shard", "size"), ["name"], "size", budget=40, shard="shard")
    packed = packed.join(listing.select("name", "path"), "name")
    lines = RQ.request_lines_from_paths(packed, "  read it  ").collect()
    assert {r.name for r in lines} == {"a.jpg", "b.jpg", "c.jpg", "d.jpg"} - {r.name for r in packed.collect()
                                                                                if r.batch is None}
    for r in lines:
        j = json.loads(r.request)
        assert j["custom_id"] == r.name and j["body"]["messages"][0]["content"][0]["text"] == "read it"
        assert j["body"]["messages"][0]["content"][1]["image_url"]["url"].startswith("data:image/jpeg;base64,")


class _Flaky:
    """Fails a URL as many times as its last digit says, then returns bytes."""

    def __init__(self):
        self.tries = {}

    def __call__(self, url):
        n = self.tries.get(url, 0)
        self.tries[url] = n + 1
        return b"ok" if n >= int(url[-1]) else None


def _flaky_factory():
    return _Flaky()


def test_fetch_backoff_and_statuses(spark):
    from palimpsest.operators import requests as RQ

    waits = []
    manifest = spark.createDataFrame([("a", "u0"), ("b", "u2"), ("c", "u7"), ("d", "u0")], "key string, url string")
    present = spark.createDataFrame([("d",)], "key string")
    got = {r.key: (r.status, r.attempts, r.bytes) for r in RQ.fetch_manifest(
        manifest.coalesce(1), present, _flaky_factory, sleep=waits.append, threads=1).collect()}
    assert got == {"a": ("Downloaded", 1, 2), "b": ("Downloaded", 3, 2),
                   "c": ("Failed after max retries", 5, None), "d": ("Exists", 0, None)}


def test_fetch_backoff_sequence():
    from palimpsest.operators.requests import _fetch_rows

    import pandas as pd

    waits = []
    run = _fetch_rows(_flaky_factory, 5, waits.append, threads=1)
    out = list(run(iter([pd.DataFrame({"key": ["c"], "url": ["u9"]})])))[0]
    assert waits == [1, 2, 4, 8, 16] and out["attempts"].tolist() == [5]


def test_request_files_one_per_batch_and_quarantine(spark, scratch):
    from palimpsest.operators import assemble as A

    req = spark.createDataFrame([("0", '{"a":1}'), ("0", '{"a":2}'), ("1", '{"a":3}'), (None, '{"a":4}')],
                                "batch string, request string").repartition(3)
    out = os.path.join(scratch, "req")
    W.write_request_jsonl(req, out)
    files = {d: [f for f in os.listdir(os.path.join(out, d)) if f.endswith(".txt")]
             for d in os.listdir(out) if d.startswith("batch=")}
    assert sorted(files) == ["batch=0", "batch=1"] and all(len(v) == 1 for v in files.values())
    side = spark.createDataFrame([("x.jpg.txt", "OCR Text: a\nSummary: s\nDate: d\nPrinted: True\nLegible: True"),
                                  ("y.jpg.txt", None)],
                                 "name string, content string")
    good, bad = A.quarantine(A.parse_sidecars(side))
    qpath = os.path.join(scratch, "quarantine")
    W.write_quarantine(bad.select("name", "outcome"), qpath)
    assert rows(spark.read.parquet(qpath), "name", "outcome") == [("y.jpg.txt", "error")]
    assert rows(good, "name", "outcome") == [("x.jpg.txt", "written")]


def test_scratch_dir_is_absolute_under_file_uri_checkpoints(spark):
    from palimpsest.session import _local_path, scratch_dir

    assert _local_path("file:/tmp/ck/u1") == "/tmp/ck/u1"
    assert _local_path("file:///tmp/ck/u1") == "/tmp/ck/u1"
    assert _local_path("hdfs://nn/ck") is None and _local_path("s3a://b/ck") is None
    d = scratch_dir(spark, "probe")
    assert os.path.isabs(d) and os.path.isdir(d)
