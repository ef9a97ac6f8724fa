"""Polls in any order of arrival give the outcome that their order of time gives."""

import os
import random
from datetime import datetime, timedelta

from palimpsest.operators import streaks as SK
from palimpsest.streaming import ledger as LG

KIND = "batch_id string, ts timestamp, event_id long, status string"
START = datetime(2024, 1, 1)


def _run(spark, folder, slices, delay, **options):
    """The stream's outcomes, a slice a micro-batch; a second call goes on from the first one's checkpoint."""
    out = os.path.join(folder, "out")
    for rows in slices:
        spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(os.path.join(folder, "polls"))
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "polls"))
    found = LG.batch_ledger_in_time(stream, delay, **options)
    with LG.timers_store(spark):
        q = (found.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(folder, "at"))
             .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(((r["batch_id"], r["outcome"], r["attempts"], r["polls"]) for r in spark.read.schema(found.schema).parquet(out).collect()),
                  key=str)


def _polls(n, batches, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one batch holds a third of all polls; times tie within and between batches
        batch = "hot" if i % 3 == 0 else None if i % 20 == 1 else f"b{rng.randrange(batches)}"
        rows.append((batch, START + timedelta(minutes=rng.randrange(n // 2)), i, rng.choice(["in_progress"] * 6 + ["completed", "failed", None])))
    return rows


def test_shuffled_arrival_gives_the_batch_answer(spark, scratch):
    rows = _polls(600, 40, 3)
    random.Random(4).shuffle(rows)
    batch = SK.batch_ledger(spark.createDataFrame([("?" if b is None else b, t, i, s or "none") for b, t, i, s in rows], KIND), retry_limit=3)
    want = sorted(((None if r["batch_id"] == "?" else r["batch_id"], r["outcome"], r["attempts"], r["polls"])
                   for r in batch.filter("outcome <> 'pending'").collect()), key=str)
    closing = [("closing", START + timedelta(days=9), -1, "in_progress")]
    first = _run(spark, scratch, [rows[:200], rows[200:400]], "2 days", retry_limit=3)
    assert first == []  # no watermark has passed anything yet
    assert _run(spark, scratch, [rows[400:] + [(None, None, 1, "failed"), ("hot", START, None, "failed")], closing], "2 days", retry_limit=3) == want
    # what comes after the end changes nothing
    assert _run(spark, scratch, [[("hot", START + timedelta(days=20), 9_999, "failed")]], "2 days", retry_limit=3) == want


def test_ended_batches_are_forgotten_after_their_time(spark, scratch):
    def at(day, event, batch="a", status="failed"):
        return [(batch, START + timedelta(days=day), event, status)]

    slices = [at(0, 1), at(3, 2, "x", None), at(4, 3), at(30, 4, "x", None), at(40, 5, "x", None), at(41, 6), at(60, 7, "x", None)]
    found = _run(spark, scratch, slices, "1 day", retry_limit=50, forget_after_ms=10 * 86_400_000)
    # the poll of day 4 finds the batch ended, the one of day 41 a new batch
    assert found == [("a", "failed", 0, 1), ("a", "failed", 0, 1)]


def test_a_state_for_a_bucket_of_batches(spark, scratch):
    rows = _polls(900, 200, 5)
    random.Random(6).shuffle(rows)
    closing = [("closing", START + timedelta(days=9), -1, "in_progress")]
    for some in (rows[:300], rows[300:600], rows[600:], closing):
        spark.createDataFrame(some, KIND).coalesce(1).write.mode("append").parquet(os.path.join(scratch, "polls"))
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(os.path.join(scratch, "polls"))
    with LG.timers_store(spark):
        q = (LG.batch_ledger_in_time(stream, "2 days", retry_limit=2, buckets=5).writeStream.format("parquet").option("path", os.path.join(scratch, "out"))
             .option("checkpointLocation", os.path.join(scratch, "at")).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert 0 < q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 5
    want = SK.batch_ledger(spark.createDataFrame([("?" if b is None else b, t, i, s or "none") for b, t, i, s in rows], KIND), retry_limit=2)
    want = sorted((r["batch_id"], r["outcome"], r["attempts"], r["polls"]) for r in want.filter("outcome <> 'pending'").collect())
    got = spark.read.schema(LG.LEDGER_OUT).parquet(os.path.join(scratch, "out")).collect()
    assert sorted((r["batch_id"] or "?", r["outcome"], r["attempts"], r["polls"]) for r in got) == want


def test_late_polls_are_dropped_and_a_bucket_wakes_by_itself(spark, scratch):
    def at(day, event, batch, status="in_progress"):
        return (batch, START + timedelta(days=day), event, status)

    # "a" waits without further polls, "late" comes behind the watermark of day 9, "b" is ended by its second poll in time
    slices = [[at(0, 1, "a", "failed"), at(2, 2, "b", "completed")], [at(10, 3, "x")], [at(1, 4, "late", "failed"), at(11, 5, "x")],
              [at(30, 6, "x", "expired")], [at(60, 7, "closing")]]
    assert _run(spark, scratch, slices, "1 day", retry_limit=3, buckets=1) == [
        ("a", "failed", 0, 1), ("b", "completed", 0, 1), ("x", "expired", 2, 3)]


def test_the_mark_outlives_a_wait_for_a_later_poll(spark, scratch):
    def at(day, event, batch="x", status="in_progress"):
        return [(batch, START + timedelta(days=day), event, status)]

    # "a" waits for day 2, then an earlier poll arrives and ends it: the poll of day 12 finds the mark
    slices = [at(2, 1, "a", "failed"), at(1, 2, "a", "failed"), at(10, 3), at(11, 4), at(12, 5, "a", "failed"), at(30, 6)]
    assert _run(spark, scratch, slices, "2 days", retry_limit=50, forget_after_ms=60 * 86_400_000) == [("a", "failed", 0, 1)]
