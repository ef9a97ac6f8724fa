"""The no-op guard inside generation, image arms, and resumption of a stopped run."""

import json
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.functions import constants as K
from palimpsest.operators import guarded as G

CALLS = tempfile.mkdtemp(prefix="palimpsest-calls-")


class Noted:
    """A factory whose generators write down each call (as files: tasks run in other processes)."""

    def __init__(self, name, plan, broken=(), fail_at=None):
        self.name, self.plan, self.broken, self.fail_at, self.folder = name, plan, tuple(broken), fail_at, CALLS

    def __hash__(self):
        return hash(self.name)

    def __eq__(self, other):
        return self.name == other.name and self.fail_at == other.fail_at

    def __call__(self, arm):
        if arm in self.broken:
            raise OSError("no checkpoint")
        plan, name, fail_at, folder = self.plan, self.name, self.fail_at, self.folder

        def gen(prompts, images):
            out = []
            for p, image in zip(prompts, images):
                i = int(p.split(":")[1])
                if arm != "untuned" and fail_at is not None and i >= fail_at:
                    raise RuntimeError("the run was stopped")
                with open(os.path.join(folder, f"{name}-{arm}-{i}-{random.random()}"), "w"):
                    pass
                out.append(f"{i} {image.decode()}" + ("" if arm == "untuned" or plan[arm][i] else f" {arm}"))
            return prompts.__class__(out, index=prompts.index)

        return gen


def calls(name):
    found = [f.split("-") for f in os.listdir(CALLS) if f.startswith(name + "-")]
    return sorted((a, int(i)) for _, a, i, *_ in found)


def walk(plan, arms, eligible, k):
    """One output after the other, as the guard's rule says: written (arm, i) and the stops."""
    written, stops = set(), {}
    for arm in arms:
        streak = 0
        for i, ok in enumerate(eligible):
            if ok:
                streak = streak + 1 if plan[arm][i] else 0
                if streak >= k:
                    stops[arm] = i + 1
                    break
            written.add((arm, i))
    return written, stops


def items(spark, folder, n, missing, no_text=()):
    for i in range(n):
        if i not in missing:
            with open(f"{folder}/{i:05d}.jpg", "wb") as f:
                f.write(f"img{i}".encode())
    rows = [(f"{i:05d}", None if i in no_text else f":{i}:", f"{folder}/{i:05d}.jpg" if i % 7 else f"file:{folder}/{i:05d}.jpg") for i in range(n)]
    return spark.createDataFrame(rows, "id string, text string, path string").repartition(5)


def test_rounds_stop_arms_as_a_walk_does(spark, scratch):
    n, k = 230, 5
    rng = random.Random(4)
    arms = {"never": [False] * n, "always": [True] * n, "late": [i >= 190 for i in range(n)],
            **{f"r{x}": [rng.random() < x / 10 for _ in range(n)] for x in (4, 6, 7, 8)}}
    missing = {i for i in range(n) if rng.random() < 0.2}
    no_text = {3, 50}
    eligible = [i not in missing and i not in no_text for i in range(n)]
    df = items(spark, scratch, n, missing, no_text)
    factory = Noted("walk", arms, broken=["broken"])
    got = G.run_guarded(df, [*arms, "broken"], factory, "id", ["id"], "text", scratch + "/run", image="path", first=16, template="{text}")
    rows = got.outputs.collect()
    written, stops = walk(arms, arms, eligible, k)
    assert {(r["arm"], int(r["id"])) for r in rows if r["arm"] != "untuned"} == written
    assert len(rows) == len(written) + n and sum(r["arm"] == "untuned" for r in rows) == n
    for r in rows:
        i = int(r["id"])
        want = "no_image" if i in missing else "no_input" if i in no_text else "ok"
        assert r["status"] == want and (r["output"] == K.NO_IMAGE_ERROR) == (want == "no_image")
    report = {r["arm"]: r for r in got.report.collect()}
    assert {a: r["stopped_at"] for a, r in report.items() if r["stopped_at"]} == stops
    assert "no checkpoint" in report["broken"]["load_error"] and report["broken"]["generated"] == 0
    # every call happened once, and none in a round after the arm's stop
    made = calls("walk")
    assert len(made) == len(set(made))
    for arm in arms:
        rounds = {((i) // 16 + 1).bit_length() - 1 for a, i in made if a == arm}
        last = ((stops[arm] - 1) // 16 + 1).bit_length() - 1 if arm in stops else max(rounds)
        assert max(rounds) == last and report[arm]["generated"] == sum(a == arm for a, _ in made)
    # untuned was complete before any arm began, and a rerun of the finished run calls nothing
    again = G.run_guarded(df, [*arms, "broken"], factory, "id", ["id"], "text", scratch + "/run", image="path", first=16, template="{text}")
    assert again.outputs.count() == len(rows) and calls("walk") == made


def test_a_stopped_run_goes_on_with_the_carried_count(spark, scratch):
    n = 120
    plan = {"a": [i >= 44 for i in range(n)], "b": [False] * n}  # the fifth in a row is the first of a round
    df = items(spark, scratch, n, set())
    with pytest.raises(Exception, match="stopped"):
        G.run_guarded(df, list(plan), Noted("resume", plan, fail_at=48), "id", ["id"], "text", scratch + "/run", image="path", first=16, template="{text}")
    before = calls("resume")
    got = G.run_guarded(df, list(plan), Noted("resume", plan), "id", ["id"], "text", scratch + "/run", image="path", first=16, template="{text}")
    assert {r["arm"]: r["stopped_at"] for r in got.report.collect()} == {"a": 49, "b": None}
    assert sorted(r["id"] for r in got.outputs.where("arm = 'a'").collect()) == [f"{i:05d}" for i in range(48)]
    new = list(calls("resume"))
    for x in before:
        new.remove(x)
    assert all(a != "untuned" and i >= 48 for a, i in new)  # finished rounds and the baseline did not run again


def test_filled_cells_are_kept_and_not_compared(spark, scratch):
    n = 40
    df = items(spark, scratch, n, set())
    held = df.withColumn("was", F.when(F.col("id").cast("int") % 2 == 0, F.lit("kept before"))).withColumn("base", F.when(F.col("id") == "00001", F.lit("1 img1")))
    plan = {"a": [True] * n}
    got = G.run_guarded(held, ["a"], Noted("cells", plan), "id", ["id"], "text", scratch + "/run", image="path", first=4, template="{text}",
                        cells={"a": "was", "untuned": "base"})
    # compared are 1, 3, 5, 7, 9: the last one stops the arm; filled cells stay, also later ones
    rows = got.outputs.where("arm = 'a'").collect()
    assert {int(r["id"]) for r in rows if r["status"] == "kept"} == set(range(0, n, 2))
    assert {int(r["id"]) for r in rows if r["status"] != "kept"} == {1, 3, 5, 7}
    assert {a for a, i in calls("cells") if i == 1} == {"a"}


def test_text_arms_and_empty_table(spark, scratch):
    df = spark.createDataFrame([(i, "x" * i) for i in range(30)], "id long, text string")
    got = G.run_guarded(df, ["same", "other"], _text, "id", ["id"], "text", scratch + "/t", first=8, template="{text}")
    assert {r["arm"]: r["stopped_at"] for r in got.report.collect()} == {"same": 5, "other": None}
    assert got.outputs.where("arm = 'other'").count() == 30 and got.outputs.where("status = 'blank'").count() == 2 + 1
    none = G.run_guarded(df.limit(0), ["same"], _text, "id", ["id"], "text", scratch + "/e", first=8)
    assert none.outputs.count() == 0 and none.report.first()["generated"] == 0


def _text(arm):
    return lambda s: s if arm != "other" else s.where(s == "", s + "!")


@pytest.mark.parametrize("seed", range(6))
def test_stretches_fold_to_the_walk_however_they_are_cut(seed):
    rng = np.random.default_rng(seed)
    for _ in range(200):
        n, k = int(rng.integers(0, 40)), int(rng.integers(1, 6))
        same = rng.random(n) < rng.random()
        places = np.cumsum(rng.integers(1, 4, n))
        streak, stop = 0, None
        for p, s in zip(places, same):
            streak = streak + 1 if s else 0
            if streak >= k and stop is None:
                stop = int(p)
        cuts = np.sort(rng.integers(0, n + 1, int(rng.integers(0, 6))))
        parts = [G.stretch(p, s, k) for p, s in zip(np.split(places, cuts), np.split(same, cuts)) if len(s)]
        left = G.NOTHING
        for x in parts:
            left = G.follow(left, x, k)
        right = G.NOTHING
        for x in reversed(parts):
            right = G.follow(x, right, k)
        assert left.stop == right.stop == stop and left.tail == right.tail == streak and left.n == n


def test_state_is_readable(spark, scratch):
    df = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(20)], "id long, text string")
    G.run_guarded(df, ["same"], _text, "id", ["id"], "text", scratch + "/t", first=2, k=4, template="{text}")
    states = {r["round"]: json.loads(r["state"]) for r in spark.read.parquet(scratch + "/t/state").collect()}
    assert states[0]["same"]["streak"] == 2 and states[1]["same"]["stopped_at"] == 4 and states[3] == states[1]


def test_rows_without_image_are_taken_together(monkeypatch):
    import pandas as pd

    images = {f"p{i}": b"x" * 10 for i in range(0, 300, 3)}

    def read(path):
        if path not in images:
            raise FileNotFoundError(path)
        return images[path]

    whole = pd.DataFrame({"_prompt": [None if i % 7 == 0 else "ab" for i in range(300)], "_path": [f"p{i}" for i in range(300)], "_arms": [["a"]] * 300})

    def cut(rows_at_once=G.ROWS_AT_ONCE):
        return [(len(pdf), list(found)) for pdf, found in G._stretches(whole, read, rows_at_once)]

    want = [images.get(f"p{i}") for i in range(300)]
    assert [n for n, _ in cut()] == [300] and cut()[0][1] == want
    assert {n for n, _ in cut(50)} == {50}
    monkeypatch.setattr(G, "BYTES_AT_ONCE", 100)
    parts = cut()
    assert len(parts) > 10 and [x for _, found in parts for x in found] == want
    assert all(sum(len(x or b"") for x in found) <= 110 for _, found in parts)
