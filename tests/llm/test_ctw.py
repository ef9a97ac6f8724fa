import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import ctw as C
from palimpsest.llm.common import held_out

from .helpers import documents, empty_documents, odd_documents

def HELD():
    return held_out(F.col("doc_id"), 7, 2)


class Plain:
    """Context-tree weighting with dictionaries: counts[context bytes nearest first, bits]."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, {}
        for t in texts:
            for before, byte in self.places(t):
                for d in range(depth + 1):
                    for b in range(8):
                        key = (before[:d], b, byte >> (8 - b))
                        self.n.setdefault(key, [0, 0])[byte >> (7 - b) & 1] += 1
        self.children = {}
        for ctx, b, bits in self.n:
            if ctx:
                self.children.setdefault((ctx[:-1], b, bits), []).append((ctx, b, bits))
        self.memo = {}

    def places(self, text):
        data = bytes(self.depth) + text + b"\0"
        for i in range(self.depth, len(data)):
            yield data[i - self.depth:i][::-1], data[i]

    def kt(self, key):
        a, b = self.n.get(key, (0, 0))
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, key):
        if key not in self.memo:
            kt = self.kt(key)
            self.memo[key] = kt if len(key[0]) == self.depth else np.logaddexp(kt, sum(map(self.weighted, self.children.get(key, [])))) - math.log(2)
        return self.memo[key]

    def bit(self, before, b, bits, bit, d=0):
        key = (before[:d], b, bits)
        n = self.n.get(key, [0, 0])
        p = (n[bit] + .5) / (sum(n) + 1)
        if d == self.depth:
            return p
        w = math.exp(self.kt(key) - math.log(2) - self.weighted(key))
        return w * p + (1 - w) * self.bit(before, b, bits, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.bit(before, b, byte >> (8 - b), byte >> (7 - b) & 1)) for before, byte in self.places(text) for b in range(8))


ROWS = [(i, t) for i, t in enumerate(["The cat sat on the mat.", "the cat ran", "A dog sat.", "", None, "unseen Zebra\nquartz", "the cat sat on the dog", "ÄÖ é 日本", "the cat ran", "mat mat mat"])]


@pytest.mark.parametrize("sent", [(1 << 20, 200_000), (3, 1), (0, 0)])
def test_scores_equal_the_plain_tree(spark, sent):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    flags = {r["doc_id"]: r["h"] for r in docs.select("doc_id", HELD().alias("h")).collect()}
    low = {k: (t or "").encode().lower() for k, t in ROWS}
    train = [low[k] for k, _ in ROWS if not flags[k]]
    plain = Plain(train, 3)
    words = Counter(w for t in train for w in t.split())
    words["end"] = len(train)
    total, distinct = sum(words.values()), len(words)
    got = {r["doc_id"]: r for r in C.score_documents(docs, HELD(), depth=3, sent_strings=sent[0], sent_words=sent[1]).collect()}
    assert set(got) == set(low)
    for k, t in low.items():
        tokens = [*t.split(), "end"]
        r = got[k]
        assert r["held_out"] == flags[k] and r["n_tokens"] == len(tokens) and r["train_tokens"] == total
        assert r["n_known"] == sum(words[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in tokens), abs=1e-9)
        assert r["score"] == pytest.approx(plain.score(t), abs=1e-9)


def test_probabilities_of_the_next_byte_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "abracadabra abra")], "doc_id long, text string")
    rows = [(t, False) for t in ("abracadabra abra",)] + [("abr" + chr(c), True) for c in range(1, 128)]
    counts = C.count_strings(spark.createDataFrame(rows, "text string, held boolean"), 3)
    ctx = int.from_bytes(b"rba", "big") << 8
    every = [(ctx | b, 0, 1) for b in range(256)]
    seen = counts.where(~F.col("s").between(ctx, ctx | 255)).union(spark.createDataFrame(every, "s long, n long, every long").join(
        counts.select(F.col("s").alias("t"), F.col("n").alias("m")), F.col("s") == F.col("t"), "left").select("s", F.coalesce("m", "n"), "every"))
    scores = C.score_strings(seen, 3).where(F.col("s").between(ctx, ctx | 255)).collect()
    assert len(scores) == 256 and sum(10 ** r["score"] for r in scores) == pytest.approx(1)


def test_better_than_words_on_held_out_documents(spark):
    got = C.score_documents(documents(spark, "/root/testdata/sf0.1"), HELD()).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > got["b"]


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2.5, 7.5, 8, 100.5, 1e6 + .5])
    assert np.allclose(C._lgamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_table():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 47, 5000)).astype(np.uint64)
    table = C._Table(keys, np.arange(len(keys), dtype=float))
    assert (table.get(keys) == np.arange(len(keys))).all()
    assert np.isnan(table.get(keys + np.uint64(1 << 50))).all()
    assert np.isnan(C._Table(keys[:0], np.zeros(0)).get(keys)).all()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = C.score_documents(docs, HELD()).collect()
    assert len(got) == docs.count() and all(r["score"] < 0 and r["n_tokens"] >= 1 for r in got)
    pairs = {}
    for r in got:
        pairs.setdefault((r["doc_id"], r["n_bytes"]), set()).add((r["score"], r["base_score"]))
    assert all(len(x) == 1 for x in pairs.values())
    assert C.score_documents(empty_documents(spark), HELD()).count() == 0
    untaught = C.score_documents(docs.where(HELD()), HELD()).collect()
    assert untaught and all(r["score"] == pytest.approx(-8 * (r["n_bytes"] + 1) * math.log10(2)) and r["train_tokens"] == 0 for r in untaught)
