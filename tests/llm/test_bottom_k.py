import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.llm import bottom_k as B

from .helpers import Union, documents, empty_documents, odd_documents


def plain_set(text, width=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows):
    """rows (doc_id, text) -> sorted (doc_id, n, component, kept); rows are told apart by their text."""
    sets = [plain_set(t) for _, t in rows]
    u, owners = Union(), {}
    for i, s in enumerate(sets):
        u.find(i)
        for x in s:
            owners.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in owners[x] if j < i}:
            if u.find(i) != u.find(j) and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                u.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = u.find(i)
            least[r] = min(least.get(r, doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        c = least.get(u.find(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), c, c is None or doc == c))
    return sorted(out, key=repr)


def found(df, **given):
    return sorted(map(tuple, B.near_duplicates(df, **given).collect()), key=repr)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab C\t\n\x0b\x1c\x85é ", max_size=60))
def test_sets_are_the_stated_shingles(text):
    assert len(B.shingle_set(text)) == len(plain_set(text))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_given_documents(spark, sf):
    docs = documents(spark, sf)
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def variants(seed, n):
    """Families of near copies around the similarity asked for, short and long, with shared passages."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(words) for _ in range(80)]
    rows = []
    for i in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([5, 9, 30, 70, 150, 400]))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(copy) // 30) + 1)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


def test_families_of_variants(spark):
    rows = variants(5, 150)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_one_large_family_in_small_blocks(spark, monkeypatch):
    """A third of all rows are near copies of one text, many of them further apart than asked."""
    monkeypatch.setattr(B, "SIDE", 4_000)
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = variants(6, 40)
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randrange(1, 5)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
        rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, " ".join(base)) for i in range(200)]
    # texts that share half of their words with all others, alike to few
    half = [f"h{i}" for i in range(60)]
    rows += [(5_000 + i, " ".join(half + [f"y{i // 2}_{j}" for j in range(40)] + ([f"z{i}"] if i % 2 else []))) for i in range(120)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_comparing_joins_what_all_pairs_join():
    rows = variants(9, 60)
    members = [(i, i, B.shingle_set(t)) for i, t in rows]
    for split in (len(members), len(members) // 2):
        links = B.compare([members[:split], members[split:]], B.K, B.LEAST, B.SLACK)
        got, want = Union(), Union()
        for a, b in links:
            got.join(a, b)
        for x, (i, _, s) in enumerate(members):
            for y, (j, _, t) in enumerate(members[:x]):
                if (split == len(members) or (y < split <= x)) and 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t)):
                    want.join(i, j)
        assert [got.find(i) for i, _ in rows] == [want.find(i) for i, _ in rows]


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("node", F.lit(1)).withColumn("n", F.lit(1)).withColumn("sketch", F.lit("a"))
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert B.near_duplicates(empty_documents(spark)).count() == 0
    none = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert found(none) == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)], key=repr)
