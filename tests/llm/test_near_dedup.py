import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm import near_dedup as N
from palimpsest.llm.components import components

from .helpers import Union, documents, empty_documents, odd_documents


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab C\t\n\x0b\x1cé ", max_size=60))
def test_fingerprint_is_the_stated_majority(text):
    assert N.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_many_shingles():
    text = " ".join(random.Random(1).choice("abcdefgh") for _ in range(1500))
    assert N.fingerprint(text) == plain_fingerprint(text)


def test_gray_rank_orders_neighbours_one_bit_apart():
    codes = np.arange(1 << 10, dtype=np.uint64)
    by_rank = codes[np.argsort(N.gray_rank(codes))]
    assert set(np.bitwise_count(by_rank[1:] ^ by_rank[:-1])) == {1}


def brute(codes, bits):
    u = Union()
    for i, a in enumerate(codes):
        u.find(i)
        for j in np.flatnonzero(np.bitwise_count(a ^ codes[:i]) <= bits):
            u.join(i, int(j))
    return [u.find(i) for i in range(len(codes))]


def clustered(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.int64).astype(np.uint64)
    codes = centres[rng.integers(0, 12, n)]
    for _ in range(5):
        codes = codes ^ np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    codes = np.unique(np.concatenate([codes, rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64)]))
    return codes[np.argsort(N.gray_rank(codes))]


def test_tree_finds_what_all_pairs_find():
    for seed in range(4):
        codes = clustered(seed, 400)
        assert N.linked(codes, len(codes), 3).tolist() == brute(codes, 3)


def test_links_of_blocks_join_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    codes = clustered(9, 300)
    ids = np.random.default_rng(0).permutation(len(codes))
    nodes = spark.createDataFrame([(int(i), int(c.view(np.int64)), int((N.gray_rank(c[None]) ^ np.uint64(1 << 63)).view(np.int64)[0]))
                                   for i, c in zip(ids, codes)], "rep long, fp long, rank long")
    got = {r["node"]: r["root"] for r in components(N.near_links(nodes, 3)).collect()}
    u = Union()
    for i, root in enumerate(brute(codes, 3)):
        u.join(int(ids[i]), int(ids[root]))
    assert all(got.get(int(i), int(i)) == u.find(int(i)) for i in ids)


def test_components_of_chains_stars_and_noise(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 200)] + [(300, 300), (None, 5), (7, 8), (8, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 200)) and 300 not in got
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_whole_table_equals_all_pairs(spark):
    docs = documents(spark)
    rows = {r["doc_id"]: r for r in N.near_duplicates(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {k: plain_fingerprint(t) for k, t in texts.items()}
    u = Union()
    ids = sorted(texts)
    for a in ids:
        u.find(a)
        for b in ids:
            if b < a and bin(prints[a] ^ prints[b]).count("1") <= 3:
                u.join(a, b)
    assert {k: (r["fingerprint"], r["component_id"]) for k, r in rows.items()} == {k: (f"{prints[k]:016x}", u.find(k)) for k in ids}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = N.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    nulls = {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert nulls == {0}  # null, empty and blank texts, with or without an id
    kept = N.keep_first(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len({(r["doc_id"], r["text"]) for r in got}) == len(got)
    assert sum(r["text"] == "one two three four five six seven eight" for r in got) == 1
    assert sum(r["doc_id"] is None for r in got) == 1  # "no id here at all"
    assert N.near_duplicates(empty_documents(spark)).count() == 0 and N.keep_first(empty_documents(spark)).count() == 0


def test_one_group_of_a_third_of_all_rows(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(400)]
    rows = []
    for i in range(600):
        text = list(base) if i % 3 == 0 else [rng.choice(words) for _ in range(60)]
        if i % 3 == 0 and i % 2:
            text[rng.randrange(400)] = "edited"
        rows.append((i, " ".join(text)))
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = {i: plain_fingerprint(t) for i, t in rows}
    u = Union()
    for i in prints:
        u.find(i)
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                u.join(i, j)
    assert got == {i: u.find(i) for i in prints}
