import hashlib

import numpy as np

from palimpsest.llm import fingerprints as P

from .helpers import documents, empty_documents, odd_documents


def by_hand(docs):
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    ids = sorted(rows, reverse=True)
    out = {}
    for i, k in enumerate(ids):
        a, b = rows[k], rows[ids[(i + 1) % len(ids)]]
        half = len(a) // 2
        out[k] = (ids[(i + 1) % len(ids)], a[:len(a) - half] + b[:half])
    return rows, out


def test_whole_table(spark):
    docs = documents(spark)
    rows, edited = by_hand(docs)
    got = {r["doc_id"]: r for r in P.edited_likeness(docs).collect()}
    assert set(got) == set(rows)
    texts = spark.createDataFrame([(k, t) for k, (_, t) in edited.items()], "k long, text string")
    prints = {r["k"]: r["fp"] for r in P.fingerprints(texts, ["k"]).collect()}
    code = {k: int(r["fingerprint"], 16) for k, r in got.items()}
    for k, r in got.items():
        after, text = edited[k]
        assert r["n_chars"] == len(rows[k]) and r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert int(r["edited_fingerprint"], 16) == prints[k] % (1 << 64)
        assert r["near_next"] == 1 - bin(code[k] ^ code[after]).count("1") / 64
        assert r["near_edited"] == 1 - bin(code[k] ^ int(r["edited_fingerprint"], 16)).count("1") / 64
        near = sum(bin(code[k] ^ x).count("1") <= 3 for x in code.values()) - 1
        assert r["n_within"] == (near if k % 20 == 0 else None)
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.9
    same = {}
    for k, t in rows.items():
        same.setdefault(t, set()).add(got[k]["fingerprint"])
    assert all(len(x) == 1 for x in same.values())


def test_votes_by_hand(spark):
    text = "a b a b c"
    terms = [("a", "b"), ("b", "a"), ("a", "b"), ("b", "c")]
    hashes = [spark.sql(f"select xxhash64('{a}', '{b}') h").first()["h"] % (1 << 64) for a, b in terms]
    want = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
    got = P.fingerprints(spark.createDataFrame([(1, text), (2, ""), (3, " \n")], "k long, text string"), ["k"]).collect()
    assert {r["k"]: r["fp"] % (1 << 64) for r in got} == {1: want, 2: 0, 3: 0}


def test_block_tables_find_all_within_the_radius(spark):
    rng = np.random.default_rng(2)
    codes = rng.integers(-(1 << 63), (1 << 63) - 1, 300, dtype=np.int64)
    near = codes[:150].copy()
    for _ in range(5):
        near ^= np.where(rng.random(150) < 0.7, np.int64(1) << rng.integers(0, 63, 150), np.int64(0))
    every = np.unique(np.concatenate([codes, near, [0, -1, 1 << 62]]))
    for radius in (1, 3):
        df = spark.createDataFrame([(int(x),) for x in every], "fp long")
        got = {(r["fp"], r["other"]) for r in P.within(df, df, radius).collect()}
        bits = np.bitwise_count((every[:, None] ^ every[None]).view(np.uint64))
        want = {(int(every[i]), int(every[j])) for i, j in zip(*np.nonzero(bits <= radius))}
        assert got == want


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = P.edited_likeness(docs).collect()
    assert len(got) == docs.count()
    assert {r["fingerprint"] for r in got if r["n_chars"] == 0} == {"0" * 16}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert P.edited_likeness(empty_documents(spark)).count() == 0
    one = P.edited_likeness(documents(spark).limit(1)).first()
    assert one["near_next"] == 1.0


def test_no_python_in_the_plan(spark):
    plan = P.edited_likeness(documents(spark))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "MapIn"))
