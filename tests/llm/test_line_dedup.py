import random
from collections import Counter, defaultdict

from palimpsest.llm import line_dedup as L

from .helpers import Union, documents, empty_documents, odd_documents


def brute(rows):
    """{(doc_id, line_no): kept} by all pairs that share a shingle."""
    at, first = [], {}
    for doc, text in sorted(rows):
        for no, line in enumerate(text.split("\n")):
            at.append((doc, no, line))
            if line.strip():
                first.setdefault(line, (doc, no))
    lines = list(first)
    sets = [L.shingles(x) for x in lines]
    u, having = Union(), defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(o for g in s for o in having[g])
        for o, n in common.items():
            if n >= 0.8 * (len(s) + len(sets[o]) - n):
                u.join(i, o)
        for g in s:
            having[g].append(i)
    least = {}
    for i, line in enumerate(lines):
        root = u.find(i)
        least[root] = min(least.get(root, (1 << 62, 0)), first[line])
    number = {line: i for i, line in enumerate(lines)}
    return {(d, no): not line.strip() or least[u.find(number[line])] == (d, no) for d, no, line in at}


def test_whole_table_equals_brute_force(spark):
    docs = documents(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in L.line_classes(docs).collect()}
    assert got == want
    out = {r["doc_id"]: r for r in L.drop_repeated_lines(docs).collect()}
    for r in docs.collect():
        kept = [x for i, x in enumerate(r["text"].split("\n")) if want[r["doc_id"], i]]
        assert out[r["doc_id"]]["text"] == "\n".join(kept) and out[r["doc_id"]]["n_chars"] == len("\n".join(kept))


def test_fuzzy_group_of_a_third_of_all_lines(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    base = [word() for _ in range(40)]
    rows = []
    for i in range(300):
        line = list(base) if i % 3 == 0 else [word() for _ in range(rng.randint(1, 40))]
        if i % 3 == 0:
            line[rng.randrange(40)] = word()
        rows.append((i, " ".join(line) + "\n" + ("common line of many" if i % 2 else "")))
    want = brute(rows)
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in L.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_large_buckets_are_split_and_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_ROWS", 20)
    monkeypatch.setattr(L, "PIVOTS", 2)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    head, others = " ".join(word() for _ in range(40)), [" ".join(word() for _ in range(9)) for _ in range(6)]
    rows = [(i, f"{head} {rng.choice(others)} number {i}" if i % 3 == 0 else " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(900)]
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in L.line_classes(docs).collect()}
    assert got == want


def test_no_task_takes_a_large_bucket_whole(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_ROWS", 50)
    rows = [(0, 7, x) for x in range(2000)] + [(5, 8, x) for x in range(5, 25)]
    shared = spark.createDataFrame(rows, "least long, bucket long, lid long")
    large = shared.groupBy("least", "bucket").count().where("count > 50").withColumnRenamed("count", "n")
    blocks = L._blocks(shared, large)
    assert blocks.select("least", "bucket", "lid").distinct().count() == len(rows)
    assert max(r["count"] for r in blocks.groupBy("least", "parts", "part").count().collect()) < 4 * 50
    # what is left after the blocks: two halves, and lines that are alone
    roots = spark.createDataFrame([(x, x % 2) for x in range(1900)], "node long, root long")
    pairs = L._pairs(shared.where("bucket = 7"), roots).collect()
    tasks = {}
    for r in pairs:
        tasks.setdefault((r["kind"], r["i"], r["j"]), []).append((r["side"], r["lid"], r["root"]))
    assert max(map(len, tasks.values())) < 4 * 50
    met = set()
    for lines in tasks.values():
        a, b = [x for x in lines if not x[0]], [x for x in lines if x[0]] or [x for x in lines if not x[0]]
        met |= {(min(x[1], y[1]), max(x[1], y[1])) for x in a for y in b if x[2] != y[2]}
    root = lambda x: x % 2 if x < 1900 else x
    assert met == {(x, y) for y in range(2000) for x in range(y) if root(x) != root(y)}


def test_lines_across_blocks_are_united():
    base = "abcdefghijklmnopqrstuvwxyz0123456789"
    found = L._Links(0.8)
    found.across({1: base, 2: "unlike everything else here"}, {3: base + "A", 4: base + "AB", 5: "some other line that is unlike"})
    assert len({found.find(x) for x in (1, 3, 4)}) == 1 and len({found.find(x) for x in (1, 2, 5)}) == 3


def test_links_of_a_bucket_are_its_exact_components():
    lines = ["abcdefghijklmnopqrstuvwxyz0123456789" + x for x in ("", "A", "AB", "ABC", "ABCD", "ABCDE", "ABCDEF", "ABCDEFGHIJKL")] + ["unlike everything else here"]
    found = L._Links(0.8)
    found.add(dict(enumerate(lines)))
    links = found.links
    u, w = Union(), Union()
    for a, b in links:
        u.join(a, b)
    sets = [L.shingles(x) for x in lines]
    for i in range(len(lines)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                w.join(i, j)
    assert [u.find(i) for i in range(len(lines))] == [w.find(i) for i in range(len(lines))]
    assert len(links) < len(lines)


def test_recall_of_the_bands():
    rng = random.Random(1)
    a, b = [], []
    while len(a) < 1500:
        x = "".join(rng.choice("abcdefgh ij") for _ in range(rng.randint(60, 500)))
        y = list(x)
        for _ in range(rng.randint(1, 4)):
            y[rng.randrange(len(y))] = "Z"
        y = "".join(y)
        s, t = L.shingles(x), L.shingles(y)
        if 0.8 <= len(s & t) / len(s | t) < 0.9:
            a.append(x)
            b.append(y)
    assert (L.band_keys(a) == L.band_keys(b)).any(axis=1).mean() >= 0.99


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = L.drop_repeated_lines(docs)
    rows = out.collect()
    assert out.columns == docs.columns and len(rows) == docs.count()
    assert sum(r["text"] == "one two three four five six seven eight" for r in rows) == 2  # one document given twice
    assert sum(r["text"] is None for r in rows) == 2
    assert any(r["text"] == "no id here at all" for r in rows)
    assert L.line_classes(empty_documents(spark)).count() == 0 and L.drop_repeated_lines(empty_documents(spark)).count() == 0


def test_very_many_equal_lines_of_one_document_go_in_one_pass(spark):
    import time

    n = 800_000
    docs = spark.createDataFrame([(1, "first line of text\n" * n + "another last line"), (2, "first line of text"), (3, None)], "doc_id long, text string")
    start = time.time()
    got = {r["doc_id"]: r["text"] for r in L.drop_repeated_lines(docs).collect()}
    assert got == {1: "first line of text\nanother last line", 2: "", 3: None}
    assert time.time() - start < 120


def test_shingle_sets_in_numbers_and_strings():
    rng = random.Random(11)
    lines = ["abc", "abcdefgh", "a" * 40, "naïve café größer", "naïve “café” größer", "x" * 7 + "é", "\x00" * 9, "日本語のテキストです、長い"]
    lines += ["".join(rng.choice("abé \x00ÿ" if i % 3 else "ab日 ") for _ in range(rng.randint(1, 60))) for i in range(60)]
    for a in lines:
        one = L.shingle_set(a)
        assert isinstance(one, frozenset) == (len(a) < L.SHINGLE or max(map(ord, a)) > 255) and len(one) == len(L.shingles(a))
        for b in lines:
            assert L.in_both(one, L.shingle_set(b)) == len(L.shingles(a) & L.shingles(b))
