"""SimHash near-duplicate groups through a Gray-order hierarchical index.

A document's fingerprint is the bitwise majority of its shingles' XXH64. The different
fingerprints are sorted by Gray rank (neighbours in that order differ in few bits) and cut
into blocks of about equal size. A block is an index node: the bits that all its members
share (mask) and their values (pattern). Two blocks are compared only where their patterns
differ in at most ``max_bits`` of the bits that both share; inside such a pair the same
test runs down a tree of ever smaller nodes to leaves of a few fingerprints, differences
accumulating as masks grow, so that whole groups are pruned at once. Matches are united
inside the task; only one link for each linked fingerprint leaves it, and the links of all
tasks are united by ``components``.

Equal fingerprints are one node, so groups of copies never meet as pairs. Defined results:
null text counts as empty; texts without words have fingerprint zero and are linked like
any other; a null doc_id gets a fingerprint and the component of the documents with an id
that share that very fingerprint (null if there is none); repeated rows are returned each;
an empty table gives no rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, place_of, plain_columns, steps, stored
from .components import components

#: Fingerprints in a block of the sorted order, and the most blocks (their list is held by the driver).
BLOCK_ROWS, MAX_BLOCKS = 131_072, 1_024
#: Members of a leaf, children of an inner node, node pairs handled at once.
LEAF, FAN, CHUNK = 16, 4, 1 << 17

_LANES = np.uint64(0x0101010101010101)
_SIGN = np.uint64(1 << 63)


def fingerprint(text: str | None, width: int = 3) -> int:
    """Majority of the XXH64 (seed 42) of the ``width``-word shingles of a lower-cased text."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - width + 1].tolist()
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1:].tolist())])
    n = len(starts)
    hashes = np.frombuffer(raw, ">u8").astype(np.uint64)
    rows = -(-n // 255)  # a lane of eight bits counts up to 255
    padded = np.zeros(rows * 255, np.uint64)
    padded[:n] = hashes
    padded = padded.reshape(rows, 255)
    result = 0
    for j in range(8):
        ones = ((padded >> np.uint64(j)) & _LANES).sum(axis=1).view(np.uint8).reshape(rows, 8).sum(axis=0, dtype=np.int64)
        for lane in np.flatnonzero(2 * ones > n).tolist():
            result |= 1 << (8 * lane + j)
    return result


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of unsigned 64-bit codes in the binary reflected Gray sequence."""
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


def with_fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp long, rank long): ``rank`` sorts as the Gray rank of ``fp``."""

    def run(batches):
        for part in steps(batches):
            codes = np.fromiter((fingerprint(t, width) for t in part.column(1).to_pylist()), np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(codes.view(np.int64)), pa.array((gray_rank(codes) ^ _SIGN).view(np.int64))],
                names=["doc_id", "fp", "rank"])

    return plain_columns(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fp long, rank long")


class _Tree:
    """Levels of (mask, pattern) over fingerprints sorted by Gray rank; level 0: leaves."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        low = np.bitwise_and.reduceat(codes, np.arange(0, len(codes), LEAF))
        high = np.bitwise_or.reduceat(codes, np.arange(0, len(codes), LEAF))
        self.levels = [(~(low ^ high), low)]
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            self.levels.append((~(low ^ high), low))


class _Union:
    """Union of array positions; the root is the smallest position."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return self.parent
            self.parent = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            root = self.roots()
            x, y = root[a], root[b]
            other = x != y
            if not other.any():
                return
            a, b, x, y = a[other], b[other], x[other], y[other]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def linked(codes: np.ndarray, split: int, max_bits: int) -> np.ndarray:
    """Roots (positions) after uniting codes that differ in at most ``max_bits`` bits: those
    before ``split`` with those from it on or, if ``split`` is their number, with one another.
    Both parts are in Gray order."""
    left = _Tree(codes[:split])
    one = split == len(codes)
    right = left if one else _Tree(codes[split:])
    union = _Union(len(codes))
    levels = max(len(left.levels), len(right.levels))
    for tree in (left, right):
        while len(tree.levels) < levels:
            tree.levels.append(tree.levels[-1])
    stack = [(levels - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    inside = np.arange(LEAF)
    while stack:
        level, a, b = stack.pop()
        if len(a) > CHUNK:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        (ma, pa_), (mb, pb) = left.levels[level], right.levels[level]
        near = np.bitwise_count((pa_[a] ^ pb[b]) & ma[a] & mb[b]) <= max_bits
        a, b = a[near], b[near]
        if level:
            for tree, side in ((left, "a"), (right, "b")):
                narrow = len(tree.levels[level - 1][0])
                fan = np.arange(1 if narrow == len(tree.levels[level][0]) else FAN)
                nodes = a if side == "a" else b
                below = (nodes[:, None] * len(fan) + fan).ravel()
                other = np.repeat(b if side == "a" else a, len(fan))
                there = below < narrow
                a, b = (below[there], other[there]) if side == "a" else (other[there], below[there])
            if one:
                a, b = a[a <= b], b[a <= b]
            stack.append((level - 1, a, b))
            continue
        for i in range(0, len(a), 4096):
            x = (a[i:i + 4096, None] * LEAF + inside)[:, :, None]
            y = (b[i:i + 4096, None] * LEAF + inside)[:, None, :]
            ok = (x < len(left.codes)) & (y < len(right.codes))
            ok &= np.bitwise_count(left.codes[np.minimum(x, len(left.codes) - 1)]
                                   ^ right.codes[np.minimum(y, len(right.codes) - 1)]) <= max_bits
            k, p, q = np.nonzero(ok)
            union.add(x[k, p, 0], y[k, 0, q] + (0 if one else split))
    return union.roots()


def near_links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes`` (rep, fp, rank; different fingerprints) -> (u, v): links between reps that
    join the same reps as all pairs within ``max_bits`` would. At most one link for each
    node and pair of blocks."""
    spark = nodes.sparkSession
    n = nodes.count()
    parts = min(MAX_BLOCKS, math.ceil(n / BLOCK_ROWS))
    if n < 2:
        return nodes.select(F.col("rep").alias("u"), F.col("rep").alias("v")).where("false")
    cuts: list[int] = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        cuts = sorted(set(nodes.agg(F.percentile_approx("rank", at, 20 * parts)).first()[0]))

    @F.pandas_udf("int")
    def block(rank: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.asarray(cuts, np.int64), rank.to_numpy(), side="right").astype(np.int32))

    placed = stored(nodes.withColumn("block", block("rank")), "gray")
    tops = placed.groupBy("block").agg(F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high")).orderBy("block").collect()
    low = np.array([t["low"] for t in tops], np.int64).view(np.uint64)
    high = np.array([t["high"] for t in tops], np.int64).view(np.uint64)
    mask = ~(low ^ high)
    pairs = []  # the top of the index: of at most MAX_BLOCKS nodes
    for i in range(len(tops)):
        near = np.flatnonzero(np.bitwise_count((low[i] ^ low[i:]) & mask[i] & mask[i:]) <= max_bits) + i
        for j in near.tolist():
            task = i * len(tops) + j
            pairs += [(tops[i]["block"], task, 0)] + ([(tops[j]["block"], task, 1)] if i != j else [])
    plan = spark.createDataFrame(pairs, "block int, task int, side int")

    def sweep(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "rank"], kind="stable")
        rep = rows["rep"].to_numpy()
        split = int((rows["side"] == 0).sum())
        root = linked(rows["fp"].to_numpy().view(np.uint64), split, max_bits)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"u": rep[moved], "v": rep[root[moved]]})

    return (placed.join(F.broadcast(plan), "block").select("task", "side", "rep", "fp", "rank")
            .groupBy("task").applyInPandas(sweep, "u long, v long"))


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the
    smallest doc_id reachable over fingerprints that differ in at most ``max_bits`` bits)."""
    prints = stored(with_fingerprints(docs, width), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("rank").alias("rank")), "nodes")
    links = near_links(nodes.where("rep is not null"), max_bits)
    roots = components(links)
    whole = (nodes.join(roots, nodes["rep"] == roots["node"], "left")
             .select("fp", F.coalesce("root", "rep").alias("component_id")))
    return prints.join(whole, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: that with the smallest
    doc_id; all columns as they are. Of documents without an id that share a fingerprint which
    no document with an id has, one stays."""
    found = stored(near_duplicates(docs, width, max_bits), "groups")
    key, text, rows = place_of(docs, "doc_id"), place_of(docs, "text"), numbered(docs)
    stay = found.where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    out = rows.join(stay, F.col(key) == F.col("kept"), "left_semi")
    counts = rows.agg(F.count(key).alias("n"), F.count_distinct(key).alias("d"), F.count("*").alias("a")).first()
    if counts["n"] != counts["d"]:  # an id given twice: one row of it stays
        out = out.dropDuplicates([key])
    if counts["a"] != counts["n"]:
        alone = found.where("doc_id is null and component_id is null").select("fingerprint").distinct()
        bare = rows.where(F.col(key).isNull()).withColumn("print", F.lpad(F.lower(F.hex(_fingerprint_udf(width)(text))), 16, "0"))
        out = out.union(bare.join(alone, F.col("print") == F.col("fingerprint"), "left_semi").dropDuplicates(["print"]).drop("print"))
    return out.toDF(*docs.columns)


def _fingerprint_udf(width: int):
    @F.pandas_udf("long")
    def one(text: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t, width) for t in text), np.uint64, len(text)).view(np.int64))

    return one
