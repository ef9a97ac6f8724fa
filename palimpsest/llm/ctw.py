"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z in lower case and one end byte (zero); zeros stand before
its start. A byte is eight binary decisions down a binary tree; each decision has a context
tree over the ``DEPTH`` bytes before it. Every node (context of d bytes, bits so far) keeps
how many zeros and ones followed it in the training texts. A node's weighted probability is
half its Krichevsky-Trofimov estimate plus half the product of its children's weighted
probabilities (at full depth: the estimate). A bit's probability mixes the estimates of all
depths by the posterior weights that follow; a byte's is the product over its eight bits.

The counts of all different (context, byte) strings of all documents are one Spark
aggregation. Strings are partitioned by the two bytes next to the predicted one, so depths
from two on are computed inside tasks; the sums that depths one and zero need are at most
256 x 255 rows. Scores of strings go to the tasks for the ``SENT_STRINGS`` most frequent
ones; occurrences of all others meet their scores in a join. Word counts of the base model
are handled likewise. Nothing is cut, only the way differs.

Defined results: null text counts as empty; texts of train and held-out documents are all
scored; no training text: every bit has probability one half; a null id is a training
document; repeated rows are counted and returned each; an empty table gives no rows."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_columns, steps, stored

#: Bytes of context.
DEPTH = 5
#: Scores sent to every task: strings (32 bytes each with the table's empty half) and words (about 120 bytes each).
SENT_STRINGS, SENT_WORDS = 1 << 20, 200_000
#: Different strings or words that a counting task holds before they go on.
HELD = 1_000_000
#: Strings whose nodes a task holds at once (a group of equal two nearest bytes is never cut).
SLICE = 200_000
#: Text bytes that a task turns into arrays at once (about 100 bytes of memory for each).
STEP_BYTES = 600_000

_U = np.uint64


def strings(data: bytes, depth: int = DEPTH) -> np.ndarray:
    """For each byte of ``data`` the number whose bytes are: the byte before it, the one
    before that, .. (``depth`` of them), and the byte itself last."""
    a = np.frombuffer(bytes(depth) + data, np.uint8).astype(_U)
    n = len(data)
    out = np.zeros(n, _U)
    for back in range(1, depth + 1):
        out |= a[depth - back:depth - back + n] << _U(8 * (depth + 1 - back))
    return out | a[depth:]


def _lower(text: str | None) -> bytes:
    return (text or "").encode().lower()


def _joined(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of all texts, each with its end byte, and where each text's strings start."""
    gap = bytes(depth)
    joined = strings(gap.join([t + b"\0" for t in texts]), depth)
    lengths = np.array([len(t) + 1 for t in texts])
    keep = np.ones(len(joined), bool)
    starts = np.concatenate([[0], np.cumsum(lengths + depth)[:-1]])
    for i in range(depth):
        keep[(starts[1:] - 1 - i)] = False
    return joined[keep], np.concatenate([[0], np.cumsum(lengths)[:-1]])


def _counted(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], *(np.add.reduceat(np.concatenate([p[i] for p in parts])[order], at) for i in (1, 2))


def count_strings(docs: DataFrame, depth: int) -> DataFrame:
    """``docs`` (text, held) -> (s, n, every): occurrences in training texts and in all."""

    def run(batches):
        parts, size = [], 0

        def flush():
            keys, n, every = _counted(parts)
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 100_000].astype(np.int64)) for x in (keys, n, every)],
                                                 names=["s", "n", "every"])

        for part in steps(batches, limit=STEP_BYTES):
            texts = part.column(0).to_pylist()
            held = np.array(part.column(1).to_pylist())
            for flag in (False, True):
                some = [_lower(t) for t, h in zip(texts, held) if h == flag]
                if some:
                    keys, n = np.unique(_joined(some, depth)[0], return_counts=True)
                    parts.append((keys, np.zeros_like(n) if flag else n, n))
                    size += len(keys)
            if size > HELD:
                parts = [_counted(parts)]
                size = len(parts[0][0])
                if size > HELD:
                    yield from flush()
                    parts, size = [], 0
        if parts:
            yield from flush()

    return docs.mapInArrow(run, "s long, n long, every long").groupBy("s").agg(F.sum("n").alias("n"), F.sum("every").alias("every"))


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - math.log(math.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5: Stirling's series above 8, reached by the recurrence."""
    small = x < 8
    shift = np.zeros_like(x)
    y = x.astype(float).copy()
    while small.any():
        shift[small] -= np.log(y[small])
        y[small] += 1
        small = y < 8
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series + shift


def _nodes(keys: np.ndarray, counts: np.ndarray, level: int):
    """Nodes after ``level`` bits: key (context, bits), zeros, ones, and each key's node."""
    node = keys >> _U(8 - level)
    new = np.concatenate([[True], node[1:] != node[:-1]])
    at = np.flatnonzero(new)
    bit = ((keys >> _U(7 - level)) & _U(1)).astype(np.int64)
    total, ones = np.add.reduceat(counts, at), np.add.reduceat(counts * bit, at)
    return node[at], total - ones, ones, np.cumsum(new) - 1, bit


class _Subtree:
    """Depths ``least`` .. ``depth`` over sorted strings (context bytes nearest first)."""

    def __init__(self, s: np.ndarray, n: np.ndarray, depth: int, least: int):
        self.depth, self.least = depth, least
        self.tables = {depth: (s, n, np.arange(len(s)))}  # keys, counts, place of each string
        for d in range(depth - 1, least - 1, -1):
            keys, counts, _ = self.tables[d + 1]
            short = (keys >> _U(16) << _U(8)) | (keys & _U(255))
            unique, inverse = np.unique(short, return_inverse=True)
            place = inverse[self.tables[d + 1][2]]
            self.tables[d] = (unique, np.bincount(inverse, counts, len(unique)).astype(np.int64), place)

    def bits(self):
        """For each bit of the byte in turn: its number, the nodes at depth ``least`` (key,
        zeros, ones, weighted) and each string's probability of its bit from that depth on.
        Only one bit's nodes are held at a time."""
        for b in range(8):
            nodes = {d: _nodes(t[0], t[1], b) for d, t in self.tables.items()}
            p = weighted = None
            for d in range(self.depth, self.least - 1, -1):
                node, zeros, ones, of, bit = nodes[d]
                log_kt = _log_kt(zeros, ones)
                place = self.tables[d][2]
                at, which = of[place], bit[place]
                kt = (np.where(which == 1, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1.0)
                if p is None:
                    p, weighted = kt, log_kt
                    continue
                below = nodes.pop(d + 1)[0]
                up = (below >> _U(8 + b) << _U(b)) | (below & _U((1 << b) - 1))
                weighted = np.logaddexp(log_kt, np.bincount(np.searchsorted(node, up), weighted, len(node))) - math.log(2)
                stay = np.exp(log_kt - math.log(2) - weighted)[at]
                p = stay * kt + (1 - stay) * p
            node, zeros, ones, _, _ = nodes[self.least]
            yield b, (node, zeros, ones, weighted), p


def _slices(near: np.ndarray):
    """Places that cut sorted groups into runs of whole groups of about ``SLICE`` rows."""
    starts = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
    cuts, last = [0], 0
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(near)]):
        if b - last > SLICE and a > last:
            cuts.append(a)
            last = a
    return list(zip(cuts, [*cuts[1:], len(near)]))


def _read(batches, *columns: str) -> list[np.ndarray]:
    parts = [[b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in columns] for b in batches]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64) for _ in columns]


def score_strings(counts: DataFrame, depth: int) -> DataFrame:
    """(s, n, every) -> (s, every, score): log10 of the byte's probability in its context."""
    if depth < 3:
        raise ValueError("at least three bytes of context")
    near = F.shiftrightunsigned("s", 8 * (depth - 1))  # the two bytes next to the predicted one
    dealt = counts.withColumn("near", near).repartition("near")

    def low(batches):
        s, n = _read(batches, "s", "n")
        if not len(s):
            return
        order = np.argsort(s.view(_U))
        keys, n = s.view(_U)[order], n[order]
        for low_, high_ in _slices(keys >> _U(8 * (depth - 1))):
            out = []
            for b, (node, zeros, ones, weighted), _ in _Subtree(keys[low_:high_], n[low_:high_], depth, 2).bits():
                first = (node >> _U(8 + b)).astype(np.int64)
                path = (1 << b) | (node & _U((1 << b) - 1)).astype(np.int64)
                both, inverse = np.unique(first << 8 | path, return_inverse=True)
                out.append((both, *(np.bincount(inverse, x, len(both)) for x in (zeros, ones, weighted))))
            node, zeros, ones, weighted = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(zeros.astype(np.int64)), pa.array(ones.astype(np.int64)), pa.array(weighted)],
                                             names=["node", "zeros", "ones", "weighted"])

    sums = (dealt.mapInArrow(low, "node long, zeros long, ones long, weighted double").groupBy("node")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted")))
    rows = sums.orderBy("node").toArrow().to_pandas()  # at most 256 x 255
    node = rows["node"].to_numpy()
    zeros, ones = rows["zeros"].to_numpy(float), rows["ones"].to_numpy(float)
    # depth one, then the root: probability of a one, and weight of this depth
    one = np.full((257, 256), 0.5)
    stay = np.full((257, 256), 0.5)
    kt = _log_kt(zeros, ones)
    weighted = np.logaddexp(kt, rows["weighted"].to_numpy()) - math.log(2)
    one[node >> 8, node & 255] = (ones + 0.5) / (zeros + ones + 1)
    stay[node >> 8, node & 255] = np.exp(kt - math.log(2) - weighted)
    z, o, w = (np.bincount(node & 255, x, 256) for x in (zeros, ones, weighted))
    kt = _log_kt(z, o)
    one[256], stay[256] = (o + 0.5) / (z + o + 1), np.exp(kt - np.logaddexp(kt, w))

    def high(batches):
        s, n, every = _read(batches, "s", "n", "every")
        if not len(s):
            return
        order = np.argsort(s.view(_U))
        s, n, every = s[order], n[order], every[order]
        whole = s.view(_U)
        for low_, high_ in _slices(whole >> _U(8 * (depth - 1))):
            keys = whole[low_:high_]
            first, byte = (keys >> _U(8 * depth)).astype(np.int64), (keys & _U(255)).astype(np.int64)
            total = np.zeros(len(keys))
            for b, _, p in _Subtree(keys, n[low_:high_], depth, 2).bits():
                path, bit = (1 << b) | (byte >> (8 - b)), (byte >> (7 - b)) & 1
                for row in (first, 256):
                    here = one[row, path]
                    p = stay[row, path] * np.where(bit == 1, here, 1 - here) + (1 - stay[row, path]) * p
                total += np.log10(p)
            yield pa.RecordBatch.from_arrays([pa.array(s[low_:high_]), pa.array(every[low_:high_]), pa.array(total)], names=["s", "every", "score"])

    return dealt.mapInArrow(high, "s long, every long, score double")


class _Table:
    """Open-addressed table of 64-bit keys; absent keys are found as NaN."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (3 * len(keys) // 2).bit_length())
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, _U)
        self.values = np.full(1 << bits, np.nan)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot] == np.iinfo(np.uint64).max
            self.keys[slot[free]] = keys[todo[free]]
            won = self.keys[slot] == keys[todo]
            self.values[slot[won]] = values[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.nan)
        todo = np.flatnonzero((there != keys) & (there != np.iinfo(np.uint64).max))
        at = slot[todo]
        while len(todo):
            slot = (at + 1) & self.mask
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there != np.iinfo(np.uint64).max)
            todo, at = todo[on], slot[on]
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """``docs`` (text, held) -> (word binary, n) over the training texts."""

    def run(batches):
        held: Counter = Counter()

        def flush():
            words = list(held)
            for i in range(0, len(words), 100_000):
                part = words[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([held[w] for w in part], pa.int64())], names=["word", "n"])

        for part in steps(batches):
            for text in part.column(0).to_pylist():
                if text:
                    held.update(text.encode().lower().split())
            if len(held) > HELD // 3:
                yield from flush()
                held = Counter()
        yield from flush()

    return docs.where("not held").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(rows: DataFrame, count: str, most: int) -> int:
    """The least count of which at most ``most`` rows have as many or more."""
    step = F.when(F.col(count) < 256, F.col(count)).otherwise(256 + F.floor(16 * F.log2(F.col(count) / 256)))
    hist = rows.groupBy(step.cast("long").alias("b")).agg(F.count("*").alias("c"), F.min(count).alias("least")).orderBy(F.desc("b")).collect()
    upto, least = 0, 1 << 62
    for r in hist:  # fewer than 1200 steps
        upto += r["c"]
        if upto > most:
            break
        least = r["least"]
    return least


_SCORED = ("rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
           "s long, word binary, times long")


def score_documents(docs: DataFrame, held, depth: int = DEPTH, sent_strings: int = SENT_STRINGS, sent_words: int = SENT_WORDS) -> DataFrame:
    """``docs`` (doc_id, text) and the condition ``held`` on doc_id -> doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    spark = docs.sparkSession
    frame = plain_columns(docs, "doc_id", "text").withColumn("held", held)
    texts = frame.select("text", "held")
    words = stored(count_words(texts), "words")
    ends = frame.where("not held").count()
    whole = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = whole["n"] + ends, whole["v"] + (1 if ends else 0)
    scores = stored(score_strings(stored(count_strings(texts, depth), "strings"), depth), "scores")

    top = scores.where(F.col("every") >= _most_frequent(scores, "every", sent_strings)).select("s", "score").toArrow()
    table = _Table(top.column(0).to_numpy().view(_U), top.column(1).to_numpy())
    known = words.where(F.col("n") >= _most_frequent(words, "n", sent_words)).toArrow()
    room = total + distinct + 1
    log_of = {w: math.log10((c + 1) / room) for w, c in zip(known.column(0).to_pylist(), known.column(1).to_pylist())}
    sent = spark.sparkContext.broadcast((table, log_of))

    def run(batches):
        table, log_of = sent.value
        rid = TaskContext.get().partitionId() << 40
        end = math.log10((ends + 1) / room)
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.int64()]
        names = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "s", "word", "times"]

        def rows(n, **columns):
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in zip(names, types)], names=names)

        for part in steps(batches, limit=STEP_BYTES):
            lowered = [_lower(t) for t in part.column(1).to_pylist()]
            n = len(lowered)
            rids = np.arange(rid, rid + n)
            rid += n
            n_tokens, n_known, base = [], [], []
            more_rid, more_word, more_times = [], [], []
            for i, text in enumerate(lowered):
                found = text.split()
                logs = list(map(log_of.get, found))
                if None in logs:
                    other = Counter([w for w, x in zip(found, logs) if x is None])
                    logs = [x for x in logs if x is not None]
                    more_rid += [int(rids[i])] * len(other)
                    more_word += other.keys()
                    more_times += other.values()
                n_tokens.append(len(found) + 1)
                n_known.append(len(logs) + (ends > 0))
                base.append(math.fsum(logs) + end)
            s, starts = _joined(lowered, depth)
            each = table.get(s)
            missing = np.flatnonzero(np.isnan(each))
            if len(missing):
                each[missing] = 0
                of = np.searchsorted(starts, missing, side="right") - 1
                order = np.lexsort((s[missing], of))
                a, b = of[order], s[missing][order]
                first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
                times = np.diff(np.concatenate([first, [len(a)]]))
                yield rows(len(first), rid=pa.array(rids[a[first]]), s=pa.array(b[first].view(np.int64)), times=pa.array(times))
            if more_rid:
                yield rows(len(more_rid), rid=pa.array(more_rid, pa.int64()), word=pa.array(more_word, pa.binary()), times=pa.array(more_times, pa.int64()))
            yield rows(n, rid=pa.array(rids), doc_id=part.column(0), held_out=part.column(2), n_tokens=pa.array(n_tokens, pa.int64()),
                       n_known=pa.array(n_known, pa.int64()), base_score=pa.array(base), score=pa.array(np.add.reduceat(each, starts)),
                       times=pa.array([len(t) for t in lowered], pa.int64()))

    out = stored(frame.mapInArrow(run, _SCORED), "scored")
    measured = out.where("n_tokens is not null")
    more_s = out.where("s is not null").select("rid", "s", "times").join(scores.select("s", F.col("score").alias("one")), "s")
    more_w = (out.where("word is not null").select("rid", "word", "times").join(words, "word", "left")
              .select("rid", F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("n_known"),
                      (F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(room)))).alias("base_score")))
    zero = F.lit(0.0)
    more = (more_s.select("rid", F.lit(0).cast("long").alias("k"), zero.alias("b"), (F.col("times") * F.col("one")).alias("p"))
            .union(more_w.select("rid", "n_known", "base_score", zero))
            .groupBy("rid").agg(F.sum("k").alias("k"), F.sum("b").alias("b"), F.sum("p").alias("p")))
    score = F.col("score") + F.coalesce("p", zero)
    return measured.join(more, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("b", zero)).alias("base_score"),
        score.alias("score"), F.col("times").alias("n_bytes"),
        (-score * F.lit(math.log2(10)) / (F.col("times") + 1)).alias("bits_per_byte"))
