"""Near-duplicate lines by MinHash, and texts without their repeats.

A line's shingles are its runs of ``SHINGLE`` characters. One permutation hash split over
``BANDS`` x ``ROWS`` bins gives its signature (an empty bin borrows from a
filled one), and each band of it a bucket; two lines of Jaccard similarity 0.8 share a bucket
with probability 0.998. Inside each bucket the shingle sets themselves are compared: from
a line the search goes on to all lines of the bucket at similarity ``LEAST`` or more that it
has not reached, so the bucket's components are exact while only one link for each line
leaves it. Buckets of the same lines are compared once, and buckets with the same smallest
line (twelve at most) in one task, which remembers what it has united. A bucket of more than
``BLOCK_ROWS`` lines is split by line into blocks, each united by itself together with a few
lines that all blocks get; then its lines outside the largest component so far are compared,
block pair by block pair in tasks of their own, with all lines of other components. The links
of all buckets are united, and of each component the first line (smallest doc_id, then line
number) stays.

Equal lines are one member of a bucket, however frequent. Lines are told apart by their
64-bit hash. Defined results: blank lines are always kept and belong to no component;
null text has no lines; lines shorter than a shingle are near-duplicates of equal lines
only; null ids come after all others; rows of equal id and text are one document; an empty
table gives no rows; other columns stay as they are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, place_of, plain_columns, steps, stored
from .components import components

#: Characters of a shingle, least similarity, bands and rows of the signature.
SHINGLE, LEAST, BANDS, ROWS = 8, 0.8, 12, 4
#: Lines of a bucket compared in one task, and about how many of a larger one every block gets.
BLOCK_ROWS, PIVOTS = 2_000, 16
#: Different lines that a task remembers to have signed.
REMEMBERED = 1_000_000
#: Characters of the lines whose signatures are computed at once.
STEP_CHARS = 200_000
#: Links that a task holds before it tells them.
TOLD = 10_000
_U = np.uint64
_WORD = np.dtype("<u8")
_LAST = (1 << 63) - 1
_EMPTY = _U((1 << 64) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def line_id(line: str) -> int:
    """As Spark's ``xxhash64(line)``."""
    x = xxhash.xxh64_intdigest(line.encode(), 42)
    return x - (1 << 64) if x >> 63 else x


def band_keys(lines: list[str], bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> np.ndarray:
    """Bucket keys, an int64 array (lines, bands); lines of ``width`` characters or more."""
    bins = bands * rows
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(_U)
    lengths = np.array([len(x) for x in lines])
    # a window's hash: the sum of its characters times odd numbers (built by doubling), mixed
    window, done, power, span = np.zeros(len(codes), _U), 0, codes * _U(0x9E3779B97F4A7C15), 1
    while True:
        if width & span:
            part = np.zeros(len(codes), _U)
            part[:len(codes) - done] = power[done:] if done else power
            window = window * _U(0x165667B19E3779F9) + part
            done += span
        if done == width:
            break
        wider = power.copy()
        wider[:len(codes) - span] += power[span:] * _U((0xC2B2AE3D27D4EB4F + 2 * span) & 0xFFFFFFFFFFFFFFFF)
        power, span = wider, span * 2
    of = np.repeat(np.arange(len(lines), dtype=_U), lengths)
    ends = np.cumsum(lengths)
    inside = np.ones(len(codes), bool)
    for i in range(1, width):
        inside[ends - i] = False
    window, of = _mix(window[inside]), of[inside]
    # line (20 bits), bin (8), value (36) in one number: sorting brings each bin's least value first
    order = (of << _U(44)) | ((((window >> _U(32)) * _U(bins)) >> _U(32)) << _U(36)) | (window & _U((1 << 36) - 1))
    order.sort()
    first = np.concatenate([[True], (order[1:] >> _U(36)) != (order[:-1] >> _U(36))])
    order = order[first]
    sketch = np.full((len(lines), bins), _EMPTY, _U)
    sketch[(order >> _U(44)).astype(np.int64), ((order >> _U(36)) & _U(255)).astype(np.int64)] = order & _U((1 << 36) - 1)
    thin = np.flatnonzero((sketch == _EMPTY).any(axis=1))
    if len(thin):
        # an empty bin borrows from the first filled one of a fixed random order of its own
        some = sketch[thin]
        filled = some.copy()
        orders = np.random.default_rng(bins).permuted(np.tile(np.arange(bins), (bins, 1)), axis=1)
        for step in range(bins):
            empty = filled == _EMPTY
            if not empty.any():
                break
            lent = some[:, orders[:, step]]
            take = empty & (lent != _EMPTY)
            filled[take] = lent[take]
        sketch[thin] = filled
    keys = np.zeros((len(lines), bands), _U)
    for row in range(rows):
        keys = _mix(keys + sketch[:, row::rows][:, :bands] + _U(row + 1))
    return (keys + np.arange(bands, dtype=_U) * _U(0x9E3779B97F4A7C15)).view(np.int64)


def _buckets(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, lid) of every different line of a task."""

    def run(batches):
        signed: set[int] = set()
        for part in steps(batches, limit=4_000_000):
            new: dict[int, str] = {}
            for text in part.column(0).to_pylist():
                for line in (text or "").split("\n"):
                    if len(line) >= SHINGLE:
                        x = line_id(line)
                        if x not in signed:
                            new[x] = line
            if len(signed) < REMEMBERED:
                signed.update(new)
            items = list(new.items())
            at = 0
            while at < len(items):  # lines of about ``STEP_CHARS`` characters, one at least
                upto, chars = at, 0
                while upto < len(items) and (upto == at or chars + len(items[upto][1]) <= STEP_CHARS):
                    chars += len(items[upto][1])
                    upto += 1
                keys = band_keys([x[1] for x in items[at:upto]], bands, rows)
                lids = np.repeat(np.array([x[0] for x in items[at:upto]], np.int64), bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(lids)], names=["key", "lid"])
                at = upto

    return docs.select("text").mapInArrow(run, "key long, lid long")


def _shared(batches):
    """Rows of whole buckets -> (least, bucket, lid) of those with more than one line; a bucket
    is named by its lines, so that buckets of the same lines become one; ``least`` is its
    smallest line."""
    keys, lids = [], []
    for b in batches:
        keys.append(b.column(0).to_numpy())
        lids.append(b.column(1).to_numpy())
    if not keys:
        return
    keys, lids = np.concatenate(keys), np.concatenate(lids)
    order = np.lexsort((lids, keys))
    keys, lids = keys[order], lids[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    fresh = new | np.concatenate([[True], lids[1:] != lids[:-1]])
    keys, lids = keys[fresh], lids[fresh]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(start, len(keys)))
    name = _mix(np.add.reduceat(_mix(lids.view(_U)), start) + size.astype(_U)).view(np.int64)
    many = np.repeat(size > 1, size)
    columns = [x[many] for x in (np.repeat(lids[start], size), np.repeat(name, size), lids)]
    for i in range(0, len(columns[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 100_000]) for x in columns], names=["least", "bucket", "lid"])


def shingles(line: str, width: int = SHINGLE) -> frozenset:
    return frozenset([line[i:i + width] for i in range(max(1, len(line) - width + 1))])


def shingle_set(line: str) -> np.ndarray | frozenset:
    """The shingles of a line: where each character is one byte (Latin-1) a shingle is exactly one
    64-bit number, and the set a sorted array of them; else the strings."""
    try:
        raw = line.encode("latin-1")
    except UnicodeEncodeError:
        return shingles(line)
    if SHINGLE != _WORD.itemsize or len(raw) < SHINGLE:
        return shingles(line)
    words = np.sort(np.ndarray(len(raw) - SHINGLE + 1, _WORD, raw, strides=(1,)))
    return words[np.concatenate(([True], words[1:] != words[:-1]))]


def _as_strings(found: np.ndarray | frozenset) -> frozenset:
    if isinstance(found, frozenset):
        return found
    text = found.tobytes().decode("latin-1")
    return frozenset([text[i:i + SHINGLE] for i in range(0, len(text), SHINGLE)])


def in_both(a: np.ndarray | frozenset, b: np.ndarray | frozenset) -> int:
    """Size of the intersection of two results of :func:`shingle_set`."""
    if isinstance(a, frozenset) or isinstance(b, frozenset):
        return len(_as_strings(a) & _as_strings(b))
    both = np.concatenate((a, b))
    both.sort(kind="stable")  # merges the two ascending runs
    return int(np.count_nonzero(both[1:] == both[:-1]))


class _Links:
    """Components among the lines of one task's buckets."""

    def __init__(self, least: float):
        self.least, self.up, self.sets, self.links = least, {}, {}, []

    def find(self, x: int) -> int:
        while self.up.setdefault(x, x) != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def _set(self, lid: int, line: str) -> np.ndarray | frozenset:
        if lid not in self.sets:
            self.sets[lid] = shingle_set(line)
        return self.sets[lid]

    def _alike(self, a: np.ndarray | frozenset, b: np.ndarray | frozenset) -> bool:
        small, large = (len(a), len(b)) if len(a) < len(b) else (len(b), len(a))
        both = in_both(a, b) if small >= self.least * large else 0
        return bool(both) and both >= self.least * (small + large - both)

    def add(self, bucket: dict[int, str]) -> None:
        """Unite the bucket's lines: from those known to be one, on to all that are alike."""
        left: dict[int, list[int]] = {}  # the bucket's lines by what is known of them
        for lid in bucket:
            left.setdefault(self.find(lid), []).append(lid)
        while len(left) > 1:
            root, queue = left.popitem()
            while queue and left:
                a = queue.pop()
                a = self._set(a, bucket[a])
                for other in list(left):
                    for lid in left[other]:
                        if self._alike(a, self._set(lid, bucket[lid])):
                            self.links.append((other, root))
                            self.up[self.find(other)] = self.find(root)
                            queue += left.pop(other)
                            break

    def across(self, some: dict[int, str], others: dict[int, str]) -> None:
        """Unite lines of ``some`` with lines of ``others`` that are alike."""
        right: dict[int, list[int]] = {}
        for lid in others:
            right.setdefault(self.find(lid), []).append(lid)
        for x, line in some.items():
            for known, lids in right.items():
                root, other = self.find(x), self.find(known)
                if root == other:
                    continue
                if any(self._alike(self._set(x, line), self._set(lid, others[lid])) for lid in lids):
                    self.links.append((other, root))
                    self.up[other] = root


def _told(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])


def _verify(least: float):
    """Rows (least, parts, part, bucket, lid, line) sorted by the first four -> links inside each
    bucket's lines of a (least, parts, part)."""

    def run(batches):
        now, bucket, held, found, links = None, None, {}, _Links(least), []
        for b in batches:
            for least_, parts, part, name, lid, line in zip(*(c.to_pylist() for c in b.columns)):
                task = least_, parts, part
                if name != bucket or task != now:
                    found.add(held)
                    held, bucket = {}, name
                if task != now:
                    links += found.links
                    if len(links) >= TOLD:
                        yield _told(links)
                        links = []
                    now, found = task, _Links(least)
                held[lid] = line
        found.add(held)
        links += found.links
        if links:
            yield _told(links)

    return run


def _cross(least: float):
    """Rows (least, bucket, kind, i, j, side, lid, root, line) sorted by the first five -> links
    between the lines of both sides or, where there is one side only, inside it; lines of
    one root are one already."""

    def run(batches):
        now, sides, found = None, ({}, {}), _Links(least)

        def unite():
            if sides[1]:
                found.across(*sides)
            else:
                found.add(sides[0])

        for b in batches:
            for *task, side, lid, root, line in zip(*(c.to_pylist() for c in b.columns)):
                if task != now:
                    unite()
                    if found.links:
                        yield _told(found.links)
                    now, sides, found = task, ({}, {}), _Links(least)
                found.up[root] = found.up[lid] = root
                sides[side][lid] = line
        unite()
        if found.links:
            yield _told(found.links)

    return run


def _blocks(shared: DataFrame, large: DataFrame | None) -> DataFrame:
    """``shared`` with parts and part: a bucket of ``large`` is split by line, and some of its
    lines are in every part."""
    if large is None:
        return shared.withColumn("parts", F.lit(1)).withColumn("part", F.lit(0))
    rows = shared.join(large, ["least", "bucket"], "left")
    rows = rows.withColumn("parts", F.expr(f"if(n is null, 1, cast(pow(2, ceil(log2(n / {BLOCK_ROWS}))) as int))"))
    every = (F.col("lid") == F.col("least")) | (F.expr("pmod(xxhash64(lid, 1), n)") < PIVOTS)
    one = F.array(F.expr("cast(pmod(xxhash64(lid), parts) as int)"))
    return rows.withColumn("part", F.explode(F.when(F.col("n").isNotNull() & every, F.expr("sequence(0, parts - 1)")).otherwise(one))).drop("n")


def _pairs(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Lines (least, bucket, lid) of large buckets and the components so far -> least, bucket,
    kind, i, j, side, lid, root: those of the largest component in blocks i against the rest
    in blocks j (kind 0), and the rest's blocks against one another (kind 1)."""
    known = stored(rows.join(roots, F.col("lid") == F.col("node"), "left")
                   .select("least", "bucket", "lid", F.coalesce("root", "lid").alias("root")), "known")
    sizes = known.groupBy("least", "bucket", "root").agg(F.count("*").alias("n"))
    main = (sizes.groupBy("least", "bucket").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("n"))
            .where("n > m.n")
            .select("least", "bucket", F.col("m.root").alias("main"),
                    F.expr(f"cast(ceil(m.n / {BLOCK_ROWS}) as int)").alias("mains"), F.expr(f"cast(ceil((n - m.n) / {BLOCK_ROWS}) as int)").alias("rests")))
    both = known.join(main, ["least", "bucket"])
    inside, outside = both.where("root = main"), both.where("root <> main").withColumn("at", F.expr("cast(pmod(xxhash64(lid), rests) as int)"))
    out = inside.selectExpr("least", "bucket", "0 as kind", "cast(pmod(xxhash64(lid), mains) as int) as i", "explode(sequence(0, rests - 1)) as j", "0 as side", "lid", "root")
    out = out.union(outside.selectExpr("least", "bucket", "0 as kind", "explode(sequence(0, mains - 1)) as i", "at as j", "1 as side", "lid", "root"))
    rest = outside.selectExpr("*", "explode(sequence(0, rests - 1)) as to")
    return out.union(rest.selectExpr("least", "bucket", "1 as kind", "least(at, to) as i", "greatest(at, to) as j", "if(at <= to, 0, 1) as side", "lid", "root"))


def _key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_doc", F.coalesce("doc_id", F.lit(_LAST))).withColumn("_hash", F.xxhash64("text"))


def near_lines(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, root): lines (by hash) that have near-duplicates, and their component."""
    texts = plain_columns(docs, "doc_id", "text").where("text is not null").select("text")
    shared = stored(_buckets(texts, bands, rows).repartition("key").mapInArrow(_shared, "least long, bucket long, lid long").distinct(), "buckets")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") >= SHINGLE)
    wanted = shared.select("lid").distinct()
    found = (lines.select(F.xxhash64("line").alias("lid"), "line").join(wanted.hint("shuffle_hash"), "lid", "left_semi")
             .groupBy("lid").agg(F.first("line").alias("line")))
    large = stored(shared.groupBy("least", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_ROWS), "large")
    if large.isEmpty():
        return components(_links(_blocks(shared, None), found, least))
    found = stored(found, "lines")
    links = stored(_links(_blocks(shared, large), found, least), "links")
    pairs = _pairs(shared.join(large.drop("n"), ["least", "bucket"], "left_semi"), stored(components(links), "united"))
    task = ["least", "bucket", "kind", "i", "j"]
    crossed = (pairs.join(found, "lid").select(*task, "side", "lid", "root", "line")
               .repartition(*task).sortWithinPartitions(*task).mapInArrow(_cross(least), "u long, v long"))
    return components(links.union(crossed))


def _links(blocks: DataFrame, found: DataFrame, least: float) -> DataFrame:
    task = ["least", "parts", "part"]
    whole = blocks.join(found, "lid").select(*task, "bucket", "lid", "line").repartition(*task).sortWithinPartitions(*task, "bucket")
    return whole.mapInArrow(_verify(least), "u long, v long")


def line_classes(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each line of ``docs``: doc_id, line_no (from 0), kept, and the first line of
    its component (first_doc_id, first_line_no); also the row's keys ``_doc`` and ``_hash``."""
    frame = _key(plain_columns(docs, "doc_id", "text").where("text is not null"))
    lines = (frame.select("_doc", "_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
             .select("_doc", "_hash", "line_no", F.when(F.trim("line", F.lit(" \t\r\x0b\x0c")) != "", F.xxhash64("line")).alias("lid")))
    lines = stored(lines.dropDuplicates(["_doc", "_hash", "line_no"]) if _repeats(frame) else lines, "lines")
    roots = stored(near_lines(docs, least, bands, rows), "roots")
    firsts = lines.where("lid is not null").groupBy("lid").agg(F.min(F.struct("_doc", "_hash", "line_no")).alias("first"))
    grouped = firsts.join(roots, F.col("lid") == F.col("node"), "left").select("lid", "root", "first")
    alone = grouped.where("root is null").select("lid", "first")
    near = grouped.where("root is not null")
    near = near.join(near.groupBy("root").agg(F.min("first").alias("least")), "root").select("lid", F.col("least").alias("first"))
    placed = lines.join(alone.union(near), "lid", "left")
    kept = F.col("first").isNull() | (F.struct("_doc", "_hash", "line_no") == F.col("first"))
    return placed.select(
        F.when(F.col("_doc") != _LAST, F.col("_doc")).alias("doc_id"), "line_no", kept.alias("kept"),
        F.when(F.col("first._doc") != _LAST, F.col("first._doc")).alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"), "_doc", "_hash")


def _repeats(frame: DataFrame) -> bool:
    n = frame.agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("_doc", "_hash"), 0.01).alias("d")).first()
    if n["d"] >= 0.9 * n["n"]:
        return not frame.groupBy("_doc", "_hash").count().where("count > 1").isEmpty()
    return True


def drop_repeated_lines(docs: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs`` with all columns, each text without the lines that repeat an earlier one, and
    ``n_chars`` (if there is one) counted anew."""
    classes = line_classes(docs, least, bands, rows)
    gone = classes.where("not kept").groupBy("_doc", "_hash").agg(F.collect_set("line_no").alias("gone"))
    key, text, every = place_of(docs, "doc_id"), place_of(docs, "text"), numbered(docs)
    keyed = every.withColumn("_doc", F.coalesce(key, F.lit(_LAST))).withColumn("_hash", F.xxhash64(text))
    # lines instead of the text: split once, and any number of them removed in one pass
    out = keyed.withColumn(text, F.split(text, "\n")).join(gone, ["_doc", "_hash"], "left")
    numbers = F.array_except(F.sequence(F.lit(0), F.size(text) - 1), F.col("gone"))
    left = F.transform(numbers, lambda i: F.get(F.col(text), i))
    out = out.withColumn(text, F.array_join(F.when(F.col("gone").isNull(), F.col(text)).otherwise(left), "\n"))
    if "n_chars" in docs.columns:
        count = place_of(docs, "n_chars")
        kind = every.schema[count].dataType
        out = out.withColumn(count, F.when(F.col("gone").isNull(), F.col(count)).otherwise(F.char_length(text)).cast(kind))
    return out.select(*every.columns).toDF(*docs.columns)
