"""Vector codes by product codebooks, their entries searched through fixed pivots (LAESA).

Vectors become integers, floor(``SCALE`` x component), and are cut into equal parts. A part
position's codebook starts as that part of the first rows and is moved, round by round, to its
parts' means (floor). Some of the first entries stay the part position's pivots: the distances
from every part to them are computed once and written with the rows. In a round the distances
from pivots to entries follow, and their differences bound every part-entry distance from
below; entries are met in the order of these bounds, exact integer distances are computed for
a growing number of the nearest bounds, and the rest goes once its bounds exceed the best.

Rows stay where they are: a round is one pass over them that sends a sum and a count for each
entry and task, added up by Spark; the driver sees codebooks only (``parts`` x ``entries``).

Defined results: vectors that are null, empty or hold null or non-finite components take no
part, nor do those of another length than the row with the smallest id; components beyond
+-131,071 count as that, so that all distances fit in 64 bits; a length that ``parts`` does not
divide is filled up with zeros; equal ids are ordered by their vector, a null id comes last;
repeated rows are coded each; fewer rows than entries give a shorter codebook, an empty table
no rows; a sum over equal labels that exceeds 64 bits is null; other columns are ignored."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import plain_columns, stored

#: Parts, entries of a codebook, rounds, factor of the integers, pivots of a part position.
PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 4, 256, 4, 1024, 8
#: Rows whose bounds are held at once, exact distances a row in the first step, largest component.
ROWS, FIRST, LARGEST = 4_096, 4, 131_071
#: A label of more than this share of the rows (a thousandth: at most a thousand labels) is met by broadcast.
HOT_SHARE = 1_000


def _valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & (F.size(v) > 0), F.lit(False))


def integers(rows: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(np.clip(rows, -LARGEST, LARGEST) * scale).astype(np.int64)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Entries far from one another: each next one has the largest sum of distances to those chosen."""
    chosen, total = [0], np.zeros(len(entries))
    while len(chosen) < min(count, len(entries)):
        total += np.sqrt(((entries - entries[chosen[-1]]).astype(float) ** 2).sum(axis=1))
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return entries[chosen]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((a - x).astype(float) ** 2).sum(axis=1)) for x in b], axis=1)


def nearest(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray):
    """(number of the nearest entry, its squared distance) for each point, ties to the lower
    number; ``to_pivots`` and ``entry_pivots`` are distances to the same pivots."""
    n, size = len(points), len(entries)
    bound = np.zeros((n, size), np.float32)
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None].astype(np.float32) - entry_pivots[None, :, p].astype(np.float32)), out=bound)
    # the differences are rounded: a bound counts only as far as it is sure
    bound -= np.float32(2e-6) * np.float32(to_pivots.max(initial=0) + entry_pivots.max(initial=0) + 1)
    best, code = np.full(n, np.iinfo(np.int64).max), np.full(n, size, np.int64)
    left, count = np.arange(n), FIRST
    while len(left):
        now = bound[left]
        if count < size:
            near = np.argpartition(now, count - 1, axis=1)[:, :count]
            least = np.take_along_axis(now, near, axis=1)
        else:
            near, least = np.broadcast_to(np.arange(size), now.shape), now
        open_ = (least < np.inf) & (np.maximum(least, 0).astype(float) ** 2 <= best[left][:, None])
        row, place = np.nonzero(open_)
        if len(row):
            entry = near[row, place]
            away = points[left[row]] - entries[entry]
            away = np.einsum("ij,ij->i", away, away)
            order = np.lexsort((entry, away, row))
            row, entry, away = row[order], entry[order], away[order]
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            who = left[row[first]]
            better = (away[first] < best[who]) | ((away[first] == best[who]) & (entry[first] < code[who]))
            best[who[better]], code[who[better]] = away[first][better], entry[first][better]
        if count >= size:
            break
        bound[left[:, None], near] = np.inf  # met
        left = left[np.maximum(bound[left].min(axis=1), 0).astype(float) ** 2 <= best[left]]
        count = min(size, count * 8)
    return code, best


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _slices(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


class Codebooks:
    """One codebook and one set of pivots for each part position."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.pivots = entries, pivots  # (parts, entries or pivots, width)
        self.entry_pivots = [distances(e, p) for e, p in zip(entries, pivots)]

    def codes(self, part: pa.RecordBatch, points: str = "points", to_pivots: str = "to_pivots"):
        """(points, codes, squared distances), each with the part position second."""
        parts, _, width = self.entries.shape
        count = self.pivots.shape[1]
        whole = _matrix(part.column(part.schema.get_field_index(points)), parts * width, np.int64).reshape(-1, parts, width)
        away = _matrix(part.column(part.schema.get_field_index(to_pivots)), parts * count, np.float32).reshape(-1, parts, count)
        found = [nearest(whole[:, p], away[:, p], self.entries[p], self.entry_pivots[p]) for p in range(parts)]
        return whole, np.stack([x[0] for x in found], axis=1), np.stack([x[1] for x in found], axis=1)

    def moved(self, sums: list) -> "Codebooks":
        entries = self.entries.copy()
        for row in sums:
            entries[row["part"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(entries.shape[2])]
        return Codebooks(entries, self.pivots)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _sums(rows: DataFrame, books: Codebooks) -> list:
    """Sum and count of the parts at each entry: at most parts x entries rows."""
    parts, size, width = books.entries.shape

    def run(batches):
        count, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
        for part in _slices(batches):
            points, code, _ = books.codes(part)
            for p in range(parts):
                np.add.at(count[p], code[:, p], 1)
                np.add.at(total[p], code[:, p], points[:, p])
        p, e = np.nonzero(count)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), *[pa.array(total[p, e, i]) for i in range(width)]],
                names=["part", "entry", "n", *[f"s{i}" for i in range(width)]])

    sums = rows.mapInArrow(run, "part int, entry int, n long" + "".join(f", s{i} long" for i in range(width)))
    whole = [F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    return sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *whole).collect()


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
           pivots: int = PIVOTS) -> tuple[DataFrame, Codebooks | None]:
    """``vectors`` (vec_id, embedding, label) -> the rows (vec_id, label, codes array<int>, error)
    and the codebooks (None if no row takes part)."""
    frame = plain_columns(vectors, "vec_id", "embedding", "label").withColumn("embedding", F.col("embedding").cast("array<double>"))
    frame = frame.where(_valid(F.col("embedding")))
    kind = dict(frame.dtypes)["label"]
    schema = f"vec_id long, label {kind}, codes array<int>, error long"
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    start = frame.orderBy(*order).limit(1).collect()
    if not start:
        return frame.sparkSession.createDataFrame([], schema), None
    length = len(start[0]["embedding"])
    frame = frame.where(F.size("embedding") == length)
    width = -(-length // parts)
    first = frame.orderBy(*order).limit(entries).collect()

    def cut(values: np.ndarray) -> np.ndarray:
        whole = integers(values, scale)
        return np.pad(whole, ((0, 0), (0, parts * width - length))).reshape(len(whole), parts, width)

    book = cut(np.array([r["embedding"] for r in first])).transpose(1, 0, 2)
    fixed = np.stack([choose_pivots(e, pivots) for e in book])

    def place(batches):
        for part in _slices(batches):
            points = cut(_matrix(part.column(1), length, float))
            away = np.stack([distances(points[:, p], fixed[p]) for p in range(parts)], axis=1).astype(np.float32)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1] * x.shape[2]).cast(pa.list_(k))
                     for x, k in ((points.astype(np.int32), pa.int32()), (away, pa.float32()))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *lists], names=["vec_id", "label", "points", "to_pivots"])

    rows = stored(frame.mapInArrow(place, f"vec_id long, label {kind}, points array<int>, to_pivots array<float>"), "parts")
    books = Codebooks(book, fixed)
    for _ in range(rounds):
        books = books.moved(_sums(rows, books))

    def final(batches):
        for part in _slices(batches):
            _, code, away = books.codes(part)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(code.astype(np.int32).reshape(-1)), parts).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists, pa.array(away.sum(axis=1))], names=["vec_id", "label", "codes", "error"])

    return rows.mapInArrow(final, schema), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over equal labels (nulls are one label). A
    frequent label's rows stay where they are; the others meet their sums in a join."""
    sums = stored(coded.groupBy("label").agg(F.count("*").alias("n"), F.try_sum("error").alias("label_error"))
                  .select(F.col("label").alias("of"), "n", "label_error"), "labels")
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot, cold = sums.where(F.col("n") * HOT_SHARE > total).drop("n"), sums.where(F.col("n") * HOT_SHARE <= total).drop("n")
    same = F.col("label").eqNullSafe(F.col("of"))
    often = coded.join(F.broadcast(hot), same)
    rare = coded.join(F.broadcast(hot), same, "left_anti").join(cold, same)
    return often.union(rare).drop("of")


def code_string(codes: Column) -> Column:
    """Two lower-case hex digits for each part (entries below 256)."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
