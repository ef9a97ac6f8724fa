"""Near-duplicate documents by bottom-k sketches of their word shingles.

One hash function gives every shingle a number; a document's sketch is its ``K`` smallest ones
(all of them, for a small set). Documents of equal sets are one class. Inverted lists lead from
a retained value to the classes that retained it. Two sets at the asked similarity have at
least ``need`` retained values in common (exactly for small sets; for a cut sketch with
``SLACK`` below the expected share, more than six standard deviations), so they meet in a list
of one of the ``size - need + 1`` rarest values of both: only these lists are followed, and a
class with that many values of its own has no partner at all.

What the lists bring together is compared in tasks. A class meets the overlaps that the task's
own inverted lists count; the sketch of a pair's union estimates its similarity, and what
passes is confirmed on the full sets. No list is written out as pairs of its members: first
every member meets the list's smallest one; then lists whose members are not yet one component
are taken together by their smallest member, and those outside the largest component meet the
others, block by block; what becomes one in a task is not compared again. All links are united by ``components``.

Defined results: null or blank text has an empty set, links with nothing and is its own
component; fewer words than a shingle are one shingle; rows of equal id and different text are
told apart; a null id gets the component of the documents with an id that it is linked with,
else null, and is kept where it is null; repeated rows are returned each; an empty table gives
no rows; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_columns, steps, stored
from .components import components

#: Words of a shingle, least similarity in percent, values of a sketch, and by how many
#: hundredths the estimate of a pair that passes may be lower.
WIDTH, LEAST, K, SLACK = 4, 80, 64, 30
#: About how many shingles one side of a task holds, and how many members are met at once.
SIDE, TOGETHER = 1_000_000, 64
#: A value in more than this share of the sketches' values (a thousandth) is met by broadcast.
HOT_SHARE = 1_000

_TASK = ["least", "kind", "i", "j"]
_NONE = np.uint64((1 << 64) - 1)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The different shingles' hashes in ascending order (unsigned)."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh3_64_intdigest
    if len(words) <= width:
        return np.array([digest(joined)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - width + 1].tolist()
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(starts, ends[width - 1:].tolist())], np.uint64))


def need(size: int, k: int = K, least: int = LEAST, slack: int = SLACK) -> int:
    """Retained values that a sketch of ``size`` values shares at least with a partner's."""
    percent = least if 100 * size <= least * k else least - slack
    return max(1, -(-percent * size // 100))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in values])]), pa.int32()), pa.array(flat.view(np.int64)))


def _key(values: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(values.tobytes())
    return tuple(int.from_bytes(digest[i:i + 8], "big", signed=True) for i in (0, 8))


def with_sketches(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """(doc_id, n, hi, lo, sketch): size of the set, its 128-bit key, its ``k`` smallest hashes."""

    def run(batches):
        for part in steps(batches):
            n, hi, lo, sketches = [], [], [], []
            for text in part.column(1).to_pylist():
                values = shingle_set(text, width)
                key = _key(values)
                n.append(len(values)), hi.append(key[0]), lo.append(key[1]), sketches.append(values[:k])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), _lists(sketches)],
                                             names=["doc_id", "n", "hi", "lo", "sketch"])

    return plain_columns(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n long, hi long, lo long, sketch array<long>")


def rare_values(classes: DataFrame, k: int, least: int, slack: int) -> DataFrame:
    """``classes`` (node, sketch) -> (node, value): the values by which a class looks for partners.
    Only values of two classes or more, and only of classes that can have a partner."""
    values = classes.select("node", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    counts = stored(values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "values")
    total = classes.agg(F.sum(F.size("sketch"))).first()[0] or 0
    # a value of more than a thousandth of all retained ones: fewer than a thousand of them
    hot, cold = counts.where(F.col("df") * HOT_SHARE > total), counts.where(F.col("df") * HOT_SHARE <= total)
    shared = values.join(cold, "value").unionByName(values.join(F.broadcast(hot), "value"))
    of = shared.groupBy("node").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("seen"))
    percent = F.when(100 * F.col("size") <= least * k, least).otherwise(least - slack)
    followed = F.col("size") - F.greatest(F.lit(1), F.ceil(percent * F.col("size") / 100)) + 1  # the rarest ones
    own = F.col("size") - F.size("seen")  # come first: they are in no other class
    return (of.withColumn("left", (followed - own).cast("int")).where("left > 0")
            .select("node", F.explode(F.slice("seen", F.lit(1), F.col("left"))).alias("x")).select("node", F.col("x.value").alias("value")))


def _different_lists(values: DataFrame) -> DataFrame:
    """(value, node) -> (list, least, members, node): lists of two members or more, each set of
    members once, named by its smallest value."""
    about = values.groupBy("value").agg(F.count("*").alias("members"), F.min("node").alias("least"),
                                        *[F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"h{i}") for i in (0, 1)])
    chosen = about.where("members > 1").groupBy("members", "least", "h0", "h1").agg(F.min("value").alias("list"))
    return stored(values.join(chosen.select("list", "least", "members"), F.col("value") == F.col("list")).select("list", "least", "members", "node"), "lists")


def estimates(sketch: np.ndarray, others: list[np.ndarray], k: int) -> np.ndarray:
    """Similarity of one sketch to each of others, from the ``k`` smallest values of their unions."""
    rows = np.full((len(others), 2 * k), _NONE)
    rows[:, :len(sketch)] = sketch
    for i, other in enumerate(others):
        rows[i, k:k + len(other)] = other
    rows.sort(axis=1)
    twice = (rows[:, 1:] == rows[:, :-1]) & (rows[:, 1:] != _NONE)  # the value before is in both
    new = np.concatenate([np.ones((len(rows), 1), bool), ~twice], axis=1) & (rows != _NONE)
    place = np.cumsum(new, axis=1)
    return (twice & (place[:, 1:] <= k)).sum(axis=1) / np.minimum(place[:, -1], k)


def compare(sides: list[list[tuple]], k: int, least: int, slack: int) -> list[tuple[int, int]]:
    """Members (node, root, set) of two sides, or of one side if the second is empty -> links that
    join the same nodes as all pairs at the asked similarity would (members of one root are one)."""
    members = sides[0] + sides[1]
    one = not sides[1]
    from_ = 0 if one else len(sides[0])
    sets = [m[2] for m in members]
    label = np.unique([m[1] for m in members], return_inverse=True)[1]
    retained = [x[:k] for x in sets[from_:]]
    sizes = np.array([len(x) for x in retained])
    whole_sizes = np.array([len(x) for x in sets])
    needs = np.array([need(n, k, least, slack) for n in sizes.tolist()])
    flat = np.concatenate(retained)
    owner = np.repeat(np.arange(len(retained)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]  # inverted lists: a value's owners lie together
    links = []
    for a in range(len(members) if one else len(sides[0])):
        others = label[from_:] != label[a]
        if one:
            others[:a + 1] = False
        if not others.any():
            continue
        whole, sketch = sets[a], sets[a][:k]
        low, high = np.searchsorted(flat, sketch, "left"), np.searchsorted(flat, sketch, "right")
        run = high - low
        at = np.arange(run.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(run)[:-1]]), run)
        overlap = np.bincount(owner[at], minlength=len(retained))
        small, large = np.minimum(whole_sizes[from_:], len(whole)), np.maximum(whole_sizes[from_:], len(whole))
        near = np.flatnonzero(others & (overlap >= np.maximum(needs, need(len(sketch), k, least, slack))) & (100 * small >= least * large))
        for i in range(0, len(near), TOGETHER):
            some = near[i:i + TOGETHER]
            some = some[label[from_ + some] != label[a]]
            if not len(some):
                continue
            some = some[100 * estimates(sketch, [retained[b] for b in some], k) >= least - slack - 1e-6]
            if not len(some):
                continue
            sets_of = [sets[from_ + b] for b in some]
            values = np.concatenate(sets_of)
            found = np.minimum(np.searchsorted(whole, values), len(whole) - 1)
            counts = whole_sizes[from_ + some]
            same = np.add.reduceat((whole[found] == values).astype(np.int64), np.concatenate([[0], np.cumsum(counts)[:-1]]))
            for b in (from_ + some[100 * same >= least * (len(whole) + counts - same)]).tolist():
                if label[b] != label[a]:
                    links.append((members[a][0], members[b][0]))
                    label[label == label[b]] = label[a]
    return links


def _links(rows: DataFrame, sets: DataFrame, k: int, least: int, slack: int) -> DataFrame:
    """Tasks' members (least, kind, i, j, side, node, root) -> their links (u, v)."""

    def run(batches):
        now, sides = None, [[], []]
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:-1]]
            values, offsets = batch.columns[-1].values.to_numpy().view(np.uint64), batch.columns[-1].offsets.to_numpy()
            for x, (*task, side, node, root) in enumerate(zip(*columns)):
                if task != now:
                    yield from told(sides)
                    now, sides = task, [[], []]
                sides[side].append((node, root, values[offsets[x]:offsets[x + 1]].copy()))
        yield from told(sides)

    def told(sides):
        found = compare(sides, k, least, slack) if sides[0] else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    return (rows.join(sets, "node").select(*_TASK, "side", "node", "root", "values")
            .repartition(*_TASK).sortWithinPartitions(*_TASK).mapInArrow(run, "u long, v long"))


def _stars(lists: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every list member with the smallest one of the list: a task for each block of the members
    of all lists that have the same smallest one."""
    pairs = lists.where("node <> least").select("least", "node").distinct().join(sizes, "node")
    blocks = stored(pairs.groupBy("least").agg(F.ceil(F.sum("n") / SIDE).cast("int").alias("blocks")), "blocks")
    same = [F.col("least"), F.lit(0).alias("kind")]
    met = pairs.join(blocks, "least").select(*same, F.expr("cast(pmod(xxhash64(node), blocks) as int)").alias("i"), F.lit(0).alias("j"),
                                             F.lit(1).alias("side"), "node", F.col("node").alias("root"))
    # a block may have got no member: its smallest one then stays alone
    return met.union(blocks.select(*same, F.explode(F.expr("sequence(0, blocks - 1)")).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"),
                                   F.col("least").alias("node"), F.col("least").alias("root")))


def _rest(lists: DataFrame, sizes: DataFrame, roots: DataFrame) -> DataFrame:
    """Of lists of three members or more that are not yet one component, all with the same smallest
    member together: the largest component's blocks against the others' (kind 1), and the others'
    against one another (kind 2)."""
    known = lists.where("members > 2").join(roots, "node", "left").select("list", "least", "node", F.coalesce("root", "node").alias("root"))
    open_ = known.groupBy("list").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("list")
    known = stored(known.join(open_, "list", "left_semi").select("least", "node", "root").distinct().join(sizes, "node"), "open")
    about = known.groupBy("least", "root").agg(F.count("*").alias("members"), F.sum("n").alias("n"))
    main = (about.groupBy("least").agg(F.max(F.struct("members", "root", "n")).alias("m"), F.sum("n").alias("n"))
            .select("least", F.col("m.root").alias("main"), F.ceil(F.col("m.n") / SIDE).cast("int").alias("mains"),
                    F.ceil((F.col("n") - F.col("m.n")) / SIDE).cast("int").alias("rests")))
    both = known.join(main, "least").withColumn("at", F.expr("cast(pmod(xxhash64(node), if(root = main, mains, rests)) as int)"))
    inside, outside = both.where("root = main"), both.where("root <> main")
    out = inside.selectExpr("least", "1 as kind", "at as i", "explode(sequence(0, rests - 1)) as j", "0 as side", "node", "root")
    out = out.union(outside.selectExpr("least", "1 as kind", "explode(sequence(0, mains - 1)) as i", "at as j", "1 as side", "node", "root"))
    return out.union(outside.selectExpr("least as l", "root", "node", "at", "explode(sequence(0, rests - 1)) as to").selectExpr(
        "l as least", "2 as kind", "least(at, to) as i", "greatest(at, to) as j", "if(at <= to, 0, 1) as side", "node", "root"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, least: int = LEAST, k: int = K, slack: int = SLACK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable
    over pairs of ``least`` percent similarity or more), kept (the component's own document)."""
    texts = plain_columns(docs, "doc_id", "text")
    prints = stored(with_sketches(texts, width, k), "sketches")
    grouped = prints.where("n > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    lists = _different_lists(stored(rare_values(classes, k, least, slack), "rare"))
    wanted = classes.join(lists.select("node").distinct(), "node", "left_semi").select("node", "rep", "hi", "lo", "n")
    sets = _full_sets(texts, wanted, width)
    sizes = wanted.select("node", "n")
    links = stored(_links(_stars(lists, sizes), sets, k, least, slack), "links")
    more = _links(_rest(lists, sizes, stored(components(links), "united")), sets, k, least, slack)
    whole = stored(components(links.union(more)), "roots")
    roots = classes.join(whole, "node", "left").select("hi", "lo", "rep", F.coalesce("root", "node").alias("root"))
    ids = roots.groupBy("root").agg(F.min("rep").alias("component_id"))
    placed = prints.drop("sketch").join(roots.join(ids, "root").select("hi", "lo", "component_id"), ["hi", "lo"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = placed.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def _full_sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, values): the full set of each class asked for, from the text of its first document."""

    def run(batches):
        for part in steps(batches):
            nodes, sets = [], []
            for node, hi, lo, text in zip(*(c.to_pylist() for c in part.columns)):
                values = shingle_set(text, width)
                if _key(values) == (hi, lo):  # not another text of the same id
                    nodes.append(node), sets.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(sets)], names=["node", "values"])

    first = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep"))).select("node", "hi", "lo", "text")
    return stored(stored(first.mapInArrow(run, "node long, values array<long>"), "found").dropDuplicates(["node"]), "sets")
