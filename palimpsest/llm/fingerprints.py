"""SimHash document fingerprints with DataFrame functions only.

A document's terms are its pairs of neighbouring words (a lone word is a term), weighted by
how often they occur. Each term's 64-bit hash votes on every bit, its weight for or against;
the signs of the sums are the fingerprint. The sums of two bits travel in one long: a
document's votes are 32 sums that are aggregated before they are shuffled.

``within`` finds all fingerprints within a Hamming radius through permuted block tables: of
``radius`` + 2 blocks of the 64 bits, two codes that differ in at most ``radius`` bits agree
in at least two, so each table is keyed by one pair of blocks and only rows with equal keys
are compared.

Defined results: null text counts as empty; a text without words has fingerprint zero and
likeness 1 to another such text; documents of equal id and text are returned each; of
different texts under one id the one with the smaller hash stands for the id as next
document; null ids come last in descending order and are all but one document for that
purpose; a single document is its own next one; an empty table gives no rows."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import plain_columns, stored

_LOW = 0x0000000100000001


def words(text: Column) -> Column:
    """Array of the words between blanks, tabs and line feeds."""
    spaced = F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def pairs(word: Column) -> Column:
    """Array of each word with the next one; of a lone word with nothing."""
    n = F.size(word)
    return F.arrays_zip(F.slice(word, 1, F.greatest(n - 1, F.least(n, F.lit(1)))).alias("a"),
                        F.slice(word, 2, F.greatest(n - 1, F.lit(0))).alias("b"))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``texts`` (keys, text) -> (keys, fp long): one row for each different key."""
    # the words are a column of their own, so that they are split once
    exploded = texts.select(*keys, words(F.col("text")).alias("_w")).select(*keys, F.explode_outer(pairs(F.col("_w"))).alias("t"))
    voted = exploded.select(*keys, F.when(F.col("t").isNotNull(), F.xxhash64("t.a", "t.b")).alias("_h"))
    sums = [F.sum(F.shiftrightunsigned("_h", j).bitwiseAND(F.lit(_LOW))).alias(f"s{j}") for j in range(32)]
    votes = voted.groupBy(*keys).agg(F.count("_h").alias("_n"), *sums)
    fp = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"s{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"s{j}", 32)
        fp = fp.bitwiseOR(F.when(low * 2 > F.col("_n"), F.lit(1 << j)).otherwise(F.lit(0).cast("long")))
        bit = 1 << (j + 32)
        fp = fp.bitwiseOR(F.when(high * 2 > F.col("_n"), F.lit(bit if bit < 1 << 63 else bit - (1 << 64))).otherwise(F.lit(0).cast("long")))
    return votes.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _tables(fp: Column, radius: int) -> Column:
    """Keys of the permuted tables: for each pair of blocks its number and the bits in it."""
    blocks = radius + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, pair in enumerate(combinations(range(blocks), 2)):
        mask = 0
        for i in pair:
            mask |= ((1 << (edges[i + 1] - edges[i])) - 1) << edges[i]
        mask = mask if mask < 1 << 63 else mask - (1 << 64)
        keys.append(F.struct(F.lit(number).alias("table"), fp.bitwiseAND(F.lit(mask).cast("long")).alias("bits")))
    return F.explode(F.array(*keys))


def within(queries: DataFrame, codes: DataFrame, radius: int = 3) -> DataFrame:
    """``queries`` (fp) and ``codes`` (fp), each without repeats -> (fp, other): all codes
    that differ from a query in at most ``radius`` bits."""
    left = queries.select("fp", _tables(F.col("fp"), radius).alias("k")).select("fp", "k.*")
    right = codes.select(F.col("fp").alias("other"), _tables(F.col("fp"), radius).alias("k")).select("other", "k.*")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius
    return left.join(right, ["table", "bits"]).where(near).select("fp", "other").distinct()


def next_ids(ids: DataFrame) -> DataFrame:
    """``ids`` (k long, without repeats) -> (k, next): the next smaller one, for the smallest
    the largest. Ranges of ids are numbered by Spark's range partitions; one row for each
    range tells what comes after it."""
    ranged = stored(ids.repartitionByRange("k").withColumn("range", F.spark_partition_id()), "ids")
    inside = ranged.withColumn("next", F.lag("k").over(Window.partitionBy("range").orderBy("k")))
    tops = ranged.groupBy("range").agg(F.max("k").alias("top"))
    w = Window.orderBy("range")
    tops = tops.select("range", F.coalesce(F.lag("top").over(w), F.max("top").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("below"))
    return inside.join(F.broadcast(tops), "range").select("k", F.coalesce("next", "below").alias("next"))


def edited_likeness(docs: DataFrame, radius: int = 3, every: int = 20) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next and, for documents whose id is divisible by
    ``every``, n_within: how many other documents lie within ``radius`` bits."""
    smallest = -(1 << 63)
    base = plain_columns(docs, "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(smallest)).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.select("k", F.xxhash64("text").alias("h"), F.char_length("text").cast("long").alias("n"), "text")
    prints = stored(fingerprints(base.select("k", "h", "n", "text"), ["k", "h", "n"]), "prints")
    copies = base.groupBy("k", "h").agg(F.count("*").alias("copies"))
    first = prints.groupBy("k").agg(F.min("h").alias("h"), F.min_by("fp", "h").alias("fp"), F.max(F.floor(F.col("n") / 2)).alias("need"))
    after = next_ids(prints.select("k").distinct())
    first = first.join(after, "k")
    wanted = first.select(F.col("k").alias("for"), F.col("next").alias("k"), "need").join(
        first.select("k", "h", F.col("fp").alias("next_fp")), "k")
    # both joins read the texts dealt by k, in the same columns, so that they are shuffled once
    dealt = base.select("k", "h", "n", "text")
    source = wanted.select("k", F.col("for"), F.col("h").alias("of"), "need", "next_fp")
    heads = (dealt.join(source, "k").where(F.col("h").bitwiseXOR(F.col("of")) == 0)
             .select(F.col("for").alias("k"), F.expr("substring(text, 1, cast(least(need, n) as int))").alias("head"), "next_fp"))
    edited = dealt.join(heads, "k").select(
        "k", "h", "n", "next_fp",
        F.concat(F.expr("substring(text, 1, cast(n - floor(n / 2) as int))"),
                 F.expr("substring(head, 1, cast(floor(n / 2) as int))")).alias("text"))
    edited = edited.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    changed = fingerprints(edited, ["k", "h", "next_fp", "sha"]).select("k", "h", "next_fp", "sha", F.col("fp").alias("edited_fp"))
    classes = prints.join(copies, ["k", "h"]).groupBy("fp").agg(F.sum("copies").alias("copies"))
    asked = prints.where((F.col("k") != smallest) & (F.col("k") % every == 0)).select("fp").distinct()
    near = (within(asked, classes.select("fp"), radius).join(classes.select(F.col("fp").alias("other"), "copies"), "other")
            .groupBy("fp").agg((F.sum("copies") - 1).alias("n_within")))
    out = prints.join(changed, ["k", "h"]).join(copies, ["k", "h"]).join(near, "fp", "left")
    asked_for = (F.col("k") != smallest) & (F.col("k") % every == 0)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        F.when(F.col("k") != smallest, F.col("k")).alias("doc_id"), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(asked_for, F.col("n_within")).alias("n_within"))
