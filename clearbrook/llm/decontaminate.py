"""Benchmark decontamination by SimHash windows.

Texts and benchmark items become shingles of five words. A window is as many shingles of a text as an item has.
Windows that share enough shingles with an item get a SimHash fingerprint, and a multi-index over blocks of its bits
finds all items of that size within a Hamming distance: with one block more than differing bits, one block is equal.
What the index finds is verified by the exact weighted similarity of the shingles, which count as often as they occur.

Which windows are worth a fingerprint follows from the similarity: a window that reaches ``SIMILARITY`` contains that
share of the item's shingles, and moving it on to the first of these never makes it less similar. So only windows that
begin with a shingle of the item and hold enough of them are built; none that counts is left out. Everything is
built-in functions; copies of a text are handled once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.llm.common import ID, TEXT, discard, keep, texts

WORDS, SIMILARITY = 5, 0.8
#: Fingerprints up to this many differing bits are found. Windows at the least similarity differ in 9.7 of 64 bits on
#: average with a deviation of 2.9, so the bound lies more than four deviations beyond.
RADIUS = 23
#: Benchmark shingles that are broadcast at a time (16 bytes each); a larger benchmark is searched in several blocks.
BROADCAST = 1_000_000
ITEM = "item_id"


def shingles(text: Column) -> Column:
    """Hashes of the word shingles of a text: words are runs of letters and digits, in lower case.

    A text of fewer words than a shingle has is one shingle; a text without words has none.
    """
    words = F.filter(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), lambda w: w != "")
    return F.transform(F.array(words), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (WORDS - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, WORDS)))
    ))[0]


def simhash(frame: DataFrame, key: list[str], hashes: str) -> DataFrame:
    """The key columns and ``print``: bit by bit the majority over an array of hashes that every row has.

    Sixteen sums of four counters of sixteen bits each count all 64 bits, so a row of numbers is added per hash instead
    of 64. Arrays of more than 65,535 hashes are counted in parts.
    """
    lane = 0x0001000100010001
    part = 1 << 15
    parts = frame.select(*key, F.posexplode(hashes).alias("nth", "hash")).select(*key, F.floor(F.col("nth") / part).alias("part"), "hash")
    sums = parts.groupBy(*key, "part").agg(
        F.count("*").alias("n"), *[F.sum(F.shiftrightunsigned("hash", j).bitwiseAND(F.lit(lane))).alias(f"s{j}") for j in range(16)]
    )
    votes = sums.groupBy(*key).agg(
        F.sum("n").alias("n"),
        *[F.sum(F.shiftrightunsigned(f"s{j}", 16 * k).bitwiseAND(F.lit(0xFFFF))).alias(f"v{16 * k + j}") for j in range(16) for k in range(4)],
    )
    bits = [F.when(2 * F.col(f"v{b}") > F.col("n"), F.lit((1 << b) - (1 << 64 if b == 63 else 0))).otherwise(F.lit(0)) for b in range(64)]
    whole = bits[0]
    for bit in bits[1:]:
        whole = whole.bitwiseOR(bit)
    return votes.select(*key, whole.cast("bigint").alias("print"))


def blocks(prints: DataFrame) -> DataFrame:
    """The rows with each block of their fingerprint: number and value."""
    edges = [64 * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    values = F.array(*[
        F.shiftrightunsigned("print", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])
    ])
    return prints.select("*", F.posexplode(values).alias("block", "value"))


def _anchors(docs: DataFrame, index: DataFrame) -> DataFrame:
    """(key, item_id, starts): where windows begin that hold enough of the item's shingles."""
    places = docs.select("key", F.posexplode(shingles(F.col(TEXT))).alias("at", "hash"))
    rows = index.count()
    turns = max(1, math.ceil(rows / BROADCAST))
    found = None
    for turn in range(turns):
        some = index if turns == 1 else index.where(F.pmod(F.xxhash64(ITEM), F.lit(turns)) == turn)
        hits = places.join(F.broadcast(some), "hash").select("key", "at", ITEM, "size")
        found = hits if found is None else found.union(hits)
    enough = F.ceil(F.col("size") * SIMILARITY - 1e-9).cast("int")
    # collect_set: rows of equal texts are one
    grouped = found.groupBy("key", ITEM, "size").agg(F.sort_array(F.collect_set("at")).alias("all"))
    starts = F.filter(
        F.transform("all", lambda at, i: F.when(F.get("all", i + enough - 1) < at + F.col("size"), at)), lambda at: at.isNotNull()
    )
    return grouped.where(F.size("all") >= enough).select("key", ITEM, "size", starts.alias("starts")).where(F.size("starts") > 0)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, at, similarity): windows of texts, named by the hash of the text, that are at least similar enough.

    ``at`` is the window's first shingle, from 0.
    """
    items = benchmark.select(ITEM, shingles(F.coalesce(benchmark[TEXT], F.lit(""))).alias("hashes")).where(F.size("hashes") > 0)
    items = keep(items.dropDuplicates([ITEM, "hashes"]).select(ITEM, F.size("hashes").alias("size"), "hashes"), "items")
    index = keep(items.select(F.explode(F.array_distinct("hashes")).alias("hash"), ITEM, "size").distinct(), "index")

    source = docs.select(F.xxhash64(TEXT).alias("key"), TEXT)
    anchors = keep(_anchors(source, index), "anchors")
    # The texts of anchors only. Texts are shuffled at every size: their keys may be few here and a third of all there.
    sized = anchors.groupBy("key").agg(F.collect_set(F.struct("size", "starts")).alias("wanted"))
    chosen = source.join(sized.hint("merge"), "key").dropDuplicates(["key"]).select("key", shingles(F.col(TEXT)).alias("hashes"), "wanted")
    windows = (
        chosen.select("key", "hashes", F.explode("wanted").alias("w")).select("key", "hashes", "w.size", F.explode("w.starts").alias("at"))
        .select("key", "size", "at", F.slice("hashes", F.col("at") + 1, F.col("size")).alias("window")).dropDuplicates(["key", "size", "at"])
    )
    windows = keep(windows, "windows")

    prints = blocks(simhash(windows, ["key", "size", "at"], "window"))
    listed = blocks(simhash(items, [ITEM, "size"], "hashes")).withColumnRenamed("print", "item_print")
    near = (
        prints.join(listed, ["size", "block", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("key", "size", "at", ITEM).distinct()
    )
    pairs = near.join(windows, ["key", "size", "at"]).join(items.select(ITEM, "size", F.col("hashes").alias("item")), [ITEM, "size"])
    # Each shingle's weight is how often it occurs: the overlap is the sum of the smaller weights.
    common = F.array_intersect("window", "item")

    def times(of: str, hash_: Column) -> Column:
        return F.size(F.filter(of, lambda x: x == hash_))

    overlap = F.aggregate(common, F.lit(0), lambda s, h: s + F.least(times("window", h), times("item", h)))
    scored = pairs.select("key", ITEM, "at", F.size("window").alias("n"), F.size("item").alias("m"), overlap.alias("overlap"))
    return scored.select("key", ITEM, "at", (F.col("overlap") / (F.col("n") + F.col("m") - F.col("overlap"))).alias("similarity")).where(F.col("similarity") >= SIMILARITY)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_ids, similarity) of the texts that contain an item: all their items, and the best similarity."""
    found = contaminations(docs, benchmark)
    return keep(found.groupBy("key").agg(F.sort_array(F.collect_set(ITEM)).alias("item_ids"), F.max("similarity").alias("similarity")), "contaminated")


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: whether it contains a benchmark item, which ones (comma-joined), and how similar.

    Null and empty texts and items, and those without letters and digits, contain nothing and are contained in
    nothing. An item of fewer than five words is only found in documents of exactly these words. Equal texts get the
    same finding, a null id stays null, items of equal text are all named. Other columns are not read.
    """
    source = texts(docs)
    found = contaminated(source, benchmark)
    keyed = source.select(ID, F.xxhash64(TEXT).alias("key"))
    return keyed.join(found, "key", "left").select(
        ID, F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce(F.size("item_ids"), F.lit(0)).alias("n_items"),
        F.coalesce(F.array_join(F.transform("item_ids", lambda i: i.cast("string")), ","), F.lit("")).alias("item_ids"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns."""
    found = contaminated(texts(docs), benchmark).select(F.col("key").alias("__key"))
    return docs.join(found.hint("merge"), F.xxhash64(F.coalesce(docs[TEXT], F.lit(""))) == found["__key"], "left_anti")
