"""SimHash near-duplicates of a stated similarity: wide fingerprints, deletion-variant signatures, exact verification.

The 64 bits and two differing ones of :mod:`simhash` tell copies with very few changes apart from all else. At a similarity of 0.8 about
fifteen per cent of the bits differ, so here fingerprints are wider and the segments many: it is enough that one
segment of the fingerprint differs in at most one bit. Every segment is indexed with each of its bits left out, an equality
join finds fingerprints with a signature in common, and candidates are compared by their five-word shingles.

Signatures miss pairs, so two exact steps stand around them. Before them, texts that can have no near copy are left out:
of two similar sets a known number of the smallest hashes is the same, and who shares fewer with all others together has
none. After them, what they have not connected is joined over the rarest shingles: similar sets have one in common among so
many as may differ and one more. Pairs within what is connected already are not made.

Members of a signature are not paired with each other. All are compared with one of them; those that are not similar to
it go on among themselves, with the next four, then sixteen and so on, until no signature has two left. A signature that
a third of all fingerprints share costs one comparison for each of them as long as they are similar, and one whose
members are not takes rounds in proportion to the logarithm of their number.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbrook.llm.common import ID, TEXT, discard, keep, texts
from clearbrook.llm.components import components
from clearbrook.llm.repeats import word_hashes, word_places

SHINGLE, SIMILARITY = 5, 0.8
#: Segments of a fingerprint, and bits of a segment.
SEGMENTS, SEGMENT = 14, 30
BITS = SEGMENTS * SEGMENT
_FACTOR = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Members of a signature that the others are compared with in a round: so many times as many as in the one before, and at most.
GROWTH, CENTRES = 4, 1024
#: Products of a similarity and a number of shingles are taken as exact within this.
_ROUNDING = 1e-6
#: Shingles whose bits are counted at a time.
_BLOCK = 1 << 13


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different shingles: words between ASCII white space, A-Z lowered; fewer words are one shingle."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    words = word_hashes(raw, *word_places(raw))
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = total * np.uint64(_FACTOR) + words[k : k + len(total)]
    return np.unique(_mixed(total))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The majority of each bit over the shingles, as segments; all zero without shingles."""
    votes = np.zeros(64 * -(-BITS // 64), np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK]
        wide = np.stack([_mixed(part + np.uint64(_FACTOR * (k + 1) % (1 << 64))) for k in range(len(votes) // 64)], axis=1)
        votes += np.unpackbits(wide.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes[:BITS] > len(hashes)).reshape(SEGMENTS, SEGMENT)
    return bits @ (1 << np.arange(SEGMENT, dtype=np.int64))


def least_common(n: int, similarity: float) -> int:
    """Shingles that a set of ``n`` shares at least with any similar one, which has at least so many itself."""
    return math.ceil(similarity * n - _ROUNDING)


def lowest(n: int, similarity: float) -> tuple[int, int]:
    """How many of its smallest hashes a set of ``n`` shows, and how many of them it has in common with those of any similar set.

    At most ``spare`` hashes of a set are not in the other, so the first ``k`` that both have are among its first ``spare + k``.
    Each shows ``spare + spare + 1``; the smaller set has the smaller number.
    """
    spare = n - least_common(n, similarity)
    other = least_common(n, similarity)
    return 2 * spare + 1, other - least_common(other, similarity) + 1


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Id, text hash (``digest``) and segments of every document, and a hash of its shingles (``u``) that names their set.

    ``low`` are the set's smallest hashes, of which similar sets have ``need`` in common.
    """
    source = texts(docs).select(ID, TEXT, F.xxhash64(TEXT).alias("digest"))
    numbers = T.ArrayType(T.LongType())
    schema = T.StructType([
        source.schema[ID], source.schema["digest"], T.StructField("segments", numbers), T.StructField("u", T.LongType()),
        T.StructField("low", numbers), T.StructField("need", T.LongType()),
    ])

    def run(batches):
        for batch in batches:
            found = [shingles(t.as_py(), shingle) for t in batch.column(1)]
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *map(fingerprint, found)]))
            segments = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * SEGMENTS), flat)
            names = np.array([xxhash.xxh64_intdigest(f.tobytes()) for f in found], np.uint64).view(np.int64)
            shown = [lowest(len(f), similarity) if len(f) else (0, 0) for f in found]
            low = pa.array([f[:k].view(np.int64) for f, (k, _) in zip(found, shown)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), segments, pa.array(names), low, pa.array([k for _, k in shown], pa.int64())], names=schema.names
            )

    return source.mapInArrow(run, schema)


def _possible(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes that share enough of their smallest hashes with others to have a similar one among them."""
    shown = prints.select("u", F.explode("low").alias("hash"))
    common = shown.groupBy("hash").agg(F.min("u").alias("a"), F.max("u").alias("b")).where("a <> b").select("hash")
    # All documents of a node show the same hashes.
    counted = shown.join(common, "hash").groupBy("u").agg(F.count("*").alias("n"))
    return nodes.join(counted, "u").where("n >= need * copies").select("u", "segments", "first")


def signatures(nodes: DataFrame) -> DataFrame:
    """(key, u): every segment with each of its bits left out, beside the segment's and the bit's number."""
    parts = nodes.select("u", F.posexplode("segments").alias("at", "part"))
    slots = parts.select("u", "at", "part", F.explode(F.sequence(F.lit(0), F.lit(SEGMENT - 1))).alias("bit"))
    left = F.col("part").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))))
    slot = (F.col("at") * SEGMENT + F.col("bit")).cast("bigint")
    return slots.select(F.shiftleft(slot, SEGMENT).bitwiseOR(left).alias("key"), "u")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of keys that several have, with the smallest of them as ``p``. One shuffle, read twice."""
    dealt = rows.repartition("key")
    centres = dealt.groupBy("key").agg(F.min("u").alias("p"), F.count("*").alias("n")).where("n > 1").select("key", "p")
    return dealt.join(centres, "key").where("u <> p").withColumn("centre", F.lit(False))


def _paired(rows: DataFrame, centres: int) -> DataFrame:
    """Rows with each of the ``centres`` smallest of their key as ``p``, smaller ones only; and whether they are one."""
    place = F.row_number().over(Window.partitionBy("key").orderBy("u"))
    first = rows.withColumn("place", place).where(F.col("place") <= centres)
    chosen = first.groupBy("key").agg(F.collect_list("u").alias("chosen")).where(F.size("chosen") > 1)
    met = rows.join(chosen, "key").withColumn("centre", F.col("u") <= F.array_max("chosen"))
    return met.select("key", "u", F.explode(F.filter("chosen", lambda p: p < F.col("u"))).alias("p"), "centre")


def largest_distance(similarity: float) -> int:
    """Differing bits that two fingerprints of that similarity have at most, four deviations from what is expected."""
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(BITS * share + 4 * (BITS * share * (1 - share)) ** 0.5)


def shingle_sets(nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """``u`` and the shingles' hashes of each of the nodes, from the document that ``first`` names."""
    holders = nodes.select("u", F.col(f"first.{ID}").alias("id"), F.col("first.digest").alias("hash"))
    source = texts(docs).withColumn("digest", F.xxhash64(TEXT))
    held = source.join(holders, source[ID].eqNullSafe(holders["id"]) & (source["digest"] == holders["hash"]))
    schema = "u bigint, hashes array<bigint>"

    def run(batches):
        for batch in batches:
            found = [shingles(t.as_py(), shingle).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["u", "hashes"])

    # Rows that are equal in id and text have the same shingles; one of them is enough.
    return held.select("u", TEXT).mapInArrow(run, schema).dropDuplicates(["u"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (u, p, ...) whose shingles are as similar as asked for."""
    met = pairs.join(sets, "u").join(sets.withColumnsRenamed({"u": "p", "hashes": "others"}), "p")
    common = F.size(F.array_intersect("hashes", "others"))
    union = F.size("hashes") + F.size("others") - common
    return met.where(common >= similarity * union).select(*pairs.columns)


def similar(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (u, p) whose shingles are as similar as asked for, after a look at their fingerprints."""
    sides = [nodes.select(F.col("u").alias(c), F.col("segments").alias(f"{c}_segments")) for c in ("u", "p")]
    near = pairs.join(sides[0], "u").join(sides[1], "p")
    differing = F.aggregate(
        F.zip_with("u_segments", "p_segments", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, n: total + n
    )
    close = keep(near.where(differing <= largest_distance(similarity)).select("u", "p"), "close")
    verified = keep(_verified(close, sets, similarity), "verified")
    discard(close)
    return verified


def links(
    nodes: DataFrame, docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, sets: DataFrame | None = None
) -> DataFrame:
    """Pairs (u, v) of similar documents' nodes, enough to connect most of those that signatures bring together.

    ``sets`` has the shingles of all nodes, where they are there already.
    """
    sets = sets or keep(shingle_sets(nodes, docs, shingle), "shingles")
    rest, found, centres = keep(_shared(signatures(nodes)), "signatures"), None, 1
    while not rest.isEmpty():
        verified = similar(rest.select("u", "p").distinct(), nodes, sets, similarity)
        found = verified if found is None else found.unionByName(verified)
        hits = rest.join(verified.withColumn("hit", F.lit(True)), ["u", "p"], "left")
        others = hits.groupBy("key", "u").agg(F.max(F.coalesce("hit", F.lit(False)) | F.col("centre")).alias("done")).where("NOT done")
        centres = min(GROWTH * centres, CENTRES)
        before, rest = rest, keep(_paired(others.select("key", "u"), centres), "signatures")
        discard(before)
    if found is None:
        return rest.select("u", F.col("p").alias("v"))
    return found.select("u", F.col("p").alias("v")).distinct()


def _rarest(sets: DataFrame, similarity: float) -> DataFrame:
    """(u, n, keys): size and rarest shingles of each set that can have a similar one, by the others' shingles.

    Shingles are in the order of how many sets have them, then of their hashes. One at least is in common among the first that
    may differ and one more; those that no other set has come first and are no keys.
    """
    each = sets.select("u", F.size("hashes").alias("n"), F.explode("hashes").alias("key"))
    times = each.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    # A text's shingles are gathered, never a shingle's texts.
    shared = each.join(times, "key").groupBy("u", "n").agg(F.sort_array(F.collect_list(F.struct("times", "key"))).alias("shared"))
    spare = F.col("n") - F.ceil(F.col("n") * similarity - _ROUNDING)
    left = (spare + 1 - F.col("n") + F.size("shared")).cast("int")
    return shared.where(left > 0).select("u", "n", F.slice("shared.key", F.lit(1), left).alias("keys"))


def _unconnected(rarest: DataFrame, sets: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) of roots of which any two nodes are similar. Every such pair of nodes has a key in common."""
    rooted = rarest.join(roots, "u", "left").select("u", "n", F.coalesce("root", "u").alias("root"), F.explode("keys").alias("key"))
    rooted = keep(rooted, "rarest")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    met = rooted.join(mixed, "key")
    others = met.select("key", F.col("u").alias("p"), F.col("n").alias("p_n"), F.col("root").alias("p_root"))
    pairs = met.join(others, "key").where(F.col("root") < F.col("p_root"))
    pairs = pairs.where(F.least("n", "p_n") >= F.greatest("n", "p_n") * similarity - _ROUNDING).select("u", "p", "root", "p_root").distinct()
    found = keep(_verified(pairs, sets, similarity), "unconnected")
    discard(rooted)
    return found.select(F.col("root").alias("u"), F.col("p_root").alias("v")).distinct()


def keep_one(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group of near copies, with all its columns: the one with the smallest id and, of these, text hash.

    Groups are what similar pairs join directly or over others; all pairs count. Null and empty
    texts, and those of white space only, have no shingle and are copies of each other. A document without an id stays
    only where its whole group has none. Of rows equal in id and text one stays.
    """
    prints = keep(fingerprints(docs, shingle, similarity), "wide-fingerprints")
    first = F.min(F.struct(F.col(ID).isNull().alias("unnamed"), ID, "digest"))
    nodes = keep(
        prints.groupBy("u").agg(
            F.first("segments").alias("segments"), F.first("need").alias("need"), F.count("*").alias("copies"), first.alias("first")
        ),
        "nodes",
    )
    possible = keep(_possible(prints, nodes), "possible")
    sets = keep(shingle_sets(possible, docs, shingle), "shingles")
    rarest = keep(_rarest(sets, similarity), "rarest")
    near = keep(possible.join(rarest.select("u"), "u", "left_semi"), "possible")
    for table in (prints, possible):
        discard(table)
    roots = components(links(near, docs, shingle, similarity, sets))
    more = components(_unconnected(rarest, sets, roots, similarity)).withColumnsRenamed({"u": "over", "root": "top"})
    rooted = nodes.select("u", "first").join(roots, "u", "left").select("first", F.coalesce("root", "u").alias("over"))
    rooted = rooted.join(more, "over", "left").select("first", F.coalesce("top", "over").alias("root"))
    stay = rooted.groupBy("root").agg(F.min("first").alias("kept")).select(
        F.col(f"kept.{ID}").alias("id"), F.col("kept.digest").alias("hash")
    )
    digest = F.xxhash64(F.coalesce(docs[TEXT], F.lit("")))
    kept = docs.join(stay, docs[ID].eqNullSafe(stay["id"]) & (digest == stay["hash"]), "left_semi")
    return kept.dropDuplicates([ID, TEXT])
