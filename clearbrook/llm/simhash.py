"""SimHash near-duplicates by deletion-variant signatures.

A document's fingerprint is the bitwise majority over the hashes of its word shingles. Fingerprints link at no more
than two differing bits. Cut into two halves, one half of a linked pair differs in at most one bit, so it is enough to
index every half with each of its bits left out: a linked pair shares at least one such signature, and an equality
join finds it. Copies are reduced to one row per fingerprint first.

A signature that very many different fingerprints share is not joined with itself. Its members get one-bit variants of
the whole fingerprint instead: two of them link exactly if they have a variant in common, at most 65 fingerprints share
one, and all that share one link with each other, so a star to the smallest of them keeps every link's connection.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbrook.llm.common import ID, TEXT, discard, keep, texts
from clearbrook.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Signatures with more fingerprints than this go by one-bit variants instead of pairs; either way finds all links.
PAIRED = 16
_BLOCK = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        starts, stops = [0], [len(joined)]
    else:
        starts = [0, *(ends[: -shingle] + 1).tolist()]
        stops = ends[shingle - 1 :].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _BLOCK], stops[at : at + _BLOCK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Id, text hash (``digest``) and fingerprint (``fp``, a signed 64-bit number) of every document."""
    source = texts(docs).select(ID, TEXT, F.xxhash64(TEXT).alias("digest"))

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found)], names=[ID, "digest", "fp"])

    return source.mapInArrow(run, T.StructType([source.schema[ID], source.schema["digest"], T.StructField("fp", T.LongType())]))


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS


def links(prints: DataFrame) -> DataFrame:
    """Pairs (u, v) of different fingerprints, enough to connect all that are linked directly or over others.

    ``prints`` has each fingerprint once, in ``fp``.
    """
    bit = F.col("slot") % 32
    half = F.when(F.col("slot") < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    index = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("slot")).select(
        "fp", F.expr("shiftleft(cast(slot as bigint), 32)").bitwiseOR(
            half.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)))
        ).alias("key"),
    )
    # One shuffle of the index; only signatures that at least two fingerprints share go on, which are few.
    counted = index.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")
    members = keep(counted, "signatures")
    few = members.where(F.col("n") <= PAIRED).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("all"))
    pairs = few.select(F.col("all"), F.posexplode("all").alias("at", "u")).select(
        "u", F.explode(F.expr("slice(all, at + 2, size(all))")).alias("v")
    )
    many = members.where(F.col("n") > PAIRED).select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit((1 << k) - (1 << 64 if k == 63 else 0)) for k in range(64)])
    variants = many.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    centres = variants.groupBy("variant").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1")
    stars = variants.join(centres, "variant").select("u", F.col("fp").alias("v"))
    found = pairs.union(stars).where((F.col("u") != F.col("v")) & _near("u", "v")).distinct()
    found = keep(found, "links")
    discard(members)
    return found


def _classes(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all documents, and the component of each fingerprint with the row that stands for it."""
    prints = keep(fingerprints(docs, shingle), "fingerprints")
    first = F.min(F.struct(F.col(ID).isNull().alias("unnamed"), ID, "digest"))
    nodes = keep(prints.groupBy("fp").agg(first.alias("first")), "nodes")
    roots = components(links(nodes.select("fp"))).withColumnRenamed("u", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return prints, rooted.join(rooted.groupBy("root").agg(F.min("first").alias("kept")), "root").select("fp", "kept")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: its fingerprint, and the smallest id of all that it reaches over links, itself included.

    Null and empty texts, and those of white space only, have fingerprint zero and are linked like any other. Rows with
    equal texts share a fingerprint and so a component. A null id stays null and never names a component, unless all
    ids of the component are null.
    """
    prints, classes = _classes(docs, shingle)
    written = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return prints.join(classes, "fp").select(ID, written.alias("fingerprint"), F.col(f"kept.{ID}").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id and, of these, text hash.

    A document without an id stays only where its whole component has none. Of rows equal in id and text one stays.
    """
    _, classes = _classes(docs, shingle)
    stay = classes.select(F.col(f"kept.{ID}").alias("id"), F.col("kept.digest").alias("hash")).distinct()
    digest = F.xxhash64(F.coalesce(docs[TEXT], F.lit("")))
    kept = docs.join(stay, docs[ID].eqNullSafe(stay["id"]) & (digest == stay["hash"]), "left_semi")
    return kept.dropDuplicates([ID, TEXT])
