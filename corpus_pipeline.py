"""A corpus pipeline: documents in, packed training sequences out.

Each stage reads what the one before has kept, and returns whole documents; the last returns the pieces of sequences.
Null texts count as empty. An empty table goes through all stages and gives no pieces.
"""

from __future__ import annotations

from clearbrook.llm import decontaminate, nearcopies, packing, quality, repeats
from clearbrook.llm.common import keep, read, ship


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go; their bands follow the labelled documents. Rows are judged one by one."""
    ship(spark)
    return quality.keep_quality(docs, quality.fit_bands(docs, read(spark, sf_dir, "labels")))


def line_dedup(spark, docs, sf_dir):
    """Later repetitions of passages go out of the texts; documents of which nothing is left go."""
    ship(spark)
    return repeats.drop_repeats(docs)


def near_dedup(spark, docs, sf_dir):
    """Of documents whose five-word shingles are similar by 0.8 or more, directly or over others, the one with the smallest
    id stays; rows without an id only where their whole group has none, and of rows equal in id and text one."""
    ship(spark)
    return nearcopies.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that contain an item of the benchmark go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark, docs, sf_dir):
    """One row per piece of the documents that are left, with its sequence and its place there."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination), ("packing", packed),
]

#: SQL has neither the compressor nor the tokenizer; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each one's rows are written and read back before the next begins."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
