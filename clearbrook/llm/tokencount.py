"""Token counts from a cache of digests.

A count belongs to a text and a tokenizer, so it is stored under the digests of both. Texts are reduced to one per
digest before anything is encoded, those with a stored count fall away, the rest are encoded and appended.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbrook.llm.common import ID, TEXT, texts
from clearbrook.llm.tokens import encoder, version
from clearbrook.session import scratch_path

TOKENIZER, LIMIT = "word_bpe_49k.json", 2048
CACHE_SCHEMA = "tokenizer string, digest binary, n_bytes bigint, n_tokens bigint"


def cached_counts(spark, cache: str) -> DataFrame:
    """The stored counts; none where the cache does not exist yet.

    Two jobs may have appended the same digest at the same time; equal rows are reduced to one when they are read.
    """
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def token_counts(docs: DataFrame, cache: str | None = None, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """One row per document: bytes, tokens, and whether there are more of them than ``limit``.

    Null texts count as empty and have no tokens. Equal texts are encoded once however many rows have them; a null id
    stays null. Without ``cache`` the counts go to a new folder. The only normalisation before the digest is null to
    empty, as any other could change what the library counts.
    """
    spark = docs.sparkSession
    cache = cache or scratch_path(spark, "token-cache")
    made_by = version(tokenizer)
    keyed = texts(docs).select(ID, TEXT, F.unhex(F.sha2(F.col(TEXT).cast("binary"), 256)).alias("digest"))

    # Partial aggregation reduces copies before the shuffle, so a text that a third of the rows share moves as one row
    # per task.
    distinct = keyed.groupBy("digest").agg(F.any_value(TEXT).alias(TEXT))
    known = cached_counts(spark, cache).where(F.col("tokenizer") == made_by)
    misses = distinct.join(known.select("digest"), "digest", "left_anti")
    schema = pa.schema([("tokenizer", pa.string()), ("digest", pa.binary()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def encode(batches):
        counter = encoder(tokenizer)
        for batch in batches:
            values = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([made_by] * len(values), pa.string()), batch.column(0).cast(pa.binary()),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) for t in values], pa.int64()),
                    pa.array([counter.count(t) for t in values], pa.int64()),
                ],
                schema=schema,
            )

    misses.select("digest", TEXT).mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)

    stored = cached_counts(spark, cache).where(F.col("tokenizer") == made_by)
    counts = stored.groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"))
    return (
        keyed.select(ID, "digest")
        .join(counts, "digest")
        .select(ID, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
