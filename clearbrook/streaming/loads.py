from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clearbrook.fixed_values import KEYS
from clearbrook.operators.contracts import new_rows, sales_rules


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table as a stream, under the schema the batch reader sees."""
    path = f"{folder.rstrip('/')}/{name}.parque"
    # A stream wants a pattern where the path is a file; this one matches the table alone.
    return spark.readStream.schema(spark.read.parquet(f"{path}t").schema).parquet(f"{path}[t]")


def dedupe_stream(
    stream: DataFrame, event_time: str, keys: Sequence[str] = KEYS, delay: str = "2 days"
) -> DataFrame:
    """First row per key within the watermark; older state is forgotten.

    Rows that come later than the watermark allows, and rows without an event
    time, are lost.  Where every row has to arrive, use
    :func:`start_dedupe_stream`, which keeps no state to forget.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def _with_place(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("load", T.StringType()), T.StructField("batch", T.LongType())])


def start_contract_stream(
    stream: DataFrame, target: str, rejected: str | None, checkpoint: str,
    rules: Mapping[str, Column] | None = None, keys: Sequence[str] = KEYS, day: str | None = "date_parsed",
    order: str | Sequence[Column] = "payload",
) -> StreamingQuery:
    """Append good new rows to ``target``, set rows that break a rule aside.

    Each micro-batch goes to a folder of its own, named by the checkpoint and
    the batch number: a batch that runs again after a failure replaces what it
    wrote the first time, and streams with other checkpoints write beside it.
    Keys that any other batch has loaded are skipped.  Below a batch's folder
    rows lie by ``day``, a part of the key, so that a later batch opens only
    the files of the days it has rows for.  Late rows are rows like any other.
    """
    rules = sales_rules() if rules is None else rules
    load_id = f"load-{hashlib.md5(checkpoint.encode()).hexdigest()}"

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]).cast("array<string>"))
        judged = batch.withColumn("broken_rules", broken).persist()
        try:
            place = f"load={load_id}/batch={number}"
            if rejected:
                judged.where(F.size("broken_rules") > 0).write.mode("overwrite").parquet(f"{rejected}/{place}")
            good = judged.where(F.size("broken_rules") == 0).drop("broken_rules")
            try:
                this_batch = (F.col("load") == load_id) & (F.col("batch") == number)
                loaded = spark.read.schema(_with_place(batch.schema)).parquet(target).where(~this_batch)
            except AnalysisException as problem:
                if problem.getCondition() != "PATH_NOT_FOUND":
                    raise
                good_new = new_rows(good.limit(0), good, keys, day, order)
            else:
                good_new = new_rows(loaded, good, keys, day, order)
            writer = good_new.write.mode("overwrite")
            (writer.partitionBy(day) if day else writer).parquet(f"{target}/{place}")
        finally:
            judged.unpersist()

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_dedupe_stream(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str] = KEYS, day: str | None = "date_parsed"
) -> StreamingQuery:
    """One row per key over the whole stream, in whatever order rows arrive; as many as in one batch."""
    return start_contract_stream(stream, target, None, checkpoint, {}, keys, day, "any")
