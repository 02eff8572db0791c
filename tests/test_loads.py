"""Contracts and repeatable loads, in batch and on streams."""

import pytest
from pyspark.sql import functions as F

from clearbrook.operators.contracts import ContractViolation, contract_violations, enforce_contract, idempotent_append
from clearbrook.streaming import dedupe_stream, start_contract_stream, start_dedupe_stream, stream_table

GOOD = ("2025-07-01", "S", "P", 1.0, 1, "C", "online", "Online")


def test_contract_counts_and_raises(sales):
    fine = sales(("1", *GOOD), ("2", *GOOD))
    assert all(r["holds"] for r in contract_violations(fine).collect())
    enforce_contract(fine)
    broken = sales(("1", *GOOD), ("1", *GOOD), ("3", None, "S", "P", 0.0, None, "C", None, None))
    counts = {r["rule"]: r["violations"] for r in contract_violations(broken).collect()}
    assert counts == {"date_missing": 1, "label_off_domain": 1, "price_not_positive": 1, "quantity_not_positive": 1, "duplicate_keys": 1}
    with pytest.raises(ContractViolation, match="duplicate_keys: 1"):
        enforce_contract(broken)
    enforce_contract(broken, {"no_store": F.col("store_id").isNull()}, keys=None)


def test_append_twice_changes_nothing(sales):
    existing = sales(("1", *GOOD))
    batch = sales(("1", *GOOD), ("2", *GOOD), ("2", *GOOD), (None, *GOOD))
    once = idempotent_append(existing, batch)
    assert sorted((r["order_id"] or "") for r in once.collect()) == ["", "1", "2"]
    complete = batch.where("order_id is not null")
    twice = idempotent_append(idempotent_append(existing, complete), complete)
    assert sorted(r["order_id"] for r in twice.collect()) == ["1", "2"]


def written_in_parts(frame, path, column):
    """One file per value, in order, for one file per micro-batch."""
    for i, value in enumerate(sorted(r[0] for r in frame.select(column).distinct().collect())):
        frame.where(F.col(column) == value).coalesce(1).write.parquet(f"{path}/sales.parquet{i}")


def one_file_per_batch(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/sales.parquet*")


def test_stream_contract_over_batches(spark, sales, tmp_path):
    frame = sales(
        ("1", *GOOD), ("1", *GOOD), ("2", "2025-07-01", "S", "P", -1.0, 1, "C", "online", "Online"),
        ("1", *GOOD), ("3", *GOOD),
    ).withColumn("part", F.when(F.col("order_id") == "3", 1).otherwise(0))
    frame = frame.unionByName(frame.where("order_id = '1'").limit(1).withColumn("part", F.lit(1)))
    written_in_parts(frame, str(tmp_path / "in"), "part")
    stream = one_file_per_batch(spark, tmp_path / "in", frame.schema)
    out, bad, state = (str(tmp_path / d) for d in ("out", "bad", "state"))
    run = start_contract_stream(stream, out, bad, state)
    run.awaitTermination()
    loaded = sorted((r["batch"], r["order_id"]) for r in spark.read.parquet(out).collect())
    assert loaded == [(0, "1"), (1, "3")]
    # The same stream from a new checkpoint finds every key loaded and overwrites nothing.
    start_contract_stream(stream, out, bad, str(tmp_path / "other state")).awaitTermination()
    again = sorted((r["batch"], r["order_id"]) for r in spark.read.parquet(out).collect())
    assert again == loaded
    rejected = spark.read.parquet(bad).where("batch = 0").limit(1).collect()
    assert [(r["order_id"], r["broken_rules"]) for r in rejected] == [("2", ["price_not_positive"])]


def test_stream_dedupe_over_batches(spark, sales, tmp_path):
    frame = sales(("1", *GOOD), ("2", *GOOD)).withColumn("part", F.lit(0))
    frame = frame.unionByName(sales(("2", *GOOD), ("3", *GOOD)).withColumn("part", F.lit(1)))
    written_in_parts(frame, str(tmp_path / "in"), "part")
    stream = one_file_per_batch(spark, tmp_path / "in", frame.schema).withColumn("t", F.col("date_parsed").cast("timestamp"))
    unique = dedupe_stream(stream, "t").select("order_id")
    run = (
        unique.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3"]


def test_stream_table_has_the_batch_schema(spark, folder):
    stream = stream_table(spark, folder, "events")
    assert stream.isStreaming and stream.columns == spark.read.parquet(f"{folder}/events.parquet").columns


def test_rows_with_incomplete_keys_are_known_by_their_content(sales):
    batch = sales((None, *GOOD), (None, *GOOD), ("5", None, "S", "P", 1.0), (None, None, "S"), (None, None, "T"), ("6", *GOOD))
    empty = batch.limit(0)
    once = idempotent_append(empty, batch)
    assert once.count() == 5
    assert sorted(map(str, idempotent_append(once, batch).collect())) == sorted(map(str, once.collect()))


def test_streams_lose_no_late_row(spark, sales, tmp_path):
    days = ["2025-07-20", "2025-07-01", "2025-07-02", None, "2025-07-20", None]
    frame = sales(*[(str(i % 4), d, "S", "P", 1.0) for i, d in enumerate(days)]).repartition(1)
    with_part = frame.withColumn("part", F.monotonically_increasing_id())
    written_in_parts(with_part, str(tmp_path / "in"), "part")
    stream = one_file_per_batch(spark, tmp_path / "in", with_part.schema).drop("part")
    start_dedupe_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.schema(frame.schema).parquet(str(tmp_path / "out"))
    assert sorted(map(str, found.select("order_id", "date_parsed").collect())) == sorted(map(str, frame.select("order_id", "date_parsed").distinct().collect()))


def test_a_table_is_streamed_without_its_neighbours(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet").limit(5)
    events.write.parquet(f"{tmp_path}/events.parquet")
    events.write.parquet(f"{tmp_path}/events.parquet_backup")
    query = stream_table(spark, str(tmp_path), "events").writeStream.format("memory").queryName("alone").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("alone").count() == 5
    spark.catalog.dropTempView("alone")
