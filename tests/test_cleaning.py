import datetime

import pytest
from pyspark.sql import functions as F

from clearbrook.operators.clean import AGENT_RULES, LEGACY_RULES, audit_flag_totals, clean, with_rules
from clearbrook.operators.dedupe import dedupe
from clearbrook.operators.profile import (
    baseline_checks, duplicate_estimate, duplicate_groups, duplicate_summary, label_column, metrics_nonnull_price,
    stack_metrics, table_metrics,
)
from clearbrook.sources.sales import sales_raw, sales_staged

D = "2025-07-01"


def test_incomplete_keys_count_as_duplicates_but_collapse(sales):
    frame = sales((None, D, "S1"), (None, D, "S2"), ("1", None), ("2", D), ("2", D))
    row = duplicate_estimate(frame, null_keys=True).first()
    assert (row["dup_est"], row["n_null_key"]) == (4, 3)
    groups = {(r["order_id"], r["cnt"]) for r in duplicate_groups(frame).collect()}
    assert groups == {(None, 2), ("2", 2)}
    assert tuple(duplicate_summary(frame).first()) == (2, 4)
    assert dedupe(frame).count() == 3
    assert dedupe(frame, null_keys="keep").count() == 4
    assert dedupe(frame, order="any").count() == 3


def test_survivor_is_the_first_by_content_nulls_last(sales):
    frame = sales(
        ("1", D, None, "P1"), ("1", D, "S2", "P1"), ("1", D, "S1", None), ("1", D, "S1", "P2", 5.0),
        ("1", D, "S1", "P2", None), ("1", D, "S1", "P2", -1.0),
    )
    row = dedupe(frame).first()
    assert (row["store_id"], row["product_id"], row["unit_price"]) == ("S1", "P2", -1.0)
    # A missing price sorts as zero: before 5.0, after -1.0.
    row = dedupe(frame.where("unit_price is null or unit_price > 0")).first()
    assert row["product_id"] == "P2" and row["unit_price"] is None


@pytest.mark.parametrize("order", ["payload", "hash"])
def test_survivors_do_not_depend_on_partitioning(sales, order):
    rows = [(str(i % 40), D, f"S{i % 7}", f"P{i % 11}", float(i % 13), i % 5) for i in range(800)]
    frame = sales(*rows)
    first = {tuple(r) for r in dedupe(frame.repartition(7), order=order).collect()}
    again = {tuple(r) for r in dedupe(frame.repartition(2, "unit_price"), order=order).collect()}
    assert first == again and len(first) == 40


def test_null_price_by_variant(sales):
    rows = [(str(i), D, "S", "P", float(i), 1, "C", "online", "Online") for i in range(1, 101)]
    frame = sales(*rows, ("n", D, "S", "P", None, 1, None, "kiosk", "kiosk"), ("z", D, "S", "P", 0.0, 1, "C", None, None))

    reference = {r["order_id"]: r for r in clean(frame).collect()}
    assert reference["n"]["unit_price"] is None and reference["n"]["was_winsorized"] is False
    assert reference["n"]["channel"] is None and reference["n"]["was_relabeled"] is True and reference["n"]["customer_id"] is None
    assert reference["z"]["unit_price"] == pytest.approx(1.99) and reference["z"]["was_winsorized"] is True
    assert reference["z"]["was_relabeled"] is None
    assert reference["100"]["unit_price"] == pytest.approx(99.01)

    agent = {r["order_id"]: r for r in clean(frame, AGENT_RULES).collect()}
    assert "n" not in agent and agent["z"]["unit_price"] == 33.8652 and agent["z"]["channel_norm"] is None

    legacy = {r["order_id"]: r for r in clean(frame, LEGACY_RULES).collect()}
    assert legacy["n"]["unit_price"] == pytest.approx(99.01) and legacy["n"]["channel_norm"] == "online"
    assert legacy["z"]["channel_norm"] == "online"


def test_cut_offs_and_labels_are_parameters(sales):
    frame = sales(*[(str(i), D, "S", "P", float(i), 1, "C", "loja", "loja") for i in range(1, 101)])
    rules = with_rules(low=0.05, high=0.95, label_map={"store": ("loja",)}, domain=("store",))
    rows = clean(frame, rules).collect()
    assert min(r["unit_price"] for r in rows) == pytest.approx(5.95) and {r["channel"] for r in rows} == {"store"}
    assert audit_flag_totals(clean(frame, rules)).first()["n_winsorized"] == 10


def test_empty_table(sales):
    frame = sales(("1", D)).where("false")
    row = baseline_checks(frame).first().asDict()
    assert row.pop("p01") is None and row.pop("p99") is None
    assert set(row.values()) == {0}
    metrics = table_metrics(frame).first()
    assert metrics["n"] == 0 and metrics["dup_est"] == 0 and metrics["p99"] is None
    assert clean(frame).count() == 0


def test_label_column_is_resolved_at_run_time(sales):
    frame = sales(("1", D, "S", "P", 1.0, 1, "C", "kiosk", "online"))
    assert table_metrics(frame).first()["n_channel_off_domain"] == 1
    assert table_metrics(frame.drop("channel_norm")).first()["n_channel_off_domain"] == 0
    bare = frame.drop("channel_norm", "channel_raw")
    assert bare.select(label_column(bare).alias("l")).first()["l"] is None
    row = table_metrics(bare).first()
    assert (row["n_channel_labels"], row["n_channel_off_domain"]) == (0, 1)


def test_short_metrics_skip_rows_without_price(sales):
    frame = sales(("1", D, "S", "P", 1.0), ("1", D, "S", "P", None), ("2", D, "S", "P", 3.0))
    assert tuple(metrics_nonnull_price(frame).first())[:2] == (2, 0)
    stacked = stack_metrics({"a": table_metrics(frame), "b": table_metrics(frame.limit(0))})
    assert {r["stage"]: r["n"] for r in stacked.collect()} == {"a": 3, "b": 0}


# Known figures of the two smaller folders.
GOLDEN = {
    "/root/testdata/sf0.001": {
        "n_rows": 1013, "n_dup_pairs": 13, "n_dup_rows": 26, "n_missing_customer": 18, "n_price_zero_or_null": 15,
        "n_qty_invalid": 4, "n_date_null": 16, "p01": 0.0024, "p99": 287.2624,
        "gold": 1000, "winsorized": 31, "relabeled": 333, "off_domain": 93, "lost_drop_day": 0, "lost_double_day": 13,
    },
    "/root/testdata/sf0.01": {
        "n_rows": 10159, "n_dup_pairs": 212, "n_dup_rows": 432, "n_missing_customer": 179, "n_price_zero_or_null": 152,
        "n_qty_invalid": 35, "n_date_null": 171, "p01": 0.0, "p99": 280.8025,
        "gold": 9939, "winsorized": 299, "relabeled": 3329, "off_domain": 921, "lost_drop_day": 0, "lost_double_day": 158,
    },
}


@pytest.mark.parametrize("path", list(GOLDEN))
def test_golden_figures(spark, path):
    known = GOLDEN[path]
    staged = sales_staged(spark, path)
    row = baseline_checks(staged).first().asDict()
    assert {k: round(v, 6) for k, v in row.items()} == {k: known[k] for k in row}
    cleaned = clean(staged).persist()
    assert cleaned.count() == known["gold"]
    assert tuple(audit_flag_totals(cleaned).first()) == (known["winsorized"], known["relabeled"])
    assert cleaned.where(F.col("channel").isNull()).count() == known["off_domain"]
    # The business drop is left alone; repeated rows of the double load go, and rows without an order become one a day.
    for day, rows_lost in ((datetime.date(2024, 1, 9), known["lost_drop_day"]), (datetime.date(2024, 1, 15), known["lost_double_day"])):
        assert staged.where(F.col("date_parsed") == day).count() - cleaned.where(F.col("date_parsed") == day).count() == rows_lost
    cleaned.unpersist()


def test_every_defect_occurs(spark):
    """Results agree only on what the table holds, so it has to hold each defect."""
    raw = sales_raw(spark, "/root/testdata/sf0.01")
    text = lambda c, pattern: F.count_if(F.col(c).rlike(pattern))
    found = raw.agg(
        F.count_if(F.col("order_id").isNull()).alias("no_order"), text("order_id", "^ +$").alias("blank_order"),
        F.count_if(F.col("date").isNull()).alias("no_date"), text("date", "^soon$").alias("unreadable_date"),
        text("date", "^2024-02-30$").alias("impossible_date"), text("date", "^ .* $").alias("padded_date"),
        text("unit_price", "^n/a$").alias("unreadable_price"), text("unit_price", "^0$").alias("zero_price"),
        text("quantity", "^-").alias("negative_quantity"), text("customer_id", "^ +$").alias("blank_customer"),
        F.count_if(F.col("channel").isNull()).alias("no_label"), text("channel", "^ +$").alias("blank_label"), text("channel", "kiosk").alias("unknown_label"),
    ).first().asDict()
    assert all(found.values()), found
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    assert raw.count() == events.count() + events.where("CAST(ts AS DATE) = DATE '2024-01-15' AND event_id % 2 = 0").count()  # nothing is left out
