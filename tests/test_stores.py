"""Sketches by day, versions, observed loads, merges, stored runs, row differences, functions per group, text files."""

import collections
import datetime
import hashlib
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clearbrook.operators import diff, grouped, joins, merge, sketches
from clearbrook.operators.contracts import ContractViolation
from clearbrook.operators.observed import enforce_load, observed_load
from clearbrook.plans import catalog, reports
from clearbrook.sources.files import read_bundled_artifacts, read_text_artifacts
from clearbrook.sources.versions import Conflict, VersionedTable

DAY = datetime.date(2025, 7, 1)


def files_of(path):
    """Names and times of all data files below a path."""
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


# --- sketches -------------------------------------------------------------------


def days_of_values(spark, days, seed=1):
    pick = random.Random(seed)
    rows = [(g, DAY + datetime.timedelta(days=d), pick.lognormvariate(0, 2), f"{g}{pick.randrange(4000)}") for d in days for g in "abc" for _ in range(2000)]
    rows += [("a", DAY, None, None), ("b", DAY, float("nan"), "x"), ("d", DAY, None, None), ("a", None, 1.0, "z")]
    return spark.createDataFrame(rows, "g string, d date, v double, u string").repartition(6)


def test_sketches_of_a_range_stay_within_their_error(spark, tmp_path):
    frame = days_of_values(spark, range(6))
    path = f"{tmp_path}/s"
    sketches.store_sketches(sketches.daily_sketches(frame, "d", "v", "u", ["g"]), path)
    probabilities = {f"p{k}": k / 20 for k in range(21)}
    stored = sketches.stored_range(spark, path, str(DAY + datetime.timedelta(days=1)), str(DAY + datetime.timedelta(days=4)))
    whole = sketches.merged(stored, ["g"])
    rows = frame.where(F.col("d").between(DAY + datetime.timedelta(days=1), DAY + datetime.timedelta(days=4)))
    errors = sketches.rank_errors(rows, "v", sketches.estimated_quantiles(whole, probabilities), probabilities, ["g"]).collect()
    assert len(errors) == 3 * 21 and max(r["rank_error"] for r in errors) <= sketches.RANK_ERROR
    exact = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count_distinct("u").alias("n")).collect()}
    for r in sketches.estimated_distinct(whole).collect():
        assert r["n_days"] == 4 and r["n"] == 8000 and abs(r["n_distinct"] - exact[r["g"]]) <= sketches.COUNT_ERROR * exact[r["g"]]


def test_adding_days_reads_and_touches_no_earlier_one(spark, tmp_path):
    path = f"{tmp_path}/s"
    sketches.store_sketches(sketches.daily_sketches(days_of_values(spark, range(3)).where("d is not null"), "d", "v", by=["g"]), path)
    before = files_of(path)
    again = days_of_values(spark, [2, 3], seed=2).where(F.col("d") > DAY)
    sketches.store_sketches(sketches.daily_sketches(again, "d", "v", by=["g"]), path)
    after = files_of(path)
    kept = {name for name in before if after.get(name) == before[name]}
    assert {os.path.basename(os.path.dirname(n)) for n in kept} == {f"day={DAY}", f"day={DAY + datetime.timedelta(days=1)}"}
    whole = sketches.merged(sketches.stored_range(spark, path), ["g"]).collect()
    assert {r["g"]: r["n_days"] for r in whole} == {"a": 4, "b": 4, "c": 4, "d": 1}
    plan = sketches.stored_range(spark, path, str(DAY), str(DAY))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_groups_without_values_and_sketches_of_nothing(spark):
    frame = days_of_values(spark, [0])
    whole = sketches.estimated_quantiles(sketches.merged(sketches.daily_sketches(frame.where("g = 'd'"), "d", "v", by=["g"]), ["g"]), {"p50": 0.5})
    assert [(r["n"], r["p50"]) for r in whole.collect()] == [(0, None)]
    assert sketches.daily_sketches(frame.limit(0), "d", "v").collect() == []
    with pytest.raises(ValueError):
        sketches.daily_sketches(frame, "d")


# --- versions -------------------------------------------------------------------


def ids(frame):
    return sorted(r[0] for r in frame.collect())


def test_versions_rollback_and_as_of(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    assert table.current() == 0 and table.history().collect() == []
    with pytest.raises(LookupError):
        table.read()
    first = table.publish(spark.range(3), {"run": "a"})
    moment = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="microseconds")
    second = table.publish(spark.range(5), expected=first)
    assert (first, second) == (1, 2)
    assert ids(table.read()) == [0, 1, 2, 3, 4] and ids(table.read(first)) == ids(table.read(as_of=moment)) == [0, 1, 2]
    assert table.rollback(first) == 3 and ids(table.read()) == [0, 1, 2] and ids(table.read(second)) == [0, 1, 2, 3, 4]
    assert [(r["version"], r["action"]) for r in table.history().orderBy("version").collect()] == [(1, "publish"), (2, "publish"), (3, "rollback")]
    for wrong in (lambda: table.read(9), lambda: table.rollback(9), lambda: table.read(as_of="2000")):
        with pytest.raises(LookupError):
            wrong()


def test_a_failure_between_the_steps_leaves_readers_on_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.publish(spark.range(3))
    table.stage(spark.range(99))  # written, never published
    assert ids(table.read()) == [0, 1, 2]
    with open(f"{tmp_path}/t/log/000000000002.json", "w") as half:  # a writer that died while it wrote its record
        half.write('{"version": 2, "folder": "da')
    assert table.current() == 1 and ids(table.read()) == [0, 1, 2]
    assert table.publish(spark.range(4)) == 3 and ids(table.read()) == [0, 1, 2, 3]


def test_two_writers_of_one_version(spark, tmp_path):
    table, other = (VersionedTable(spark, f"{tmp_path}/t") for _ in range(2))
    seen = table.publish(spark.range(1))
    assert other.publish(spark.range(2), expected=seen) == 2
    with pytest.raises(Conflict):
        table.publish(spark.range(3), expected=seen)
    # Both saw number 3 free; the record can be created only once.
    table._taken = lambda: 2
    other.publish(spark.range(4))
    with pytest.raises(Conflict):
        table.publish(spark.range(5))
    assert ids(table.read()) == [0, 1, 2, 3]


# --- observed loads ---------------------------------------------------------------


def test_a_load_is_counted_while_it_is_written(spark, sales, tmp_path):
    rows = [(str(k), "2025-07-01", "S", "P", 1.0, 1, "C", "online", "online") for k in range(10)]
    table = VersionedTable(spark, f"{tmp_path}/t")
    good = observed_load(sales(*rows), table, measures={"revenue": F.sum("unit_price")})
    assert good.version == 1 and good.n_rows == 10 and not good.broken
    assert table.history().first()["details"]["revenue"] == "10.0"
    bad = sales(*rows, rows[0], ("x", None, "S", "P", 0.0, 0, "C", "kiosk", "kiosk"))
    refused = observed_load(bad, table)
    assert refused.version is None and refused.broken == {
        "repeated_rows": 1, "date_missing": 1, "label_off_domain": 1, "price_not_positive": 1, "quantity_not_positive": 1,
    }
    assert table.current() == 1 and table.read().count() == 10
    with pytest.raises(ContractViolation, match="repeated_rows: 1"):
        enforce_load(bad, table)
    assert observed_load(bad, table, keys=None, tolerated=dict.fromkeys(refused.broken, 1)).version == 2
    assert observed_load(sales(), table).n_rows == 0


def test_a_checked_load_scans_once(spark, sales, tmp_path):
    sales(("1", "2025-07-01", "S", "P", 1.0, 1, "C", "online", "online")).write.parquet(f"{tmp_path}/in")
    group = "observed-load"
    spark.sparkContext.setJobGroup(group, group)
    try:
        observed_load(spark.read.parquet(f"{tmp_path}/in"), VersionedTable(spark, f"{tmp_path}/t"), keys=None)
        tracker = spark.sparkContext.statusTracker()
        assert len(tracker.getJobIdsForGroup(group)) <= 2  # footers, and the write
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# --- merge ------------------------------------------------------------------------


def test_merge_rewrites_the_days_it_touches(spark, sales, tmp_path):
    path = f"{tmp_path}/h"
    rows = [(str(k), f"2025-07-0{1 + k % 4}", "S", "P", float(k)) for k in range(12)] + [("n", None, "S", "P", 7.0), (None, "2025-07-01", "S", "P", 8.0)]
    history = sales(*rows)
    merge.write_history(history, path)
    before = files_of(path)
    batch = sales(("1", "2025-07-02", "S", "P", 100.0), ("1", "2025-07-02", "S", "P", 101.0), ("new", "2025-07-02", "S", "P", 5.0),
                  ("new", "2025-07-09", "S", "P", 6.0), ("n", None, "S", "P", 7.0), ("m", None, "S", "P", 9.0))
    removals = sales(("5", "2025-07-02"), *[(str(k), "2025-07-04") for k in (3, 7, 11)])
    for _ in range(2):  # merging again changes nothing
        merge.merge_history(spark, path, batch, removals)
        found = {(r["order_id"], str(r["date_parsed"]), r["unit_price"]) for r in merge.read_history(spark, path, history.schema).collect()}
        expected = {(r[0], str(r[1]), r[4]) for r in rows if r[0] not in ("1", "5", "3", "7", "11")}
        expected |= {("1", "2025-07-02", 100.0), ("new", "2025-07-02", 5.0), ("new", "2025-07-09", 6.0), ("m", "None", 9.0)}
        assert found == expected
        assert merge.read_history(spark, path, history.schema).count() == len(expected)
    after = files_of(path)
    untouched = {n for n in before if "date_parsed=2025-07-01" in n or "date_parsed=2025-07-03" in n}
    assert untouched and all(after.get(n) == before[n] for n in untouched)
    assert not any("2025-07-04" in n for n in after)
    with pytest.raises(ValueError):
        merge.merge_history(spark, path, batch, keys=("order_id",))


# --- stored runs --------------------------------------------------------------------


def test_runs_are_appended_and_read_back(spark, tmp_path):
    path = f"{tmp_path}/runs"
    failed = {"timestamp": "2025-01-01T00:00:00+00:00", "patch": "p", "syntax_ok": False, "execution_error": "guardrail", "applied": False,
              "decision": "review", "before_after": {"stg": {"n": 3, "p01": None}, "gold_simulated": None}, "gates": None, "notes": "x",
              "fallback": [("a", False, "missing")], "fallback_notice": None}
    good = {**failed, "timestamp": "2025-01-02T00:00:00+00:00", "applied": True, "gates": {"drop_ratio": 0.25, "checks": {"one": True, "two": False}, "ok": False},
            "fallback_notice": {"patch_efetivo": "b"}, "fallback": [("a", False, "missing"), ("b", True, None)]}
    first, second = reports.append_report(spark, path, failed), reports.append_report(spark, path, good)
    stored = reports.read_reports(spark, path)
    assert first != second and stored.count() == 2
    last = reports.latest_report(stored)
    assert last.first()["run_id"] == second and reports.latest_report(stored.limit(0)).collect() == []
    tables = reports.report_tables(last)
    assert {(r["gate"], r["passed"]) for r in tables["run_gates"].collect()} == {("one", True), ("two", False)}
    assert {(r["stage"], r["metric"], r["value"]) for r in tables["run_metrics"].collect()} == {("stg", "n", 3.0), ("stg", "p01", None)}
    assert {(r["candidate"], r["effective"]) for r in tables["run_candidates"].collect()} == {("a", "b"), ("b", "b")}
    assert reports.reported_gates(stored.where(F.col("run_id") == first)).collect() == []


# --- differences of rows ------------------------------------------------------------


def plain_diff(before, after):
    """Pairs of single rows, one by one."""
    left, right = collections.Counter(before), collections.Counter(after)
    old, new = left - right, right - left
    order = lambda r: [(v is not None, v) for v in r[2:]]
    found = collections.Counter()
    for key in {r[:2] for r in [*old, *new]}:
        sides = [sorted((r for r in side.elements() if r[:2] == key), key=order) for side in (old, new)]
        both = min(map(len, sides)) if None not in key else 0
        for a, b in zip(sides[0][:both], sides[1][:both]):
            found[key, "changed", tuple(n for n, x, y in zip("vw", a[2:], b[2:]) if x != y)] += 1
        found[key, "removed", ()] += len(sides[0]) - both
        found[key, "added", ()] += len(sides[1]) - both
    return +found


@pytest.mark.parametrize("seed", range(4))
def test_row_diff_against_plain_pairs(spark, seed):
    pick = random.Random(seed)
    rows = lambda n: [(pick.choice(["a", "b", None]), pick.choice([1, 2, None]), pick.choice([1.5, 2.5, None]), pick.choice(["x", "y", None])) for _ in range(n)]
    before, after = rows(pick.choice([0, 30, 90])), rows(pick.choice([0, 40, 80]))
    schema = "k string, l int, v double, w string"
    found = diff.row_diff(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), ["k", "l"]).collect()
    got = collections.Counter()
    for r in found:
        got[(r["k"], r["l"]), r["kind"], tuple(r["changed_columns"])] += r["n"]
    assert got == plain_diff(before, after)


def test_row_diff_of_one_very_frequent_row(spark):
    before = spark.range(1000).selectExpr("'k' as order_id", "date'2025-07-01' as date_parsed", "1 as v")
    after = spark.range(600).selectExpr("'k' as order_id", "date'2025-07-01' as date_parsed", "if(id < 250, 1, 2) as v")
    found = {(r["kind"], r["n"], r["before"] and r["before"]["v"], r["after"] and r["after"]["v"]) for r in diff.row_diff(before, after).collect()}
    assert found == {("changed", 350, 1, 2), ("removed", 400, 1, None)}
    assert diff.row_diff(before, before).collect() == []


# --- a user's function ----------------------------------------------------------------


def test_hot_groups_are_split_and_merged(spark):
    rows = [("hot", float(k), k % 7) for k in range(5000)] + [("small", float(k), k) for k in range(20)] + [("one value", 5.0, k) for k in range(900)]
    rows += [(None, float(k), 1) for k in range(10)] + [("hot", None, 3), ("small", None, 3)]
    frame = spark.createDataFrame(rows, "g string, t double, v int").repartition(5)
    parts = {r["g"]: (r["n"], r["most"]) for r in grouped.split_groups(frame, ["g"], "t", 500).groupBy("g", "part").count().groupBy("g").agg(
        F.count("*").alias("n"), F.max("count").alias("most")).collect()}
    assert parts["small"] == (1, 21) and parts["one value"] == (1, 900) and parts[None] == (1, 10)
    assert parts["hot"][0] >= 10 and parts["hot"][1] < 700

    def piece(part: pd.DataFrame) -> pd.DataFrame:
        return part[["g"]].head(1).assign(first=part["t"].min(), total=int(part["v"].sum()), largest=len(part))

    def whole(parts: pd.DataFrame) -> pd.DataFrame:
        assert parts["part"].is_monotonic_increasing and parts["first"].dropna().is_monotonic_increasing
        return parts[["g"]].head(1).assign(first=parts["first"].min(), total=int(parts["total"].sum()), largest=int(parts["largest"].max()))

    schema = "g string, first double, total long, largest long"
    found = {r["g"]: r for r in grouped.apply_by_group(frame, ["g"], "t", piece, schema, whole, most_rows=500).collect()}
    assert found["hot"]["total"] == sum(k % 7 for k in range(5000)) + 3 and found["hot"]["largest"] < 700
    assert found["small"]["total"] == sum(range(20)) + 3 and found[None]["total"] == 10 and set(found) == {"hot", "small", "one value", None}
    alone = {r["g"]: r["total"] for r in grouped.apply_by_group(frame, ["g"], "t", piece, schema).collect()}
    assert alone == {g: r["total"] for g, r in found.items()}


def test_small_groups_share_batches_and_keep_their_kinds(spark):
    rows = [(g, k, (1 << 60) + g if g % 2 or k else None, None if g % 3 == 0 and k else k % 2 == 0) for g in range(60) for k in range(9)]
    frame = spark.createDataFrame(rows, "g long, t int, v long, even boolean").repartition(3)

    def piece(part: pd.DataFrame) -> pd.DataFrame:
        kinds = f"{part.dtypes.to_dict()} {part['even'].tolist()} {type(part['even'].iloc[-1])}"
        return part[["g"]].head(1).assign(kinds=kinds, last=part["v"].iloc[-1], n=len(part), ordered=bool(part["t"].is_monotonic_increasing))

    def whole(parts: pd.DataFrame) -> pd.DataFrame:
        return parts.drop(columns="part").tail(1).assign(n=int(parts["n"].sum()))

    schema = "g long, kinds string, last long, n long, ordered boolean"
    found = grouped.apply_by_group(frame, ["g"], "t", piece, schema, whole).withColumn("task", F.spark_partition_id()).collect()
    known = frame.groupBy("g").applyInPandas(lambda part: piece(part.sort_values("t", kind="stable")), schema).collect()
    assert sorted(r[:5] for r in found) == sorted(tuple(r) for r in known)
    assert all(r["last"] == (1 << 60) + r["g"] for r in found if r["g"] % 2) and len(found) == 60
    assert len({r["task"] for r in found}) > 1  # results of all groups were merged in one task


def test_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    frame = spark.range(1000).selectExpr("if(id % 9 = 0, null, id) AS a", "id % 7 AS b")
    spread = joins.dealt(frame, ["a", "b"], rows=100)
    assert spread.rdd.getNumPartitions() == 10 and spread.exceptAll(frame).isEmpty() and spread.count() == 1000
    assert joins.dealt(frame.where("b > 9"), ["a"]).rdd.getNumPartitions() == 1
    # The share of a task in the gates over two keys does not grow with the table.
    monkeypatch.setattr(joins.dealt, "__defaults__", (100,))
    lines = spark.range(1000).selectExpr("id % 50 AS l_orderkey", "id AS l_linenumber", "date'2025-07-01' AS l_shipdate", "1.5D AS l_extendedprice")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = catalog.queries()["gates_lineitem_row_loss"](spark, str(tmp_path))
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_orderkey" in text and ", 10" in text
    assert {r["second_key"]: r["drop_ratio"] for r in found.collect()} == {"l_shipdate": 0.95, "l_linenumber": 0.0}


# --- text files -----------------------------------------------------------------------


def test_text_files_with_a_limit(spark, tmp_path):
    os.makedirs(f"{tmp_path}/a/b")
    for name, content in {"a/plan.json": b"{}", "a/b/notes.txt": "ü\n\n".encode(), "a/big.txt": b"x" * 101, "bad.txt": b"\xff\xfe"}.items():
        with open(f"{tmp_path}/{name}", "wb") as file:
            file.write(content)
    rows = {os.path.basename(r["path"]): r for r in read_text_artifacts(spark, str(tmp_path), largest=100).collect()}
    assert {n: (r["state"], r["content"], r["n_bytes"]) for n, r in rows.items()} == {
        "plan.json": ("read", "{}", 2), "notes.txt": ("read", "ü\n\n", 4), "big.txt": ("too large", None, 101),
        "bad.txt": ("unreadable", None, 2),
    }
    assert all(r["modified"] is not None for r in rows.values())
    assert read_text_artifacts(spark, str(tmp_path), pattern="*.json").count() == 1
    text = read_text_artifacts(spark, str(tmp_path), largest=100)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [LessThanOrEqual(length,100)]" in text


def test_bundled_text_files_are_judged_like_single_ones(spark, tmp_path):
    os.makedirs(f"{tmp_path}/single")
    for name, content in {"plan.json": b"{}", "notes.txt": "ü\n\n".encode(), "big.txt": b"x" * 101, "bad.txt": b"\xff\xfe"}.items():
        with open(f"{tmp_path}/single/{name}", "wb") as file:
            file.write(content)
    spark.read.format("binaryFile").load(f"{tmp_path}/single").write.parquet(f"{tmp_path}/bundled")
    single = read_text_artifacts(spark, f"{tmp_path}/single", largest=100)
    bundled = read_bundled_artifacts(spark, f"{tmp_path}/bundled", largest=100)
    assert bundled.schema == single.schema
    assert sorted(map(tuple, bundled.collect())) == sorted(map(tuple, single.collect())) and bundled.count() == 4


def test_text_artifact_scan_makes_no_file_for_each_document(spark, tmp_path, monkeypatch):
    """Files follow from tasks, not from documents; the rows are those of the SQL."""
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(catalog, "scratch_path", lambda session, label: f"{scratch}/{label}")
    rows = [(k, f"text {k} ü \"quoted\"\n" * (1 if k % 50 else 2000)) for k in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in catalog.queries()["text_artifact_scan"](spark, str(tmp_path)).collect()}
    assert len(list(scratch.rglob("part-*"))) < 100
    assert len(found) == 400 and all(r["strict_as_expected"] for r in found.values())
    for k, text in rows:
        assert found[k]["large"] == (k % 50 == 0) and found[k]["state"] == ("read" if k % 50 else "too large")
        assert found[k]["text_md5"] == (hashlib.md5(text.encode()).hexdigest() if k % 50 else None)
