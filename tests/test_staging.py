import datetime

import pytest
from pyspark.sql import functions as F

from clearbrook.functions.labels import map_labels, map_labels_by_table, map_labels_or_default
from clearbrook.functions.scalars import (
    blank_to_null, composite_key, normalize_label, parse_date, relative_deviation, safe_double, safe_int,
)
from clearbrook.sources.files import (
    csv_rejects, read_csv_lenient, read_json_records, read_text_artifacts, text_schema, write_csv, write_json_records,
)

DAY = datetime.date(2025, 7, 5)


def one(spark, value, expression, kind="string"):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-07-05", DAY), ("2025-7-5", DAY), ("05/07/2025", DAY), (" 5/7/2025 ", DAY), ("2025/07/05", DAY),
        ("31/02/2025", None), ("2025-13-01", None), ("25-07-15", None), ("2025-07-05x", None), ("", None), (None, None),
        ("2025-07-05 10:00", None), ("29/02/2024", datetime.date(2024, 2, 29)),
    ],
)
def test_dates_in_three_formats(spark, text, expected):
    assert one(spark, text, parse_date) == expected


def test_formats_with_names_use_the_formatter(spark):
    assert one(spark, "5 Jul 2025", lambda c: parse_date(c, ["yyyy-MM-dd", "d MMM yyyy"])) == DAY
    assert one(spark, "2025-7-5", lambda c: parse_date(c, ["yyyy-MM-dd", "d MMM yyyy"])) is None


def test_first_fitting_format_wins(spark):
    assert one(spark, "05/07/2025", lambda c: parse_date(c, ["M/d/yyyy", "d/M/yyyy"])) == datetime.date(2025, 5, 7)


@pytest.mark.parametrize(
    "text, number, whole",
    [
        ("3.7", 3.7, 4), ("2.5", 2.5, 3), ("-2.5", -2.5, -3), ("1e3", 1000.0, 1000), (" 12 ", 12.0, 12), ("n/a", None, None),
        ("", None, None), (None, None, None), ("1.5d", None, None), ("2f", None, None), ("0x10", None, None),
        ("99999999999", 99999999999.0, None),
    ],
)
def test_safe_casts(spark, text, number, whole):
    assert one(spark, text, safe_double) == number
    assert one(spark, text, safe_int) == whole


def test_blank_keeps_tabs(spark):
    assert one(spark, "   ", blank_to_null) is None
    assert one(spark, " \t ", blank_to_null) == "\t"
    assert one(spark, " C1 ", blank_to_null) == "C1"


def test_labels(spark):
    assert one(spark, "In-Store X", normalize_label) == "in_store_x"
    assert one(spark, "instore", map_labels) == "in_store"
    assert one(spark, "kiosk", map_labels) is None
    assert one(spark, None, map_labels) is None
    assert one(spark, "Online", lambda c: map_labels_or_default(F.lit(None).cast("string"), c)) == "online"
    assert one(spark, "MARKETPLACE", lambda c: map_labels_or_default(F.lit("x"), c)) == "marketplace"
    assert one(spark, "kiosk", lambda c: map_labels_or_default(c, c)) == "online"


def test_label_table_never_multiplies_rows(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "label_norm string")
    pairs = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "n")], "spelling string, label string")
    rows = map_labels_by_table(frame, "label_norm", pairs, "label").collect()
    assert sorted((r["label_norm"] or "", r["label"] or "") for r in rows) == [("", ""), ("a", "x"), ("a", "x"), ("z", "")]


def test_key_is_null_when_a_part_is(spark):
    assert one(spark, "7", lambda c: composite_key(c, F.lit(DAY))) == "7|2025-07-05"
    assert one(spark, None, lambda c: composite_key(c, F.lit(DAY))) is None


def test_deviation_is_guarded(spark):
    assert one(spark, 5, lambda c: relative_deviation(c, F.lit(4.0)), "long") == 0.25
    assert one(spark, 5, lambda c: relative_deviation(c, F.lit(0.0)), "long") is None
    assert one(spark, 5, lambda c: relative_deviation(c, F.lit(None).cast("double")), "long") is None


def test_malformed_lines_are_skipped_whatever_is_read(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n,,\n")
    frame = read_csv_lenient(spark, str(path), ["a", "b", "c"])
    assert frame.count() == 3
    assert [r["a"] for r in frame.select("a").collect()] == ["1", "10", None]


def test_quoted_line_breaks_on_request(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('a,b\n"say ""hi""","line 1\nline 2"\n')
    row = read_csv_lenient(spark, str(path), ["a", "b"], multi_line=True).first()
    assert (row["a"], row["b"]) == ('say "hi"', "line 1\nline 2")


def test_csv_keeps_spaces_quotes_and_nulls(spark, tmp_path):
    rows = [("  ", 'a"b', None), ("x,y", " lead", "1")]
    frame = spark.createDataFrame(rows, text_schema(["a", "b", "c"]))
    write_csv(frame, str(tmp_path / "out"))
    back = read_csv_lenient(spark, str(tmp_path / "out"), ["a", "b", "c"])
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_json_records_keep_nulls_and_missing_paths_fail(spark, tmp_path):
    frame = spark.createDataFrame([(1, None), (2, 0.5)], "n long, p double")
    write_json_records(frame, str(tmp_path / "j"))
    assert sorted(map(tuple, read_json_records(spark, str(tmp_path / "j"), frame.schema).collect())) == [(1, None), (2, 0.5)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_json_records(spark, str(tmp_path / "none"), frame.schema)


def test_text_files_are_read_whole(spark, tmp_path):
    (tmp_path / "patch.sql").write_text("SELECT 1;\n-- two lines\n")
    row = read_text_artifacts(spark, str(tmp_path)).first()
    assert row["path"].endswith("patch.sql") and row["content"] == "SELECT 1;\n-- two lines\n"


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,c,a\n0,3,1\nshort\n")
    (tmp_path / "b.csv").write_text("a,c\n4,6\n7,8,9\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    assert sorted(map(tuple, read_csv_lenient(spark, paths, ["a", "c"]).collect())) == [("1", "3"), ("4", "6")]
    rejects = csv_rejects(spark, paths, ["a", "c"])
    assert sorted(r["line"] for r in rejects.collect()) == ["7,8,9", "short"] and rejects.count() == 2
    with pytest.raises(ValueError, match="missing from the header: b"):
        read_csv_lenient(spark, paths[0], ["a", "b"])


def test_files_of_a_folder_have_to_agree(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,c\n1,3\n")
    (tmp_path / "2.csv").write_text("c,a\n6,4\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv_lenient(spark, str(tmp_path), ["a", "c"]).collect()
