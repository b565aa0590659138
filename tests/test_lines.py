"""Files of several encodings, rejected lines, and the history of results."""

import datetime as dt
import json

import pytest
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructType

from dealcast.sources import history as H
from dealcast.sources import lines as L

SCHEMA = StructType().add("name", StringType()).add("v", IntegerType())


def put(path, text, encoding="utf-8"):
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))


def test_each_file_has_its_own_encoding(spark, tmp_path):
    put(tmp_path / "a.csv", "name,v\nCafé 日本,1\nplain,2\n")
    put(tmp_path / "b.csv", "NAME,V\nCafé,3\n", "latin-1")
    put(tmp_path / "c.csv", "Café “€”,4\r\n", "cp1252")
    put(tmp_path / "d.csv", "﻿Marked é,5\n")
    put(tmp_path / "e.csv", "only ascii,6")
    put(tmp_path / "f.csv", b"open \x81 \x93,7\n")
    put(tmp_path / "g.csv", b"")
    good, bad = L.read_delimited(spark, str(tmp_path), SCHEMA)
    got = {r.v: r.name for r in good.collect()}
    assert got == {1: "Café 日本", 2: "plain", 3: "Café", 4: "Café “€”", 5: "Marked é", 6: "only ascii", 7: "open \x81 \x93"}
    assert bad.count() == 0
    kinds = {r.file[-5:]: r.encoding for r in L.file_encodings(L.raw_lines(spark, str(tmp_path))).collect()}
    assert kinds == {"a.csv": "utf-8", "b.csv": "iso-8859-1", "c.csv": "windows-1252", "d.csv": "utf-8", "e.csv": "utf-8", "f.csv": "iso-8859-1"}


@pytest.mark.parametrize("split", [64, 1 << 20])
def test_one_bad_byte_anywhere_decides_for_the_file(spark, tmp_path, split):
    """Also if the file is read in many splits and only one of them has it."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    put(tmp_path / "big.csv", b"".join(b"row%05d \xc3\xa9,%d\n" % (i, i) for i in range(400)) + b"last \xe9,400\n")
    put(tmp_path / "other.csv", "é,-1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        good, _ = L.read_delimited(spark, str(tmp_path), SCHEMA)
        got = {r.v: r.name for r in good.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 402 and got[-1] == "é" and got[400] == "last é" and got[0] == "row00000 Ã©"


def test_bad_lines_have_a_reason_and_nothing_is_lost(spark, tmp_path):
    schema = StructType().add("name", StringType()).add("v", IntegerType()).add("x", DoubleType()).add("day", DateType())
    put(tmp_path / "a.csv", "\n".join(["name,v,x,day", "ok,1,2.5,2024-01-31", "empty,,,", "few,1,2.5", "many,1,2.5,2024-01-31,more", "number,one,2.5,2024-01-31",
                                         "double,1,2.5.6,2024-01-31", "date,1,2.5,2024-02-31", "two,x,y,z", '"a,b",2,1e3,2024-02-29', "", "   "]))
    good, bad = L.read_delimited(spark, str(tmp_path), schema)
    assert sorted(map(tuple, good.collect())) == [("a,b", 2, 1000.0, dt.date(2024, 2, 29)), ("empty", None, None, None), ("ok", 1, 2.5, dt.date(2024, 1, 31))]
    why = {r.line.split(",")[0]: r.reason for r in bad.collect()}
    assert why == {"few": "wrong number of fields", "many": "wrong number of fields", "number": "v: no int", "double": "x: no double", "date": "day: no date", "two": "v: no int"}
    assert all(r.file.endswith("a.csv") for r in bad.collect())


def test_another_separator_and_no_header(spark, tmp_path):
    put(tmp_path / "a.txt", "name;1\nv;2\n")
    good, bad = L.read_delimited(spark, [str(tmp_path / "a.txt")], SCHEMA, sep=";", header=False)
    assert sorted(r.v for r in good.collect()) == [1, 2] and bad.count() == 0


def result(month, ts, **fields):
    return {"timestamp": ts, "current_month": month, **fields}


def test_result_history_of_three_shapes(spark, tmp_path):
    files = {
        "r1.json": result("2024-01", "2024-02-01T10:00:00", drift_detected=True, prediction_drift=0.3, num_drifted_columns=4, alert_level="HIGH", accuracy=0.8),
        "r2.json": result("2024-02", "2024-03-01 10:00:00", drift_detection={"results": {"prediction_drift": 0.05}}),
        "r3.json": result("2024-03", "2024-04-01 10:00:00", other=[1, {"a": 2}], drift_detection={"success": True, "results": {
            "drift_detected": False, "prediction_drift": 0.15, "num_drifted_columns": 6, "alert_level": "MEDIUM", "accuracy": None, "missing_values_share": 0.25, "new": 1}}),
        "r3b.json": result("2024-03", "2024-04-02 10:00:00", drift_detection={"results": {"alert_level": "LOW"}}),
        "r4.json": result("2024-04", None),
        "no_month.json": {"timestamp": "2024-01-01"},
    }
    for name, doc in files.items():
        put(tmp_path / name, json.dumps(doc, indent=2))
    put(tmp_path / "cut.json", '{"current_month": "2024-05", "drift_det')
    put(tmp_path / "list.json", "[1, 2]")
    put(tmp_path / "empty.json", " \n")
    put(tmp_path / "ignored.txt", "{}")
    rows, bad = H.result_history(spark, str(tmp_path))
    by = {r.current_month: r for r in H.trend(rows).collect()}
    assert sorted(by) == ["2024-01", "2024-02", "2024-03", "2024-04"] and rows.count() == 5
    one, two, three, four = (by[k] for k in sorted(by))
    assert (one.drift_detected, one.prediction_drift, one.num_drifted_columns, one.alert_level, one.accuracy, one.missing_values_share) == (True, 0.3, 4, "HIGH", 0.8, 0.0)
    assert (two.drift_detected, two.prediction_drift, two.num_drifted_columns, two.alert_level, two.accuracy) == (False, 0.05, 0, "NONE", None)
    assert (three.alert_level, three.prediction_drift, three.timestamp.day) == ("LOW", 0.0, 2)  # the later run of the month
    assert four.timestamp is None and four.alert_level == "NONE"
    assert {r.file.rsplit("/")[-1]: r.reason for r in bad.collect()} == {
        "cut.json": "malformed", "list.json": "no JSON object", "empty.json": "empty", "no_month.json": "no current_month"}


def test_history_of_nothing(spark, tmp_path):
    put(tmp_path / "cut.json", "{")
    rows, bad = H.result_history(spark, str(tmp_path))
    assert H.trend(rows).count() == 0 and bad.count() == 1
    assert set(H.trend(rows).columns) == {"current_month", "timestamp", *H.FIELDS}
