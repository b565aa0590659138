"""Sketches as stream state and as a stored layer; fitted encoders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dealcast.operators import sketches as SK
from dealcast.operators.drift import daily_metrics
from dealcast.operators.fitted import Encoders
from dealcast.streaming import sketched as S


def events(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, value double, k double, event_type string")


def day(n, minute=0):
    return dt.datetime(2024, 1, n, 12) + dt.timedelta(minutes=minute)


def test_the_stream_is_within_its_bounds_and_its_state_is_small(spark, sf, tmp_path):
    out = str(tmp_path / "out")
    query = S.run_to_the_end(spark, sf, out, str(tmp_path / "ck"))
    ev = S.events_of(spark, sf)
    S.flush_open_days(ev, S.reference(ev, ev.select(F.min(F.to_date("ts"))).first()[0]), out)  # nothing left to do
    got = {r.timestamp: r for r in spark.read.parquet(out).collect()}
    exact = {r.timestamp: r for r in daily_metrics(ev).collect()}
    assert got.keys() == exact.keys() and len(got) == 30
    _, drift = S.error_bounds()
    for ts, r in got.items():
        e = exact[ts]
        assert abs(r.prediction_drift - e.prediction_drift) <= drift
        assert abs(r.share_missing_values - e.share_missing_values) < 1e-12 and abs(r.value_range - e.value_range) < 1e-12
    assert 0 < S.state_rows(query) <= 30 * 3  # a row a day and feature
    assert sum(r.late for r in S.late_events(ev, out).collect()) == 0


def test_late_events_are_counted_and_change_nothing(spark, tmp_path):
    """Files in turn; one has events of a day that is closed by then."""
    src = tmp_path / "in"
    rows = [[(day(1, i), float(i), 1.0, "a") for i in range(20)] + [(day(2, i), float(i), 1.0, "b") for i in range(20)],
            [(day(6), 5.0, 1.0, "a")], [(day(7), 5.0, 1.0, "a")], [(day(1, 100 + i), 1e6, 1.0, "late") for i in range(7)] + [(day(9), 1.0, 1.0, "a")], [(day(9), 1.0, None, None)]]
    src.mkdir()
    for n, part in enumerate(rows):
        events(spark, part).coalesce(1).write.parquet(str(tmp_path / str(n)))
        next((tmp_path / str(n)).glob("*.parquet")).rename(src / f"{n}.parquet")
        os.utime(src / f"{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    stored = spark.read.parquet(str(src))
    ref = S.reference(stored, dt.date(2024, 1, 2))
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    out = str(tmp_path / "out")
    query = S.start_daily_metrics(spark, stream, ref, out, str(tmp_path / "ck"))
    query.awaitTermination()
    got = {r.day.day: r for r in spark.read.parquet(out).collect()}
    assert got[1].events == 20 and got[1].quantile < 100 and S.dropped_rows(query) > 0
    late = {r.day.day: r.late for r in S.late_events(stored, out).collect()}
    assert late[1] == 7 and late[2] == 0


def test_categories_beyond_the_reference_count_together(spark, monkeypatch):
    rows = [(day(1, i), None, None, "xyz"[i % 3] if i % 10 else None) for i in range(60)] + [(day(2, i), None, None, f"new{i}") for i in range(50)]
    ev = events(spark, rows)
    ref = S.reference(ev, dt.date(2024, 1, 1))
    assert ref.categories == {"event_type": ["x", "y", "z"]}
    rows = S.tokens(ev.where(F.to_date("ts") == F.lit(dt.date(2024, 1, 2))), S.NUMERIC, S.CATEGORICAL)
    prof = S._rows(S._profile(rows, [F.to_date("ts").alias("_day")], ref.ranges, ref.categories), F.col("_day"))
    assert {r.feature: list(r.counts) for r in prof.collect()}["event_type"] == [50, 0, 0, 0]
    m = S._metrics(prof, ref, "value", "value").first()
    assert m.prediction_drift is None and m.quantile is None and m.num_drifted_columns == 1 and abs(m.share_missing_values - 2 / 3) < 1e-12


def test_stored_sketches_add_up(spark):
    df = spark.range(20_000).select(F.concat(F.lit("2024-0"), (F.col("id") % 4 + 1).cast("string")).alias("p"), (F.col("id") % 7_000).alias("a"),
                                    F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("b"), F.lit(None).cast("double").alias("c"))
    layer = SK.period_sketches(df, ["a", "b", "c"], "p")
    whole = {r["column"]: r for r in SK.roll_up(layer, period="p").collect()}
    assert (whole["a"]["rows"], whole["a"].missing, whole["a"].periods) == (20_000, 0, 4)
    assert abs(whole["a"].distinct - 7_000) <= 7_000 * SK.relative_error() and abs(whole["b"].distinct - 6_667) <= 6_667 * SK.relative_error()
    assert whole["c"].distinct == 0 and whole["c"].missing_share == 1.0
    # the union of months is the sketch of all rows
    once = df.agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col("a").cast("string"), F.lit(SK.LG_K)))).first()[0]
    assert abs(once - whole["a"].distinct) <= 2 * 7_000 * SK.relative_error()
    half = SK.roll_up(layer, F.when(F.col("p") <= "2024-02", "first").otherwise("second").alias("half"), period="p")
    assert half.count() == 6 and {r.periods for r in half.collect()} == {2}


def test_encoders_transform_only(spark, tmp_path):
    train = spark.createDataFrame([("b", "x", 1.0, 5), ("a", None, 3.0, 5), ("b", "y", None, 5)], "g string, h string, v double, w int")
    new = spark.createDataFrame([("a", "y", 4.0, 5), ("zz", None, None, 6), (None, "unseen", 2.0, None)], "g string, h string, v double, w int")
    Encoders.fit(train, ["g", "h"], ["v", "w"]).save(str(tmp_path), "v1")
    for growing in ((), ("g", "h")):
        Encoders.fit(train, ["g", "h"], ["v", "w"], growing).save(str(tmp_path), "v2")
        got = [tuple(r) for r in Encoders.load(spark, str(tmp_path), "v2").transform(new).select("g_encoded", "h_encoded", "v_scaled", "w_scaled").collect()]
        assert sorted(got, key=str) == sorted([(0, 1, 2.0, 0.0), (0, 2, None, 1.0), (0, 0, 0.0, None)], key=str)
        # a null that training has seen is its last class, one that it hasn't is unseen
    later = Encoders.load(spark, str(tmp_path), "v1").transform(spark.createDataFrame([("c", "x", 9.0, 1)], new.schema)).first()
    assert later.g_encoded == 0 and later.v_scaled == 7.0  # its own values have no say
    with pytest.raises(ValueError):
        Encoders.load(spark, str(tmp_path), "none")
    only = Encoders.fit(train, [], ["v"])
    assert only.codes.count() == 0 and only.transform(new).columns == [*new.columns, "v_scaled"]
