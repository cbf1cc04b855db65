"""Structured Streaming jobs equal their batch twins (file source, availableNow)."""

from shiplens.sources import tables as tb
from shiplens.streaming import jobs as sj


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_daily_counts_stream_equals_batch(spark, sf_dir, tmp_dir):
    q = sj.start_daily_counts(spark, sf_dir, tmp_dir + "/daily", base=tmp_dir)
    q.awaitTermination(300)
    batch = sj.daily_prediction_counts(tb.prediction_events(spark, sf_dir))
    assert _rows(sj.read_daily_counts(spark, tmp_dir + "/daily")) == _rows(batch)
    assert sj.late_rows(q) == 0


def test_daily_counts_over_batches_with_late_rows(spark, tmp_dir):
    """Days change over several batches; a row behind the watermark is counted as late; old epochs go."""
    import os
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    files = [["2024-01-01 10:00:00", "2024-01-02 10:00:00"], ["2024-01-02 11:00:00", "2024-03-10 00:00:00"],
             ["2024-03-10 05:00:00"], ["2024-01-01 12:00:00", "2024-03-11 00:00:00"]]
    for i, stamps in enumerate(files):
        rows = spark.sql(" UNION ALL ".join(
            f"SELECT {i * 10 + j}L AS event_id, TIMESTAMP_NTZ '{t}' AS ts, 'click' AS event_type, 1.0D AS value" for j, t in enumerate(stamps)))
        rows.coalesce(1).write.mode("append").parquet(tmp_dir + "/events")
        ev = spark.readStream.schema(schema).parquet(tmp_dir + "/events")
        q = sj.start_daily_counts(spark, "", tmp_dir + "/daily", base=tmp_dir, events=ev)
        q.awaitTermination(300)
    got = [(str(d), n) for d, n in _rows(sj.read_daily_counts(spark, tmp_dir + "/daily"))]
    assert got == [("2024-03-10", 2), ("2024-03-11", 1)]
    assert sj.late_rows(q) == 1
    assert len([x for x in os.listdir(tmp_dir + "/daily") if x.startswith("epoch=")]) <= 2


def test_service_summary_stream_equals_batch(spark, sf_dir, tmp_dir):
    q = sj.start_service_summary(spark, sf_dir, tmp_dir + "/services", base=tmp_dir)
    q.awaitTermination(300)
    batch = sj.stream_service_summary(tb.shipments(spark, sf_dir))
    assert _rows(sj.read_service_summary(spark, tmp_dir + "/services")) == _rows(batch)


def test_response_tail_stream_equals_batch(spark, sf_dir, tmp_dir):
    q = sj.start_response_tail(spark, sf_dir, tmp_dir + "/tail", base=tmp_dir)
    q.awaitTermination(300)
    got = sj.read_response_stats(spark, tmp_dir + "/tail")
    batch = sj.response_time_stats(tb.prediction_events(spark, sf_dir))
    assert _rows(got) == _rows(batch)


def test_stream_score_equals_batch(spark, sf_dir, tmp_dir):
    q = sj.start_stream_score(spark, sf_dir, tmp_dir + "/scored", base=tmp_dir)
    q.awaitTermination(300)
    got = spark.read.parquet(tmp_dir + "/scored")
    batch = sj.score_requests(tb.requests(spark, sf_dir))
    assert got.count() == batch.count()
    assert _rows(got.exceptAll(batch)) == []


def test_late_rows_are_counted_exactly(spark, tmp_dir):
    """k rows behind the watermark report k, over several batches and restarts; days of their own are not late."""
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    files = [["2024-05-01 10:00:00"], ["2024-06-20 00:00:00", "2024-04-01 00:00:00"],
             ["2024-05-20 23:59:59", "2024-05-21 00:00:00", "2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-05-20 00:00:00"],
             ["2024-06-21 00:00:00", "2024-05-20 12:00:00", "2023-01-01 00:00:00"], []]
    late = 0
    for i, stamps in enumerate(files):
        rows = [f"SELECT {i * 10 + j}L AS event_id, TIMESTAMP_NTZ '{t}' AS ts, 'click' AS event_type, 1.0D AS value" for j, t in enumerate(stamps)]
        if rows:
            spark.sql(" UNION ALL ".join(rows)).coalesce(1).write.mode("append").parquet(tmp_dir + "/late_events")
        ev = spark.readStream.schema(schema).parquet(tmp_dir + "/late_events")
        q = sj.start_daily_counts(spark, "", tmp_dir + "/late_daily", base=tmp_dir + "/late_base", events=ev)
        q.awaitTermination(300)
        late += [0, 0, 4, 2, 0][i]       # watermarks: none, 04-01 10:00 (its day is open), 05-21 00:00, 05-21 00:00
        assert sj.late_rows(q) == late, i
    got = [(str(d), n) for d, n in _rows(sj.read_daily_counts(spark, tmp_dir + "/late_daily"))]
    assert got == [("2024-06-20", 1), ("2024-06-21", 1)]
