"""Structured Streaming jobs (S1-S4) and their batch twins.

The same transformation functions run on a static DataFrame (batch twin, the
oracle-checked query) and on a streaming one (``readStream`` file source):

* S1 daily prediction counts: watermark 30 days, tumbling 1-day windows, ``foreachBatch``
  adding each batch's days to a durable table; rows behind the watermark of the batch
  before are left out and counted exactly;
* S2 response-time stats: ``foreachBatch`` keeping a <= 1000-row tail table;
* S3 stream scoring: requests validated and scored, appended to a sink; with a fitted
  pipeline also on route history, from a stored table of trailing medians that is read
  anew in every micro-batch;
* S4 incremental service summary: mergeable streaming aggregates, update mode, upserted
  into a durable table.

State and tables live on shared storage.  The small tables are written as one folder
per micro-batch (a replayed batch overwrites its own), and folders older than the one
before the latest are deleted, so a restarted query resumes exactly where it stopped
and nothing piles up.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplens.functions import scalars as sc
from shiplens.functions.stats import COST, TIME, cnt, exact_avg, r6
from shiplens.operators.quality import validation_reasons
from shiplens.session import materialize_small
from shiplens.sources import tables as tb

KEEP_DAYS = 30
TAIL = 1000


def js_round(c) -> F.Column:
    """Math.round: half rounds toward +infinity."""
    return F.floor(c + F.lit(5e-1))


# ---------------------------------------------------------------- S1 (batch)
def daily_prediction_counts(ev: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Successful predictions per UTC day for the last ``keep_days`` days before the latest day."""
    d = ev.where("success").groupBy(F.to_date("ts").alias("day")).agg(cnt().alias("n"))
    return _last_days(d, keep_days)


def prediction_stats(ev: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Today's count (latest day), all-time total, rounded mean over kept days, active days."""
    kept = daily_prediction_counts(ev, keep_days)
    tot = ev.where("success").agg(cnt().alias("total"))
    k = kept.agg(F.max("day").alias("date"), F.max_by("n", "day").alias("today"),
                 js_round(F.avg("n")).cast("long").alias("average_daily"), cnt().alias("active_days"))
    return k.crossJoin(tot).select("date", "today", "total", "average_daily", "active_days")


# ---------------------------------------------------------------- S2 (batch)
def response_time_stats(ev: DataFrame, tail: int = TAIL) -> DataFrame:
    """Stats of the last ``tail`` response times (by ts, then id): rounded mean, upper median
    sorted[n // 2], min, max; total requests; sample count."""
    last = ev.orderBy(F.col("ts").desc(), F.col("request_id").desc()).limit(tail)  # top-k: bounded
    return _tail_stats(last, ev.agg(cnt().alias("total_requests")))


def _tail_stats(last: DataFrame, total: DataFrame) -> DataFrame:
    r = last.select("response_ms", F.row_number().over(Window.orderBy("response_ms")).alias("_rk"),
                    F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))  # <= tail rows
    s = r.agg(js_round(exact_avg("response_ms")).alias("average_ms"),
              js_round(F.max(F.when(F.col("_rk") == F.floor(F.col("_n") / 2) + 1, F.col("response_ms"))))
              .alias("median_ms"),
              js_round(F.min("response_ms")).alias("min_ms"), js_round(F.max("response_ms")).alias("max_ms"),
              cnt().alias("recent_samples"))
    return s.crossJoin(total).select(*[F.col(c).cast("long").alias(c) for c in (
        "average_ms", "median_ms", "min_ms", "max_ms")], "total_requests", "recent_samples")


# ---------------------------------------------------------------- S4 (batch)
def service_running_summary(s: DataFrame) -> DataFrame:
    """Per service: n, mean and sample std of time and cost (mergeable aggregates)."""
    return s.groupBy("service_level").agg(
        cnt().alias("n"), exact_avg(TIME).alias("avg_transit_time"), F.stddev_samp(TIME).alias("transit_time_std"),
        exact_avg(COST).alias("avg_cost"), F.stddev_samp(COST).alias("cost_std"))


def stream_service_summary(s: DataFrame) -> DataFrame:
    g = service_running_summary(s)
    return g.select("service_level", "n", *[r6(c).alias(c) for c in (
        "avg_transit_time", "transit_time_std", "avg_cost", "cost_std")])


# ---------------------------------------------------------------- S3 (batch)
def score_requests(req: DataFrame) -> DataFrame:
    """Validated requests scored with the rate-card scorer (expected days and cost);
    invalid ones carry their reasons and NULL predictions."""
    x = req.withColumn("reasons", validation_reasons())
    x = x.select("*", F.col("zone").alias("rate_zone"), *sc.package_columns(), F.month("ship_date").alias("month"))
    x = sc.with_rate_card(x)
    ok = F.col("reasons") == ""
    return x.select("request_id", "l_linenumber", ok.alias("success"), "reasons",
                    F.when(ok, r6(sc.expected_transit())).alias("predicted_transit_days"),
                    F.when(ok, r6(sc.expected_cost())).alias("predicted_cost_usd"))


# ------------------------------------------------------------- stream jobs
def _ckpt(spark: SparkSession, name: str, base: str | None) -> str:
    from shiplens.session import checkpoint_dir
    root = base or checkpoint_dir(spark)
    return os.path.join(root, "streams", name)


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _epochs(spark: SparkSession, folder: str) -> list[int]:
    """Completed epochs below ``folder`` (a listing; no data is read)."""
    path, fs = _fs(spark, folder)
    if not fs.exists(path):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(path)]
    return sorted(int(n[6:]) for n in names if n.startswith("epoch=")
                  and fs.exists(_fs(spark, f"{folder}/{n}/_SUCCESS")[0]))


def _read_epoch(spark: SparkSession, folder: str, below: int | None = None) -> DataFrame | None:
    """The latest completed epoch (before ``below``), or None."""
    have = [e for e in _epochs(spark, folder) if below is None or e < below]
    return spark.read.parquet(f"{folder}/epoch={have[-1]}") if have else None


def _write_epoch(df: DataFrame, folder: str, epoch: int) -> None:
    """Write an epoch, then delete all but it and its predecessor (which a replay reads)."""
    df.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")
    for e in [e for e in _epochs(df.sparkSession, folder) if e < epoch][:-1]:
        path, fs = _fs(df.sparkSession, f"{folder}/epoch={e}")
        fs.delete(path, True)


def _upsert(folder: str, key: str, keep=lambda df: df):
    """foreachBatch function: rows of a batch replace those of the same key in a small table."""
    def merge(batch: DataFrame, epoch: int):
        prev = _read_epoch(batch.sparkSession, folder, below=epoch)
        both = batch if prev is None else batch.unionByName(prev.join(batch.select(key), key, "left_anti"))
        _write_epoch(keep(both), folder, epoch)
    return merge


def _last_days(d: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    last = d.agg(F.max("day").alias("_last"))
    return d.crossJoin(F.broadcast(last)).where(F.col("day") >= F.date_sub(F.col("_last"), keep_days)).select("day", "n")


def start_daily_counts(spark: SparkSession, sf_dir: str, out_dir: str, base: str | None = None,
                       available_now: bool = True, events: DataFrame | None = None):
    """S1 stream: success events -> 1-day tumbling windows; each batch adds its days to the table
    below ``out_dir`` (the last 30 days stay).

    A row is late when its day had ended by the watermark: the latest event time of the batches
    before, less 30 days.  Late rows change no day; their number is kept beside the table.
    State is the table itself (a few dozen rows and one of totals), so a replayed batch starts
    from its predecessor's state and a restart goes on where the stream stopped.
    """
    ev = tb.prediction_events(spark, sf_dir, events if events is not None else tb.stream_table(spark, sf_dir, "events"))
    ev = ev.where("success").select(F.col("ts").cast("timestamp").alias("ts"))

    def merge(batch: DataFrame, epoch: int):
        sp = batch.sparkSession
        days, totals = _read_epoch(sp, out_dir, below=epoch), _read_epoch(sp, f"{out_dir}/late", below=epoch)
        last = totals.first() if totals is not None else None           # one row
        edge = None if last is None or last["latest"] is None else last["latest"] - KEEP_DAYS * 86_400_000_000
        ended = F.unix_micros(F.date_add("day", 1).cast("timestamp"))
        new = materialize_small(batch.groupBy(F.to_date("ts").alias("day")).agg(cnt().alias("n"), F.max(F.unix_micros("ts")).alias("latest"))
                                .withColumn("late", F.lit(False) if edge is None else ended <= edge))   # a row a day
        fresh = new.where("NOT late").select("day", "n")
        both = fresh if days is None else days.unionByName(fresh).groupBy("day").agg(F.sum("n").alias("n"))
        _write_epoch(_last_days(both), out_dir, epoch)
        one = new.agg(F.max("latest").alias("latest"), F.coalesce(F.sum(F.when(F.col("late"), F.col("n"))), F.lit(0)).alias("late"))
        if last is not None:
            one = one.select(F.greatest("latest", F.lit(last["latest"]).cast("long")).alias("latest"), (F.col("late") + last["late"]).alias("late"))
        _write_epoch(one, f"{out_dir}/late", epoch)

    w = ev.writeStream.foreachBatch(merge).option("checkpointLocation", _ckpt(spark, "daily_counts", base))
    q = (w.trigger(availableNow=True) if available_now else w).start()
    q.late_dir = f"{out_dir}/late"
    return q


def read_daily_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """S1 result of the latest completed micro-batch."""
    return _read_epoch(spark, out_dir)


def late_rows(query) -> int:
    """Number of rows that came behind the watermark, over all runs of the stream so far."""
    spark = SparkSession.getActiveSession()
    totals = _read_epoch(spark, query.late_dir)
    return totals.first()["late"] if totals is not None else 0


def start_response_tail(spark: SparkSession, sf_dir: str, tail_dir: str, base: str | None = None,
                        tail: int = TAIL, available_now: bool = True):
    """S2 stream: each micro-batch merges its rows into a <= ``tail``-row table of the most
    recent requests and adds its count to the running total (both stored under ``tail_dir``)."""
    ev = tb.prediction_events(spark, sf_dir, tb.stream_table(spark, sf_dir, "events"))

    def merge(batch: DataFrame, epoch: int):
        sp = batch.sparkSession
        rows, total = batch.select("request_id", "ts", "response_ms"), batch.agg(cnt().alias("total"))
        prev, before = (_read_epoch(sp, f"{tail_dir}/{x}", below=epoch) for x in ("tail", "total"))
        if prev is not None:
            rows = prev.unionByName(rows)
        if before is not None:
            total = total.unionByName(before).agg(F.sum("total").alias("total"))
        # top-k merge: at most ``tail`` rows survive, computed per task then merged
        _write_epoch(rows.orderBy(F.col("ts").desc(), F.col("request_id").desc()).limit(tail), f"{tail_dir}/tail", epoch)
        _write_epoch(total, f"{tail_dir}/total", epoch)

    w = ev.writeStream.foreachBatch(merge).option("checkpointLocation", _ckpt(spark, "response_tail", base))
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_response_stats(spark: SparkSession, tail_dir: str) -> DataFrame:
    """S2 result of the latest completed micro-batch."""
    total = _read_epoch(spark, f"{tail_dir}/total").select(F.col("total").alias("total_requests"))
    return _tail_stats(_read_epoch(spark, f"{tail_dir}/tail"), total)


def start_stream_score(spark: SparkSession, sf_dir: str, out_dir: str, base: str | None = None,
                       available_now: bool = True):
    """S3 stream: lineitem arrivals -> requests (stream-static join with part) -> validation
    and scoring -> Parquet sink (append)."""
    req = tb.requests(spark, sf_dir, tb.stream_table(spark, sf_dir, "lineitem"))
    w = (score_requests(req).writeStream.outputMode("append").format("parquet").option("path", out_dir)
         .option("checkpointLocation", _ckpt(spark, "stream_score", base)))
    return (w.trigger(availableNow=True) if available_now else w).start()


def start_model_score(spark: SparkSession, sf_dir: str, out_dir: str, models: dict, base: str | None = None,
                      available_now: bool = True):
    """S3 stream with a fitted pipeline (``models`` of fit_all or load_models): requests are
    validated and scored by the trained regressors on zone-only features -> Parquet (append)."""
    from shiplens.operators.models import batch_predict
    req = tb.requests(spark, sf_dir, tb.stream_table(spark, sf_dir, "lineitem"))
    w = (batch_predict(req, models).writeStream.outputMode("append").format("parquet").option("path", out_dir)
         .option("checkpointLocation", _ckpt(spark, "model_score", base)))
    return (w.trigger(availableNow=True) if available_now else w).start()


def store_route_medians(history: DataFrame, table_dir: str, epoch: int = 0) -> None:
    """S3: the trailing medians of every route and day that ``history`` has a frame for, and the global
    ones, as the next epoch below ``table_dir``.  Run it again as history grows; streams take
    the latest complete epoch."""
    from shiplens.operators import features as fe
    known, overall = fe.route_median_table(history)
    _write_epoch(overall, f"{table_dir}/overall", epoch)
    _write_epoch(known, f"{table_dir}/routes", epoch)


def start_history_score(spark: SparkSession, sf_dir: str, out_dir: str, models: dict, table_dir: str, base: str | None = None,
                        available_now: bool = True):
    """S3 stream on history: each micro-batch of requests is joined to the stored route medians as of
    its dates (read anew, so a refreshed table counts from the next batch on) and scored like
    ``batch_predict`` with a history.  One folder per micro-batch; a replay overwrites its own."""
    from shiplens.operators.models import batch_predict
    req = tb.requests(spark, sf_dir, tb.stream_table(spark, sf_dir, "lineitem"))

    def score(batch: DataFrame, epoch: int):
        sp = batch.sparkSession
        medians = _read_epoch(sp, f"{table_dir}/routes"), _read_epoch(sp, f"{table_dir}/overall")
        batch_predict(batch, models, medians=medians).write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")

    w = req.writeStream.foreachBatch(score).option("checkpointLocation", _ckpt(spark, "history_score", base))
    return (w.trigger(availableNow=True) if available_now else w).start()


def start_service_summary(spark: SparkSession, sf_dir: str, out_dir: str, base: str | None = None,
                          available_now: bool = True):
    """S4 stream: lineitem arrivals joined to the static dimensions, per-service running
    count/mean/std (state = mergeable aggregation buffers), update mode; each batch
    upserts the services it changed below ``out_dir``."""
    s = tb.shipments(spark, sf_dir, tb.stream_table(spark, sf_dir, "lineitem"))
    w = (stream_service_summary(s).writeStream.outputMode("update").foreachBatch(_upsert(out_dir, "service_level"))
         .option("checkpointLocation", _ckpt(spark, "service_summary", base)))
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_service_summary(spark: SparkSession, out_dir: str) -> DataFrame:
    """S4 result of the latest completed micro-batch."""
    return _read_epoch(spark, out_dir)
