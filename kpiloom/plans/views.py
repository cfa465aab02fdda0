"""Telemetry derived from the ``events`` table, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VENDORS = ("free5gc", "open5gs", "ericsson_enm")


def seconds(ts: str | Column) -> Column:
    """Whole seconds since the epoch."""
    return F.floor(F.col(ts).cast("timestamp").cast("double")) if isinstance(ts, str) else F.floor(ts.cast("timestamp").cast("double"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample for each event: an instance a user, counters run over (inst, metric); one restarts every 5 samples.

    Windows are taken by instance and metric, so their number grows with the data and none with the whole history.
    """
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    key = Window.partitionBy("inst", "metric")
    order = key.orderBy("ts", "event_id")
    rows = e.select(
        "event_id", "ts", F.col("user_id").cast("int").alias("inst"), F.when(F.col("user_id") % 2 == 0, "310-260").otherwise("311-480").alias("plmn"),
        F.col("event_type").alias("metric"), F.get_json_object("props", "$.k").alias("k"), F.round(F.col("value") * 100).cast("bigint").alias("iv"), F.col("value"),
    )
    rows = rows.withColumn("vendor", F.element_at(F.array(*map(F.lit, VENDORS)), F.col("inst") % 3 + 1))
    rows = rows.withColumn("n", F.row_number().over(order) - 1).withColumn("raw", F.sum("iv").over(order))
    block = Window.partitionBy("inst", "metric", F.floor(F.col("n") / 5)).orderBy("ts", "event_id")
    return rows.withColumn("raw_reset", F.sum("iv").over(block)).withColumn("hour", F.floor(seconds("ts") / 3600).cast("bigint"))


SERIES = """
s0 AS (
  SELECT event_id, ts, CAST(user_id AS INTEGER) AS inst, CASE WHEN user_id % 2 = 0 THEN '310-260' ELSE '311-480' END AS plmn,
         event_type AS metric, json_extract_string(props, '$.k') AS k, CAST(round(value * 100) AS BIGINT) AS iv, value,
         CASE user_id % 3 WHEN 0 THEN 'free5gc' WHEN 1 THEN 'open5gs' ELSE 'ericsson_enm' END AS vendor,
         CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour
  FROM events
), s1 AS (SELECT *, row_number() OVER (PARTITION BY inst, metric ORDER BY ts, event_id) - 1 AS n FROM s0
), series AS (
  SELECT *, CAST(sum(iv) OVER (PARTITION BY inst, metric ORDER BY ts, event_id) AS BIGINT) AS raw,
         CAST(sum(iv) OVER (PARTITION BY inst, metric, n // 5 ORDER BY ts, event_id) AS BIGINT) AS raw_reset
  FROM s1
)"""


def scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each network and hour: absent counters are 0, absent gauges null, and a success rate."""
    s = series(spark, sf_dir)
    total = lambda m, v: F.sum(F.when(F.col("metric") == m, F.col(v)))
    rows = s.groupBy("plmn", "hour").agg(
        F.coalesce(total("signup", "iv"), F.lit(0)).alias("att"), F.coalesce(total("error", "iv"), F.lit(0)).alias("fail"),
        (total("purchase", "iv") / 100).alias("sess"), (total("click", "iv") / 100).alias("gnb"), (total("view", "iv") / 100).alias("upf"),
    )
    return rows.withColumn("rate", F.when(F.col("att") > 0, (F.col("att") - F.col("fail")) / F.col("att")).otherwise(0.0))


SCRAPES = """
scrapes AS (
  SELECT *, CASE WHEN att > 0 THEN (att - fail) / CAST(att AS DOUBLE) ELSE 0.0 END AS rate FROM (
    SELECT plmn, hour, CAST(coalesce(sum(iv) FILTER (metric = 'signup'), 0) AS BIGINT) AS att, CAST(coalesce(sum(iv) FILTER (metric = 'error'), 0) AS BIGINT) AS fail,
           sum(iv) FILTER (metric = 'purchase') / 100.0 AS sess, sum(iv) FILTER (metric = 'click') / 100.0 AS gnb, sum(iv) FILTER (metric = 'view') / 100.0 AS upf
    FROM series GROUP BY plmn, hour)
)"""


def window_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scrapes as window samples: plmn, slice_id, metric, ts, seq, value."""
    s = scrapes(spark, sf_dir)
    named = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in (("att", "att"), ("reg_rate", "rate"), ("sess", "sess"), ("gnb", "gnb"), ("upf", "upf"))])
    rows = s.select("plmn", F.lit("").alias("slice_id"), F.timestamp_seconds(F.col("hour") * 3600).alias("ts"), F.col("hour").alias("seq"), F.explode(named).alias("m"))
    return rows.select("plmn", "slice_id", "ts", "seq", "m.metric", "m.value").where("value IS NOT NULL")


#: Windows of 24 hours sliding by one, half-open; ``w`` is the first hour.
WINDOWS = """
members AS (
  SELECT s.*, w.w FROM scrapes s, LATERAL (SELECT unnest(range(s.hour - 23, s.hour + 1)) AS w) w
), stats AS (
  SELECT plmn, w,
    count(att) AS att_n, avg(CAST(att AS DOUBLE)) AS att_mean, stddev_pop(CAST(att AS DOUBLE)) AS att_sigma, arg_max(CAST(att AS DOUBLE), hour) AS att_last,
    count(rate) AS reg_rate_n, arg_max(rate, hour) AS reg_rate_last,
    count(sess) AS sess_n, max(sess) AS sess_peak, arg_max(sess, hour) AS sess_last,
    count(gnb) AS gnb_n, max(gnb) AS gnb_peak, arg_max(gnb, hour) AS gnb_last,
    count(upf) AS upf_n, avg(upf) AS upf_mean, arg_max(upf, hour) AS upf_last
  FROM members GROUP BY plmn, w
), fired AS (
  SELECT 'RegistrationStorm' AS rule_name, 'critical' AS severity, 'AMF' AS nf, plmn, w FROM stats
  WHERE att_n >= 4 AND reg_rate_n >= 2 AND att_sigma > 0 AND att_last > att_mean + 3 * att_sigma AND reg_rate_last < 0.9
  UNION ALL
  SELECT 'SessionDrop', 'warning', 'SMF', plmn, w FROM stats
  WHERE sess_n >= 2 AND reg_rate_n >= 1 AND sess_peak > 0 AND (sess_peak - sess_last) / sess_peak > 0.20 AND reg_rate_last >= 0.9
  UNION ALL
  SELECT 'RANCoreDivergence', 'warning', 'gNB', plmn, w FROM stats
  WHERE gnb_n >= 2 AND upf_n >= 2 AND CASE WHEN gnb_peak > 0 THEN (gnb_peak - gnb_last) / gnb_peak ELSE 0 END > 0.30
    AND CASE WHEN upf_mean > 0 THEN abs(upf_last - upf_mean) / upf_mean ELSE 0 END < 0.10
)"""
