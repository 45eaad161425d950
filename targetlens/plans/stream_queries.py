"""Registered queries: the stream operators run over the events table to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from targetlens.plans import bindings as b
from targetlens.plans.registry import Family, rounded, rsql
from targetlens.session import shared_folder
from targetlens.streaming import streams as sm

family = Family()
register = family.register
QUERIES, ORACLES = family.queries, family.oracles

# A window closes when the watermark, one hour behind the newest event, has passed its end.
_CLOSED = """last AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events),
closed AS (SELECT *, date_trunc('day', ts) AS start FROM events, last
  WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark)"""


def _events(spark, folder):
    """The events table as a stream; the glob lets later files join in."""
    schema = b.table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


@register("stream_signals", f"""WITH {_CLOSED},
    p AS (SELECT event_type AS drug, 'E' || CAST(user_id % 10 AS VARCHAR) AS event, CAST(count(*) AS DOUBLE) AS a FROM closed GROUP BY 1, 2),
    c AS (SELECT *, sum(a) OVER (PARTITION BY drug) - a AS b, sum(a) OVER (PARTITION BY event) - a AS c,
      sum(a) OVER () - sum(a) OVER (PARTITION BY drug) - sum(a) OVER (PARTITION BY event) + a AS d FROM p)
    SELECT drug, event, a, b, c, d, {rsql('a * d / (b * c) AS ror', '(a / (a + b)) / (c / (c + d)) AS prr')} FROM c""")
def stream_signals(spark, folder):
    reports = _events(spark, folder).select(
        F.col("event_id").alias("id"), "ts", F.col("event_type").alias("drug"),
        F.concat(F.lit("E"), (F.col("user_id") % 10).cast("string")).alias("event"))
    out = shared_folder(spark, "signals")
    sm.stream_signals(reports, f"{out}/counts", f"{out}/state").awaitTermination()
    signals = sm.current_signals(spark.read.parquet(f"{out}/counts"))
    return rounded(signals.select("drug", "event", "a", "b", "c", "d", "ror", "prr"))


@register("stream_qc_gate", f"""WITH {_CLOSED},
    m AS (SELECT start, count(*) AS n, avg(value) AS mean_value,
      avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS failure_rate FROM closed GROUP BY 1)
    SELECT CAST(start AS VARCHAR) AS start, 'min_rows' AS name, CAST(n AS DOUBLE) AS value, CAST(300 AS DOUBLE) AS threshold,
      CASE WHEN n >= 300 THEN 'pass' ELSE 'fail' END AS level, n >= 300 AS ok FROM m
    UNION ALL SELECT CAST(start AS VARCHAR), 'max_failure_rate', round(failure_rate, 6), CAST(0.2 AS DOUBLE),
      CASE WHEN failure_rate <= 0.2 THEN 'pass' ELSE 'fail' END, failure_rate <= 0.2 FROM m""")
def stream_qc_gate(spark, folder):
    events = _events(spark, folder).select("ts", "value", (F.col("event_type") == "error").alias("failed"))
    out = shared_folder(spark, "gate")
    limits = {"min_rows": ("n", 300, "min"), "max_failure_rate": ("failure_rate", 0.2, "max")}
    sm.stream_qc_gate(events, f"{out}/checks", f"{out}/state", limits).awaitTermination()
    checks = spark.read.parquet(f"{out}/checks")
    return rounded(checks.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss")))


@register("stream_results_append", """SELECT user_id AS id, CASE WHEN bool_or(event_type = 'purchase') THEN 'ok' ELSE 'failed' END AS status
    FROM events GROUP BY 1""")
def stream_results_append(spark, folder):
    results = _events(spark, folder).select(
        F.col("user_id").alias("id"),
        F.when(F.col("event_type") == "purchase", "ok").otherwise("failed").alias("status"))
    out = shared_folder(spark, "results")
    sm.stream_results_append(results, f"{out}/rows", f"{out}/state").awaitTermination()
    return sm.latest_results(spark, f"{out}/rows").select("id", "status")
