"""Table operators on event streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from targetlens.operators.qc import qc_gate
from targetlens.operators.screening import pending_work
from targetlens.operators.signals import contingency_cells, disproportionality


def event_time(stream: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; zone-less times are read in the session zone (UTC)."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def window_pairs(reports: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Distinct reports (id, ts, drug, event) counted per time window and pair."""
    return (
        event_time(reports).withWatermark("ts", late)
        .dropDuplicatesWithinWatermark(["id"])
        .groupBy(F.window("ts", width), "drug", "event").agg(F.count(F.lit(1)).alias("a"))
        .select(F.col("window.start").alias("start"), "drug", "event", "a")
    )


def stream_signals(
    reports: DataFrame, counts_path: str, checkpoint: str, late: str = "1 hour", width: str = "1 day"
) -> StreamingQuery:
    """Append closed window counts of drug-event pairs to ``counts_path``.

    The ratios need the marginals of the whole table, so ``current_signals`` computes them from
    the stored counts. The file sink commits each batch once.
    """
    return (
        window_pairs(reports, late, width).writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint).option("path", counts_path)
        .trigger(availableNow=True).start()
    )


def current_signals(stored: DataFrame, min_count: int = 3) -> DataFrame:
    """Signals over all stored window counts."""
    pairs = stored.groupBy("drug", "event").agg(F.sum("a").cast("double").alias("a"))
    return disproportionality(contingency_cells(pairs), min_count)


def stream_qc_metrics(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Tumbling-window metrics of (ts, value, failed): rows, mean value, failure rate."""
    return (
        event_time(events).withWatermark("ts", late).groupBy(F.window("ts", width))
        .agg(
            F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"),
            F.avg(F.col("failed").cast("double")).alias("failure_rate"),
        )
        .select(F.col("window.start").alias("start"), "n", "mean_value", "failure_rate")
    )


def stream_qc_gate(
    events: DataFrame, path: str, checkpoint: str,
    thresholds: Mapping[str, tuple[str, float | None, str]], late: str = "1 hour", width: str = "1 day",
) -> StreamingQuery:
    """Append the gate checks of every closed window; rows behind the watermark are dropped."""
    metrics = stream_qc_metrics(events, late, width)
    checks = qc_gate(metrics, thresholds, keep=["start"])
    return (
        checks.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint).option("path", path)
        .trigger(availableNow=True).start()
    )


def append_once(path: str, key: str = "id") -> Callable[[DataFrame, int], None]:
    """Batch writer that appends only work without a stored ok row; safe to replay.

    A replayed batch finds its own rows by batch number and does not write them again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.groupBy(key).agg(
            F.max_by(F.struct(*batch.columns), F.struct((F.col("status") == "ok").alias("s"), *batch.columns)).alias("r")
        ).select("r.*")
        target = f"{path}/batch={number}"
        try:
            stored = spark.read.option("basePath", path).parquet(path).where(F.col("batch") != number)
            rows = pending_work(rows, stored, key)
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
        rows.write.mode("overwrite").parquet(target)

    return write


def latest_results(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """One row per key of what ``stream_results_append`` (or ``append_once``) has written: an ok row if there is one, else the latest."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c != "batch"]
    newest = F.max_by(F.struct(*columns), F.struct((F.col("status") == "ok").alias("ok"), F.col("batch"), F.struct(*columns)))
    return rows.groupBy(key).agg(newest.alias("r")).select("r.*")


def stream_results_append(results: DataFrame, path: str, checkpoint: str, key: str = "id") -> StreamingQuery:
    """Append finished work (key, status, ...) once: nothing more of a key after its first ok row.

    One state row per key tells whether an ok row is stored and how many rows are. A batch reads its
    own rows and their keys' states, never what is stored; of a key's rows in a batch the best one is
    appended, an ok row before others. The state and the file sink share the checkpoint, so that a
    repeated batch appends nothing twice. ``batch`` counts the rows of a key.
    """
    columns = results.columns
    schema = StructType([*results.schema.fields, StructField("batch", LongType())])

    def step(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, number = state.get if state.exists else (False, 0)
        best = None
        for part in parts:  # a row at most stays of each piece
            part = part if best is None else pd.concat([best, part])
            good = part[part["status"] == "ok"]
            best = (good if len(good) else part).sort_values(columns, na_position="first").tail(1)
        if done or best is None:
            return
        state.update((bool((best["status"] == "ok").any()), number + 1))
        yield best.assign(batch=number)

    rows = results.groupBy(key).applyInPandasWithState(step, schema, "done boolean, number long", "append", GroupStateTimeout.NoTimeout)
    return (
        rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", path)
        .trigger(availableNow=True).start()
    )
