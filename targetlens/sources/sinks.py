"""Sinks: tables, one-row JSON summaries, appended results, table fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sink_tables(df: DataFrame, path: str, kind: str = "parquet", by: tuple[str, ...] = ()) -> None:
    """Overwrite a result table; CSV with a header on request."""
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    if kind == "csv":
        flat = df.select(*[
            F.array_join(f.name, ",").alias(f.name) if f.dataType.typeName() == "array" else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ])
        flat.write.mode("overwrite").option("header", True).csv(path)
    else:
        writer.parquet(path)


def summary_json(summary: DataFrame) -> DataFrame:
    """One JSON line per row of a summary."""
    return summary.select(F.to_json(F.struct(*summary.columns)).alias("value"))


def sink_summary_json(summary: DataFrame, path: str) -> None:
    summary_json(summary).write.mode("overwrite").text(path)


def sink_append_results(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _portable_hash(row: Column) -> Column:
    """First 15 hex digits of an md5, as a number any engine can compute."""
    return F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)")


def input_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """(name, rows, digest): order-insensitive content hash; duplicate rows count.

    Every field is written with its length before it, so no two rows read alike.
    """
    field = lambda c: F.coalesce(F.concat(F.char_length(c), F.lit(":"), c), F.lit("-"))
    text = F.concat_ws("|", *[field(F.col(f"`{c}`").cast("string")) for c in df.columns])
    return df.agg(
        F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_portable_hash(text)), F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest"),
    )


def file_fingerprint(spark, path: str) -> DataFrame:
    """(name, sha256) of every file under a path."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("name"), F.sha2("content", 256).alias("sha256")
    )


def changed_inputs(now: DataFrame, before: DataFrame) -> DataFrame:
    """(name, state): new, changed, removed or same, against the last manifest."""
    old = before.select("name", F.col("digest").alias("_old"))
    return now.select("name", "digest").join(old, "name", "full_outer").select(
        "name",
        F.when(F.col("_old").isNull(), "new").when(F.col("digest").isNull(), "removed")
        .when(F.col("digest") != F.col("_old"), "changed").otherwise("same").alias("state"),
    )
