"""Readers: delimited tables, text lines with line numbers, saved XML summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from targetlens.functions.columns import resolve_column

# Accepted gene and source column names of target lists.
GENE_COLUMNS = (
    "gene", "symbol", "hgnc", "gene_symbol", "hugo", "node1", "node2", "protein1", "protein2",
    "source", "target", "string_id1", "string_id2",
)
SOURCE_COLUMNS = ("source", "database", "data_source", "target_source", "origin")

XML_SCHEMA = (
    "Id string, Item array<struct<_Name: string, _Type: string, _VALUE: string, "
    "Item: array<struct<_Name: string, _Type: string, _VALUE: string>>>>"
)


def scan_delimited(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, or TSV for .tsv / .txt (gzip allowed); every column a string."""
    plain = path.lower().removesuffix(".gz")
    sep = "\t" if plain.endswith((".tsv", ".txt")) else ","
    return spark.read.option("header", True).option("sep", sep).csv(path)


def gene_list(table: DataFrame, gene_column: str | None = None) -> DataFrame:
    """(gene): distinct upper-case symbols of the gene column."""
    column = gene_column or resolve_column(table, GENE_COLUMNS, table.columns[0])
    if column not in table.columns:
        raise ValueError(f"gene column '{column}' not found")
    return (
        table.select(F.upper(F.trim(f"`{column}`")).alias("gene")).where("gene <> ''").distinct()
    )


def target_table(table: DataFrame, name: str, gene_column: str | None = None) -> DataFrame:
    """(gene, source) of a compound-target table; ``name`` where it has no source column."""
    column = gene_column or resolve_column(table, GENE_COLUMNS, table.columns[0])
    source = resolve_column(table, SOURCE_COLUMNS)
    return table.select(
        F.upper(F.trim(f"`{column}`")).alias("gene"),
        (F.trim(f"`{source}`") if source else F.lit(name)).alias("source"),
    ).where("gene <> ''").distinct()


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, line_no, value): text lines numbered from 1 within their file.

    Lines are numbered inside each input block (a bounded split of a file) and shifted by the
    lines of the blocks before it, so long files stay distributed.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        "value", F.monotonically_increasing_id().alias("_id"),
    )
    before = W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    shifts = raw.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n")).select(
        "file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy("file", "_block").orderBy("_id")
    return (
        raw.withColumn("_i", F.row_number().over(inside)).join(shifts, ["file", "_block"])
        .select("file", (F.col("_i") + F.col("_before")).alias("line_no"), "value")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): one whole JSON document per file."""
    return spark.read.option("wholetext", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )


def scan_catalog_xml(spark: SparkSession, path: str) -> DataFrame:
    """Raw catalog columns from saved XML summaries."""
    docs = spark.read.format("xml").option("rowTag", "DocSum").schema(XML_SCHEMA).load(path)
    return catalog_items(docs)


def catalog_items(docs: DataFrame) -> DataFrame:
    """Named items of parsed summaries as columns; the sample list becomes a count."""
    named = lambda name: F.try_element_at(
        F.filter("Item", lambda i: i["_Name"] == name), F.lit(1)
    )
    text = lambda name: F.trim(named(name)["_VALUE"])
    samples = F.size(F.filter(named("Samples")["Item"], lambda i: i["_Name"] == "Sample"))
    return docs.select(
        F.col("Id").alias("uid"),
        *[text(n).alias(n) for n in ("Accession", "GPL", "PDAT", "gdsType", "entryType", "taxon")],
        text("title").alias("title"), text("summary").alias("summary"),
        F.when(named("Samples").isNotNull(), F.greatest(samples, F.lit(0)).cast("string")).alias("n_samples"),
    )
