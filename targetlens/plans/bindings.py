"""Domain tables derived from the star-schema tables, and their SQL twins.

Every binding reads whole tables; nothing is cut by id, prefix or row number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from targetlens.operators.expression import log_normalize

MITO = "^small "
RIBO = "^large "
CASE, NORMAL = "EUROPE", "ASIA"
WORDS = ("blue", "cold", "hot", "large", "new", "old", "red", "small")


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; its footer is read for the schema only once."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def counts(spark: SparkSession, folder: str) -> DataFrame:
    """(gene, cell, value): quantity of each part name bought by each customer."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_name").alias("gene"), F.col("o_custkey").alias("cell"))
        .agg(F.sum("l_quantity").alias("value"))
    )


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """(cell, sample, condition, celltype): customers with nation, region and segment."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return (
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("cell"), F.col("n_name").alias("sample"),
            F.col("r_name").alias("condition"), F.col("c_mktsegment").alias("celltype"),
        )
    )


def expression(spark: SparkSession, folder: str) -> DataFrame:
    """(gene, sample, value): mean quantity per customer for each part name and nation."""
    people = cells(spark, folder)
    sizes = people.groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts(spark, folder).join(people.select("cell", "sample"), "cell")
        .groupBy("gene", "sample").agg(F.sum("value").alias("v"))
        .join(sizes, "sample")
        .select("gene", "sample", (F.col("v") / F.col("n")).alias("value"))
    )


def normalised(spark: SparkSession, folder: str) -> DataFrame:
    """Log-normalised counts."""
    return log_normalize(counts(spark, folder))


def word_sets(spark: SparkSession, folder: str) -> DataFrame:
    """(set_name, set_pos, gene): part names grouped by their first word."""
    names = table(spark, folder, "part").select(F.col("p_name").alias("gene")).distinct()
    word = F.split_part("gene", F.lit(" "), F.lit(1))
    order = F.array(*[F.lit(w) for w in WORDS])
    return names.select(
        word.alias("set_name"), F.array_position(order, word).cast("int").alias("set_pos"), "gene"
    )


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """(sample, condition, cell_type): nations with region; the cell type is the key class."""
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("sample"), F.col("r_name").alias("condition"),
        F.concat(F.lit("T"), (F.col("n_nationkey") % 4).cast("string")).alias("cell_type"),
    )


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """(drug, event, count): part names against order priorities, one row per line item."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("p_name").alias("drug"), F.col("o_orderpriority").alias("event"),
            F.col("l_quantity").alias("count"),
        )
    )


def screening(spark: SparkSession, folder: str) -> DataFrame:
    """(id, affinity, status): one screening result per line item."""
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        (-F.col("l_extendedprice") / 10000.0).alias("affinity"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("ok").alias("status"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog rows from the documents: the whole text is both title and summary."""
    docs = table(spark, folder, "documents")
    return docs.select(
        F.concat(F.lit("GSE"), F.col("doc_id").cast("string")).alias("accession"),
        F.col("text").alias("title"), F.col("text").alias("summary"),
        F.col("lang").alias("organism"), F.col("n_chars").cast("string").alias("samples"),
        F.col("source").alias("platform"),
        F.concat_ws(
            "-", (2000 + F.col("doc_id") % 25).cast("string"),
            (1 + F.col("doc_id") % 12).cast("string"), (1 + F.col("doc_id") % 28).cast("string"),
        ).alias("date"),
        F.concat(F.lit("Expression by "), F.col("source")).alias("type"),
    )


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """(protein1, protein2): parts of consecutive line numbers of the same order."""
    lines = (
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    )
    following = lines.select(
        "l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("next")
    )
    return lines.join(following, ["l_orderkey", "l_linenumber"]).select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("protein1"),
        F.concat(F.lit("P"), F.col("next").cast("string")).alias("protein2"),
    )


def target_sources(spark: SparkSession, folder: str) -> DataFrame:
    """(gene, source): part of a line item under its return flag and line status."""
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("gene"),
        F.concat("l_returnflag", "l_linestatus").alias("source"),
    )


def disease_genes(spark: SparkSession, folder: str) -> DataFrame:
    """(gene): small parts."""
    return table(spark, folder, "part").where(F.col("p_size") < 25).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("gene")
    )


# SQL twins, joined into WITH clauses by ``sql``.
CTES = {
    "counts": """counts AS (SELECT p_name AS gene, o_custkey AS cell, sum(l_quantity) AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY 1, 2)""",
    "cells": """cells AS (SELECT c_custkey AS cell, n_name AS sample, r_name AS condition,
        c_mktsegment AS celltype FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)""",
    "norm": """norm AS (SELECT gene, cell,
        ln(1 + 1e4 * value / sum(value) OVER (PARTITION BY cell)) AS value FROM counts)""",
    "expression": """expression AS (SELECT gene, sample, sum(value) / max(n) AS value
        FROM counts JOIN cells USING (cell)
        JOIN (SELECT sample, count(*) AS n FROM cells GROUP BY 1) USING (sample) GROUP BY 1, 2)""",
    "word_sets": """word_sets AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS set_name,
        CAST(list_position(['blue','cold','hot','large','new','old','red','small'],
        split_part(p_name, ' ', 1)) AS INTEGER) AS set_pos, p_name AS gene FROM part)""",
    "samples": """samples AS (SELECT n_name AS sample, r_name AS condition,
        'T' || CAST(n_nationkey % 4 AS VARCHAR) AS cell_type
        FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "reports": """reports AS (SELECT p_name AS drug, o_orderpriority AS event, l_quantity AS count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)""",
    "screening": """screening AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey,
        l_suppkey) AS id, -l_extendedprice / 10000.0 AS affinity,
        CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'ok' END AS status FROM lineitem)""",
    "catalog": """catalog AS (SELECT 'GSE' || CAST(doc_id AS VARCHAR) AS accession, text AS title,
        text AS summary, lang AS organism, CAST(n_chars AS VARCHAR) AS samples, source AS platform,
        concat_ws('-', 2000 + doc_id % 25, 1 + doc_id % 12, 1 + doc_id % 28) AS date,
        'Expression by ' || source AS type FROM documents)""",
    "interactions": """interactions AS (SELECT 'P' || CAST(a.l_partkey AS VARCHAR) AS protein1,
        'P' || CAST(b.l_partkey AS VARCHAR) AS protein2 FROM lineitem a JOIN lineitem b
        ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber)""",
    "target_sources": """target_sources AS (SELECT 'P' || CAST(l_partkey AS VARCHAR) AS gene,
        l_returnflag || l_linestatus AS source FROM lineitem)""",
    "disease_genes": """disease_genes AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS gene
        FROM part WHERE p_size < 25)""",
    "edges": """edges AS (SELECT DISTINCT least(protein1, protein2) AS src,
        greatest(protein1, protein2) AS dst FROM interactions WHERE protein1 <> protein2)""",
}


def sql(body: str, *names: str) -> str:
    """WITH clause of the named twins (in the given order) before ``body``.

    ``body`` may start with further CTEs, then with a comma-free ``name AS (...)`` list that
    ends in its own SELECT.
    """
    body = body.strip()
    head = ",\n".join(CTES[n] for n in names)
    if not head:
        return body
    joiner = "\n" if body.upper().startswith("SELECT") else ",\n"
    return f"WITH {head}{joiner}{body}"


ERFC_SQL = (
    "(1/(1+0.5*({x}))*exp(-({x})*({x})-1.26551223+(1/(1+0.5*({x})))*(1.00002368"
    "+(1/(1+0.5*({x})))*(0.37409196+(1/(1+0.5*({x})))*(0.09678418+(1/(1+0.5*({x})))*(-0.18628806"
    "+(1/(1+0.5*({x})))*(0.27886807+(1/(1+0.5*({x})))*(-1.13520398+(1/(1+0.5*({x})))*(1.48851587"
    "+(1/(1+0.5*({x})))*(-0.82215223+(1/(1+0.5*({x})))*0.17087277))))))))))"
)


def erfc_sql(x: str) -> str:
    return ERFC_SQL.replace("{x}", x)
