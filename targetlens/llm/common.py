"""Helpers shared by the operators: tables, words, scratch tables, row identity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens.session import shared_folder

#: Rows of a few longs or short strings up to which a join side is sent to every executor.
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if its counted ``rows`` are within the bound, else left to a shuffle join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A value used only inside a lambda would otherwise be computed again for every element.
    """
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; NULL becomes empty."""
    text = F.coalesce(text, F.lit(""))
    one_byte = F.octet_length(text) == F.char_length(text)
    return F.when(one_byte, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def plain_words(text: Column) -> Column:
    """Array of the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text in ASCII lower case."""
    return F.array_remove(F.split(ascii_lower(text), WORD_GAP), "")


def space_words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_GAP), "")


def row_identity(id_col: str, text_col: str) -> list[Column]:
    """(_id, _h): rows that agree in both get the same answer, so repeated and NULL ids are safe."""
    return [F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h")]


def boxed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_row, _id, _h): all columns in one struct, so that no name of theirs can clash."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("_row"), *row_identity(id_col, text_col))


def unboxed(columns: list[str], replaced: dict[str, Column] | None = None) -> list[Column]:
    """The columns of a boxed row, some of them replaced."""
    replaced = replaced or {}
    return [replaced.get(c, F.col("_row")[c]).alias(c) for c in columns]


def without_lines(text: Column, gone: Column) -> Column:
    """The text less the lines (counted from 0) of the array ``gone``."""
    left = let(F.split(text, "\n"), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)), "\n"))
    return F.when(F.size(gone) > 0, left).otherwise(text)


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_h"] == right["_h"])


class Scratch:
    """Tables in the shared folder that are deleted when they are no longer needed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        path = shared_folder(self.spark, "table")
        df.write.parquet(path)
        self.paths.append(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((kept, path))
        return kept

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def drop(self, keep_last: int = 0) -> None:
        cut = len(self.paths) - keep_last
        for path in self.paths[:cut]:
            self._delete(path)
        self.paths = self.paths[cut:]

    def only(self, *needed: DataFrame) -> None:
        """Delete every table but these, which ``keep`` has returned."""
        wanted = {path for df, path in self.tables if any(df is x for x in needed)}
        for path in self.paths:
            if path not in wanted:
                self._delete(path)
        self.paths = [path for path in self.paths if path in wanted]
