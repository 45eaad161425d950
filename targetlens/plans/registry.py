"""Helpers shared by the query families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round the doubles so that both engines print the same value; -0.0 becomes 0.0."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in names})


def rsql(*columns: str, digits: int = 6) -> str:
    """SQL twin of ``rounded``; an item may be 'expression AS name'."""
    items = []
    for c in columns:
        expression, _, name = c.rpartition(" AS ") if " AS " in c else (c, "", "")
        items.append(f"round({expression}, {digits}) + 0.0 AS {name or expression}")
    return ", ".join(items)


class Family:
    """Queries of one family with their SQL twins."""

    def __init__(self):
        self.queries, self.oracles = {}, {}

    def register(self, name: str, twin: str | None = None):
        def keep(run):
            self.queries[name] = run
            if twin is not None:
                self.oracles[name] = twin
            return run

        return keep
