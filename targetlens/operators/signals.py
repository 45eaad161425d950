"""Drug-event disproportionality signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.functions.columns import number, ratio, resolve_column, yes

COUNT_ALIASES = ("count", "n", "cases", "reports")


def pair_contingency(
    reports: DataFrame,
    drug_column: str = "drug",
    event_column: str = "event",
    count_column: str | None = None,
) -> DataFrame:
    """2x2 cells a, b, c, d of every drug-event pair; reports without a count weigh 1."""
    count_column = count_column or resolve_column(reports, COUNT_ALIASES)
    weight = F.coalesce(number(count_column), F.lit(1.0)) if count_column else F.lit(1.0)
    pairs = (
        reports.select(
            F.trim(F.col(drug_column).cast("string")).alias("drug"),
            F.trim(F.col(event_column).cast("string")).alias("event"),
            weight.alias("weight"),
        )
        .where((F.col("drug") != "") & (F.col("event") != ""))
        .groupBy("drug", "event")
        .agg(F.sum("weight").alias("a"))
    )
    return contingency_cells(pairs)


def contingency_cells(pairs: DataFrame) -> DataFrame:
    """Cells from summed pairs (drug, event, a)."""
    everything = pairs.agg(F.sum("a")).scalar()
    by_drug = pairs.groupBy("drug").agg(F.sum("a").alias("_drug"))
    by_event = pairs.groupBy("event").agg(F.sum("a").alias("_event"))
    return (
        pairs.join(by_drug, "drug")
        .join(by_event, "event")
        .withColumn("n", everything)
        .select(
            "drug", "event", "a",
            (F.col("_drug") - F.col("a")).alias("b"),
            (F.col("_event") - F.col("a")).alias("c"),
            (F.col("n") - F.col("_drug") - F.col("_event") + F.col("a")).alias("d"),
            "n",
        )
    )


def _inverse(c: Column) -> Column:
    return F.try_divide(F.lit(1.0), c)


def disproportionality(cells: DataFrame, min_count: int = 3) -> DataFrame:
    """ROR, PRR, chi-square, IC and EBGM with their bounds and flags.

    A zero cell makes the affected measures NULL and their flags false.
    """
    a, b, c, d, n = (F.col(x) for x in "abcdn")

    def bound(point: str, error: str, sign: int) -> Column:
        value = F.col(point)
        return F.when(value > 0, F.exp(F.ln(value) + sign * 1.96 * F.col(error)))

    measured = cells.withColumns(
        {
            "ror": ratio(a * d, b * c),
            "_ror_se": F.sqrt(_inverse(a) + _inverse(b) + _inverse(c) + _inverse(d)),
            "prr": ratio(ratio(a, a + b), ratio(c, c + d)),
            "_prr_se": F.sqrt(_inverse(a) - _inverse(a + b) + _inverse(c) - _inverse(c + d)),
            "chi_square": ratio(
                n * F.pow(a * d - b * c, F.lit(2.0)), (a + b) * (c + d) * (a + c) * (b + d)
            ),
            "_expected": (a + b) * (a + c) / n,
        }
    ).withColumns(
        {
            "ror_lower": bound("ror", "_ror_se", -1),
            "ror_upper": bound("ror", "_ror_se", 1),
            "prr_lower": bound("prr", "_prr_se", -1),
            "prr_upper": bound("prr", "_prr_se", 1),
            "ic": F.log2((a + 0.5) / (F.col("_expected") + 0.5)),
            "ebgm": ratio(a, F.col("_expected")),
        }
    ).withColumns(
        {
            "ic_lower": F.col("ic") - F.try_divide(F.lit(3.3), F.sqrt(a)),
            "ebgm05": F.exp(
                F.ln(F.col("ebgm") + 1e-9)
                - 1.96 * F.sqrt(_inverse(a) + _inverse(F.col("_expected")))
            ),
        }
    )
    enough = a >= min_count
    flagged = measured.withColumns(
        {
            "signal_ror": yes(enough & (F.col("ror_lower") > 1.0)),
            "signal_prr": yes(enough & (F.col("prr") >= 2.0) & (F.col("chi_square") >= 4.0)),
            "signal_bcpnn": yes(enough & (F.col("ic_lower") > 0.0)),
            "signal_ebgm": yes(enough & (F.col("ebgm05") > 1.0)),
        }
    )
    return flagged.withColumn(
        "signal",
        F.col("signal_ror") & F.col("signal_prr")
        & (F.col("signal_bcpnn") | F.col("signal_ebgm")),
    ).drop("_ror_se", "_prr_se", "_expected", "n")


def signal_order() -> list[Column]:
    """Report order: signals first, strongest lower bound, then most reports."""
    return [
        F.col("signal").desc(), F.col("ror_lower").desc_nulls_last(), F.col("a").desc(),
        F.col("drug"), F.col("event"),
    ]


def top_signal_drugs(signals: DataFrame, n: int = 10) -> DataFrame:
    """Drugs with the most reports among their signals."""
    return (
        signals.where("signal").groupBy("drug").agg(F.sum("a").alias("reports"))
        .orderBy(F.col("reports").desc(), "drug").limit(n)
    )
