"""Closed forms Spark does not ship: erfc, log-factorial, hypergeometric tails."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chebyshev coefficients of the public erfc approximation (relative error 1.2e-7).
ERFC_COEFFICIENTS = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]

# Lanczos coefficients for g = 7.
LANCZOS_COEFFICIENTS = [
    0.99999999999980993, 676.5203681218851, -1259.1392167224028,
    771.32342877765313, -176.61502916214059, 12.507343278686905,
    -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
]


def erfc(x: Column) -> Column:
    """Complementary error function of a non-negative column."""
    t = 1.0 / (1.0 + 0.5 * x)
    series: Column = F.lit(ERFC_COEFFICIENTS[-1])
    for coefficient in reversed(ERFC_COEFFICIENTS[:-1]):
        series = F.lit(coefficient) + t * series
    return t * F.exp(-x * x + series)


def normal_two_sided(z: Column) -> Column:
    """Two-sided normal tail of a z score."""
    return F.least(F.lit(1.0), erfc(F.abs(z) / math.sqrt(2.0)))


def ln_factorial(n: Column) -> Column:
    """ln(n!) for n >= 0."""
    x = n.cast("double")
    series: Column = F.lit(LANCZOS_COEFFICIENTS[0])
    for i, coefficient in enumerate(LANCZOS_COEFFICIENTS[1:], start=1):
        series = series + F.lit(coefficient) / (x + float(i))
    t = x + 7.5
    return 0.5 * math.log(2 * math.pi) + (x + 0.5) * F.ln(t) - t + F.ln(series)


def ln_choose(n: Column, k: Column) -> Column:
    return ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k)


def hypergeometric_support(drawn: Column, marked: Column, population: Column) -> tuple[Column, Column]:
    """Range of the hypergeometric variable that carries any weight in double precision.

    The full support may be as long as the population, but beyond 40 standard deviations
    (plus a constant for tiny cases) every term underflows, so the range grows with the
    square root of the population only.
    """
    n, k, m = (c.cast("double") for c in (population, drawn, marked))
    mean = F.try_divide(k * m, n)
    variance = F.try_divide(k * m * (n - m) * (n - k), n * n * F.greatest(n - 1.0, F.lit(1.0)))
    reach = 40.0 * F.sqrt(variance) + 200.0
    low = F.greatest(F.lit(0.0), k + m - n, F.floor(mean - reach).cast("double"))
    high = F.least(k, m, F.ceil(mean + reach).cast("double"))
    return low.cast("long"), high.cast("long")


def hypergeometric_ln_pmf(x: Column, drawn: Column, marked: Column, population: Column) -> Column:
    return (
        ln_choose(marked, x)
        + ln_choose(population - marked, drawn - x)
        - ln_choose(population, drawn)
    )


def _sum_over(low: Column, high: Column, term) -> Column:
    values = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + term(x))


def hypergeometric_upper_tail(
    observed: Column, drawn: Column, marked: Column, population: Column
) -> Column:
    """P(X >= observed)."""
    low, high = hypergeometric_support(drawn, marked, population)
    pmf = lambda x: F.exp(hypergeometric_ln_pmf(x, drawn, marked, population))
    return F.least(F.lit(1.0), _sum_over(F.greatest(low, observed.cast("long")), high, pmf))


def fisher_two_sided(observed: Column, drawn: Column, marked: Column, population: Column) -> Column:
    """Sum of the probabilities of all tables no more likely than the observed one."""
    low, high = hypergeometric_support(drawn, marked, population)
    limit = hypergeometric_ln_pmf(observed, drawn, marked, population) + 1e-7

    def term(x: Column) -> Column:
        lp = hypergeometric_ln_pmf(x, drawn, marked, population)
        return F.when(lp <= limit, F.exp(lp)).otherwise(F.lit(0.0))

    return F.least(F.lit(1.0), _sum_over(low, high, term))
