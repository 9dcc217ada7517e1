"""Small statistical formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KS_TERMS = 100


def psi_term(expected: Column, actual: Column, floor: float = 1e-4) -> Column:
    """(e - a) ln(e / a), both shares held at the floor."""
    e = F.when(expected < floor, F.lit(floor)).otherwise(expected)
    a = F.when(actual < floor, F.lit(floor)).otherwise(actual)
    return (e - a) * F.ln(e / a)


def half_kl(p: Column, other: Column) -> Column:
    """p/2 log2(p / ((p + other) / 2)), 0 for p = 0: one side of the Jensen-Shannon divergence."""
    return F.when(p > 0, p / 2 * F.log2(2 * p / (p + other))).otherwise(F.lit(0.0))


def ks_p_value(stat: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov-Smirnov statistic."""
    lam = F.sqrt(n.cast("double") * m / (n + m)) * stat
    terms = F.transform(F.sequence(F.lit(1), F.lit(KS_TERMS)),
                        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam))
    series = 2 * F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    # below 0.2 the p-value is 1 within rounding and the series converges slowly
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def number(column: str) -> Column:
    """The column as a double, with NaN as null."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
