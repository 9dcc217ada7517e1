"""Fixed-edge binnings of single columns."""

from pyspark.sql import Column, functions as F


def bin_age(age) -> Column:
    """18-35 is 1, 36-60 is 2, from 61 is 3, anything else 0."""
    a = F.col(age)
    return (F.when(a.between(18, 35), 1).when(a.between(36, 60), 2).when(a >= 61, 3).otherwise(0))


def bin_contacts(n) -> Column:
    """Campaign contacts: one, two or three, more; other values pass through."""
    c = F.col(n)
    return F.when(c == 1, 1).when(c.between(2, 3), 2).when(c >= 4, 3).otherwise(c)


def duration_flags(minutes) -> dict[str, Column]:
    d = F.col(minutes)
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    return {"t_min": flag(d <= 5), "t_e_min": flag((d > 5) & (d <= 10)), "e_min": flag(d > 10)}


def pdays_bins(pdays) -> dict[str, Column]:
    """Flag for never contacted (-1) and months passed; other negatives keep the raw quotient."""
    p = F.col(pdays)
    months = p / F.lit(30.0)
    binned = (F.when((months >= 0) & (months <= 2), 1.0).when((months > 2) & (months <= 6), 2.0)
              .when(months > 6, 3.0).otherwise(months))
    return {"pdays_not_contacted": F.when(p == -1, 1).otherwise(0), "months_passed": binned}


def balance_bins(balance) -> dict[str, Column]:
    """Six balance classes and three sign flags.

    The flags are set by the sign of the balance, which is what their names say.
    """
    b = F.col(balance)
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    classes = (F.when(b < 1, 0).when(b < 100, 1).when(b < 500, 2).when(b < 2000, 3)
               .when(b < 5000, 4).when(b >= 5000, 5))
    return {"Neg_Balance": flag(b < 0), "No_Balance": flag(b == 0), "Pos_Balance": flag(b > 0),
            "bin_Balance": classes}
