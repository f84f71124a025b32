"""Column helpers for ratios, shrinkage, decay and exploration terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def num(x) -> Column:
    return col(x).cast("double")


def ratio(a, b) -> Column:
    """a / b in double; NULL when b is zero."""
    return F.try_divide(num(a), num(b))


def correlation(x, y) -> Column:
    """Pearson correlation of the pairs without NULL; NULL where one side does not vary."""
    x, y = num(x), num(y)
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def dsum(x) -> Column:
    """Exact decimal sum, handed on as a double."""
    return F.sum(col(x)).cast("double")


def _all_present(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def strict_least(*xs) -> Column:
    """LEAST that is NULL when any argument is NULL."""
    cs = [col(x) for x in xs]
    return F.when(_all_present(cs), F.least(*cs))


def strict_greatest(*xs) -> Column:
    """GREATEST that is NULL when any argument is NULL."""
    cs = [col(x) for x in xs]
    return F.when(_all_present(cs), F.greatest(*cs))


def clamp(x, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), col(x)))


def whole(x) -> Column:
    """Half-away-from-zero rounding to an integer (a bare cast truncates)."""
    return F.round(num(x)).cast("long")


def shrink(successes, trials, prior, weight) -> Column:
    """Empirical-Bayes mean: (x + weight * prior) / (n + weight)."""
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    return F.try_divide(num(successes) + num(prior) * w, num(trials) + w)


def half_life(age_days, days: float) -> Column:
    """Weight that halves every ``days``."""
    return F.pow(F.lit(0.5), num(age_days) / F.lit(float(days)))


def power_decay(age_days, base: float = 0.95) -> Column:
    return F.pow(F.lit(base), num(age_days))


def logistic(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-num(x)))


def ucb_bonus(total, trials, c) -> Column:
    """c * sqrt(2 ln(max(total,1)) / max(n,1))."""
    scale = c if isinstance(c, Column) else F.lit(float(c))
    return scale * F.sqrt(
        F.ln(F.greatest(num(total), F.lit(1.0))) * 2.0 / F.greatest(num(trials), F.lit(1.0))
    )


def cooldown_end(last_sent, uses, base_hours) -> Column:
    """last_sent + base * 1.5^uses hours, to the second."""
    seconds = F.round(num(base_hours) * F.pow(F.lit(1.5), num(uses)) * 3600).cast("int")
    return col(last_sent) + F.make_dt_interval(secs=seconds)


def ladder(x, *steps: tuple[float, object], default) -> Column:
    """First ``x >= bound`` wins: ladder(c, (10, 'a'), (5, 'b'), default='c')."""
    c = col(x)
    out = None
    for bound, value in steps:
        cond = c >= F.lit(bound)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))
