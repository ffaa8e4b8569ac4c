"""Statistics (inventory rows 179-182): correlation, crosstab, chi-square.

The data work is aggregates. p-values are columns of the results: the tails
of the t and chi-square distributions as expressions, continued fractions of a
fixed number of steps folded from the innermost step outwards.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FRACTION_STEPS = 400
SMALL_TAIL = 2.0  # below it the series of the lower tail, above it the fraction of the upper one


def _fold(steps: int, inner, step) -> Column:
    """``inner`` put through ``step(value, i)`` for i = steps .. 1."""
    return F.aggregate(F.sequence(F.lit(steps), F.lit(1), F.lit(-1)), inner, lambda v, i: step(v, i.cast("double")))


def _half_step_ratio(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a): ten steps up by gamma's recurrence, then the
    asymptotic series (no difference of two large logarithms)."""
    b = a + 10.0
    tail = F.sqrt(b) * F.exp(-1 / (8 * b) + 1 / (192 * F.pow(b, F.lit(3.0))) - 1 / (640 * F.pow(b, F.lit(5.0)))
                             + 17 / (14336 * F.pow(b, F.lit(7.0))))
    down = F.lit(1.0)
    for k in range(10):
        down = down * (a + k) / (a + k + 0.5)
    return tail * down


def student_tail(t: Column, dof: Column) -> Column:
    """Two-sided p of a t statistic: I_x(dof / 2, 1 / 2) at x = dof / (dof + t^2).

    The complement, a series of positive terms, is taken from 1 where it
    converges faster: beyond x = (a + 1) / (a + 5/2), and for moderate t of
    many degrees.
    """
    a, half = dof.cast("double") / 2, F.lit(0.5)
    x = dof / (dof + t * t)
    other = t * t / (dof + t * t)  # 1 - x without cancellation

    def fraction(p, q, z):
        def step(v, i):
            k = F.floor(i / 2)
            even = k * (q - k) * z / ((p + i - 1) * (p + i))
            odd = -(p + k) * (p + q + k) * z / ((p + i - 1) * (p + i))
            return 1 + F.when(i % 2 == 0, even).otherwise(odd) / v
        return 1 / _fold(FRACTION_STEPS, F.lit(1.0), step)

    # exp(a ln x) with x near 1: ln x = -ln(1 + t^2 / dof)
    front = F.exp(-a * F.log1p(t * t / dof)) * F.sqrt(other) * _half_step_ratio(a) / F.lit(math.sqrt(math.pi))
    near = front / a * fraction(a, half, x)
    far = 1 - front / half * _fold(FRACTION_STEPS, F.lit(1.0), lambda v, i: 1 + (a + i - 0.5) * other / (i + 0.5) * v)
    return F.when(t == 0, F.lit(1.0)).when((x > (a + 1) / (a + 2.5)) | ((a > 50) & (t * t < 30)), far).otherwise(near)


def chi_square_tail(x: Column, dof: int = 1) -> Column:
    """Upper tail Q(dof / 2, x / 2) of the chi-square distribution."""
    a, z = dof / 2.0, x / 2
    front = F.exp(-z + a * F.log(z)) / F.lit(math.gamma(a))
    # upper: 1 / (z + 1 - a - 1 (1 - a) / (z + 3 - a - 2 (2 - a) / (z + 5 - a - ...)))
    upper = front / (z + 1 - a - _fold(FRACTION_STEPS, F.lit(0.0), lambda v, i: i * (i - a) / (z + 2 * i + 1 - a - v)))
    # lower: sum of z^k / (a (a + 1) ... (a + k)), innermost first
    lower = front / a * _fold(FRACTION_STEPS, F.lit(1.0), lambda v, i: 1 + z / (a + i) * v)
    return F.when(x <= 0, F.lit(1.0)).when(z < SMALL_TAIL, 1 - lower).otherwise(upper)


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """r, n, the t statistic of r (n - 2 degrees of freedom) and its
    two-sided p; null where there is none, p 0 where r is 1 or -1."""
    g = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"), F.count(F.lit(1)).alias("n"))
    g = g.withColumn("t_stat", F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r"))))
    p = F.when(F.abs("r") >= 1, F.lit(0.0)).when(F.col("t_stat").isNotNull(), student_tail(F.col("t_stat"), F.col("n") - 2))
    return g.withColumn("p", F.when(F.col("n") >= 3, p))


def pearson_test(df: DataFrame, x: str, y: str) -> tuple[float, float]:
    """(r, two-sided p), like ``scipy.stats.pearsonr``."""
    row = pearson(df, x, y).first()
    return tuple(float("nan") if v is None else v for v in (row["r"], row["p"]))


def _beta_fraction(a: float, b: float, x: float, places: float = 1e-15) -> float:
    """Value K of the continued fraction of I_x(a, b), where
    I_x(a, b) = x**a (1 - x)**b / (a B(a, b)) * K and
    K = 1 / (1 + d1 / (1 + d2 / (1 + ...))) with
    d_{2k} = k (b - k) x / ((a + 2k - 1)(a + 2k)),
    d_{2k+1} = -(a + k)(a + b + k) x / ((a + 2k)(a + 2k + 1)).
    Convergents come from the three-term recurrence of numerators and
    denominators, rescaled by the newest denominator."""

    def term(i: int) -> float:
        k = i // 2
        if i % 2 == 0:
            return k * (b - k) * x / ((a + i - 1) * (a + i))
        return -(a + k) * (a + b + k) * x / ((a + i - 1) * (a + i))

    top, above = 1.0, 1.0  # numerators: current, previous
    low, below = 1.0 + term(1), 1.0
    value = top / low
    for i in range(2, 10_000):
        t = term(i)
        top, above = top + t * above, top
        low, below = low + t * below, low
        if low:
            top, above, low, below = top / low, above / low, 1.0, below / low
            if abs(top - value) <= places * abs(top):
                return top
            value = top
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):  # the fraction converges fast on the other side
        return 1.0 - incomplete_beta(b, a, 1 - x)
    log_factor = a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a + 1) - math.lgamma(b)
    return math.exp(log_factor) * _beta_fraction(a, b, x)


def corr_matrix(df: DataFrame, columns) -> DataFrame:
    """Pairwise Pearson correlation, long form (col_a, col_b, corr); one
    aggregate computes every pair."""
    cols = list(columns)
    pairs = [(a, b) for a, b in combinations(cols, 2)]
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}")
                   for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', `_c{i}`" for i, (a, b) in enumerate(pairs))
    return agg.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")


def crosstab(df: DataFrame, row: str, col: str, values=(0, 1)) -> DataFrame:
    """Counts of ``row`` x ``col`` (pivot with fixed column values)."""
    p = df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    return p.select(row, *[F.coalesce(F.col(str(v)), F.lit(0)).cast("long").alias(f"{col}_{v}") for v in values])


def chi_square_2x2(df: DataFrame, row: str, col: str, correction: bool = True) -> DataFrame:
    """Chi-square of a 2x2 table with Yates' correction (scipy's default
    for one degree of freedom): each observed count moves 0.5 toward its
    expected count."""
    t = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).agg(
        *[F.sum(((F.col(row) == i) & (F.col(col) == j)).cast("long")).alias(f"o{i}{j}")
          for i in (0, 1) for j in (0, 1)])
    n = sum((F.col(f"o{i}{j}") for i in (0, 1) for j in (0, 1)), F.lit(0)).cast("double")
    r = {i: (F.col(f"o{i}0") + F.col(f"o{i}1")).cast("double") for i in (0, 1)}
    c = {j: (F.col(f"o0{j}") + F.col(f"o1{j}")).cast("double") for j in (0, 1)}
    terms = []
    for i in (0, 1):
        for j in (0, 1):
            e = r[i] * c[j] / n
            o = F.col(f"o{i}{j}").cast("double")
            if correction:
                o = o + 0.5 * F.signum(e - o)
            terms.append((o - e) * (o - e) / e)
    chi2 = terms[0] + terms[1] + terms[2] + terms[3]
    return t.withColumn("chi2", chi2).select("*", F.lit(1).alias("dof"), chi_square_tail(F.col("chi2")).alias("p"))


def chi_square_test(df: DataFrame, row: str, col: str, correction: bool = True) -> tuple[float, float]:
    """(chi2, p) for one degree of freedom."""
    got = chi_square_2x2(df, row, col, correction).first()
    return got["chi2"], got["p"]
