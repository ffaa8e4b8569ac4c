"""p-values as columns against tabulated values (fixed values from published tables of the distributions)."""

import math

import pytest
from pyspark.sql import functions as F

from sessionlens.operators import stats


def _col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_student_tail(spark):
    # dof 1: 1 - 2/pi atan t; dof 2: 1 - t / sqrt(t^2 + 2); dof 4: 1 - s (3 - s^2) / 2 at s = t / sqrt(t^2 + 4)
    ts = [0.0, 1e-6, 0.1, 1.0, 2.5, 12.0, 300.0]
    exact = {1: lambda t: 1 - 2 / math.pi * math.atan(t), 2: lambda t: 1 - t / math.sqrt(t * t + 2),
             4: lambda t: 1 - (s := t / math.sqrt(t * t + 4)) * (3 - s * s) / 2}
    for dof, f in exact.items():
        got = _col(spark, [(t, dof) for t in ts] + [(-t, dof) for t in ts], "t double, d long", stats.student_tail(F.col("t"), F.col("d")))
        assert got == pytest.approx([f(t) for t in ts] * 2, abs=1e-10)
    # with many degrees of freedom the normal distribution
    ts = [0.0, 1e-6, 0.1, 1.0, 2.5, 3.3, 5.4, 5.6, 12.0]
    got = _col(spark, [(t, 10**12) for t in ts], "t double, d long", stats.student_tail(F.col("t"), F.col("d")))
    assert got == pytest.approx([math.erfc(t / math.sqrt(2)) for t in ts], abs=1e-10)


def test_chi_square_tail(spark):
    xs = [0.0, 1e-9, 0.3, 1.0, 3.841458820694124, 3.9999, 4.0001, 30.0, 400.0]
    for dof, f in ((1, lambda x: math.erfc(math.sqrt(x / 2))), (2, lambda x: math.exp(-x / 2)),
                   (4, lambda x: math.exp(-x / 2) * (1 + x / 2))):
        got = _col(spark, [(x,) for x in xs], "x double", stats.chi_square_tail(F.col("x"), dof))
        assert got == pytest.approx([f(x) for x in xs], abs=1e-10)
        assert all(abs(g - f(x)) <= 1e-9 * f(x) for g, x in zip(got, xs))


def test_results_carry_p(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.5), (4, 7.0), (None, 1.0)], "x int, y double")
    r = stats.pearson(df, "x", "y").first()
    assert r.n == 4 and r.p == pytest.approx(1 - r.t_stat / math.sqrt(r.t_stat ** 2 + 2), abs=1e-12)
    assert stats.pearson(df.limit(2), "x", "y").first().p is None
    assert stats.pearson(df.selectExpr("x", "x AS y"), "x", "y").first().p == 0.0
    t = spark.createDataFrame([(0, 0)] * 10 + [(0, 1)] * 5 + [(1, 0)] * 3 + [(1, 1)] * 9, "a int, b int")
    c = stats.chi_square_2x2(t, "a", "b").first()
    assert c.p == pytest.approx(math.erfc(math.sqrt(c.chi2 / 2)), abs=1e-12) and 0.01 < c.p < 0.1
