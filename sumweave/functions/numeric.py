"""Normal and chi-square tails as native column expressions.

Spark has no ``erfc``, normal quantile or chi-square tail. Composing them from arithmetic keeps
them inside whole-stage code generation, with no Python worker in the plan.
"""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Smallest positive double, the floor of every two-sided p-value.
P_FLOOR = 5e-324

# Rational approximations of erf/erfc, W. J. Cody, Math. Comp. 23 (1969).
# Each list runs from the highest power down to the constant term.
ERF_NUM = [1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2,
           3.77485237685302021e2, 3.20937758913846947e3]
ERF_DEN = [1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3,
           2.84423683343917062e3]
MID_NUM = [2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0,
           6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2,
           1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3]
MID_DEN = [1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2,
           1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3,
           3.43936767414372164e3, 1.23033935480374942e3]
FAR_NUM = [1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1,
           1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4]
FAR_DEN = [1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1,
           6.05183413124413191e-2, 2.33520497626869185e-3]

# Normal quantile, M. J. Wichura, algorithm AS 241 (PPND16), Appl. Statist. 37
# (1988). Highest power first; centre, tail (r <= 5) and far tail.
CENTRE_NUM = [2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4,
              4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3,
              1.3314166789178437745e2, 3.3871328727963666080e0]
CENTRE_DEN = [5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4,
              2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2,
              4.2313330701600911252e1, 1.0]
TAIL_NUM = [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
            1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0,
            4.63033784615654529590e0, 1.42343711074968357734e0]
TAIL_DEN = [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
            1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0,
            2.05319162663775882187e0, 1.0]
FAR_TAIL_NUM = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
                2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0,
                5.46378491116411436990e0, 6.65790464350110377720e0]
FAR_TAIL_DEN = [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
                7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
                5.99832206555887937690e-1, 1.0]


def horner(coefs: list[float], x: Column) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefs[1:], F.lit(coefs[0]))


def erfc(x: Column) -> Column:
    """Complementary error function of a non-negative column."""
    square = x * x
    near = 1.0 - x * horner(ERF_NUM, square) / horner(ERF_DEN, square)
    # exp(-x^2) is split at a multiple of 1/16 so that the exponent keeps its low bits.
    head = F.floor(x * 16.0) / 16.0
    decay = F.exp(-head * head) * F.exp(-(x - head) * (x + head))
    mid = decay * horner(MID_NUM, x) / horner(MID_DEN, x)
    inv = 1.0 / square
    far = decay * (1.0 / math.sqrt(math.pi) - inv * horner(FAR_NUM, inv) / horner(FAR_DEN, inv)) / x
    return (F.when(x <= 0.46875, near).when(x <= 4.0, mid)
            .when(x <= 27.5, far).when(x.isNotNull(), F.lit(0.0)))


def p_from_z(z: Column) -> Column:
    """Two-sided normal p-value, never below the smallest positive double."""
    return F.when(z.isNotNull(), F.greatest(erfc(F.abs(z) * (1.0 / math.sqrt(2.0))), F.lit(P_FLOOR)))


def z_from_p(p: Column) -> Column:
    """Unsigned z of a two-sided p-value: infinite at 0, NULL outside [0, 1]."""
    q = 0.5 - p * 0.5
    r = 0.180625 - q * q
    centre = q * horner(CENTRE_NUM, r) / horner(CENTRE_DEN, r)
    # ln p - ln 2 instead of ln(p / 2): half of the smallest double would be 0.
    depth = F.sqrt(math.log(2.0) - F.ln(p))
    tail = horner(TAIL_NUM, depth - 1.6) / horner(TAIL_DEN, depth - 1.6)
    far = horner(FAR_TAIL_NUM, depth - 5.0) / horner(FAR_TAIL_DEN, depth - 5.0)
    return (F.when((p < 0) | (p > 1) | F.isnan(p), F.lit(None).cast("double"))
            .when(p == 0, F.lit(float("inf")))
            .when(q <= 0.425, centre).when(depth <= 5.0, tail).when(p.isNotNull(), far))


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper chi-square tail for integer degrees of freedom, as a finite sum."""
    h = x * 0.5
    df = df.cast("int")
    odd = df % 2 == 1
    shift = F.when(odd, 0.5).otherwise(0.0)
    first = F.when(odd, 2.0 * F.sqrt(h / math.pi)).otherwise(F.lit(1.0))
    terms = F.floor(df / 2).cast("int")
    # State: the current term and the sum so far; term j is term j-1 times h / (j - shift).
    state = F.struct(first.alias("term"), first.alias("total"))

    def step(acc: Column, j: Column) -> Column:
        term = acc["term"] * h / (j - shift)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    # Even df sums j = 0..m-1, odd df j = 1..m; both start from `first`.
    start = F.when(odd, F.lit(2)).otherwise(F.lit(1))
    stop = F.when(odd, terms).otherwise(terms - 1)
    steps = F.when(stop >= start, F.sequence(start, stop)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, state, step)["total"]
    series = F.when(terms == 0, F.lit(0.0)).when(h < 700, F.exp(-h) * total).otherwise(F.exp(F.ln(total) - h))
    tail = F.when(odd, erfc(F.sqrt(h)) + series).otherwise(series)
    return F.when((df < 1) | F.isnan(x), F.lit(None).cast("double")).when(x <= 0, F.lit(1.0)).otherwise(tail)


def chi2_quantile_1df(q: float) -> float:
    """Lower quantile of chi-square with one degree of freedom, for the lambda denominators."""
    return NormalDist().inv_cdf((1.0 + q) / 2.0) ** 2


def effective_size(cases: Column, controls: Column) -> Column:
    return F.try_divide(F.lit(4.0) * cases * controls, cases + controls)


def logistic_effective_size(cases: Column, controls: Column) -> Column:
    return cases * (1.0 - F.try_divide(cases.cast("double"), cases + controls))
