"""Tail probabilities and t quantiles as Column expressions.

They loop inside ``aggregate(sequence(...))``, which Spark interprets row by row.  Use them
on result rows (one per outcome), never on participant data.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from phasewise.functions.columns import bind

# Lanczos coefficients for g = 7 and nine terms.
LANCZOS_G = 7.0
LANCZOS = (
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
)

TINY = 1e-300
NEWTON_STEPS = 6
# From here on four terms of Stirling's series are exact to the last bits.
STIRLING_FROM = 16


def _d(x) -> Column:
    return x.cast("double") if isinstance(x, Column) else F.lit(float(x))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for positive arguments."""
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], start=1):
        series = series + F.lit(c) / (x - 1 + i)
    t = x + (LANCZOS_G - 0.5)
    return 0.5 * math.log(2 * math.pi) + (x - 0.5) * F.log(t) - t + F.log(series)


def _gamma_step(a: Column) -> Column:
    """log of gamma(a + 1/2) / (gamma(a) sqrt(a)), which falls to nothing for large a."""
    half = a + 0.5
    return (
        stirling_rest(half) - stirling_rest(a) + a * F.log1p(0.5 / a) - 0.5
    )


def log_factorial(n: Column) -> Column:
    return log_gamma(n.cast("double") + 1)


def stirling_rest(n: Column) -> Column:
    """log n! minus Stirling's sqrt(2 pi n) (n / e)^n, for positive n."""

    def body(v) -> Column:
        n, square = v["n"], v["s"]
        series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / square) / square) / square) / n
        plain = log_gamma(n + 1) - 0.5 * F.log(2 * math.pi * n) - n * F.log(n) + n
        return F.when(n >= STIRLING_FROM, series).otherwise(plain)

    return bind({"n": n, "s": n * n}, body)


def _stirling_rest_of_whole(n: Column) -> Column:
    """The same for whole numbers, those below STIRLING_FROM looked up."""
    small = [math.lgamma(i + 1) - 0.5 * math.log(2 * math.pi * i) - i * math.log(i) + i for i in range(1, STIRLING_FROM)]
    known = F.expr(f"array({', '.join(f'{x!r}D' for x in [0.0, *small, 0.0])})")
    near = F.get(known, F.least(n, F.lit(float(STIRLING_FROM))).cast("int"))
    series = bind({"s": n * n}, lambda v: (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / v["s"]) / v["s"]) / v["s"]) / n)
    return F.when(n < STIRLING_FROM, near).otherwise(series)


def deviance(x: Column, mean: Column) -> Column:
    """x log(x / mean) + mean - x without cancellation of large terms."""
    return bind(
        {"m": mean, "d": (x - mean) / mean}, lambda v: v["m"] * ((1 + v["d"]) * F.log1p(v["d"]) - v["d"])
    )


def log_binomial(x: Column, n: Column, p: Column, q: Column) -> Column:
    """Log probability of x of n successes at chance p = 1 - q, as saddle point and corrections.
    x and n are whole numbers.

    Differences of log factorials lose as many digits as n has; this loses none.
    """

    def body(v) -> Column:
        x, n, y, p, q = (v[k] for k in ("x", "n", "y", "p", "q"))
        inside = (
            _stirling_rest_of_whole(n) - _stirling_rest_of_whole(x) - _stirling_rest_of_whole(y)
            - deviance(x, n * p) - deviance(y, n * q)
            + 0.5 * F.log(n / (2 * math.pi * x * y))
        )
        none = F.when(n == 0, 0.0).otherwise(n * F.log(q))
        return F.when(x == 0, none).when(y == 0, n * F.log(p)).otherwise(inside)

    return bind({"x": x, "n": n, "y": n - x, "p": p, "q": q}, body)


def _safe(x: Column) -> Column:
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def _steps(a: Column) -> Column:
    """Terms to take: series and fractions here settle after some multiple of sqrt(a)."""
    return (30 + 6 * F.sqrt(a)).cast("int")


def _iterate(init: dict[str, Column], steps: Column, step, result) -> Column:
    """Run ``step(state, i)`` for i = 1..steps over a struct of doubles."""

    def pack(values: dict[str, Column]) -> Column:
        return F.struct(*[v.cast("double").alias(k) for k, v in values.items()])

    return F.aggregate(
        F.sequence(F.lit(1), steps),
        pack(init),
        lambda s, i: pack(step({k: s[k] for k in init}, i.cast("double"))),
        lambda s: result({k: s[k] for k in init}),
    )


def _beta_fraction(x: Column, y: Column, a: Column, b: Column) -> Column:
    """x^a y^b / B(a, b) over I_x(a, b): a continued fraction in which x meets its complement y
    only as a y - b x, so that an x next to 1 loses nothing."""

    def denominator(m) -> Column:
        return m + m * (b - m) * x / (a + 2 * m - 1) + (a + m) * (a * y - b * x + 1 + m * (1 + y)) / (a + 2 * m + 1)

    def step(s, m):
        below = denominator(m)
        share = (a + m - 1) * (a + b + m - 1) * m * (b - m) * x * x / ((a + 2 * m - 1) * (a + 2 * m - 1))
        d = 1 / _safe(below + share * s["d"])
        c = _safe(below + share / s["c"])
        return {"c": c, "d": d, "h": s["h"] * c * d}

    start = _safe(a * (a * y - b * x + 1) / (a + 1))
    steps = _steps(F.greatest(a, b) / 4)  # each step is worth two of the plain fraction's
    return _iterate({"c": start, "d": F.lit(0.0), "h": start}, steps, step, lambda s: s["h"])


def beta_inc(x: Column, a: Column, b: Column, rest: Column | None = None) -> Column:
    """Regularised incomplete beta function I_x(a, b).  Give ``rest``, 1 - x, where it is known
    better than x near 1 can tell."""
    y = 1 - _d(x) if rest is None else _d(rest)
    return bind({"x": _d(x), "y": y, "a": _d(a), "b": _d(b)}, _beta_by_side)


def _beta_by_side(v) -> Column:
    """The fraction converges fast left of the mean; right of it use the complement."""
    flip = v["x"] > (v["a"] + 1) / (v["a"] + v["b"] + 2)
    sides = {
        "flip": flip,
        "x": F.when(flip, v["y"]).otherwise(v["x"]),
        "y": F.when(flip, v["x"]).otherwise(v["y"]),
        "a": F.when(flip, v["b"]).otherwise(v["a"]),
        "b": F.when(flip, v["a"]).otherwise(v["b"]),
    }

    def body(s) -> Column:
        x, y, a, b = s["x"], s["y"], s["a"], s["b"]
        # x^a y^b / B(a, b)
        log_front = (
            stirling_rest(a + b) - stirling_rest(a) - stirling_rest(b)
            - deviance(a, (a + b) * x) - deviance(b, (a + b) * y)
            + 0.5 * F.log(a * b / (2 * math.pi * (a + b)))
        )
        part = F.exp(log_front) / _beta_fraction(x, y, a, b)
        return bind({"p": part}, lambda q: F.when(s["flip"], 1 - q["p"]).otherwise(q["p"]))

    # Degrees of freedom that a correction made zero or negative have no distribution.
    known = v["x"].isNotNull() & (v["a"] > 0) & (v["b"] > 0)
    inside = F.when(known, bind(sides, body))
    return F.when(~known, None).when(v["x"] <= 0, 0.0).when(v["x"] >= 1, 1.0).otherwise(inside)


def chi2_sf(x: Column, df: Column) -> Column:
    """P(chi-square with df degrees of freedom > x)."""
    return bind({"y": _d(x) / 2, "a": _d(df) / 2}, lambda v: _gamma_upper(v["a"], v["y"]))


def _gamma_upper(a: Column, y: Column) -> Column:
    """Regularised upper incomplete gamma function: series left of the mean, fraction right."""
    # y^a e^-y / gamma(a)
    front = F.exp(0.5 * F.log(a / (2 * math.pi)) - stirling_rest(a) - deviance(a, y))
    series = _iterate(
        {"term": 1 / a, "sum": 1 / a},
        _steps(a),
        lambda s, n: {
            "term": s["term"] * y / (a + n),
            "sum": s["sum"] + s["term"] * y / (a + n),
        },
        lambda s: s["sum"],
    )

    def step(s, n):
        an = -n * (n - a)
        bn = y + 2 * n + 1 - a
        d = 1 / _safe(an * s["d"] + bn)
        c = _safe(bn + an / s["c"])
        return {"c": c, "d": d, "h": s["h"] * d * c}

    d0 = 1 / _safe(y + 1 - a)
    fraction = _iterate(
        {"c": F.lit(1 / TINY), "d": d0, "h": d0}, _steps(a), step, lambda s: s["h"]
    )
    inside = F.when(y < a + 1, 1 - front * series).otherwise(front * fraction)
    return F.when(y <= 0, 1.0).when(y.isNotNull(), inside)


def normal_two_sided(z: Column) -> Column:
    """P(|Z| > |z|) for a standard normal Z."""
    return chi2_sf(_d(z) * _d(z), F.lit(1.0))


def f_sf(f: Column, df1: Column, df2: Column) -> Column:
    """P(F with df1, df2 degrees of freedom > f)."""

    def body(v) -> Column:
        f, df1, df2 = v["f"], v["n"], v["d"]
        both = df2 + df1 * f
        return beta_inc(F.try_divide(df2, both), df2 / 2, df1 / 2, F.try_divide(df1 * f, both))

    return bind({"f": _d(f), "n": _d(df1), "d": _d(df2)}, body)


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > |t|) for a t variable with df degrees of freedom."""
    return f_sf(_d(t) * _d(t), F.lit(1.0), _d(df))


def t_quantile(level: float, df: Column) -> Column:
    """The t with P(|T| <= t) = level.

    Closed forms for one and two degrees of freedom; else Newton steps from the expansion
    around the normal quantile.  The tail is convex, so the steps close in from below.
    """
    z = NormalDist().inv_cdf((1 + level) / 2)
    tail = 1 - level

    def density(t: Column, df: Column) -> Column:
        ratio = 0.5 * F.log(df / 2) + _gamma_step(df / 2)
        return F.exp(ratio - 0.5 * F.log(df * math.pi) - (df + 1) / 2 * F.log1p(t * t / df))

    def refine(df: Column) -> Column:
        start = z + F.lit((z**3 + z) / 4) / df + F.lit((5 * z**5 + 16 * z**3 + 3 * z) / 96) / df**2
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(NEWTON_STEPS)),
            start,
            lambda t, _: t + (t_two_sided(t, df) - tail) / (2 * density(t, df)),
        )

    def by_df(v) -> Column:
        return (
            F.when(v["df"] == 1, math.tan(math.pi * level / 2))
            .when(v["df"] == 2, level * math.sqrt(2 / (1 - level**2)))
            .when(v["df"] > 2, refine(v["df"]))
        )

    return bind({"df": _d(df)}, by_df)
