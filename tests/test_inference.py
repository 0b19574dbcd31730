"""Tests and tables against brute force."""

import itertools
import math
import random
import statistics as st
from collections import defaultdict
from fractions import Fraction

import pytest
from comparing import rows
from pyspark.sql import functions as F

from phasewise.functions import distributions as dist
from phasewise.functions import text
from phasewise.plans import inference, tables


@pytest.fixture(scope="module")
def long(spark):
    rng = random.Random(3)
    data = []
    for i in range(22):
        own = rng.gauss(0, 2)
        for t in (1, 2, 3):
            y = 10 + own + 0.6 * t + rng.gauss(0, 1)
            data.append((str(i), t, y, None if (i, t) == (0, 2) else 2 * y + rng.gauss(0, 1)))
    data.pop()  # participant 21 lacks the last timepoint
    return spark.createDataFrame(data, "id string, time int, a double, b double")


def complete(long, outcome):
    got = {}
    for r in long.collect():
        got.setdefault(r.id, {})[r.time] = r[outcome]
    return [[v[t] for t in (1, 2, 3)] for v in got.values()
            if len(v) == 3 and None not in v.values()]


def test_anova_by_sums_of_squares(long):
    got = {r.outcome: r for r in
           inference.repeated_measures_anova(long, ["a", "b"], "time", "id").collect()}
    for name, n in (("a", 21), ("b", 20)):
        y = complete(long, name)
        assert len(y) == n == got[name].n
        g = st.mean(v for row in y for v in row)
        mt = [st.mean(row[t] for row in y) for t in range(3)]
        ms = [st.mean(row) for row in y]
        time = n * sum((m - g) ** 2 for m in mt)
        subject = 3 * sum((m - g) ** 2 for m in ms)
        error = sum((row[t] - ms[i] - mt[t] + g) ** 2 for i, row in enumerate(y) for t in range(3))
        f = (time / 2) / (error / (2 * (n - 1)))
        r = got[name]
        assert r.anova_F == pytest.approx(f)
        assert r.anova_ges == pytest.approx(time / (time + subject + error))
        assert r.anova_p == pytest.approx((1 + f / (n - 1)) ** -(n - 1))
        assert r.mean_2 == pytest.approx(mt[1]) and 0.5 <= r.correction_GGe <= 1
        assert 0 < r.sphericity_W <= 1


def test_two_timepoints_give_the_squared_t(spark, long):
    two = long.filter("time < 3")
    anova = inference.repeated_measures_anova(two, ["a"], "time", "id", times=(1, 2)).first()
    t = inference.pairwise_t_tests(two, ["a"], "time", "id", times=(1, 2), comparisons=[(2, 1)]).first()
    assert anova.anova_F == pytest.approx(t.ttest_statistic**2)
    assert anova.anova_p == pytest.approx(t.ttest_p)


def test_four_timepoints(spark):
    rng = random.Random(5)
    data = [(str(i), t, rng.gauss(t, 1)) for i in range(15) for t in (1, 2, 3, 4)]
    df = spark.createDataFrame(data, "id string, time int, y double")
    r = inference.repeated_measures_anova(df, ["y"], "time", "id", times=(1, 2, 3, 4)).first()
    assert 1 / 3 <= r.correction_GGe <= 1 and 0 <= r.sphericity_p <= 1
    shuffled = inference.repeated_measures_anova(
        df.repartition(7), ["y"], "time", "id", times=(4, 2, 3, 1)
    ).first()
    assert shuffled.sphericity_W == pytest.approx(r.sphericity_W)


def test_paired_t(spark):
    data = [("a", 1.0, 2.0), ("b", 2.0, 2.5), ("c", 4.0, 3.0), ("d", 5.0, 9.0), ("e", None, 1.0)]
    df = spark.createDataFrame(data, "id string, y double, x double")
    r = inference.paired_t_tests(df, [("o", "x", "y")]).first()
    d = [x - y for _, y, x in data if y is not None]
    m, s = st.mean(d), st.stdev(d)
    assert (r.n, r.mean_difference) == (4, pytest.approx(m))
    assert r.t == pytest.approx(m / (s / 2)) and r.effect_size_cohensd == pytest.approx(m / s)
    # P(|T| > t) with three degrees of freedom in closed form.
    u = abs(r.t) / math.sqrt(3)
    assert r.p_value == pytest.approx(1 - 2 / math.pi * (math.atan(u) + u / (1 + u * u)))
    assert r.conf_int2 == pytest.approx(m + 3.182446305284263 * s / 2)
    with pytest.raises(ValueError):
        inference.paired_t_tests(df, [("o", "x", "absent")])


def test_adjustments_by_hand(spark):
    p = [0.01, 0.04, 0.03]
    df = spark.createDataFrame([("o", str(i), v) for i, v in enumerate(p)], "o string, i string, p double")
    expected = {
        "none": p, "bonferroni": [0.03, 0.12, 0.09], "holm": [0.03, 0.06, 0.06],
        "hochberg": [0.03, 0.04, 0.04], "BH": [0.03, 0.04, 0.04],
        "BY": [v * 11 / 6 for v in (0.03, 0.04, 0.04)],
    }
    for method, values in expected.items():
        got = [r[3] for r in rows(inference.adjust_p(df, "p", ["o"], method))]
        assert got == pytest.approx(values), method


def test_rank_sum_by_brute_force(spark):
    rng = random.Random(1)
    data = [("x" if rng.random() < 0.4 else "y", float(rng.randint(0, 9))) for _ in range(80)]
    data += [("z", 1.0), ("x", None)]
    df = spark.createDataFrame(data, "g string, v double")
    r = inference.rank_sum_tests(df, ["v"], "g", "x", "y").first()
    pool = sorted(v for g, v in data if g in "xy" and v is not None)
    rank = {v: pool.index(v) + 1 + (pool.count(v) - 1) / 2 for v in set(pool)}
    n1 = sum(g == "x" and v is not None for g, v in data)
    n, n2 = len(pool), len(pool) - n1
    w = sum(rank[v] for g, v in data if g == "x" and v is not None) - n1 * (n1 + 1) / 2
    ties = sum(pool.count(v) ** 3 - pool.count(v) for v in set(pool))
    sd = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (abs(w - n1 * n2 / 2) - 0.5) / sd
    assert (r.n1, r.n2, r.statistic) == (n1, n2, w)
    assert r.p_value == pytest.approx(math.erfc(z / math.sqrt(2)))


@pytest.mark.parametrize(("n1", "n2", "values"), [(3, 5, 4), (5, 3, 50), (1, 6, 3), (4, 4, 1), (2, 0, 5)])
def test_exact_rank_sum_by_enumeration(spark, n1, n2, values):
    rng = random.Random(n1 * 10 + n2)
    data = [("x", rng.randrange(values) * 1.0) for _ in range(n1)] + [("y", rng.randrange(values) * 1.0) for _ in range(n2)]
    r = inference.rank_sum_tests(spark.createDataFrame(data, "g string, v double"), ["v"], "g", "x", "y", exact=True).first()
    pool = sorted(v for _, v in data)
    rank = [pool.index(v) + (pool.count(v) + 1) / 2 for _, v in data]
    mean = n1 * (n1 + n2 + 1) / 2
    far = abs(sum(rank[:n1]) - mean)
    sums = [sum(c) for c in itertools.combinations(rank, n1)]
    assert r.p_value == pytest.approx(sum(abs(s - mean) >= far - 1e-9 for s in sums) / len(sums))
    assert r.statistic == sum(rank[:n1]) - n1 * (n1 + 1) / 2 and r.method.endswith("exact")


def table(spark, cells):
    data = [("v", lv, g) for (lv, g), k in cells.items() for _ in range(k)]
    df = spark.createDataFrame([(lv, g) for _, lv, g in data], "v string, g string")
    return df, inference.cross_counts(df, ["v"], "g")


def test_chi_square_with_an_empty_cell(spark):
    cells = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 15, ("b", "y"): 5, ("c", "x"): 8}
    _, counts = table(spark, cells)
    r = inference.chi_square_tests(counts).first()
    n = sum(cells.values())
    rows_ = {lv: sum(k for (a, _), k in cells.items() if a == lv) for lv in "abc"}
    cols_ = {g: sum(k for (_, b), k in cells.items() if b == g) for g in "xy"}
    expected = {(lv, g): rows_[lv] * cols_[g] / n for lv in "abc" for g in "xy"}
    chi = sum((cells.get(c, 0) - e) ** 2 / e for c, e in expected.items())
    assert r.statistic == pytest.approx(chi) and r.df == 2
    assert r.p_value == pytest.approx(math.exp(-chi / 2))
    assert r.min_expected == pytest.approx(min(expected.values()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fisher_by_enumeration(spark, seed):
    rng = random.Random(seed)
    cells = {(lv, g): rng.randint(0 if lv == "a" else 1, 6) for lv in "abcd" for g in "xy"}
    df, counts = table(spark, cells)
    r = inference.fisher_tests(counts, "x").first()
    totals = [cells[lv, "x"] + cells[lv, "y"] for lv in "abcd"]
    seen = [cells[lv, "x"] for lv in "abcd"]
    c1 = sum(seen)

    def weight(xs):
        return math.prod(math.comb(t, x) for t, x in zip(totals, xs))

    every = [xs for xs in itertools.product(*(range(t + 1) for t in totals)) if sum(xs) == c1]
    p = sum(weight(xs) for xs in every if weight(xs) <= weight(seen)) / math.comb(sum(totals), c1)
    assert r.p_value == pytest.approx(p)
    both = inference.category_tests(df, ["v"], "g", "x").first()
    assert both.method == "Fisher's exact test" and both.p_value == pytest.approx(p)


def hypergeometric_p(a, r1, c1, n):
    """Two-sided p of a 2x2 table in whole numbers."""
    every = range(max(0, r1 + c1 - n), min(r1, c1) + 1)
    weight = {x: math.comb(r1, x) * math.comb(n - r1, c1 - x) for x in every}
    return float(Fraction(sum(w for w in weight.values() if w <= weight[a]), math.comb(n, c1)))


def margins(spark, tables):
    """Counts of tables given as {variable: [(first, second), ...]} by level."""
    data = [(v, f"l{i}", g, n) for v, cells in tables.items() for i, c in enumerate(cells) for g, n in zip("xy", c) if n]
    return spark.createDataFrame(data, "variable string, level string, by string, n long")


def test_fisher_of_two_levels_of_any_size(spark):
    cells = {
        "small": [(3, 1), (1, 3)], "even": [(5, 5), (5, 5)], "none": [(0, 7), (9, 2)], "all": [(4, 0), (0, 6)],
        "one": [(4, 6)], "group": [(4, 0), (9, 0)], "hundreds": [(130, 200), (170, 150)], "lopsided": [(2, 1), (40, 3000)],
        "mode": [(1000, 1000), (999, 1001)], "thousands": [(1040, 960), (980, 1020)],
    }
    got = {r.variable: r.p_value for r in inference.fisher_tests(margins(spark, cells), "x").collect()}
    for name, rows_ in cells.items():
        (a, b), (c, d) = rows_ if len(rows_) == 2 else (*rows_, (0, 0))
        expected = hypergeometric_p(a, a + b, a + c, a + b + c + d)
        assert got[name] == pytest.approx(expected, rel=1e-9), name


def test_fisher_of_ten_million_rows(spark):
    """Large tables approach chi-square, with the continuity correction that the exact steps call for."""
    cells = {"v": [(2_502_000, 2_498_000), (2_498_500, 2_501_500)]}
    p = inference.fisher_tests(margins(spark, cells), "x").first().p_value
    (a, b), (c, d) = cells["v"]
    n, r1, c1 = a + b + c + d, a + b, a + c
    mean, sd = r1 * c1 / n, math.sqrt(r1 * c1 / n * (n - r1) * (n - c1) / n / (n - 1))
    assert p == pytest.approx(math.erfc((abs(a - mean) - 0.5) / sd / math.sqrt(2)), rel=1e-5)


def freeman_halton(cells):
    totals, seen = [a + b for a, b in cells], [a for a, _ in cells]
    ways = {(sum(seen), 1): 1}  # (left, product so far): number of ways
    for r in totals:
        nxt = defaultdict(int)
        for (left, w), n in ways.items():
            for x in range(min(r, left) + 1):
                nxt[left - x, w * math.comb(r, x)] += n
        ways = nxt
    mark = math.prod(math.comb(r, x) for r, x in zip(totals, seen))
    good = sum(w * n for (left, w), n in ways.items() if left == 0 and w <= mark)
    return float(Fraction(good, math.comb(sum(totals), sum(seen))))


def test_fisher_of_many_levels(spark):
    rng = random.Random(7)
    cells = {f"v{k}": [(rng.randint(0, 5), rng.randint(0, 9)) for _ in range(k)] for k in (3, 4, 5, 6)}
    cells |= {"equal": [(i % 3, 2 - i % 3) for i in range(9)], "far": [(6, 0), (0, 9), (5, 1)], "rare": [(1, 2), (3, 400), (2, 900)],
              "two": [(2, 5), (3, 1)]}
    cells = {k: [c for c in v if sum(c)] for k, v in cells.items()}
    got = {r.variable: r.p_value for r in inference.fisher_tests(margins(spark, cells), "x").collect()}
    assert got == {k: pytest.approx(freeman_halton(v), rel=1e-8) for k, v in cells.items()}


def test_sparse_variables_of_any_size_get_the_exact_test(spark):
    """More tables than could ever be listed: 3 levels of a million rows, one rare."""
    cells = {"v": [(3, 1), (400_000, 600_000), (399_000, 601_000)]}
    data = margins(spark, cells)
    p = inference.fisher_tests(data, "x", only_below=5).first().p_value
    chi = inference.chi_square_tests(data).first()
    assert chi.min_expected < 5 and 0.2 < p / chi.p_value < 3
    assert inference.fisher_tests(margins(spark, {"v": [(30, 30), (40, 20), (25, 45)]}), "x", only_below=5).collect() == []


@pytest.mark.parametrize("df", [999_999.0, 1_000_001.0, 1e9])
def test_tails_of_many_degrees_of_freedom(spark, df):
    """Against the first terms of the expansion around the normal and chi-square tails."""
    t, n, f = 2.1, 3.0, 1.7
    r = spark.range(1).select(
        dist.t_two_sided(F.lit(t), F.lit(df)).alias("t"), dist.f_sf(F.lit(f), F.lit(n), F.lit(df)).alias("f"),
        dist.chi2_sf(F.lit(n * f), F.lit(n)).alias("c")).first()
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    normal = math.erfc(t / math.sqrt(2))
    assert r.t == pytest.approx(normal + (t**3 + t) / 2 / df * density, rel=1e-9)
    x = n * f
    step = x ** (n / 2) * math.exp(-x / 2) / (2 ** (n / 2) * math.gamma(n / 2)) * (x - n + 2) / (2 * df)
    assert r.f == pytest.approx(r.c + step, rel=1e-9)


def test_summary_table_rows(spark):
    df = spark.createDataFrame(
        [(1.0, "u"), (3.0, "v"), (None, "w"), (1000.5, "u")], "x double, c string"
    )
    variables = [tables.Continuous("x", "X"), tables.Categorical("c", "C", ("u", "v"))]
    got = {(r.variable, r.label): (r.n_0, r.stat_0) for r in
           tables.summary_table(df, variables).collect()}
    assert got["x", "X"] == (3, "334.8 (576.5) [1, 1,000]")
    assert got["x", "Unknown"] == (1, "1") and got["c", "Unknown"] == (1, "1")
    assert got["c", "u"] == (2, "2 (67)".replace(")", "%)")) and got["c", "v"] == (1, "1 (33%)")
    assert ("x", "Unknown") not in {
        (r.variable, r.label) for r in tables.summary_table(df, variables, missing=False).collect()
    }


def test_anova_table_uses_the_correction_and_blanks(long):
    results = inference.anova_with_comparisons(
        long.withColumnsRenamed({"a": "cesd_score", "b": "promis_summary_mental_health_t"}),
        ["cesd_score", "promis_summary_mental_health_t"], "time", "id",
    )
    got = {r.outcome_name: r for r in tables.anova_table(results).collect()}
    assert set(got) == {"CESD Score", "\tMental health", "PROMIS Subscale t-score",
                        "PROMIS Summary t-score"}
    assert got["PROMIS Summary t-score"].anova_f == ""
    plain = {r.outcome: r for r in results.collect()}["cesd_score"]
    p = plain.correction_p_GG if plain.sphericity_p < 0.05 else plain.anova_p
    assert got["CESD Score"].anova_significant == (p < 0.05)
    assert plain.anova_formula == "cesd_score ~ time + Error(id/time)"


def test_small_p_is_significant(spark):
    df = spark.createDataFrame([(1e-9,), (0.2,)], "p double")
    assert [r[0] for r in df.select(text.significant(df.p)).collect()] == [True, False]


@pytest.mark.parametrize("n", [1, 2])
def test_few_complete_participants_do_not_end_the_job(spark, n):
    data = [(str(i), t, float(i * t + t * t)) for i in range(n) for t in (1, 2, 3)]
    df = spark.createDataFrame(data, "id string, time int, a double")
    r = inference.repeated_measures_anova(df, ["a"], "time", "id").first()
    assert r.n == n and (r.anova_p is None) == (n == 1)
    assert inference.pairwise_t_tests(df, ["a"], "time", "id").count() == 3
