"""Column functions on hand-made rows."""

import datetime as dt
import math

import pytest
from comparing import rows
from pyspark.sql import functions as F

from phasewise.functions import choices, columns, dates, recode, rowwise, text
from phasewise.functions import distributions as dist


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


def test_dates_from_parts(spark):
    df = spark.createDataFrame(
        [(2024, 2, 3), (2024, 2, 30), (None, 2, 3), (2024, 13, 1)],
        "year_a int, month_a int, day_a int",
    )
    got = [r.date_a for r in dates.construct_dates(df, ["a"]).collect()]
    assert got == [dt.date(2024, 2, 3), None, None, None]


@pytest.mark.parametrize(
    "start,end,units,expected",
    [
        ("2024-01-31", "2024-02-01", "months", 1),
        ("2024-01-01", "2024-01-31", "months", 0),
        ("2023-12-31", "2024-01-01", "years", 1),
        ("2024-01-01", "2024-01-31", "days", 30),
        ("2024-03-01", "2024-01-31", "months", None),
        ("2024-03-01", None, "days", None),
    ],
)
def test_calendar_periods(spark, start, end, units, expected):
    df = spark.createDataFrame([(start, end)], "s string, e string")
    span = dates.periods_between(F.col("s").cast("date"), F.col("e").cast("date"), units)
    assert df.select(span.alias("y")).first().y == expected


def test_calendar_units_are_checked():
    with pytest.raises(ValueError):
        dates.periods_between(F.lit(1), F.lit(1), "weeks")


@pytest.mark.parametrize(
    "items,expected",
    [
        ([], ""),
        (["q_A"], "A"),
        (["q_B", "q_A"], "B & A"),
        (["q_Other", "q_B", "q_A"], "B, A & Other"),
        (["q_A", "q_other", "q_B", "q_C"], "A, B, C & other"),
    ],
)
def test_pretty_join(spark, items, expected):
    joined = text.pretty_join(F.col("x"), prefix="q", other_last=True)
    assert one(spark, joined, items, "array<string>") == expected


def test_pretty_join_sorts(spark):
    joined = text.pretty_join(F.col("x"), sort=True)
    assert one(spark, joined, ["c", "a", "b"], "array<string>") == "a, b & c"


@pytest.mark.parametrize(
    "p,shown", [(0.0004, "<0.001"), (0.0314, "0.031"), (0.9996, ">0.999"), (None, None)]
)
def test_p_text(spark, p, shown):
    assert one(spark, text.p_text(F.col("x")), p, "double") == shown


@pytest.mark.parametrize("x,shown", [(3.0, "3"), (3.14159, "3.14"), (0.5, "0.5"), (-2.0, "-2")])
def test_plain_number(spark, x, shown):
    assert one(spark, text.plain_number(F.col("x")), x, "double") == shown


@pytest.mark.parametrize(
    "share,shown", [(0.0, "0"), (0.0005, "<0.1"), (0.0123, "1.2"), (0.5, "50"), (1.0, "100")]
)
def test_percent_text(spark, share, shown):
    assert one(spark, text.percent_text(F.col("x")), share, "double") == shown


def test_f_text(spark):
    df = spark.createDataFrame([(2.0, 40.0, 3.52, 0.0391), (2.0, 40.0, 30.0, 1e-6)], "a double, b double, f double, p double")
    shown = text.f_text(F.col("a"), F.col("b"), F.col("f"), F.col("p"))
    got = [r.y for r in df.select(shown.alias("y")).collect()]
    assert got == ["F(2, 40)=3.52, p=0.039", "F(2, 40)=30, p<0.001"]


def test_separate_keeps_short_and_drops_long(spark):
    df = spark.createDataFrame([("a_b_c",), ("a",)], "name string")
    assert rows(text.separate(df, "name", ["x", "y"])) == [("a", None), ("a", "b")]


def test_note_flag_counts_missing_as_written(spark):
    assert [one(spark, recode.note_flag(F.col("x")), v) for v in ("", "hi", None)] == [0, 1, 1]


def test_recode_leaves_unknown_codes(spark):
    df = spark.createDataFrame([("1",), ("1.0",), ("9",), (None,)], "gender string")
    got = recode.recode_labels(df, {"gender": {1: "Male"}, "absent": {1: "x"}})
    assert [r.gender for r in got.collect()] == ["Male", "Male", "9", None]


@pytest.mark.parametrize(
    "a,b,both,either",
    [(1, 1, 1, 1), (1, 0, 0, 1), (0, 0, 0, 0), (1, None, None, 1), (0, None, 0, None),
     (None, None, None, None)],
)
def test_three_valued_flags(spark, a, b, both, either):
    df = spark.createDataFrame([(a, b)], "a int, b int")
    on = F.lit(True)
    got = df.select(
        recode.both_flags(F.col("a"), F.col("b"), on).alias("both"),
        recode.either_flag(F.col("a"), F.col("b"), on).alias("either"),
    ).first()
    assert tuple(got) == (both, either)


@pytest.mark.parametrize(
    "flag,phase,expected", [(None, 1, 0), (1, 1, 1), (1, 2, None), (None, 2, None)]
)
def test_reconcile_flag(spark, flag, phase, expected):
    df = spark.createDataFrame([(flag, phase)], "f int, p int")
    got = df.select(recode.reconcile_flag(F.col("f"), F.col("p"), 1).alias("y")).first().y
    assert got == expected


def test_threshold_is_a_fraction_not_code():
    assert recode.parse_threshold("1/3") == pytest.approx(1 / 3)
    with pytest.raises(ValueError):
        recode.parse_threshold("__import__('os')")


@pytest.mark.parametrize("x,expected", [(8 / 24, 1), (7.9 / 24, 0), (None, 0)])
def test_sufficient_wear(spark, x, expected):
    assert one(spark, recode.sufficient(F.col("x"), "1/3"), x, "double") == expected


def test_levels_off_the_set_are_missing(spark):
    level = recode.level_index(F.col("x"), ["a", "b"])
    assert [one(spark, level, v) for v in ("a", "b", "c", None)] == [1, 2, None, None]


def test_living_arrangement(spark):
    got = [one(spark, recode.living_arrangement(F.col("x")), v)
           for v in ("Partner & Children", "Alone", None)]
    assert got == ["With partner & children", "Alone", None]


def test_timepoints(spark):
    got = [one(spark, recode.timepoint_number(F.col("x")), v) for v in ("bl", "mp", "eos", "zz")]
    assert got == [1, 2, 3, None]


def test_options_combined_counted_and_worded(spark):
    questions = {"living": {1: "Alone", 2: "Partner", 3: "Other"}}
    df = spark.createDataFrame([(1, 0, 1), (0, 0, 0), (None, 1, None)],
                               "living___1 int, living___2 int, living___3 int")
    named = choices.name_options(df, questions)
    out = choices.options_to_words(
        choices.count_options(choices.combine_options(named, questions), questions), questions
    )
    got = [(r.living_combined, r.living_combined_n_choices, r.living_Alone) for r in out.collect()]
    assert got == [("Alone & Other", 2, "Yes"), ("", 0, "No"), ("Partner", 1, None)]


def test_rename_collisions_are_errors(spark):
    df = spark.createDataFrame([(1, 2)], "a_bl int, a int")
    with pytest.raises(ValueError):
        columns.rename_by_patterns(df, [("_bl$", "")])


def test_select_cols(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "rate_a int, rate_b string, other double")
    assert columns.select_cols(df, starts="rate") == ["rate_a", "rate_b"]
    assert columns.select_cols(df, starts="rate", numeric=True) == ["rate_a"]
    with pytest.raises(ValueError):
        columns.only_column(df, "rate")


def test_row_arithmetic(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    got = df.select(
        rowwise.row_sum([F.col("a"), F.col("b")]).alias("s"),
        rowwise.row_mean_strict([F.col("a"), F.col("b")]).alias("m"),
        rowwise.ratio(F.col("a"), F.lit(0)).alias("r"),
    ).first()
    assert tuple(got) == (1, None, None)


# ---- distribution tails: published values ----------------------------------------------


@pytest.mark.parametrize(
    "t,df,p",
    [(-2.81, 20, 0.0108151250768), (-2.24, 20, 0.0366083794724), (12.7062047362, 1, 0.05),
     (4.3026527297, 2, 0.05), (0.0, 5, 1.0)],
)
def test_t_tail(spark, t, df, p):
    tail = dist.t_two_sided(F.col("x"), F.lit(float(df)))
    assert one(spark, tail, t, "double") == pytest.approx(p, abs=1e-9)


def test_f_tail_for_two_numerator_degrees(spark):
    tail = dist.f_sf(F.col("x"), F.lit(2.0), F.lit(40.0))
    assert one(spark, tail, 3.52, "double") == pytest.approx((1 + 2 * 3.52 / 40) ** -20, abs=1e-10)


@pytest.mark.parametrize("x", [0.01, 1.0, 3.84, 30.0])
def test_chi_square_tail(spark, x):
    two = one(spark, dist.chi2_sf(F.col("x"), F.lit(2.0)), x, "double")
    assert two == pytest.approx(math.exp(-x / 2), abs=1e-10)
    normal = one(spark, dist.normal_two_sided(F.sqrt("x")), x, "double")
    assert normal == pytest.approx(math.erfc(math.sqrt(x / 2)), abs=1e-10)


@pytest.mark.parametrize("df", [1.0, 2.0, 3.0, 7.0, 21.0, 1500.0, 2e6])
def test_t_quantile_inverts_the_tail(spark, df):
    q = one(spark, dist.t_quantile(0.95, F.col("x")), df, "double")
    p = one(spark, dist.t_two_sided(F.lit(q), F.col("x")), df, "double")
    assert p == pytest.approx(0.05, abs=1e-9)
