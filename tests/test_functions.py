from datetime import date
from decimal import Decimal, getcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthloom.functions import calendar, ratios, status, text


def one(spark, column, **values):
    frame = spark.range(1)
    for name, (value, kind) in values.items():
        frame = frame.withColumn(name, F.lit(value).cast(kind))
    return frame.select(column.alias("x")).first()[0]


D9 = "decimal(38,9)"
getcontext().prec = 60


@pytest.mark.parametrize(
    ("n", "d", "rounded", "cut"),
    [
        ("2", "3", "0.666666667", "0.666666666"),
        ("1", "0", None, None),
        ("1", None, None, None),
        (None, "2", None, None),
        ("5", "-1", None, None),
        ("-2", "3", "-0.666666667", "-0.666666666"),
        ("123456789012345678.123456789", "1000000000", "123456789.012345678", "123456789.012345678"),
    ],
)
def test_ratios(spark, n, d, rounded, cut):
    values = {"n": (n, D9), "d": (d, D9)}
    expected = [None if x is None else Decimal(x) for x in (rounded, cut)]
    assert one(spark, ratios.positive_ratio(F.col("n"), F.col("d")), **values) == expected[0]
    assert one(spark, ratios.trunc_share(F.col("n"), F.col("d")), **values) == expected[1]


NINES = "9" * 29 + "." + "9" * 9


@pytest.mark.parametrize(
    ("n", "d"),
    [
        ("123456789012345678901.123456789", "1"),
        ("9000000000", "1"),
        ("100", "0.000000001"),
        (NINES, "1"),
        (NINES, NINES),
        (NINES, "3"),
        ("1", NINES),
        ("-" + NINES, "7.000000001"),
        ("12345678901234567890123456789", "98765432109876543210987654321.5"),
        ("5", "20000000000"),
        ("49999999999999999999999999999.5", "99999999999999999999999999999"),
    ],
)
def test_wide_ratios_are_exact(spark, n, d):
    top, bottom = (int(Decimal(x).scaleb(9)) for x in (n, d))
    sign = -1 if top < 0 else 1
    rounded = sign * ((2 * abs(top) * 10**9 + bottom) // (2 * bottom))
    cut = sign * (abs(top) * 10**9 // bottom)
    both = F.struct(
        ratios.safe_divide(F.col("n"), F.col("d")),
        ratios.trunc_share(F.col("n"), F.col("d")),
        ratios.growth(F.col("n"), F.col("d")),
        ratios.trunc_growth(F.col("n"), F.col("d")),
    )
    expected = [rounded, cut, rounded - 10**9, cut - 10**9]
    assert [int(x.scaleb(9)) for x in one(spark, both, n=(n, D9), d=(d, D9))] == expected


def test_growth_needs_a_positive_base(spark):
    grow = ratios.growth(F.col("n"), F.col("d"))
    assert one(spark, grow, n=("100", D9), d=("50", D9)) == Decimal(1)
    assert one(spark, grow, n=("100", D9), d=("0", D9)) is None
    assert one(spark, grow, n=("0", D9), d=("50", D9)) == Decimal(-1)


@settings(max_examples=12, deadline=None)
@given(
    st.integers(min_value=0, max_value=10**15), st.integers(min_value=1, max_value=10**9)
)
def test_exact_ratios_against_integers(spark, n, d):
    values = {"n": (str(n), D9), "d": (str(d * 10**6), D9)}
    base = d * 10**6
    both = F.struct(
        ratios.safe_divide(F.col("n"), F.col("d")), ratios.trunc_share(F.col("n"), F.col("d"))
    )
    rounded, cut = one(spark, both, **values)
    assert rounded == Decimal((2 * n * 10**9 + base) // (2 * base)).scaleb(-9)
    assert cut == Decimal(n * 10**9 // base).scaleb(-9)


@pytest.mark.parametrize(
    ("value", "shown"),
    [
        ("0", "0"),
        ("0.000000001", "0.000000001"),
        ("1200.500", "1200.5"),
        ("100", "100"),
        ("-7.10", "-7.1"),
        ("9007199254740993.123456790", "9007199254740993.12345679"),
        (None, None),
    ],
)
def test_plain_decimal(spark, value, shown):
    assert one(spark, text.plain_decimal(F.col("v")), v=(value, D9)) == shown


@pytest.mark.parametrize(
    ("written", "strict", "nine"),
    [
        ("12.5", "12.5", "12.5"),
        ("-3", "-3", "-3"),
        ("1e3", None, None),
        (" 1 ", None, None),
        ("1\n", None, None),
        ("1.", None, None),
        ("NaN", None, None),
        ("1.0000000000", "1", None),
        ("1.0000000001", None, None),
        ("0.000000001", "0.000000001", "0.000000001"),
        ("99999999999999999999999999999.999999999",) * 3,
        ("100000000000000000000000000000", None, None),
    ],
)
def test_strict_numbers(spark, written, strict, nine):
    as_number = [None if x is None else Decimal(x) for x in (strict, nine)]
    assert one(spark, text.parse_decimal(F.col("v")), v=(written, "string")) == as_number[0]
    assert one(spark, text.parse_decimal_nine(F.col("v")), v=(written, "string")) == as_number[1]


def test_exact_sum(spark):
    from monthloom.operators.aggregate import exact_sum

    rows = spark.createDataFrame([("9007199254740993.123456789",), ("0.000000001",), (None,)], "v string")
    found = rows.agg(exact_sum(F.col("v").cast(D9)).alias("s")).select(text.plain_decimal(F.col("s")))
    assert found.first()[0] == "9007199254740993.12345679"


@pytest.mark.parametrize(
    ("value", "long", "short"),
    [
        ("1234567.5", "1,234,567.5", "1.23M"),
        ("999", "999", "999"),
        ("999995", "999,995", "1M"),
        ("76450000000", "76,450,000,000", "76.45B"),
        (None, "資料不足", "資料不足"),
    ],
)
def test_amounts(spark, value, long, short):
    assert one(spark, text.amount_text(F.col("v")), v=(value, D9)) == long
    assert one(spark, text.compact_amount_text(F.col("v")), v=(value, D9)) == short


@pytest.mark.parametrize(
    ("ratio", "shown"),
    [
        ("0.01035", "1.03%"),
        ("0.00125", "0.13%"),
        ("-0.00125", "-0.13%"),
        ("0.99999", "100.00%"),
        ("0.01005", "1.00%"),
        ("12.3456", "1234.56%"),
        ("-0.0000001", "-0.00%"),
    ],
)
def test_percent_rounds_the_binary_value(spark, ratio, shown):
    assert one(spark, text.percent_text(F.col("v")), v=(ratio, D9)) == shown


def test_percent_and_cells(spark):
    assert one(spark, text.percent_text(F.col("v")), v=("0.25", D9)) == "25.00%"
    assert one(spark, text.percent_text(F.col("v")), v=(None, D9)) == "資料不足"
    assert one(spark, text.csv_cell(F.lit("=1+1"))) == "'=1+1"
    assert one(spark, text.csv_cell(F.lit("a=1"))) == "a=1"
    assert one(spark, text.quoted_csv_cell(F.lit('a"b'))) == '"a""b"'


@pytest.mark.parametrize(
    ("amount", "band"),
    [
        (None, "no_data"),
        ("0", "zero"),
        ("999999", "band_0"),
        ("1000000", "band_1"),
        ("10000000", "band_2"),
        ("100000000", "band_3"),
        ("1000000000", "band_4"),
    ],
)
def test_bands(spark, amount, band):
    assert one(spark, status.band_amount(F.col("v")), v=(amount, D9)) == band


def test_periods(spark):
    assert calendar.period_list("201611", "201702") == ["201611", "201612", "201701", "201702"]
    for start, end in (("201512", "201601"), ("201702", "201701"), ("201613", "201701")):
        with pytest.raises(ValueError):
            calendar.period_list(start, end)
    check = calendar.valid_period(F.col("p"))
    for period, good in (("201601", True), ("201512", False), ("201613", False), ("20161", False), (None, False)):
        assert one(spark, check, p=(period, "string")) is good


def test_export_range_is_bounded():
    calendar.check_export_range(date(2016, 1, 1), date(2031, 1, 1))
    with pytest.raises(ValueError):
        calendar.check_export_range(date(2016, 1, 1), date(2031, 2, 1))
    with pytest.raises(ValueError):
        calendar.check_export_range(date(2016, 1, 2), date(2016, 2, 1))


def test_calendar_lookup_is_not_the_previous_row(spark):
    rows = spark.createDataFrame(
        [("a", date(2023, 1, 1), 1), ("a", date(2023, 3, 1), 3), ("a", date(2024, 1, 1), 9)],
        "k string, month date, v int",
    )
    lookups = {"pm": ("v", -1), "py": ("v", -12)}
    found = calendar.with_calendar_lookups(rows, ["k"], "month", lookups).orderBy("month").collect()
    assert [(r.pm, r.py) for r in found] == [(None, None), (None, None), (None, 1)]


def test_staged_ratios_equal_the_expressions(spark):
    import itertools
    import random
    from decimal import Decimal

    dice = random.Random(4)
    values = [None, "0", "1", "-1", "0.000000001", "0.999999999", "3", "-7.5", "100000000000000000000", "99999999999999999999.999999999", "-100000000000000000000"]
    values += [f"{dice.choice(['', '-'])}{dice.randrange(10 ** dice.randrange(1, 27))}.{dice.randrange(10**9):09d}" for _ in range(40)]
    pairs = [(k, n and Decimal(n), d and Decimal(d)) for k, (n, d) in enumerate(itertools.product(values, values))]
    frame = spark.createDataFrame(pairs, "k int, n decimal(38,9), d decimal(38,9)")
    # Only results that fit; the others fail in both forms.
    frame = frame.where("d is null or n is null or d = 0 or abs(cast(n as double) / cast(d as double)) < 1e28").cache()
    forms = {
        "safe": ratios.safe_divide, "positive": ratios.positive_ratio, "growth": ratios.growth,
        "cut": ratios.trunc_share, "cut_growth": ratios.trunc_growth,
    }
    found = ratios.with_ratios(frame, {name: (name, "n", "d") for name in forms})
    assert found.columns == ["k", "n", "d", *forms]
    expected = frame.select("k", *[form(F.col("n"), F.col("d")).alias(name) for name, form in forms.items()])
    assert sorted(map(tuple, found.select("k", *forms).collect())) == sorted(map(tuple, expected.collect()))
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    assert plan.startswith("Found 1 WholeStageCodegen subtrees") and "CodegenFallback" not in plan
    narrow = found.where("positive > 1 and growth < 9")._jdf.queryExecution().optimizedPlan().toString()
    assert narrow.count("__top1") < 12  # the filter holds no copy of the stages
