from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.functions import arithmetic, casts, cleaning, dates, rules


def one(spark, column, **values):
    """The column's value over one row with the given named values."""
    row = spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])
    return row.select(column.alias("value")).first()["value"]


@pytest.mark.parametrize(
    "text, day",
    [
        ("25/12/23", date(2023, 12, 25)),
        ("5/2/23", date(2023, 2, 5)),
        ("01/01/69", date(2069, 1, 1)),
        ("01/01/70", date(1970, 1, 1)),
        ("31/12/99", date(1999, 12, 31)),
        ("29/02/72", date(1972, 2, 29)),
    ],
)
def test_short_dates(spark, text, day):
    assert one(spark, dates.parse_short_date(F.col("t")), t=text) == day


def test_bad_date_raises(spark):
    with pytest.raises(Exception):
        one(spark, dates.parse_short_date(F.col("t")), t="2023-12-25")


def test_date_parts(spark):
    day = F.lit("2024-05-01").cast("date")
    assert one(spark, dates.date_key(day)) == 20240501
    assert one(spark, dates.weekday_name(day)) == "Wednesday"
    assert one(spark, dates.weekday_name(F.lit("2024-05-03").cast("date"), padded=True)) == "Friday   "
    assert one(spark, dates.short_date_text(day)) == "01/05/24"
    assert one(spark, dates.file_token(day)) == "20240501"
    assert one(spark, dates.run_date("2024-05-01")) == date(2024, 5, 1)
    assert one(spark, dates.run_date() == F.date_sub(F.current_date(), 1)) is True


def test_seasons(spark):
    names = [row[0] for row in spark.range(1, 13).orderBy("id").select(dates.season_of(F.col("id"))).collect()]
    assert names == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]


@pytest.mark.parametrize("text", ["", "12.0", "x"])
def test_bad_counts_raise(spark, text):
    with pytest.raises(Exception):
        one(spark, casts.to_count(F.col("t")), t=text)


def test_money(spark):
    assert one(spark, casts.to_money(F.col("t")), t="1.005") == Decimal("1.01")
    assert one(spark, casts.to_money(F.col("t")), t="-1.005") == Decimal("-1.01")
    with pytest.raises(Exception):
        one(spark, casts.to_money(F.col("t")), t="")
    assert one(spark, casts.to_money_or_null(F.col("t")), t="") is None
    assert one(spark, casts.to_money_or_null(F.col("t")), t="2.5") == Decimal("2.50")


def test_is_one(spark):
    assert one(spark, casts.is_one(F.col("t")), t="1") is True
    assert one(spark, casts.is_one(F.col("t")), t="01") is False
    assert one(spark, casts.is_one(F.lit(None).cast("string"))) is False


def test_whole_division_truncates_and_guards_zero(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, arithmetic.whole_division(a, b), a=7, b=2) == 3
    assert one(spark, arithmetic.whole_division(a, b), a=-7, b=2) == -3
    assert one(spark, arithmetic.whole_division(a, b), a=7, b=0) is None


@pytest.mark.parametrize(
    "a, b, places, expected",
    [
        ("49", "20", 1, "2.5"),
        ("-49", "20", 1, "-2.5"),
        ("5", "0", 1, None),
        ("1", "3", 2, "0.33"),
        ("2", "3", 0, "1"),
        ("99999999.99", "0.01", 2, "9999999999.00"),
        ("0.01", "99999999.99", 2, "0.00"),
    ],
)
def test_rounded_ratio_is_half_up(spark, a, b, places, expected):
    value = one(spark, arithmetic.rounded_ratio(F.col("a"), F.col("b"), places), a=Decimal(a), b=Decimal(b))
    assert value == (None if expected is None else Decimal(expected))


def test_baseline_demand(spark):
    flags = {"p": True, "r": True, "w": True}
    column = arithmetic.baseline_demand(F.col("price"), F.col("p"), F.col("r"), F.col("w"))
    assert one(spark, column, price=Decimal("85.00"), **flags) == Decimal("39.47")  # 23 * 1.716
    plain = {"p": False, "r": False, "w": False}
    assert one(spark, column, price=Decimal("1000.00"), **plain) == Decimal("10.00")


@pytest.mark.parametrize(
    "forecast, sold, flag",
    [
        (0, 0, "accurate"),
        (5, 0, "over-forecast"),
        (0, 5, "under-forecast"),
        ("110.00", 100, "accurate"),
        ("110.01", 100, "over-forecast"),
        ("90.00", 100, "accurate"),
        ("89.99", 100, "under-forecast"),
        ("-111", -100, "over-forecast"),  # (-111 + 100) / -100 = 0.11
        ("-89", -100, "under-forecast"),
        (None, 5, "accurate"),
    ],
)
def test_accuracy_flag(spark, forecast, sold, flag):
    value = F.lit(None if forecast is None else Decimal(str(forecast))).cast("decimal(10,2)")
    assert one(spark, rules.accuracy_flag(value, F.lit(sold))) == flag


def test_negative_forecast_without_sales_raises(spark):
    with pytest.raises(Exception, match="negative forecast"):
        one(spark, rules.accuracy_flag(F.lit(Decimal("-1.00")), F.lit(0)))


@pytest.mark.parametrize(
    "on_hand, on_order, demand, dos, status, action, severity",
    [
        (5, 9, 10, "0.9", "Critical", "Order more and delivery by tomorrow", 1),
        (5, 9, 10, "1.0", "Critical", "Delivery by tomorrow", 2),
        (10, 0, 10, "1.0", "Low", "Order more", 3),
        (10, 0, 10, "1.9", "Low", "Order more", 3),
        (10, 0, 10, "2.0", "Healthy", "No action required", 5),
        (10, 0, 10, "4.0", "Healthy", "No action required", 5),
        (10, 1, 10, "4.1", "Overstocked", "Cancel existing order and apply discount", 4),
        (10, 0, 10, "4.1", "Overstocked", "Apply discount", 4),
        (10, 0, 0, None, None, "No action required", None),
    ],
)
def test_alert_ladder(spark, on_hand, on_order, demand, dos, status, action, severity):
    cover = F.lit(None if dos is None else Decimal(dos)).cast("decimal(10,2)")
    hand, order, need = F.lit(on_hand), F.lit(on_order), F.lit(Decimal(demand))
    row = spark.range(1).select(
        rules.health_status(hand, need, cover),
        rules.recommended_action(hand, order, need, cover),
        rules.severity_level(hand, need, cover),
    )
    assert tuple(row.first()) == (status, action, severity)


def test_cleaning(spark):
    assert one(spark, cleaning.lower_text(F.col("t")), t="SuNNy") == "sunny"
    assert [one(spark, cleaning.yes_no_to_digit(F.col("t")), t=t) for t in ("yes", "no", "1")] == ["1", "0", "1"]
    known = ["cloudy", "sunny"]
    assert one(spark, cleaning.known_or_first(F.col("t"), known), t="sunny") == "sunny"
    assert one(spark, cleaning.known_or_first(F.col("t"), known), t="hail") == "cloudy"
    assert one(spark, cleaning.known_or_first(F.lit(None).cast("string"), known)) == "cloudy"
