"""Exact arithmetic on whole numbers and decimals; no doubles."""

from pyspark.sql import functions as F

EXACT = "decimal(18,2)"


def zero_to_null(value):
    """Divisor that turns a division by zero into NULL."""
    return F.nullif(value, F.lit(0))


def whole_division(numerator, denominator):
    """Integer division, truncating toward zero; NULL for a zero denominator."""
    return F.call_function("div", numerator.cast("long"), zero_to_null(denominator.cast("long")))


def exact_ratio(numerator, denominator):
    """Decimal quotient with about 20 fractional digits; NULL for a zero denominator."""
    return numerator.cast(EXACT) / zero_to_null(denominator.cast(EXACT))


def rounded_ratio(numerator, denominator, places):
    """:func:`exact_ratio` rounded half away from zero."""
    return F.round(exact_ratio(numerator, denominator), places)


def at_least_zero(value):
    return F.greatest(value, F.lit(0).cast(EXACT))


def effective_inventory(on_hand, on_order):
    return on_hand + on_order


def units_deviation(forecast, sold):
    return F.round(forecast - sold, 2)


def baseline_demand(base_price, is_promotion, is_rainy_clothing, is_winter_electronics):
    """Rule-based demand for one SKU and day, rounded to two places."""
    # Budget per price point, smallest volume and the three uplifts.
    budget_cents, smallest = 200000, 10
    promotion, rainy_clothing, winter_electronics = "1.3", "1.1", "1.2"

    def uplift(condition, factor):
        return F.when(condition, F.lit(factor).cast("decimal(2,1)")).otherwise(
            F.lit("1.0").cast("decimal(2,1)")
        )

    price_cents = (base_price.cast("decimal(10,2)") * 100).cast("long")
    volume = F.greatest(F.lit(smallest).cast("long"), whole_division(F.lit(budget_cents), price_cents))
    return F.round(
        volume.cast("decimal(12,0)")
        * uplift(is_promotion, promotion)
        * uplift(is_rainy_clothing, rainy_clothing)
        * uplift(is_winter_electronics, winter_electronics),
        2,
    )
