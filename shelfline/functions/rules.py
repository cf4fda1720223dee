"""Business rules that turn measures into labels."""

from functools import reduce

from pyspark.sql import functions as F

# Labels, actions, severities and thresholds of the stock-health rules.
CRITICAL, LOW, HEALTHY, OVERSTOCKED = "Critical", "Low", "Healthy", "Overstocked"
ORDER_AND_DELIVER = "Order more and delivery by tomorrow"
DELIVER = "Delivery by tomorrow"
ORDER = "Order more"
NO_ACTION = "No action required"
CANCEL_AND_DISCOUNT = "Cancel existing order and apply discount"
DISCOUNT = "Apply discount"
ONE_DAY, TWO_DAYS, FOUR_DAYS = 1, 2, 4
ACCURATE, OVER, UNDER = "accurate", "over-forecast", "under-forecast"
TOLERANCE = "0.10"


def _bands(on_hand, next_day_demand, dos):
    """Named conditions over one SKU's stock position."""
    short_tomorrow = next_day_demand > on_hand
    return {
        "out_today": short_tomorrow & (dos < ONE_DAY),
        "out_tomorrow": short_tomorrow & (dos >= ONE_DAY),
        "low": (dos >= ONE_DAY) & (dos < TWO_DAYS),
        "healthy": (dos >= TWO_DAYS) & (dos <= FOUR_DAYS),
        "overstocked": dos > FOUR_DAYS,
    }


def _ladder(rungs):
    """First matching condition wins; NULL when none does."""
    (condition, value), *rest = rungs
    return reduce(lambda ladder, rung: ladder.when(*rung), rest, F.when(condition, value))


def health_status(on_hand, next_day_demand, dos):
    band = _bands(on_hand, next_day_demand, dos)
    return _ladder(
        [
            (band["out_today"] | band["out_tomorrow"], CRITICAL),
            (band["low"], LOW),
            (band["healthy"], HEALTHY),
            (band["overstocked"], OVERSTOCKED),
        ]
    )


def recommended_action(on_hand, on_order, next_day_demand, dos):
    band = _bands(on_hand, next_day_demand, dos)
    return _ladder(
        [
            (band["out_today"], ORDER_AND_DELIVER),
            (band["out_tomorrow"], DELIVER),
            (band["low"], ORDER),
            (band["overstocked"] & (on_order > 0), CANCEL_AND_DISCOUNT),
            (band["overstocked"] & (on_order == 0), DISCOUNT),
        ]
    ).otherwise(NO_ACTION)


def severity_level(on_hand, next_day_demand, dos):
    band = _bands(on_hand, next_day_demand, dos)
    return _ladder(
        [
            (band["out_today"], 1),
            (band["out_tomorrow"], 2),
            (band["low"], 3),
            (band["healthy"], 5),
            (band["overstocked"], 4),
        ]
    )


def relative_gap(forecast, sold, tolerance=TOLERANCE):
    """+1 / -1 / 0: forecast above, below or within the tolerance around sold units.

    ``(forecast - sold) / sold`` is compared with the tolerance by multiplying out, which is
    exact. Multiplying by the sign of ``sold`` keeps negative sold units right.
    """
    side = F.signum(sold).cast("decimal(1,0)")
    gap = (forecast - sold) * side
    allowed = F.abs(sold).cast("decimal(10,0)") * F.lit(tolerance).cast("decimal(4,2)")
    return F.when(gap > allowed, 1).when(gap < -allowed, -1).otherwise(0)


def accuracy_flag(forecast, sold, tolerance=TOLERANCE):
    """accurate / over-forecast / under-forecast; NULL measures count as accurate.

    A negative forecast with nothing sold has no relative deviation and raises; the
    non-negative check of ``operators.quality`` finds such rows beforehand.
    """
    nothing_sold, nothing_forecast = sold == 0, forecast == 0
    undefined = F.raise_error(F.lit("negative forecast with zero units sold"))
    gap = relative_gap(forecast, sold, tolerance)
    return (
        F.when(nothing_sold & nothing_forecast, ACCURATE)
        .when(nothing_sold & (forecast > 0), OVER)
        .when(nothing_sold & (forecast < 0), undefined.cast("string"))
        .when(nothing_forecast & (sold > 0), UNDER)
        .when(gap == 1, OVER)
        .when(gap == -1, UNDER)
        .otherwise(ACCURATE)
    )
