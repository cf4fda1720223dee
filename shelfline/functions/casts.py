"""Text to typed columns. Malformed numbers raise (ANSI mode)."""

from pyspark.sql import functions as F

MONEY_TYPE = "decimal(10,2)"


def to_count(text):
    """Text to INT; empty or fractional text raises."""
    return text.cast("int")


def to_money(text):
    """Text to DECIMAL(10,2), rounding half up; empty text raises."""
    return text.cast(MONEY_TYPE)


def to_money_or_null(text):
    """Like :func:`to_money`, but empty text becomes NULL."""
    return F.nullif(text, F.lit("")).cast(MONEY_TYPE)


def is_one(text):
    """TRUE for '1', FALSE for anything else including NULL."""
    return F.coalesce(text == "1", F.lit(False))
