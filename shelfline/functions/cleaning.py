"""Cleaning of categorical text before scoring."""

from pyspark.sql import functions as F


def lower_text(value):
    return F.lower(value.cast("string"))


def yes_no_to_digit(value):
    """'yes' to '1', 'no' to '0', other text unchanged."""
    return F.when(value == "yes", "1").when(value == "no", "0").otherwise(value)


def known_or_first(value, labels):
    """Values outside the fitted labels (and NULLs) become the first label."""
    return F.when(value.isin(list(labels)), value).otherwise(F.lit(labels[0]))


def trimmed(*names):
    """Trimmed columns under their own names."""
    return [F.trim(F.col(name)).alias(name) for name in names]
