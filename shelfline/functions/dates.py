"""Calendar expressions."""

from pyspark.sql import functions as F

# Text formats of the input files and first month of each season.
SHORT_DATE_PATTERN = "d/M/yy"
SHORT_DATE_FORMAT = "dd/MM/yy"
FILE_TOKEN_FORMAT = "yyyyMMdd"
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8], "Autumn": [9, 10, 11]}
WEEKDAY_WIDTH = 9


def parse_short_date(text):
    """``DD/MM/YY`` text to a date; two-digit years 70-99 belong to 1970-1999."""
    parsed = F.to_date(F.trim(text), SHORT_DATE_PATTERN)
    return F.when(F.year(parsed) >= 2070, F.add_months(parsed, -1200)).otherwise(parsed)


def date_key(day):
    """Date to its integer key yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def weekday_name(day, padded=False):
    """English weekday name, blank-padded to nine characters when asked for."""
    name = F.date_format(day, "EEEE")
    return F.rpad(name, WEEKDAY_WIDTH, " ") if padded else name


def season_of(month):
    """Month number to season name; any other value counts as Autumn."""
    return (
        F.when(month.isin(SEASONS["Winter"]), "Winter")
        .when(month.isin(SEASONS["Spring"]), "Spring")
        .when(month.isin(SEASONS["Summer"]), "Summer")
        .otherwise("Autumn")
    )


def short_date_text(day):
    return F.date_format(day, SHORT_DATE_FORMAT)


def file_token(day):
    return F.date_format(day, FILE_TOKEN_FORMAT)


def run_date(text=None):
    """The date a job runs for: the given ISO date, else yesterday in the session's time zone."""
    if text is None:
        return F.date_sub(F.current_date(), 1)
    return F.lit(text).cast("date")
