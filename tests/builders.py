"""Small hand-made tables."""

from datetime import date, timedelta
from decimal import Decimal

from shelfline.operators.joins import Star
from shelfline.schemas import DIM_DATE, DIM_PRODUCT, DIM_STORE, FACT, FORECAST, RAW_FORECAST, RAW_INVENTORY

DAY = date(2024, 3, 9)


def key_of(day):
    return day.year * 10000 + day.month * 100 + day.day


def money(value):
    return None if value is None else Decimal(str(value))


def star(spark, facts):
    """``facts``: dicts with product (default P1), day, stock, ordered, sold, forecast, price."""
    products = sorted({fact.get("product", "P1") for fact in facts})
    days = sorted({fact.get("day", DAY) for fact in facts})
    rows = [
        (
            key_of(fact.get("day", DAY)),
            1,
            products.index(fact.get("product", "P1")) + 1,
            fact.get("stock", 0),
            fact.get("sold", 0),
            fact.get("ordered", 0),
            money(fact.get("forecast", 0)),
            money(fact.get("price", 10)),
            money(0),
            money(9),
            "Sunny",
            False,
        )
        for fact in facts
    ]
    dates = [(key_of(d), d, d.month, d.year, "Spring", False, d.strftime("%A")) for d in days]
    members = [(i + 1, name, "Toys", "Active") for i, name in enumerate(products)]
    return Star(
        spark.createDataFrame(rows, FACT),
        spark.createDataFrame(dates, DIM_DATE),
        spark.createDataFrame([(1, "S1", "East", "Active")], DIM_STORE),
        spark.createDataFrame(members, DIM_PRODUCT),
    )


def forecast(spark, demands):
    """``demands``: product -> list of daily demands from the day after DAY; a list entry repeats a day."""
    rows = []
    for product, values in demands.items():
        for offset, entry in enumerate(values):
            day = DAY + timedelta(days=offset + 1)
            for demand in entry if isinstance(entry, list) else [entry]:
                rows.append(
                    (DAY, day, "S1", product, "Toys", "East", money(10), money(0), "Sunny", False,
                     money(9), "Spring", money(demand))
                )
    return spark.createDataFrame(rows, FORECAST)


def raw_row(day="9/3/24", store="S1", product="P1", **changes):
    row = {
        "Date": day,
        "Store ID": store,
        "Product ID": product,
        "Category": "Toys",
        "Region": "East",
        "Inventory Level": "50",
        "Units Sold": "20",
        "Units Ordered": "5",
        "Demand Forecast": "21.5",
        "Price": "9.99",
        "Discount": "10",
        "Weather Condition": "Sunny",
        "Holiday/Promotion": "0",
        "Competitor Pricing": "9.5",
        "Seasonality": "Spring",
    }
    row.update(changes)
    return tuple(row[name] for name in RAW_INVENTORY.fieldNames())


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_INVENTORY)


def raw_forecast_row(made="09/03/24", day="10/03/24", product="P1", **changes):
    row = dict(zip(RAW_INVENTORY.fieldNames(), raw_row(day=day, product=product)))
    row["Forecasted On"] = made
    row.update(changes)
    return tuple(row[name] for name in RAW_FORECAST.fieldNames())


def raw_forecast(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_FORECAST)
