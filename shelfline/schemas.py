"""Table schemas and the constraints that the loads check."""

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# Column names of the two input files and of the warehouse tables.
RAW_INVENTORY_COLUMNS = [
    "Date",
    "Store ID",
    "Product ID",
    "Category",
    "Region",
    "Inventory Level",
    "Units Sold",
    "Units Ordered",
    "Demand Forecast",
    "Price",
    "Discount",
    "Weather Condition",
    "Holiday/Promotion",
    "Competitor Pricing",
    "Seasonality",
]
RAW_FORECAST_COLUMNS = [
    "Forecasted On",
    "Date",
    "Store ID",
    "Product ID",
    "Category",
    "Region",
    "Price",
    "Discount",
    "Weather Condition",
    "Holiday/Promotion",
    "Competitor Pricing",
    "Seasonality",
    "Demand Forecast",
]


def _text(columns):
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


RAW_INVENTORY = _text(RAW_INVENTORY_COLUMNS)
RAW_FORECAST = _text(RAW_FORECAST_COLUMNS)

DIM_DATE = _struct(
    ("date_key", T.IntegerType()),
    ("full_date", T.DateType()),
    ("month", T.IntegerType()),
    ("year", T.IntegerType()),
    ("season", T.StringType()),
    ("is_holiday", T.BooleanType()),
    ("weekday_name", T.StringType()),
)
DIM_STORE = _struct(
    ("store_key", T.LongType()),
    ("store_id", T.StringType()),
    ("region", T.StringType()),
    ("store_status", T.StringType()),
)
DIM_PRODUCT = _struct(
    ("product_key", T.LongType()),
    ("product_id", T.StringType()),
    ("category", T.StringType()),
    ("product_status", T.StringType()),
)
FACT = _struct(
    ("date_key", T.IntegerType()),
    ("store_key", T.LongType()),
    ("product_key", T.LongType()),
    ("inventory_level", T.IntegerType()),
    ("units_sold", T.IntegerType()),
    ("units_ordered", T.IntegerType()),
    ("demand_forecast", MONEY),
    ("selling_price", MONEY),
    ("discount_applied", MONEY),
    ("competitor_price", MONEY),
    ("weather_condition", T.StringType()),
    ("is_promotion_active", T.BooleanType()),
)
FORECAST = _struct(
    ("forecasted_on", T.DateType()),
    ("full_date", T.DateType()),
    ("store_id", T.StringType()),
    ("product_id", T.StringType()),
    ("category", T.StringType()),
    ("region", T.StringType()),
    ("selling_price", MONEY),
    ("discount_applied", MONEY),
    ("weather_condition", T.StringType()),
    ("is_promotion_active", T.BooleanType()),
    ("competitor_price", MONEY),
    ("season", T.StringType()),
    ("demand_forecast", MONEY),
)
REJECTED = _struct(
    ("rule", T.StringType()),
    ("date_key", T.IntegerType()),
    ("store_id", T.StringType()),
    ("product_id", T.StringType()),
    ("row_count", T.LongType()),
)
TRAINING = _struct(
    ("demand_forecast", T.DoubleType()),
    ("price", T.DoubleType()),
    ("discount", T.DoubleType()),
    ("Holiday_Promotion", T.StringType()),
    ("weather_condition", T.StringType()),
    ("seasonality", T.StringType()),
    ("forecast_accuracy_flag", T.StringType()),
)
SCORING = T.StructType(TRAINING.fields[:-1])

FACT_KEY = ["date_key", "store_key", "product_key"]
PRIMARY_KEYS = {
    "dim_date": ["date_key"],
    "dim_store": ["store_key"],
    "dim_product": ["product_key"],
    "fct_inventory_daily": FACT_KEY,
}
UNIQUE_KEYS = {"dim_store": ["store_id"], "dim_product": ["product_id"]}
REQUIRED = {
    "dim_date": ["date_key"],
    "fct_inventory_daily": FACT_KEY,
    "dim_store": ["store_id", "region", "store_status"],
    "dim_product": ["product_id", "category", "product_status"],
}
FOREIGN_KEYS = {"date_key": "dim_date", "store_key": "dim_store", "product_key": "dim_product"}
NON_NEGATIVE = ["inventory_level", "units_sold", "units_ordered", "demand_forecast"]

# Longest text each column may hold.
MAX_LENGTHS = {
    "dim_date": {"season": 20, "weekday_name": 10},
    "dim_store": {"store_id": 10, "region": 50, "store_status": 10},
    "dim_product": {"product_id": 10, "category": 50, "product_status": 10},
    "fct_inventory_daily": {"weather_condition": 50},
    "demand_forecast_7d": {
        "store_id": 10,
        "product_id": 10,
        "category": 50,
        "region": 50,
        "weather_condition": 50,
        "season": 20,
    },
}
