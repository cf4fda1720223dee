"""Stock health from two snapshots bucketed by SKU: the forecast and the facts of the latest date.

The windows over the forecast, the join with the facts and the grouping per SKU all work on
(store_id, product_id). Both snapshots are dealt and sorted by it when a delivery is loaded, once, so
the marts and KPIs that read them shuffle neither.
"""

from shelfline.operators.windows import SKU
from shelfline.plans import kpis, marts
from shelfline.schemas import FORECAST

FACTS, DEMAND = "dwh/health_facts", "dwh/health_forecast"
FACT_COLUMNS = "full_date date, store_id string, region string, product_id string, category string, inventory_level int, units_ordered int, selling_price decimal(10,2)"


def refresh(warehouse, latest):
    """Writes both snapshots anew from the warehouse, with one number of buckets."""
    buckets = int(warehouse.spark.conf.get("spark.sql.shuffle.partitions"))
    warehouse.replace_bucketed(FACTS, marts.outlook_facts(warehouse.star(), latest), SKU, buckets)
    warehouse.replace_bucketed(DEMAND, warehouse.forecast(), SKU, buckets)


def outlook(warehouse):
    """:func:`marts.sku_outlook` from the snapshots; None before the first delivery."""
    spark = warehouse.spark
    facts = warehouse.read_bucketed(FACTS, spark.createDataFrame([], FACT_COLUMNS).schema)
    demand = warehouse.read_bucketed(DEMAND, FORECAST)
    if facts is None or demand is None:
        return None
    return marts.outlook_per_sku(marts.outlook_of(facts, demand))


def inventory_health(warehouse):
    """:func:`marts.inventory_health` from the snapshots; None before the first delivery."""
    skus = outlook(warehouse)
    return None if skus is None else marts.health_of(skus)


def sku_risks(warehouse):
    """:func:`kpis.sku_risks` from the snapshots; None before the first delivery."""
    skus = outlook(warehouse)
    return None if skus is None else kpis.risks_of(skus)
