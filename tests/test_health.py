"""Days of supply against a plain row-by-row computation, and the alerts of special cases."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

import builders
from shelfline.operators.joins import latest_facts
from shelfline.operators.quality import lost_skus
from shelfline.operators.windows import running_demand
from shelfline.plans import kpis, marts


def rounded(value, places):
    return value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def expected_dos(stock, days):
    """None if the SKU is dropped, else (dos, next_day_demand)."""
    rows = [
        (day, None if demand is None else Decimal(str(demand)))
        for day, entry in enumerate(days)
        for demand in sorted(
            entry if isinstance(entry, list) else [entry], key=lambda d: (d is None, d or 0)
        )
    ]
    kept, values, first_total = False, [], None
    for number, (day, demand) in enumerate(rows, 1):
        known = [d for other, d in rows if other <= day and d is not None]
        total = sum(known) if known else None
        if number == 1:
            first_total = total
        short = total is not None and stock < total
        if not short and number != 7:
            continue
        kept = True
        if number == 1:
            value = rounded(stock / demand, 1) if demand else None
        elif number == 7 and not short:
            value = Decimal(7) + 7 * (stock - total) / total if total else None
        else:
            covered = None if demand is None else max(stock - (total - demand), Decimal(0))
            value = rounded(number - 1 + covered / demand, 1) if demand else None
        if value is not None:
            values.append(value)
    return (rounded(min(values), 2) if values else None, first_total) if kept else None


cents = st.integers(0, 6000).map(lambda c: c / 100)
entry = st.one_of(cents, st.none(), st.lists(st.sampled_from([0.0, 3.5, 12.0, 40.0]), min_size=2, max_size=3))
sku = st.tuples(st.integers(0, 200), st.integers(0, 100), st.lists(entry, min_size=1, max_size=9))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(sku, min_size=1, max_size=40))
def test_days_of_supply_matches_row_by_row(spark, skus):
    names = [f"P{i:03d}" for i in range(len(skus))]
    facts = [
        {"product": name, "stock": stock, "ordered": ordered}
        for name, (stock, ordered, _) in zip(names, skus)
    ]
    star = builders.star(spark, facts)
    forecast = builders.forecast(spark, {name: days for name, (_, _, days) in zip(names, skus)})
    found = {
        row.product_id: (row.dos, row.next_day_demand)
        for row in marts.sku_outlook(star, forecast).collect()
    }
    expected = {
        name: expected_dos(Decimal(stock + ordered), days) for name, (stock, ordered, days) in zip(names, skus)
    }
    assert found == {name: value for name, value in expected.items() if value is not None}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 400), st.lists(st.integers(1, 90), min_size=7, max_size=7)),
        min_size=1,
        max_size=30,
    )
)
def test_first_short_day_bounds_the_supply(spark, skus):
    names = [f"P{i:03d}" for i in range(len(skus))]
    star = builders.star(spark, [{"product": n, "stock": s} for n, (s, _) in zip(names, skus)])
    forecast = builders.forecast(spark, {n: days for n, (_, days) in zip(names, skus)})
    dos = {row.product_id: row.dos for row in marts.sku_outlook(star, forecast).collect()}
    for name, (stock, days) in zip(names, skus):
        short = [k for k in range(1, 8) if stock < sum(days[:k])]
        low = short[0] - 1 if short else 7
        high = short[0] if short else None
        assert dos[name] >= low and (high is None or dos[name] <= high)


def health_of(spark, facts, demands):
    rows = marts.inventory_health(builders.star(spark, facts), builders.forecast(spark, demands)).collect()
    return {row.product_id: row for row in rows}


def test_only_the_latest_date_counts(spark):
    earlier = builders.DAY.replace(day=1)
    facts = [{"stock": 500, "day": earlier}, {"stock": 10}, {"product": "P2", "stock": 5, "day": earlier}]
    rows = health_of(spark, facts, {"P1": [20] * 7, "P2": [20] * 7})
    assert set(rows) == {"P1"} and rows["P1"].inventory_level == 10


def test_tail_beyond_the_horizon(spark):
    rows = health_of(spark, [{"stock": 500}], {"P1": [0.01] * 6 + [0.02]})
    assert rows["P1"].dos == Decimal("43750.00")
    assert rows["P1"].inventory_action_required == "Apply discount"


def test_rounding_moves_the_action(spark):
    rows = health_of(spark, [{"stock": 96}], {"P1": [100] * 7})
    assert rows["P1"].dos == Decimal("1.00")
    assert rows["P1"].inventory_action_required == "Delivery by tomorrow"


def test_zero_demand_has_no_status(spark):
    row = health_of(spark, [{"stock": 5}], {"P1": [0] * 7})["P1"]
    assert (row.dos, row.inventory_health_status, row.severity_level) == (None, None, None)
    assert row.inventory_action_required == "No action required"


def test_dropped_skus_are_reported(spark):
    facts = [{"product": p, "stock": 50} for p in ("P1", "P2", "P3", "P4")]
    star = builders.star(spark, facts)
    forecast = builders.forecast(spark, {"P1": [1] * 7, "P2": [1] * 3, "P3": [60]})
    assert {r.product_id for r in marts.inventory_health(star, forecast).collect()} == {"P1", "P3"}
    lost = {(r.product_id, r.reason) for r in lost_skus(latest_facts(star), forecast).collect()}
    assert lost == {("P2", "short horizon"), ("P4", "no forecast")}


def test_risk_kpis(spark):
    facts = [
        {"product": "P1", "stock": 4, "ordered": 3, "price": 2.5},
        {"product": "P2", "stock": 90, "ordered": 10, "price": 3},
    ]
    star = builders.star(spark, facts)
    risks = kpis.sku_risks(star, builders.forecast(spark, {"P1": [10] * 7, "P2": [10] * 7}))
    assert kpis.projected_stockout_loss(risks).first().projected_stockout_loss == Decimal("15.0000")
    locked = kpis.capital_locked(risks).first()
    assert (locked.capital_locked, locked.overstocked_skus) == (Decimal("180.0000"), 1)
    assert kpis.low_inventory_share(risks).first().low_inventory_share == Decimal("0.5")


def test_explicit_latest_date_gives_the_same_rows(spark, sf_dir):
    from shelfline.sources.driver_tables import folded_forecast, star

    built, forecast = star(spark, sf_dir, folded=True), folded_forecast(spark, sf_dir)
    found = marts.inventory_health(built, forecast)
    given_date = marts.inventory_health(built, forecast, latest=19950128)
    assert sorted(found.collect()) == sorted(given_date.collect())


def test_a_repeated_forecast_row_does_not_fill_the_window(spark):
    star = builders.star(spark, [{"product": "P1", "stock": 900}, {"product": "P2", "stock": 25}])
    rows = builders.forecast(spark, {"P1": [0.01] * 7, "P2": [10] * 7})
    copies = F.when(F.col("product_id") == "P1", 20000).otherwise(1)
    hot = rows.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")
    assert running_demand(hot).count() == 14
    dos = {row.product_id: row.dos for row in marts.sku_outlook(star, hot).collect()}
    # Rows of one day share its running total of 200, so the seventh row is covered by 900:
    # 7 + 7 * (900 - 200) / 200. The first short row comes 80000 rows later.
    assert dos == {"P1": Decimal("31.50"), "P2": Decimal("2.50")}


def test_sketch_cuts_stay_within_their_rank_error(spark):
    """Groups of 40,000 values: the cuts' ranks are within the stated error, also after merging parts."""
    rows = spark.range(120_000).selectExpr("concat('S', id % 3) as store_id", "concat('C', id % 2) as category", "cast(abs(xxhash64(id)) % 1000000 as decimal(18,6)) as turnover")
    fine = kpis.segment_sketches(rows)
    stores = kpis.merged_sketches(fine, "store_id")
    for cuts, keys in ((kpis.segment_cuts(fine), ["store_id", "category"]), (kpis.segment_cuts(stores), ["store_id"])):
        below = rows.join(cuts, keys).groupBy(*keys).agg(
            F.avg((F.col("turnover").cast("double") <= F.col("slow")).cast("int")).alias("slow"),
            F.avg((F.col("turnover").cast("double") <= F.col("fast")).cast("int")).alias("fast"),
        )
        for row in below.collect():
            assert abs(row.slow - 0.25) <= kpis.KLL_RANK_ERROR and abs(row.fast - 0.75) <= kpis.KLL_RANK_ERROR
