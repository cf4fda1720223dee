"""Building blocks of the comparison SQL (DuckDB). Money is kept in whole cents."""

_LINES = """
lines AS (
  SELECT CAST(l_shipdate AS DATE) AS ship_day, s_nationkey, r_name, l_partkey, l_orderkey,
         l_partkey // 80 AS number, CAST(l_quantity AS BIGINT) AS q,
         CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS unit_c,
         CAST(round(l_discount * 100) AS BIGINT) AS disc, l_returnflag, l_suppkey % 4 AS w
  FROM lineitem
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey
)"""

_FLAT = """
daily AS (
  SELECT {day} AS full_date, s_nationkey, number, r_name AS region,
         CAST(SUM(q + l_partkey % 50) AS BIGINT) AS inventory_level,
         CAST(SUM(q) AS BIGINT) AS units_sold,
         CAST(SUM(l_orderkey % 90) AS BIGINT) AS units_ordered,
         CAST(SUM(q * (80 + l_orderkey % 41)) AS BIGINT) AS demand_c,
         MIN(unit_c) AS price_c, MAX(unit_c) AS competitor_c, MAX(disc) AS disc,
         BOOL_OR(l_returnflag = 'R') AS promo, MIN(w) AS w
  FROM lines GROUP BY 1, 2, 3, 4
),
flat AS (
  SELECT full_date, printf('S%03d', s_nationkey) AS store_id, printf('P%04d', number) AS product_id,
         'C' || CAST(number % 5 AS VARCHAR) AS category, region, inventory_level, units_sold,
         units_ordered, demand_c, price_c, competitor_c, disc, promo,
         CASE w WHEN 0 THEN 'Sunny' WHEN 1 THEN 'Rainy' WHEN 2 THEN 'Cloudy' ELSE 'Snowy' END AS weather,
         CASE WHEN month(full_date) IN (12, 1, 2) THEN 'Winter'
              WHEN month(full_date) IN (3, 4, 5) THEN 'Spring'
              WHEN month(full_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
  FROM daily
)"""

_FOLD = "DATE '1995-01-01' + CAST(date_diff('day', DATE '1995-01-01', ship_day) % 35 AS INTEGER)"

_SPLIT = """
facts AS (SELECT * FROM flat WHERE full_date <= DATE '1995-01-28'),
forecast AS (SELECT * FROM flat WHERE full_date > DATE '1995-01-28')"""

_OUTLOOK = """
today AS (SELECT * FROM facts WHERE full_date = (SELECT MAX(full_date) FROM facts)),
numbered AS (
  SELECT store_id, product_id, full_date AS forecasted_for, demand_c AS d,
         SUM(demand_c) OVER w AS rt, ROW_NUMBER() OVER w AS rn
  FROM forecast WINDOW w AS (PARTITION BY store_id, product_id ORDER BY full_date)
),
outlook AS (
  SELECT t.*, n.forecasted_for, n.d, n.rt, n.rn, 100 * (t.inventory_level + t.units_ordered) AS eff,
         100 * (t.inventory_level + t.units_ordered) < n.rt AS short
  FROM today t JOIN numbered n USING (store_id, product_id)
),
risk AS (
  SELECT full_date, store_id, region, product_id, category, inventory_level, units_ordered, price_c, eff,
         MIN(CASE WHEN short AND rn = 1 THEN 10 * ((20 * eff + d) // (2 * d))
                  WHEN short THEN 100 * (rn - 1) + 10 * ((20 * greatest(eff - rt + d, 0) + d) // (2 * d))
                  WHEN rn = 7 THEN 700 + (1400 * (eff - rt) + rt) // (2 * rt) END) AS dos_h,
         MAX(CASE WHEN rn = 1 THEN rt END) AS next_c, MAX(CASE WHEN rn = 4 THEN rt END) AS four_c
  FROM outlook GROUP BY ALL HAVING BOOL_OR(short OR rn = 7)
),
banded AS (
  SELECT *, CASE WHEN next_c > 100 * inventory_level THEN CASE WHEN dos_h < 100 THEN 1 ELSE 2 END
                 WHEN dos_h > 400 THEN 4 WHEN dos_h >= 200 THEN 5 WHEN dos_h >= 100 THEN 3 END AS band
  FROM risk
),
health AS (
  SELECT *,
         CASE band WHEN 1 THEN 'Critical' WHEN 2 THEN 'Critical' WHEN 3 THEN 'Low'
                   WHEN 5 THEN 'Healthy' WHEN 4 THEN 'Overstocked' END AS status,
         CASE WHEN band = 1 THEN 'Order more and delivery by tomorrow'
              WHEN band = 2 THEN 'Delivery by tomorrow' WHEN band = 3 THEN 'Order more'
              WHEN band = 4 AND units_ordered > 0 THEN 'Cancel existing order and apply discount'
              WHEN band = 4 THEN 'Apply discount' ELSE 'No action required' END AS action,
         greatest(next_c - 100 * inventory_level, 0) * price_c AS loss,
         CASE WHEN dos_h > 400 THEN (eff - four_c) * price_c ELSE 0 END AS locked
  FROM banded
)"""

# Label of each row with a tolerance in percent; sold units are in whole units.
FLAG = (
    "CASE WHEN 100 * demand_c - 10000 * units_sold > {pct} * 100 * units_sold THEN 'over-forecast' "
    "WHEN 10000 * units_sold - 100 * demand_c > {pct} * 100 * units_sold THEN 'under-forecast' "
    "ELSE 'accurate' END"
)


def flag(pct=10):
    return FLAG.format(pct=pct)


def cents(name, alias=None):
    """A cents column as a double amount."""
    return f"CAST({name} AS DOUBLE) / 100 AS {alias or name}"


def text(name="full_date"):
    return f"CAST({name} AS VARCHAR) AS {name}"


def big(expression, alias):
    return f"CAST({expression} AS BIGINT) AS {alias}"


def half_up(numerator, denominator, places):
    """Quotient of non-negative whole numbers rounded half up, as a double."""
    scale = 10**places
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(CAST(({2 * scale} * {n} + {d}) // (2 * {d}) AS DOUBLE) / {scale})"


def lines(body):
    return f"WITH {_LINES}\n{body}"


def long(body, *ctes):
    parts = [_LINES, _FLAT.format(day="ship_day"), *ctes]
    return f"WITH {','.join(parts)}\n{body}"


def folded(body, *ctes):
    parts = [_LINES, _FLAT.format(day=_FOLD), _SPLIT, *ctes]
    return f"WITH {','.join(parts)}\n{body}"


def outlook(body, *ctes):
    return folded(body, _OUTLOOK, *ctes)


def short_text(name="full_date"):
    return f"strftime({name}, '%d/%m/%y')"


def money_text(name):
    return f"printf('%d.%02d', {name} // 100, {name} % 100)"
