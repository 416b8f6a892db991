"""DuckDB oracle SQL for every registered query (the driver's correctness gate).

The retail feeds are rebuilt from the driver tables with plain SQL CTEs, then each model is
restated in warehouse SQL. Every
output column is cast to the type the Spark query returns so values hash identically.
"""

from __future__ import annotations

M = "DECIMAL(18,2)"
N = "DECIMAL(38,9)"
BASE_TS = "TIMESTAMP '1992-01-01 00:00:00'"


def m(x: str) -> str:
    return f"CAST({x} AS {M})"


def num_div(a: str, b: str, scale: int = 9) -> str:
    """Exact NUMERIC safe_divide rounded half away from zero to ``scale`` digits.

    DuckDB turns DECIMAL / DECIMAL into DOUBLE, so the quotient is computed on integers
    (HUGEINT) instead: q = sign * ((2*|A|*10^s + |B|) // (2*|B|)) with A, B in units of 1e-9.
    """
    ua = f"CAST(CAST({a} AS {N}) * 1000000000 AS HUGEINT)"
    ub = f"CAST(CAST({b} AS {N}) * 1000000000 AS HUGEINT)"
    p = 10 ** scale
    q = (f"(sign({ua}) * sign({ub}) * ((2 * abs({ua}) * {p} + abs({ub})) // (2 * abs({ub}))))")
    # q is in units of 10^-scale: render sign, integer part and zero-padded fraction, then cast.
    text = (f"CAST(CASE WHEN {ub} = 0 OR {ub} IS NULL OR {ua} IS NULL THEN NULL ELSE "
            f"(CASE WHEN {q} < 0 THEN '-' ELSE '' END) || CAST(abs({q}) // {p} AS VARCHAR) || '.' || "
            f"lpad(CAST(abs({q}) % {p} AS VARCHAR), {scale}, '0') END AS {N})")
    return text


def flt_div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / CAST(NULLIF({b}, 0) AS DOUBLE))"


def dow(x: str) -> str:
    return f"(dayofweek({x}) + 1)"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def pick(key: str, mapping: dict, default) -> str:
    parts = " ".join(f"WHEN {key} = {k} THEN {_lit(v)}" for k, v in mapping.items())
    return f"(CASE {parts} ELSE {_lit(default)} END)"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str) and not v.startswith("@"):
        return "'" + v.replace("'", "''") + "'"
    return str(v)[1:] if isinstance(v, str) else str(v)


def cycle(key: str, values: list) -> str:
    return pick(f"({key}) % {len(values)}", dict(enumerate(values[:-1])), values[-1])


# --------------------------------------------------------------------------- raw feeds
_LINE_ORDER = ("l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, "
               "l_discount, l_tax, l_returnflag, l_linestatus")
WAREHOUSES = [" wh-east", "WH-West ", "Wh-Central"]

FEEDS: dict[str, tuple[list[str], str]] = {}

_UNIT = m("l_extendedprice")
_DISC = m(f"{_UNIT} * {m('l_discount')}")
FEEDS["raw_order_items"] = ([], f"""
  SELECT (l_orderkey * (SELECT CAST(pow(10, length(CAST(max(n) AS VARCHAR))) AS BIGINT)
                        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber))
          + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}))
           * (SELECT CAST(pow(10, length(CAST(max(l_linenumber) AS VARCHAR))) AS BIGINT) FROM lineitem) + l_linenumber AS id,
         l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         {m('l_extendedprice')} AS unit_price,
         {_DISC} AS discount_amount, {m(f"{_UNIT} - {_DISC}")} AS total_price,
         CAST(l_shipdate AS TIMESTAMP) AS created_at, CAST(l_shipdate AS TIMESTAMP) AS updated_at
  FROM lineitem""")

_status = (f"CASE WHEN o_orderstatus = 'F' THEN {pick('o_orderkey % 10', {0: ' Returned', 1: 'CANCELLED'}, 'Delivered')}"
           f" WHEN o_orderstatus = 'O' THEN {pick('o_orderkey % 3', {0: 'pending', 1: 'confirmed', 2: 'Processing'}, None)}"
           f" WHEN o_orderstatus = 'P' THEN 'shipped' END")
FEEDS["raw_orders"] = (["raw_order_items"], f"""
  SELECT id, order_number, customer_id, status, subtotal, discount_amount, tax_amount, shipping_amount,
         {m('subtotal - discount_amount + tax_amount + shipping_amount + CASE WHEN id % 97 = 0 THEN ' + m('1') + ' ELSE ' + m('0') + ' END')} AS total_amount,
         shipping_address_line1, shipping_address_line2, shipping_city, shipping_state, shipping_postal_code,
         shipping_country, notes, created_at, updated_at
  FROM (
    SELECT *, {m('(subtotal - discount_amount) * CAST(0.08 AS DECIMAL(3,2))')} AS tax_amount
    FROM (
      SELECT *, CASE WHEN id % 4 = 0 THEN {m('subtotal * CAST(0.05 AS DECIMAL(3,2))')} ELSE {m('0')} END AS discount_amount
      FROM (
        SELECT o_orderkey AS id, '  ORD-' || CAST(o_orderkey AS VARCHAR) AS order_number, o_custkey AS customer_id,
               {_status} AS status,
               {m(f"coalesce(s._items, {m('0')}) + CASE WHEN o_orderkey % 50 = 0 THEN {m('1')} ELSE {m('0')} END")} AS subtotal,
               CAST(CASE o_orderkey % 3 WHEN 0 THEN {m('0')} WHEN 1 THEN CAST(5.99 AS DECIMAL(3,2)) ELSE CAST(9.99 AS DECIMAL(3,2)) END AS {M}) AS shipping_amount,
               CAST(o_orderkey AS VARCHAR) || ' Main St ' AS shipping_address_line1,
               CAST(NULL AS VARCHAR) AS shipping_address_line2,
               ' City ' || CAST(o_custkey % 50 AS VARCHAR) AS shipping_city,
               ' st' || CAST(o_orderkey % 7 AS VARCHAR) || ' ' AS shipping_state,
               lpad(CAST(o_custkey % 99999 AS VARCHAR), 5, '0') AS shipping_postal_code,
               'us ' AS shipping_country, o_orderpriority AS notes,
               CAST(o_orderdate AS TIMESTAMP) AS created_at, CAST(o_orderdate AS TIMESTAMP) AS updated_at
        FROM orders LEFT JOIN (SELECT order_id, sum(total_price) AS _items FROM raw_order_items GROUP BY order_id) s
          ON o_orderkey = s.order_id)))""")

FEEDS["raw_payments"] = ([], f"""
  SELECT o_orderkey AS id, o_orderkey AS order_id,
         {cycle('o_orderkey', ['credit_card', 'debit_card', 'PayPal', 'apple_pay', 'google_pay'])} AS payment_method,
         {pick('o_orderkey % 10', {0: 'refunded', 1: 'failed', 2: 'pending'}, 'Completed')} AS payment_status,
         {m('o_totalprice')} AS amount, 'txn_' || CAST(o_orderkey AS VARCHAR) AS transaction_id,
         CAST(o_orderdate AS TIMESTAMP) AS created_at, CAST(o_orderdate AS TIMESTAMP) AS updated_at
  FROM orders""")

FEEDS["raw_refunds"] = (["raw_order_items"], f"""
  SELECT id, order_id, order_id AS payment_id, id AS order_item_id,
         {cycle('id', ['damaged', 'Changed_Mind', 'size_issue'])} AS reason,
         {pick('id % 4', {0: 'rejected', 1: 'pending'}, 'Processed')} AS status,
         total_price AS amount, CASE WHEN id % 2 = 0 THEN 'customer note' END AS notes, created_at, updated_at
  FROM raw_order_items WHERE id % 7 = 0""")

FEEDS["raw_customers"] = ([], f"""
  SELECT c_custkey AS id, ' ' || c_name || '@Example.COM ' AS email, ' ' || c_mktsegment AS first_name,
         CASE WHEN c_custkey % 50 <> 0 THEN c_name END AS last_name,
         CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS date_of_birth, CAST(NULL AS VARCHAR) AS gender,
         CAST(NULL AS VARCHAR) AS address_line1, CAST(NULL AS VARCHAR) AS address_line2,
         n_name AS city, r_name AS state, CAST(NULL AS VARCHAR) AS postal_code, 'us' AS country,
         c_acctbal >= 0 AS is_active, {BASE_TS} AS created_at, {BASE_TS} AS updated_at
  FROM customer LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey) g
    ON c_nationkey = g.n_nationkey""")

_price = f"CASE WHEN p_partkey % 500 = 0 THEN {m('0')} ELSE {m('p_retailprice')} END"
FEEDS["raw_products"] = ([], f"""
  SELECT p_partkey AS id, 'sku-' || CAST(p_partkey AS VARCHAR) || ' ' AS sku, p_name AS name, p_type AS description,
         CAST(p_size % 10 AS BIGINT) AS category_id, p_brand AS brand, {_price} AS price,
         {m(f'({_price}) * CAST(0.45 AS DECIMAL(3,2))')} AS cost_price,
         ' ' || CAST(p_size AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS color, CAST(NULL AS VARCHAR) AS material,
         CAST(p_size * 4 AS INTEGER) AS stock_quantity, p_partkey % 20 <> 0 AS is_active,
         {BASE_TS} AS created_at, {BASE_TS} AS updated_at
  FROM part""")

FEEDS["raw_campaigns"] = ([], f"""
  SELECT CAST(r_regionkey AS BIGINT) AS id, ' Campaign ' || r_name || ' ' AS name,
         CASE WHEN r_regionkey % 2 = 0 THEN 'Google_Ads' ELSE 'meta_ads' END AS platform,
         {cycle('r_regionkey', ['Conversions', 'traffic', 'awareness'])} AS objective, ' ACTIVE' AS status,
         {m('100 + r_regionkey * 25')} AS daily_budget, {m('3000 + r_regionkey * 750')} AS total_budget,
         '1992-01-01' AS start_date, CAST(NULL AS VARCHAR) AS end_date, {BASE_TS} AS created_at, {BASE_TS} AS updated_at
  FROM region""")

FEEDS["raw_ad_sets"] = ([], f"""
  SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_regionkey AS BIGINT) AS campaign_id, n_name || ' set ' AS name,
         {cycle('n_nationkey', ['all', 'female', 'male'])} AS targeting_gender,
         CAST(18 + n_nationkey % 10 AS INTEGER) AS targeting_age_min, CAST(45 + n_nationkey % 20 AS INTEGER) AS targeting_age_max,
         'fashion,shoes' AS targeting_interests, {m('20 + n_nationkey')} AS daily_budget,
         ' Lowest_Cost' AS bid_strategy, 'active' AS status, {BASE_TS} AS created_at, {BASE_TS} AS updated_at
  FROM nation""")

FEEDS["raw_ads"] = ([], f"""
  SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS ad_set_id, s_name AS name,
         {cycle('s_suppkey', ['image', ' Video ', 'carousel'])} AS ad_type, 'Deal ' || CAST(s_suppkey AS VARCHAR) AS headline,
         CAST(NULL AS VARCHAR) AS description, ' Shop_Now' AS call_to_action,
         'https://shop.example/s/' || CAST(s_suppkey AS VARCHAR) || ' ' AS destination_url,
         CASE WHEN s_suppkey % 10 = 0 THEN 'paused' ELSE 'ACTIVE' END AS status,
         {BASE_TS} AS created_at, {BASE_TS} AS updated_at
  FROM supplier""")

FEEDS["raw_daily_performance"] = ([], f"""
  SELECT l_suppkey * 100000 + (year(d) - 1990) * 400 + dayofyear(d) AS id, l_suppkey AS ad_id,
         strftime(d, '%Y-%m-%d') AS date, CAST(q * 40 AS INTEGER) AS impressions,
         CAST(CASE WHEN l_suppkey % 20 = 0 THEN 0 ELSE q END AS INTEGER) AS clicks,
         CASE WHEN l_suppkey % 25 = 0 THEN {m('0')} ELSE {m('p * CAST(0.01 AS DECIMAL(3,2))')} END AS spend,
         CASE WHEN l_suppkey % 20 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(31250 + l_suppkey % 7 * 1171 AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS ctr,
         CASE WHEN l_suppkey % 20 <> 0 THEN CAST(p AS DOUBLE) / CAST(10000 AS DOUBLE) END AS cpc,
         CAST(n AS INTEGER) AS purchases, {m('pn * CAST(0.02 AS DECIMAL(3,2))')} AS revenue,
         CAST(d AS TIMESTAMP) AS created_at, CAST(d AS TIMESTAMP) AS updated_at
  FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS q, sum({m('l_extendedprice')}) AS p,
               count_if(l_returnflag = 'N') AS n,
               sum(CASE WHEN l_returnflag = 'N' THEN {m('l_extendedprice')} ELSE {m('0')} END) AS pn
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE))""")

FEEDS["raw_inventory_snapshots"] = ([], f"""
  SELECT p_partkey * 1000 + k AS id, p_partkey AS product_id, strftime(DATE '1998-01-05' + CAST(k * 7 AS INTEGER), '%Y-%m-%d') AS snapshot_date,
         CAST(p_size * 4 + k AS INTEGER) AS quantity_on_hand, CAST(p_size % 3 AS INTEGER) AS quantity_reserved,
         CAST(p_size * 4 + k - p_size % 3 AS INTEGER) AS quantity_available,
         {m(f"{m('p_retailprice')} * CAST(0.45 AS DECIMAL(3,2))")} AS unit_cost,
         {m(f"CAST(p_size * 4 + k AS INTEGER) * {m('p_retailprice')}")} AS total_value,
         {cycle('p_partkey', WAREHOUSES)} AS warehouse_location,
         CAST(DATE '1998-01-05' + CAST(k * 7 AS INTEGER) AS TIMESTAMP) AS created_at,
         CAST(DATE '1998-01-05' + CAST(k * 7 AS INTEGER) AS TIMESTAMP) AS updated_at
  FROM (SELECT p_partkey, p_size, p_retailprice, unnest(range(0, 4)) AS k FROM part)""")

_qty = "CAST(CASE WHEN id % 5 IN (1, 3) THEN -quantity ELSE quantity END AS INTEGER)"
FEEDS["raw_inventory_movements"] = (["raw_order_items"], f"""
  SELECT id, product_id, {cycle('id', ['Purchase', 'sale', 'return', 'damage', 'adjustment'])} AS movement_type,
         {_qty} AS quantity, {m('unit_price * CAST(0.45 AS DECIMAL(3,2))')} AS unit_cost,
         {m(m('unit_price * CAST(0.45 AS DECIMAL(3,2))') + ' * ' + _qty)} AS total_cost,
         ' ORD-' || CAST(order_id AS VARCHAR) AS reference_id, {cycle('order_id', WAREHOUSES)} AS warehouse_location,
         CAST(NULL AS VARCHAR) AS notes, strftime(created_at, '%Y-%m-%d') AS movement_date, created_at, updated_at
  FROM raw_order_items""")

FEEDS["raw_change_feed"] = ([], """
  SELECT user_id AS id, event_type AS status, value AS amount, event_id,
         CAST(ts AS TIMESTAMP) AS created_at, CAST(ts AS TIMESTAMP) AS updated_at
  FROM events""")

# Three extracts of products for the SCD2 snapshot: v2 re-prices id % 10 = 0, v3 drops id % 100 = 3
# and adds new ids (-id for id % 100 = 7).
FEEDS["raw_products_v2"] = (["raw_products"], f"""
  SELECT * REPLACE (CASE WHEN id % 10 = 0 THEN {m('price * CAST(1.1 AS DECIMAL(2,1))')} ELSE price END AS price)
  FROM raw_products""")
FEEDS["raw_products_v3"] = (["raw_products", "raw_products_v2"], """
  SELECT * FROM raw_products_v2 WHERE id % 100 <> 3
  UNION ALL
  SELECT * REPLACE (-id AS id, 'sku-n' || CAST(-id AS VARCHAR) AS sku)
  FROM raw_products WHERE id % 100 = 7""")

# --------------------------------------------------------------------------- staging
STG: dict[str, tuple[list[str], str]] = {}
STG["stg_customers"] = (["raw_customers"], f"""
  SELECT id AS customer_id, lower({trim('email')}) AS email, {trim('first_name')} AS first_name, {trim('last_name')} AS last_name,
         {trim('first_name')} || ' ' || {trim('last_name')} AS full_name, phone, date_of_birth, gender,
         {trim('address_line1')} AS address_line1, {trim('address_line2')} AS address_line2, {trim('city')} AS city,
         upper({trim('state')}) AS state, {trim('postal_code')} AS postal_code, upper({trim('country')}) AS country,
         is_active, created_at, updated_at
  FROM raw_customers""")
STG["stg_products"] = (["raw_products"], f"""
  SELECT id AS product_id, upper({trim('sku')}) AS sku, {trim('name')} AS product_name, description AS product_description,
         category_id, {trim('brand')} AS brand, CAST(price AS {N}) AS price, CAST(cost_price AS {N}) AS cost_price,
         {num_div('price - cost_price', 'price', 4)} AS gross_margin,
         {trim('size')} AS size, {trim('color')} AS color, {trim('material')} AS material,
         stock_quantity, is_active, created_at, updated_at
  FROM raw_products""")
STG["stg_orders"] = (["raw_orders"], f"""
  SELECT id AS order_id, {trim('order_number')} AS order_number, customer_id, lower({trim('status')}) AS order_status,
         CAST(subtotal AS {N}) AS subtotal, CAST(discount_amount AS {N}) AS discount_amount,
         CAST(tax_amount AS {N}) AS tax_amount, CAST(shipping_amount AS {N}) AS shipping_amount,
         CAST(total_amount AS {N}) AS total_amount,
         {trim('shipping_address_line1')} AS shipping_address_line1, {trim('shipping_address_line2')} AS shipping_address_line2,
         {trim('shipping_city')} AS shipping_city, upper({trim('shipping_state')}) AS shipping_state,
         {trim('shipping_postal_code')} AS shipping_postal_code, upper({trim('shipping_country')}) AS shipping_country,
         notes, created_at AS ordered_at, updated_at
  FROM raw_orders""")
STG["stg_order_items"] = (["raw_order_items"], f"""
  SELECT id AS order_item_id, order_id, product_id, quantity, CAST(unit_price AS {N}) AS unit_price,
         CAST(discount_amount AS {N}) AS item_discount_amount, CAST(total_price AS {N}) AS item_total, created_at, updated_at
  FROM raw_order_items""")
STG["stg_payments"] = (["raw_payments"], f"""
  SELECT id AS payment_id, order_id, lower({trim('payment_method')}) AS payment_method,
         lower({trim('payment_status')}) AS payment_status, CAST(amount AS {N}) AS payment_amount,
         {trim('transaction_id')} AS transaction_id, created_at AS paid_at, updated_at
  FROM raw_payments""")
STG["stg_refunds"] = (["raw_refunds"], f"""
  SELECT id AS refund_id, order_id, payment_id, order_item_id, lower({trim('reason')}) AS refund_reason,
         lower({trim('status')}) AS refund_status, CAST(amount AS {N}) AS refund_amount, notes AS refund_notes,
         created_at AS refunded_at, updated_at
  FROM raw_refunds""")
STG["stg_campaigns"] = (["raw_campaigns"], f"""
  SELECT id AS campaign_id, {trim('name')} AS campaign_name, lower({trim('platform')}) AS platform,
         lower({trim('objective')}) AS objective, lower({trim('status')}) AS campaign_status,
         CAST(daily_budget AS {N}) AS daily_budget, CAST(total_budget AS {N}) AS total_budget,
         CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date, created_at, updated_at
  FROM raw_campaigns""")
STG["stg_ad_sets"] = (["raw_ad_sets"], f"""
  SELECT id AS ad_set_id, campaign_id, {trim('name')} AS ad_set_name, targeting_gender, targeting_age_min,
         targeting_age_max, targeting_interests, CAST(daily_budget AS {N}) AS daily_budget,
         lower({trim('bid_strategy')}) AS bid_strategy, lower({trim('status')}) AS ad_set_status, created_at, updated_at
  FROM raw_ad_sets""")
STG["stg_ads"] = (["raw_ads"], f"""
  SELECT id AS ad_id, ad_set_id, {trim('name')} AS ad_name, lower({trim('ad_type')}) AS ad_type,
         {trim('headline')} AS headline, description AS ad_description, lower({trim('call_to_action')}) AS call_to_action,
         {trim('destination_url')} AS destination_url, lower({trim('status')}) AS ad_status, created_at, updated_at
  FROM raw_ads""")
STG["stg_daily_performance"] = (["raw_daily_performance"], f"""
  SELECT id AS performance_id, ad_id, CAST(date AS DATE) AS performance_date, impressions, clicks,
         CAST(spend AS {N}) AS spend, CAST(ctr AS {N}) AS ctr, CAST(cpc AS {N}) AS cpc, purchases,
         CAST(revenue AS {N}) AS revenue, created_at, updated_at
  FROM raw_daily_performance""")
STG["stg_inventory_snapshots"] = (["raw_inventory_snapshots"], f"""
  SELECT id AS snapshot_id, product_id, CAST(snapshot_date AS DATE) AS snapshot_date, quantity_on_hand,
         quantity_reserved, quantity_available, CAST(unit_cost AS {N}) AS unit_cost,
         CAST(total_value AS {N}) AS total_value, upper({trim('warehouse_location')}) AS warehouse_location,
         created_at, updated_at
  FROM raw_inventory_snapshots""")
STG["stg_inventory_movements"] = (["raw_inventory_movements"], f"""
  SELECT id AS movement_id, product_id, lower({trim('movement_type')}) AS movement_type, quantity,
         CAST(unit_cost AS {N}) AS unit_cost, CAST(total_cost AS {N}) AS total_cost, {trim('reference_id')} AS reference_id,
         upper({trim('warehouse_location')}) AS warehouse_location, notes, CAST(movement_date AS DATE) AS movement_date,
         created_at, updated_at
  FROM raw_inventory_movements""")

# --------------------------------------------------------------------------- marts
MART: dict[str, tuple[list[str], str]] = {}
MART["fct_orders"] = (["stg_orders", "stg_customers", "stg_order_items", "stg_payments", "stg_refunds"], f"""
  SELECT o.order_id, o.order_number, o.ordered_at, o.updated_at AS order_updated_at, o.customer_id,
         c.full_name AS customer_name, c.email AS customer_email, c.city AS customer_city, c.state AS customer_state,
         c.country AS customer_country, o.order_status,
         CASE WHEN o.order_status = 'delivered' THEN 'completed'
              WHEN o.order_status IN ('cancelled', 'returned') THEN 'closed'
              WHEN o.order_status = 'pending' THEN 'open' ELSE 'in_progress' END AS order_status_category,
         CAST(coalesce(oi.item_count, 0) AS BIGINT) AS item_count,
         CAST(coalesce(oi.total_quantity, 0) AS BIGINT) AS total_quantity,
         CAST(o.subtotal AS {N}) AS subtotal, CAST(o.discount_amount AS {N}) AS order_discount_amount,
         CAST(coalesce(oi.items_discount_total, 0) AS {N}) AS item_discount_amount,
         CAST(o.discount_amount + coalesce(oi.items_discount_total, 0) AS {N}) AS total_discount_amount,
         CAST(o.tax_amount AS {N}) AS tax_amount, CAST(o.shipping_amount AS {N}) AS shipping_amount,
         CAST(o.total_amount AS {N}) AS order_total,
         p.payment_method, p.payment_status, CAST(p.payment_amount AS {N}) AS payment_amount, p.paid_at,
         CAST(coalesce(r.refund_count, 0) AS BIGINT) AS refund_count,
         CAST(coalesce(r.total_refund_amount, 0) AS {N}) AS refund_amount,
         CASE WHEN r.refund_count > 0 THEN true ELSE false END AS has_refund,
         CAST(o.total_amount - coalesce(r.total_refund_amount, 0) AS {N}) AS net_revenue,
         o.shipping_city, o.shipping_state, o.shipping_country,
         CAST(o.ordered_at AS DATE) AS order_date, CAST(year(o.ordered_at) AS INTEGER) AS order_year,
         CAST(month(o.ordered_at) AS INTEGER) AS order_month, CAST({dow('o.ordered_at')} AS INTEGER) AS order_day_of_week
  FROM stg_orders o
  LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
  LEFT JOIN (SELECT order_id, count(*) AS item_count, sum(quantity) AS total_quantity,
                    sum(item_total) AS items_subtotal, sum(item_discount_amount) AS items_discount_total
             FROM stg_order_items GROUP BY order_id) oi ON o.order_id = oi.order_id
  LEFT JOIN stg_payments p ON o.order_id = p.order_id
  LEFT JOIN (SELECT order_id, count(*) AS refund_count, sum(refund_amount) AS total_refund_amount
             FROM stg_refunds GROUP BY order_id) r ON o.order_id = r.order_id""")

MART["fct_daily_marketing_performance"] = (["stg_daily_performance", "stg_ads", "stg_ad_sets", "stg_campaigns"], f"""
  SELECT dp.performance_id, dp.performance_date, c.campaign_id, c.campaign_name, c.platform, c.objective,
         c.campaign_status, ast.ad_set_id, ast.ad_set_name, ast.bid_strategy, ast.targeting_gender,
         ast.targeting_age_min, ast.targeting_age_max, a.ad_id, a.ad_name, a.ad_type, a.call_to_action, a.ad_status,
         dp.impressions, dp.clicks, dp.spend, dp.ctr, dp.cpc, dp.purchases, dp.revenue,
         {num_div('dp.revenue', 'dp.spend')} AS roas,
         {num_div('dp.spend', 'NULLIF(dp.purchases, 0)')} AS cost_per_acquisition,
         {flt_div('dp.purchases', 'dp.clicks')} AS conversion_rate,
         CAST(year(dp.performance_date) AS INTEGER) AS year, CAST(month(dp.performance_date) AS INTEGER) AS month,
         CAST({dow('dp.performance_date')} AS INTEGER) AS day_of_week
  FROM stg_daily_performance dp
  LEFT JOIN stg_ads a ON dp.ad_id = a.ad_id
  LEFT JOIN stg_ad_sets ast ON a.ad_set_id = ast.ad_set_id
  LEFT JOIN stg_campaigns c ON ast.campaign_id = c.campaign_id""")

RUN_TS = "TIMESTAMP '2024-01-01 00:00:00'"

MART["recon_orders_vs_items"] = (["stg_orders", "stg_order_items"], f"""
  SELECT o.order_id, CAST(o.subtotal AS {N}) AS order_subtotal,
         CAST(coalesce(i.items_subtotal, 0) AS {N}) AS items_subtotal,
         CAST(round(o.subtotal - coalesce(i.items_subtotal, 0), 2) AS {N}) AS discrepancy,
         CASE WHEN abs(o.subtotal - coalesce(i.items_subtotal, 0)) <= 0.02 THEN 'matched' ELSE 'discrepancy' END AS status,
         {RUN_TS} AS reconciled_at
  FROM stg_orders o
  LEFT JOIN (SELECT order_id, sum(item_total) AS items_subtotal FROM stg_order_items GROUP BY order_id) i
    ON o.order_id = i.order_id""")

MART["recon_payments_vs_refunds"] = (["stg_payments", "stg_refunds"], f"""
  SELECT p.order_id, CAST(p.total_paid AS {N}) AS total_paid, CAST(coalesce(r.total_refunded, 0) AS {N}) AS total_refunded,
         CAST(p.total_paid - coalesce(r.total_refunded, 0) AS {N}) AS net_collected,
         CASE WHEN coalesce(r.total_refunded, 0) > p.total_paid THEN 'over_refunded'
              WHEN coalesce(r.total_refunded, 0) > 0 THEN 'partially_refunded' ELSE 'no_refund' END AS refund_status,
         {RUN_TS} AS reconciled_at
  FROM (SELECT order_id, sum(payment_amount) AS total_paid FROM stg_payments
        WHERE payment_status = 'completed' OR payment_status = 'refunded' GROUP BY order_id) p
  LEFT JOIN (SELECT order_id, sum(refund_amount) AS total_refunded FROM stg_refunds
             WHERE refund_status = 'processed' GROUP BY order_id) r ON p.order_id = r.order_id""")

_roas = num_div("total_revenue", "total_spend")
MART["recon_marketing_spend_vs_revenue"] = (["fct_daily_marketing_performance"], f"""
  SELECT platform, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
         CAST(total_spend AS {N}) AS total_spend, CAST(total_revenue AS {N}) AS total_revenue,
         CAST(total_impressions AS BIGINT) AS total_impressions, CAST(total_clicks AS BIGINT) AS total_clicks,
         CAST(total_purchases AS BIGINT) AS total_purchases,
         {_roas} AS roas, {num_div('total_spend', 'NULLIF(total_purchases, 0)')} AS cpa,
         {flt_div('total_clicks', 'total_impressions')} AS avg_ctr,
         CASE WHEN {_roas} >= 3.0 THEN 'profitable' WHEN {_roas} >= 1.0 THEN 'break_even' ELSE 'unprofitable' END
           AS profitability_status,
         {RUN_TS} AS reconciled_at
  FROM (SELECT platform, year(performance_date) AS year, month(performance_date) AS month,
               sum(spend) AS total_spend, sum(revenue) AS total_revenue, sum(impressions) AS total_impressions,
               sum(clicks) AS total_clicks, sum(purchases) AS total_purchases
        FROM fct_daily_marketing_performance GROUP BY ALL)""")

VIEWS: dict[str, tuple[list[str], str]] = {**FEEDS, **STG, **MART}


def with_views(body: str, needs: list[str]) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first, each once)."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in VIEWS[name][0]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}"


def view_sql(name: str) -> str:
    return with_views(f"SELECT * FROM {name}", [name])


# --------------------------------------------------------------------------- declared suites (fixed values)
# Data tests, written out: "model.column" for tests of one column, "-> parent.column" for relationships.
UNIQUE_AND_NOT_NULL = """customers.id customers.email products.id products.sku orders.id orders.order_number order_items.id
payments.id payments.transaction_id refunds.id
stg_customers.customer_id stg_customers.email stg_products.product_id stg_products.sku stg_orders.order_id stg_orders.order_number
stg_order_items.order_item_id stg_payments.payment_id stg_payments.transaction_id stg_refunds.refund_id
campaigns.id ad_sets.id ads.id daily_performance.id
stg_campaigns.campaign_id stg_ad_sets.ad_set_id stg_ads.ad_id stg_daily_performance.performance_id
inventory_snapshots.id inventory_movements.id stg_inventory_snapshots.snapshot_id stg_inventory_movements.movement_id
fct_orders.order_id fct_orders.order_number fct_daily_marketing_performance.performance_id
recon_orders_vs_items.order_id recon_payments_vs_refunds.order_id""".split()
NOT_NULL = """orders.customer_id order_items.order_id order_items.product_id payments.order_id refunds.order_id refunds.payment_id
stg_orders.customer_id stg_order_items.order_id stg_order_items.product_id stg_payments.order_id stg_refunds.order_id
stg_refunds.payment_id ad_sets.campaign_id ads.ad_set_id daily_performance.ad_id inventory_snapshots.product_id
inventory_movements.product_id fct_orders.customer_id fct_orders.order_total fct_orders.order_date
fct_daily_marketing_performance.campaign_id fct_daily_marketing_performance.ad_id
fct_daily_marketing_performance.performance_date""".split()
RELATIONSHIPS = """orders.customer_id -> customers.id
order_items.order_id -> orders.id
order_items.product_id -> products.id
payments.order_id -> orders.id
refunds.order_id -> orders.id
refunds.payment_id -> payments.id""".splitlines()
ORDER_STATUSES = "'pending', 'confirmed', 'processing', 'shipped', 'delivered', 'cancelled', 'returned'"
PAYMENT_STATUSES = "'pending', 'completed', 'failed', 'refunded'"
# (name, model, column, kind, failing rows)
OTHER_TESTS = [
    ("accepted_values_fct_orders_order_status", "fct_orders", "order_status", "accepted_values", f"order_status NOT IN ({ORDER_STATUSES})"),
    ("assert_net_revenue_not_exceeds_total", "fct_orders", None, "net_revenue_not_exceeds_total", "net_revenue > order_total + 0.01"),
    ("assert_order_total_matches_components", "fct_orders", None, "order_total_matches_components",
     "abs(order_total - round(subtotal - order_discount_amount + tax_amount + shipping_amount, 2)) > 0.02"),
    ("assert_roas_not_negative", "fct_daily_marketing_performance", None, "roas_not_negative", "spend > 0 AND revenue > 0 AND roas < 0"),
]
GENERIC_TESTS = [
    ("positive_value_fct_orders_order_total", "fct_orders", "order_total", "positive_value", "order_total < 0"),
    ("positive_value_stg_inventory_movements_quantity", "stg_inventory_movements", "quantity", "positive_value", "quantity < 0"),
    ("value_in_range_stg_products_gross_margin", "stg_products", "gross_margin", "value_in_range", "gross_margin < 0 OR gross_margin > 1"),
]


def view_of(name: str) -> str:
    """The oracle's view of a model or raw table."""
    return f"raw_{name}" if f"raw_{name}" in FEEDS else name


def data_tests() -> list[tuple[str, str, str | None, str, str]]:
    """(name, model, column, kind, SQL of the failing rows) of every declared test."""
    out = []
    for x in UNIQUE_AND_NOT_NULL:
        m_, c = x.split(".")
        out.append((f"unique_{m_}_{c}", m_, c, "unique",
                    f"SELECT {c} FROM {view_of(m_)} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"))
    for x in UNIQUE_AND_NOT_NULL + NOT_NULL:
        m_, c = x.split(".")
        out.append((f"not_null_{m_}_{c}", m_, c, "not_null", f"SELECT 1 FROM {view_of(m_)} WHERE {c} IS NULL"))
    for x in RELATIONSHIPS:
        (m_, c), (p, k) = (y.split(".") for y in x.split(" -> "))
        out.append((f"relationships_{m_}_{c}__{k}__{p}", m_, c, "relationships",
                    f"SELECT 1 FROM {view_of(m_)} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                    f"(SELECT 1 FROM {view_of(p)} pa WHERE pa.{k} = ch.{c})"))
    for name, m_, c, kind, bad in OTHER_TESTS + GENERIC_TESTS:
        out.append((name, m_, c, kind, f"SELECT 1 FROM {view_of(m_)} WHERE {bad}"))
    return out


# Mandatory columns of the raw tables, their foreign keys, the tables of each layer, data columns.
RAW_NOT_NULL = {
    "customers": "id email first_name last_name country created_at updated_at",
    "products": "id sku name category_id brand price cost_price created_at updated_at",
    "orders": "id order_number customer_id status total_amount created_at updated_at",
    "order_items": "id order_id product_id quantity unit_price total_price created_at updated_at",
    "payments": "id order_id payment_method payment_status amount transaction_id created_at updated_at",
    "refunds": "id order_id payment_id reason status amount created_at updated_at",
}
RAW_FOREIGN_KEYS = """orders.customer_id -> customers.id
order_items.order_id -> orders.id
order_items.product_id -> products.id
payments.order_id -> orders.id
refunds.order_id -> orders.id
refunds.payment_id -> payments.id""".splitlines()
RAW_TABLES = ["customers", "products", "orders", "order_items", "payments", "refunds", "campaigns", "ad_sets", "ads", "daily_performance",
              "inventory_snapshots", "inventory_movements"]
MARTS = ["fct_orders", "fct_daily_marketing_performance", "recon_orders_vs_items", "recon_payments_vs_refunds",
         "recon_marketing_spend_vs_revenue"]
LAYERS = {
    "commerce": "customers products orders order_items payments refunds",
    "marketing": "campaigns ad_sets ads daily_performance",
    "inventory": "inventory_snapshots inventory_movements",
    "marts": "fct_orders fct_daily_marketing_performance",
}
RAW_DATA_COLUMNS = {"customers": 16, "products": 15, "orders": 18, "order_items": 9, "payments": 8, "refunds": 10}
# Product history: tracked columns, and those that open a new version.
HISTORY_COLUMNS = ("product_id, sku, product_name, category_id, brand, price, cost_price, gross_margin, size, color, material, "
                   "stock_quantity, is_active, updated_at")
HISTORY_CHECKED = ["price", "cost_price", "category_id", "is_active", "stock_quantity"]
