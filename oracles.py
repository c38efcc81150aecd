"""The registered queries in DuckDB SQL, written from the model definitions.

``CTES`` holds named steps; a query selects from one and gets the steps it needs in front.
"""

from __future__ import annotations

import re


def _gold(copper: str) -> str:
    return f"CAST(round(({copper}) / 100.0, 2) AS DECIMAL(18,2))"


def _mixed(text: str, key: str) -> str:
    return f"CASE WHEN {key} % 3 = 0 THEN upper({text}) WHEN {key} % 3 = 1 THEN ' ' || {text} || ' ' ELSE {text} END"


def _two_shapes(at: str, key: str) -> str:
    return (
        f"CASE WHEN {key} % 2 = 0 THEN replace(CAST({at} AS VARCHAR), ' ', 'T') || 'Z' "
        f"ELSE CAST({at} AS VARCHAR) END"
    )


def _day(first: str, offset: str) -> str:
    return f"CAST(DATE '{first}' + CAST({offset} AS INTEGER) AS VARCHAR)"


def _pick(index: str, values: list[str]) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"([{listed}])[CAST({index} AS INTEGER) + 1]"


# Fixed values in the SQL below: accepted spellings, statuses, channels, methods, regions and tiers.


def _boolean(text: str) -> str:
    return (
        f"CASE WHEN lower(trim({text})) IN ('y','yes','true','t','1') THEN true "
        f"WHEN lower(trim({text})) IN ('n','no','false','f','0') THEN false END"
    )


def _timestamp(text: str) -> str:
    return f"TRY_CAST(replace(replace({text}, 'T', ' '), 'Z', '') AS TIMESTAMP)"


def _four_places(numerator: str, denominator: str) -> str:
    """Half-up rounding of an integer ratio with a positive denominator, in integers."""
    n, d = f"({numerator})", f"({denominator})"
    return f"CASE WHEN {d} <> 0 THEN sign({n}) * ((abs({n}) * 20000 + {d}) // (2 * {d})) / 10000.0 END"


REGION_NAMES = ["Northern Reaches", "Crystal Vale", "The Marshlands", "Ember Coast", "Silverwood"]
REGION_CODES = ["NR", "CV", "ML", "EC", "SW"]
METHODS = ["coin", "guild_credit", "crystal_transfer", "barter"]
TIERS = ["apprentice", "adept", "archmage"]
TOKENS = ["Y", "n", " TRUE", "No", "1", "0", "t", "F ", "yes", "maybe"]
UNITS = ["gram", "vial", "dram", "pinch"]
CATEGORIES = ["economy", "large", "medium", "promo", "small", "standard"]

RAW: dict[str, str] = {
    "raw_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_custkey % 26 AS shop_id,
            CASE WHEN o_orderkey % 251 <> 0 THEN {_two_shapes(
                "(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)))", "o_orderkey")}
                ELSE 'n/a' END AS ordered_at,
            {_mixed('''(CASE WHEN o_orderstatus = 'F' THEN 'completed'
                WHEN o_orderstatus = 'P' THEN 'returned'
                WHEN o_orderkey % 4 = 0 THEN 'cancelled' ELSE 'placed' END)''', "o_orderkey")} AS status,
            {_mixed('''(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'courier_owl'
                WHEN o_orderpriority IN ('3-MEDIUM','4-NOT SPECIFIED') THEN 'in_store'
                ELSE 'marketplace' END)''', "o_orderkey")} AS channel,
            CASE WHEN o_orderkey % 37 <> 0
                THEN CAST(round(o_totalprice * 100) AS BIGINT) % 1000 END AS discount_copper
        FROM orders""",
    "raw_order_items": """
        SELECT l_orderkey || '-' || l_linenumber AS order_item_id, l_orderkey AS order_id,
            l_partkey AS potion_sku, CAST(l_quantity AS BIGINT) AS quantity,
            CAST(round(l_extendedprice * 100) AS BIGINT) AS unit_price_copper
        FROM lineitem""",
    "raw_payments": f"""
        SELECT event_id AS payment_id,
            CASE WHEN event_id % 4 = 0 THEN user_id ELSE event_id - event_id % 3 END AS order_id,
            {_mixed(_pick("event_id // 4 % 4", METHODS), "event_id")} AS method,
            {_mixed('''(CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'refunded'
                ELSE 'success' END)''', "event_id")} AS status,
            CAST(round(value * 100) AS BIGINT) AS amount_copper, ts AS paid_at
        FROM events""",
    "raw_potions": f"""
        SELECT p_partkey AS potion_sku, p_name AS potion_name,
            {_mixed("lower(p_type)", "p_partkey")} AS category,
            CASE WHEN p_partkey % 101 = 0 THEN 0
                ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS base_price_copper,
            p_size AS potency, 30 + (p_partkey % 12) * 30 AS shelf_life_days,
            {_pick("p_size % 10", TOKENS)} AS is_regulated,
            CASE WHEN p_partkey % 89 = 0 THEN '2024-13-05' WHEN p_partkey % 97 = 0 THEN '2024'
                ELSE {_day("2018-01-01", "p_partkey % 2500")} END AS introduced_at
        FROM part""",
    "raw_shops": f"""
        SELECT n_nationkey AS shop_id, 'Shop ' || n_name AS shop_name, r_name AS city,
            {_pick("r_regionkey", REGION_NAMES)} AS region,
            {_day("2010-01-01", "n_nationkey * 97")} AS opened_at
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_suppliers": f"""
        SELECT n_nationkey AS supplier_id, 'Supplier ' || n_name AS supplier_name,
            {_pick("n_regionkey", REGION_NAMES)} AS region, 1 + n_nationkey % 5 AS reliability_rating,
            CASE WHEN n_nationkey % 11 = 5 THEN 'unknown'
                ELSE {_day("2012-03-01", "n_nationkey * 61")} END AS contracted_since
        FROM nation""",
    "raw_ingredients": f"""
        SELECT s_suppkey AS ingredient_id, s_name AS ingredient_name, s_nationkey AS supplier_id,
            {_mixed(_pick("s_suppkey % 4", UNITS), "s_suppkey")} AS unit,
            CAST(round(abs(s_acctbal) * 100) AS BIGINT) AS unit_cost_copper,
            {_pick("s_suppkey % 10", TOKENS)} AS is_hazardous,
            {_mixed(_pick("s_suppkey % 3", ["spring", "summer", "autumn"]), "s_suppkey")} AS harvest_season
        FROM supplier""",
    "raw_recipes": f"""
        SELECT l_partkey AS potion_sku, l_suppkey AS ingredient_id,
            sum(CAST(l_quantity AS BIGINT)) AS quantity,
            {_mixed(_pick("l_suppkey % 4", UNITS), "l_suppkey")} AS unit
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "raw_brew_events": f"""
        SELECT event_id AS brew_id, user_id AS potion_sku, event_id % 25 AS shop_id,
            'CLD-' || (event_id % 7) AS cauldron_id, {_two_shapes("ts", "event_id")} AS brewed_at,
            1 + event_id % 20 AS batch_size,
            CASE WHEN event_id % 100 = 0 THEN NULL WHEN event_id % 100 = 50 THEN 0
                ELSE event_id % 100 END AS brew_duration_minutes,
            {_mixed('''(CASE WHEN event_type = 'error' THEN 'fail'
                WHEN event_type <> 'view' OR event_id % 10 <> 0 THEN 'pass' END)''', "event_id")} AS quality_check,
            'Brewer ' || (event_id % 13) AS brewer_name
        FROM events""",
    "raw_customers": f"""
        SELECT c_custkey AS customer_id, c_name AS full_name,
            CASE WHEN c_custkey % 50 = 0 THEN '  ' ELSE 'c' || c_custkey || '@example.org ' END AS email,
            CASE WHEN c_custkey % 97 = 0 THEN 'Far Isles'
                WHEN c_custkey % 4 = 0 THEN {_pick("n_regionkey", REGION_CODES)}
                WHEN c_custkey % 4 = 1 THEN lower({_pick("n_regionkey", REGION_CODES)})
                WHEN c_custkey % 4 = 2 THEN ' ' || {_pick("n_regionkey", REGION_NAMES)}
                ELSE lower({_pick("n_regionkey", REGION_NAMES)}) END AS home_region,
            CASE WHEN c_custkey % 113 = 0 THEN '2024-13-05'
                ELSE {_day("2015-01-01", "c_custkey % 2000")} END AS signed_up_at,
            1940 + c_custkey % 60 AS birth_year,
            {_mixed("lower(c_mktsegment)", "c_custkey")} AS favored_discipline
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_guilds": """
        SELECT n_nationkey AS guild_id, 'Guild ' || n_name AS guild_name,
            1700 + n_nationkey * 7 AS founded_year
        FROM nation""",
    "raw_memberships": f"""
        SELECT c_custkey AS membership_id, c_custkey AS customer_id, c_custkey % 25 AS guild_id,
            {_mixed(_pick("c_custkey % 3", TIERS), "c_custkey")} AS tier,
            {_day("2019-01-01", "c_custkey % 1000")} AS valid_from,
            CASE WHEN c_custkey % 5 <> 0 THEN ' '
                ELSE {_day("2022-01-01", "c_custkey % 700")} END AS valid_to
        FROM customer""",
    "raw_memberships_later": """
        SELECT membership_id, customer_id, guild_id,
            CASE WHEN membership_id % 10 = 0 THEN 'Archmage' ELSE tier END AS tier, valid_from,
            CASE WHEN membership_id % 10 = 3 THEN '2024-01-31' ELSE valid_to END AS valid_to
        FROM raw_memberships WHERE membership_id % 17 <> 0
        UNION ALL
        SELECT -membership_id - 1, customer_id, guild_id, 'apprentice', '2024-02-01', ''
        FROM raw_memberships WHERE membership_id % 20 = 0""",
}


def _staged_memberships(source: str) -> str:
    return f"""
        SELECT membership_id, customer_id, guild_id, lower(trim(tier)) AS tier,
            TRY_CAST(valid_from AS DATE) AS valid_from,
            TRY_CAST(nullif(trim(valid_to), '') AS DATE) AS valid_to,
            nullif(trim(valid_to), '') IS NULL AS is_current_membership
        FROM {source}"""


MODELS: dict[str, str] = {
    "stg_orders": f"""
        SELECT order_id, customer_id, shop_id, {_timestamp("ordered_at")} AS ordered_at,
            lower(trim(status)) AS order_status, lower(trim(channel)) AS channel,
            discount_copper, {_gold("discount_copper")} AS discount_gold
        FROM raw_orders""",
    "stg_order_items": f"""
        SELECT *, {_gold("unit_price_copper")} AS unit_price_gold,
            quantity * unit_price_copper AS gross_line_amount_copper,
            {_gold("quantity * unit_price_copper")} AS gross_line_amount_gold
        FROM raw_order_items""",
    "stg_payments": f"""
        SELECT payment_id, order_id, lower(trim(method)) AS payment_method,
            lower(trim(status)) AS payment_status, amount_copper,
            {_gold("amount_copper")} AS amount_gold, paid_at
        FROM raw_payments""",
    "stg_potions": f"""
        SELECT potion_sku, potion_name, lower(trim(category)) AS category, base_price_copper,
            {_gold("base_price_copper")} AS base_price_gold, potency, shelf_life_days,
            {_boolean("is_regulated")} AS is_regulated, TRY_CAST(introduced_at AS DATE) AS introduced_at
        FROM raw_potions""",
    "stg_shops": """
        SELECT shop_id, shop_name, city, region, TRY_CAST(opened_at AS DATE) AS opened_at FROM raw_shops""",
    "stg_suppliers": """
        SELECT supplier_id, supplier_name, region, reliability_rating,
            TRY_CAST(contracted_since AS DATE) AS contracted_since
        FROM raw_suppliers""",
    "stg_ingredients": f"""
        SELECT ingredient_id, ingredient_name, supplier_id, lower(trim(unit)) AS unit, unit_cost_copper,
            {_gold("unit_cost_copper")} AS unit_cost_gold, {_boolean("is_hazardous")} AS is_hazardous,
            lower(trim(harvest_season)) AS harvest_season
        FROM raw_ingredients""",
    "stg_recipes": "SELECT potion_sku, ingredient_id, quantity, lower(trim(unit)) AS unit FROM raw_recipes",
    "stg_brew_events": f"""
        SELECT brew_id, potion_sku, shop_id, cauldron_id, {_timestamp("brewed_at")} AS brewed_at,
            batch_size, brew_duration_minutes, lower(trim(quality_check)) AS quality_check, brewer_name
        FROM raw_brew_events""",
    "stg_customers": """
        SELECT customer_id, full_name, nullif(trim(email), '') AS email,
            CASE WHEN lower(trim(home_region)) IN ('nr', 'northern reaches') THEN 'Northern Reaches'
                WHEN lower(trim(home_region)) IN ('cv', 'crystal vale') THEN 'Crystal Vale'
                WHEN lower(trim(home_region)) IN ('ml', 'the marshlands', 'marshlands') THEN 'The Marshlands'
                WHEN lower(trim(home_region)) IN ('ec', 'ember coast') THEN 'Ember Coast'
                WHEN lower(trim(home_region)) IN ('sw', 'silverwood') THEN 'Silverwood' END AS home_region,
            TRY_CAST(signed_up_at AS DATE) AS signed_up_at, birth_year,
            lower(trim(favored_discipline)) AS favored_discipline
        FROM raw_customers""",
    "stg_guilds": "SELECT * FROM raw_guilds",
    "stg_memberships": _staged_memberships("raw_memberships"),
    "stg_memberships_later": _staged_memberships("raw_memberships_later"),
    "order_item_totals": f"""
        SELECT order_id, count(*) AS line_count, sum(quantity) AS total_quantity,
            sum(gross_line_amount_copper) AS gross_amount_copper,
            {_gold("CAST(sum(gross_line_amount_copper) AS BIGINT)")} AS gross_amount_gold
        FROM stg_order_items GROUP BY order_id""",
    "order_payments": f"""
        SELECT *, {_gold("collected_copper")} AS collected_gold, {_gold("refunded_copper")} AS refunded_gold
        FROM (SELECT order_id,
            CAST(sum(CASE WHEN payment_status = 'success' THEN amount_copper ELSE 0 END) AS BIGINT) AS collected_copper,
            CAST(sum(CASE WHEN payment_status = 'refunded' THEN amount_copper ELSE 0 END) AS BIGINT) AS refunded_copper,
            count(*) AS payment_attempt_count, count(*) FILTER (WHERE payment_status = 'failed') AS failed_payment_count,
            max(paid_at) AS last_payment_at,
            min(CASE WHEN payment_status = 'success' THEN payment_method END) AS primary_payment_method
        FROM stg_payments GROUP BY order_id)""",
    "orders_enriched": """
        SELECT o.*, s.shop_name, s.region AS shop_region, s.city AS shop_city, c.full_name AS customer_name,
            c.home_region AS customer_home_region, c.favored_discipline
        FROM stg_orders o LEFT JOIN stg_shops s ON o.shop_id = s.shop_id
        LEFT JOIN stg_customers c ON o.customer_id = c.customer_id""",
    "fct_orders": f"""
        SELECT o.order_id, o.customer_id, o.shop_id, o.ordered_at, o.order_status, o.channel,
            dayofweek(o.ordered_at) IN (0, 6) AS is_weekend_order, o.shop_name, o.shop_region, o.customer_name,
            t.line_count, t.total_quantity, t.gross_amount_copper, t.gross_amount_gold, o.discount_copper,
            t.gross_amount_copper - o.discount_copper AS net_amount_copper,
            {_gold("CAST(t.gross_amount_copper - o.discount_copper AS BIGINT)")} AS net_amount_gold,
            coalesce(p.collected_copper, 0) AS collected_copper, coalesce(p.collected_gold, 0) AS collected_gold,
            coalesce(p.refunded_gold, 0) AS refunded_gold,
            coalesce(p.payment_attempt_count, 0) AS payment_attempt_count,
            coalesce(p.failed_payment_count, 0) AS failed_payment_count,
            p.primary_payment_method, p.last_payment_at
        FROM orders_enriched o LEFT JOIN order_item_totals t ON o.order_id = t.order_id
        LEFT JOIN order_payments p ON o.order_id = p.order_id""",
    "fct_order_items": """
        SELECT i.order_item_id, i.order_id, i.potion_sku, o.customer_id, o.shop_id, o.shop_region, o.ordered_at,
            o.order_status, p.potion_name, p.category AS potion_category, p.is_regulated, i.quantity,
            i.unit_price_copper, i.unit_price_gold, i.gross_line_amount_copper, i.gross_line_amount_gold
        FROM stg_order_items i JOIN orders_enriched o ON i.order_id = o.order_id
        LEFT JOIN stg_potions p ON i.potion_sku = p.potion_sku""",
    "orders_backfill": """
        SELECT o.order_id, o.shop_region, o.channel, o.order_status, o.ordered_at,
            CAST(date_trunc('month', o.ordered_at) AS TIMESTAMP) AS order_month, t.gross_amount_copper,
            t.gross_amount_gold, o.discount_gold
        FROM orders_enriched o LEFT JOIN order_item_totals t ON o.order_id = t.order_id""",
    "regulated_sales": """
        SELECT order_item_id, order_id, potion_sku, potion_name, potion_category, customer_id, shop_id, shop_region,
            ordered_at, quantity, unit_price_gold, gross_line_amount_gold,
            CAST(date_trunc('quarter', ordered_at) AS TIMESTAMP) AS reporting_quarter
        FROM fct_order_items WHERE is_regulated AND order_status = 'completed'""",
    "brew_yield": """
        SELECT b.brew_id, b.potion_sku, b.shop_id, b.cauldron_id, b.brewed_at, b.batch_size, b.brew_duration_minutes,
            b.quality_check, b.batch_size / nullif(b.brew_duration_minutes, 0) AS units_per_minute,
            b.brewed_at + to_minutes(CAST(b.brew_duration_minutes AS INTEGER)) AS brew_finished_at
        FROM stg_brew_events b JOIN stg_potions p ON b.potion_sku = p.potion_sku""",
    "current_membership": """
        SELECT m.customer_id, m.guild_id, m.tier, g.guild_name, m.valid_from AS tier_since
        FROM stg_memberships m JOIN stg_guilds g ON m.guild_id = g.guild_id WHERE m.is_current_membership""",
    "customer_activity": """
        SELECT customer_id, count(*) AS lifetime_order_count, sum(collected_gold) AS lifetime_collected_gold,
            min(ordered_at) AS first_order_at, max(ordered_at) AS most_recent_order_at
        FROM fct_orders WHERE order_status = 'completed' GROUP BY customer_id""",
    "dim_customers": """
        SELECT c.*, m.guild_id, m.guild_name, m.tier AS guild_tier, m.tier_since AS guild_tier_since,
            coalesce(a.lifetime_order_count, 0) AS lifetime_order_count,
            coalesce(a.lifetime_collected_gold, 0) AS lifetime_collected_gold,
            a.first_order_at, a.most_recent_order_at,
            CASE WHEN a.lifetime_collected_gold >= 500 THEN 'archmage'
                WHEN a.lifetime_collected_gold >= 150 THEN 'adept'
                WHEN a.lifetime_collected_gold > 0 THEN 'apprentice' ELSE 'prospect' END AS value_segment
        FROM stg_customers c LEFT JOIN current_membership m ON c.customer_id = m.customer_id
        LEFT JOIN customer_activity a ON c.customer_id = a.customer_id""",
    "recipe_cost": """
        SELECT r.potion_sku, count(*) AS ingredient_count, sum(r.quantity * i.unit_cost_copper) AS recipe_cost_copper,
            max(CASE WHEN i.is_hazardous THEN 1 ELSE 0 END) = 1 AS has_hazardous_ingredient
        FROM stg_recipes r JOIN stg_ingredients i ON r.ingredient_id = i.ingredient_id GROUP BY r.potion_sku""",
    "brew_stats": """
        SELECT potion_sku, count(*) AS brew_event_count, sum(batch_size) AS total_units_brewed,
            avg(brew_duration_minutes) AS avg_brew_duration_minutes,
            CAST(count(*) FILTER (WHERE quality_check = 'fail') AS DOUBLE) / nullif(count(*), 0) AS brew_failure_rate
        FROM stg_brew_events GROUP BY potion_sku""",
    "dim_potions": f"""
        SELECT p.*, c.ingredient_count, c.recipe_cost_copper,
            {_gold("CAST(c.recipe_cost_copper AS BIGINT)")} AS recipe_cost_gold, c.has_hazardous_ingredient,
            p.base_price_copper - c.recipe_cost_copper AS unit_margin_copper,
            {_four_places("p.base_price_copper - c.recipe_cost_copper", "p.base_price_copper")} AS unit_margin_pct,
            b.brew_event_count, b.total_units_brewed, b.avg_brew_duration_minutes, b.brew_failure_rate
        FROM stg_potions p LEFT JOIN recipe_cost c ON p.potion_sku = c.potion_sku
        LEFT JOIN brew_stats b ON p.potion_sku = b.potion_sku""",
    "supplier_scorecard": """
        SELECT s.supplier_id, s.supplier_name, s.region, s.reliability_rating,
            count(DISTINCT i.ingredient_id) AS ingredient_count,
            CAST(sum(i.unit_cost_gold) AS DOUBLE) / nullif(count(i.unit_cost_gold), 0) AS avg_unit_cost_gold,
            count(*) FILTER (WHERE i.is_hazardous) AS hazardous_ingredient_count, s.contracted_since AS contract_start_date
        FROM stg_suppliers s LEFT JOIN stg_ingredients i ON s.supplier_id = i.supplier_id
        GROUP BY s.supplier_id, s.supplier_name, s.region, s.reliability_rating, s.contracted_since""",
    "shop_counts": "SELECT region, count(*) AS shop_count FROM stg_shops GROUP BY region",
    "revenue_by_region": """
        SELECT a.*, s.shop_count,
            round(CAST(a.gross_revenue_gold AS DOUBLE) / nullif(s.shop_count, 0), 2) AS gross_revenue_gold_per_shop
        FROM (SELECT shop_region, order_month, count(DISTINCT order_id) AS order_count,
                sum(gross_amount_copper) AS gross_revenue_copper, sum(gross_amount_gold) AS gross_revenue_gold,
                sum(discount_gold) AS discount_gold, count(*) FILTER (WHERE order_status = 'returned') AS returned_order_count
            FROM orders_backfill GROUP BY shop_region, order_month) a
        LEFT JOIN shop_counts s ON a.shop_region = s.region""",
    "category_revenue_pivot": f"""
        SELECT shop_region, CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS order_month,
            {", ".join(f"sum(CASE WHEN potion_category = '{c}' THEN gross_line_amount_gold ELSE 0 END) AS revenue_{c}_gold"
                       for c in CATEGORIES)},
            sum(gross_line_amount_gold) AS revenue_total_gold, count(DISTINCT order_id) AS order_count
        FROM fct_order_items WHERE order_status = 'completed' GROUP BY ALL""",
    "payment_method_mix": f"""
        SELECT shop_region, {", ".join(
            f"sum(CASE WHEN primary_payment_method = '{m}' THEN collected_gold END) AS {m}" for m in METHODS)}
        FROM fct_orders WHERE order_status = 'completed' AND primary_payment_method IS NOT NULL
        GROUP BY shop_region""",
    "payment_mix_total": f"""
        SELECT shop_region, {", ".join(
            f"sum(CASE WHEN primary_payment_method = '{m}' THEN collected_gold ELSE 0 END) AS collected_gold_{m}"
            for m in METHODS)}, sum(collected_gold) AS collected_gold_total
        FROM fct_orders GROUP BY shop_region""",
    "channel_rows": """
        SELECT o.channel, o.shop_region, CAST(date_trunc('month', o.ordered_at) AS TIMESTAMP) AS order_month,
            t.gross_amount_gold, o.order_id
        FROM orders_enriched o LEFT JOIN order_item_totals t ON o.order_id = t.order_id""",
    "channel_mix_labelled": """
        SELECT 'in_store' AS channel, shop_region, order_month, sum(gross_amount_gold) AS gross_revenue_gold,
            count(DISTINCT order_id) AS order_count
        FROM channel_rows WHERE channel = 'in_store' GROUP BY shop_region, order_month
        UNION ALL
        SELECT 'courier_owl', shop_region, order_month, sum(gross_amount_gold), count(DISTINCT order_id)
        FROM channel_rows WHERE channel = 'courier_owl' GROUP BY shop_region, order_month""",
    "scd2_check": """
        SELECT o.*, TIMESTAMP '2024-01-01' AS version_from,
            CASE WHEN gone OR changed THEN TIMESTAMP '2024-02-01' END AS version_to,
            CASE WHEN gone OR changed THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS version_updated_at,
            md5(o.membership_id || '|2024-01-01 00:00:00') AS version_id
        FROM stg_memberships o JOIN (SELECT a.membership_id, b.membership_id IS NULL AS gone,
                b.membership_id IS NOT NULL AND (a.tier IS DISTINCT FROM b.tier
                    OR a.guild_id IS DISTINCT FROM b.guild_id OR a.valid_to IS DISTINCT FROM b.valid_to) AS changed
            FROM stg_memberships a LEFT JOIN stg_memberships_later b ON a.membership_id = b.membership_id) f
            ON o.membership_id = f.membership_id
        UNION ALL
        SELECT n.*, TIMESTAMP '2024-02-01', CAST(NULL AS TIMESTAMP), TIMESTAMP '2024-02-01',
            md5(n.membership_id || '|2024-02-01 00:00:00')
        FROM stg_memberships_later n LEFT JOIN stg_memberships p ON n.membership_id = p.membership_id
        WHERE p.membership_id IS NULL OR p.tier IS DISTINCT FROM n.tier
            OR p.guild_id IS DISTINCT FROM n.guild_id OR p.valid_to IS DISTINCT FROM n.valid_to""",
    "extracts_in_order": """
        SELECT *, 1 AS place FROM stg_memberships
        UNION ALL
        SELECT * REPLACE (CASE WHEN membership_id % 7 = 0 THEN 'archmage' ELSE tier END AS tier), 2
        FROM stg_memberships WHERE membership_id % 13 <> 0
        UNION ALL
        SELECT *, 3 FROM stg_memberships_later""",
    "extract_versions": """
        SELECT *, sum(opens) OVER (PARTITION BY membership_id ORDER BY place) AS version FROM (
            SELECT *, CASE WHEN lag(place) OVER w = place - 1 AND tier IS NOT DISTINCT FROM lag(tier) OVER w
                AND guild_id IS NOT DISTINCT FROM lag(guild_id) OVER w
                AND valid_to IS NOT DISTINCT FROM lag(valid_to) OVER w THEN 0 ELSE 1 END AS opens
            FROM extracts_in_order WINDOW w AS (PARTITION BY membership_id ORDER BY place))""",
    "scd2_late_extract": """
        SELECT f.membership_id, f.customer_id, f.guild_id, f.tier, f.valid_from, f.valid_to, f.is_current_membership,
            version_from, version_to, coalesce(version_to, version_from) AS version_updated_at,
            md5(f.membership_id || '|' || strftime(version_from, '%Y-%m-%d %H:%M:%S')) AS version_id
        FROM (SELECT membership_id, version, min(place) AS first_place,
                CASE min(place) WHEN 1 THEN TIMESTAMP '2024-01-01' WHEN 2 THEN TIMESTAMP '2024-01-15'
                    ELSE TIMESTAMP '2024-02-01' END AS version_from,
                CASE max(place) WHEN 1 THEN TIMESTAMP '2024-01-15' WHEN 2 THEN TIMESTAMP '2024-02-01' END AS version_to
            FROM extract_versions GROUP BY ALL) v
        JOIN extract_versions f ON f.membership_id = v.membership_id AND f.place = v.first_place""",
    "merged_payments": """
        SELECT * REPLACE (CASE WHEN payment_status = 'failed' AND paid_at < TIMESTAMP '2024-01-16'
            THEN amount_copper + 7 ELSE amount_copper END AS amount_copper)
        FROM stg_payments WHERE payment_id % 50 <> 7""",
    "order_payments_maintained": f"""
        SELECT *, {_gold("collected_copper")} AS collected_gold, {_gold("refunded_copper")} AS refunded_gold
        FROM (SELECT order_id,
            CAST(sum(CASE WHEN payment_status = 'success' THEN amount_copper ELSE 0 END) AS BIGINT) AS collected_copper,
            CAST(sum(CASE WHEN payment_status = 'refunded' THEN amount_copper ELSE 0 END) AS BIGINT) AS refunded_copper,
            count(*) AS payment_attempt_count, count(*) FILTER (WHERE payment_status = 'failed') AS failed_payment_count,
            max(paid_at) AS last_payment_at,
            min(CASE WHEN payment_status = 'success' THEN payment_method END) AS primary_payment_method
        FROM merged_payments GROUP BY order_id)""",
    "followed_payments": """
        SELECT payment_id, order_id, payment_method, payment_status FROM stg_payments
        UNION ALL
        SELECT payment_id, order_id, 'shells', payment_status FROM stg_payments WHERE payment_id % 40 = 1""",
    "three_runs": """
        SELECT run, total + (run - 1) * CAST(ties AS BIGINT) AS appended, total AS upserted, ids
        FROM (SELECT count(*) AS total, count(DISTINCT payment_id) AS ids FROM stg_payments),
            (SELECT count(*) AS ties FROM stg_payments WHERE paid_at = (SELECT max(paid_at) FROM stg_payments)),
            (SELECT unnest([1, 2, 3]) AS run)""",
}


def _not_null(table: str, column: str, source: str | None = None) -> str:
    return _check(table, "not_null", column, f"SELECT count(*) FROM {source or table} WHERE {column} IS NULL")


def _unique(table: str, *columns: str, source: str | None = None) -> str:
    kept = f"WHERE {columns[0]} IS NOT NULL" if len(columns) == 1 else ""
    kind = "unique" if len(columns) == 1 else "unique_combination"
    listed = ", ".join(columns)
    repeated = f"SELECT {listed} FROM {source or table} {kept} GROUP BY {listed} HAVING count(*) > 1"
    return _check(table, kind, ",".join(columns), f"SELECT count(*) FROM ({repeated})")


def _accepted(table: str, column: str, values: list[str], source: str | None = None) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return _check(
        table, "accepted_values", column, f"SELECT count(*) FROM {source or table} WHERE {column} NOT IN ({listed})"
    )


def _related(table: str, column: str, parent: str, source: str | None = None) -> str:
    missing = (
        f"SELECT count(*) FROM {source or table} c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"
    )
    return _check(table, "relationships", column, missing)


def _check(table: str, kind: str, column: str, failures: str) -> str:
    return f"SELECT '{table}' AS table_name, '{kind}' AS check_name, '{column}' AS column_name, ({failures}) AS failures"


def _key(table: str, column: str, source: str | None = None) -> list[str]:
    return [_unique(table, column, source=source), _not_null(table, column, source)]


STATUSES = ["completed", "returned", "cancelled", "placed"]
CHANNELS = ["in_store", "courier_owl", "marketplace"]

ALL_CHECKS = [
    *_key("stg_orders", "order_id"),
    *(_not_null("stg_orders", c) for c in ("customer_id", "shop_id", "ordered_at")),
    _accepted("stg_orders", "order_status", STATUSES),
    _accepted("stg_orders", "channel", CHANNELS),
    *_key("stg_order_items", "order_item_id"),
    *(_not_null("stg_order_items", c) for c in ("order_id", "potion_sku", "quantity")),
    _related("stg_order_items", "order_id", "stg_orders"),
    *_key("stg_payments", "payment_id"),
    _not_null("stg_payments", "order_id"),
    _accepted("stg_payments", "payment_method", METHODS),
    _accepted("stg_payments", "payment_status", ["success", "failed", "refunded"]),
    *_key("stg_potions", "potion_sku"),
    *_key("stg_shops", "shop_id"),
    _not_null("stg_shops", "region"),
    *_key("stg_suppliers", "supplier_id"),
    *_key("stg_ingredients", "ingredient_id"),
    _not_null("stg_ingredients", "supplier_id"),
    _unique("stg_potion_ingredients", "potion_sku", "ingredient_id", source="stg_recipes"),
    _not_null("stg_potion_ingredients", "potion_sku", "stg_recipes"),
    _not_null("stg_potion_ingredients", "ingredient_id", "stg_recipes"),
    *_key("stg_brew_events", "brew_id"),
    _not_null("stg_brew_events", "potion_sku"),
    _accepted("stg_brew_events", "quality_check", ["pass", "fail"]),
    *_key("stg_customers", "customer_id"),
    _accepted("stg_customers", "home_region", REGION_NAMES),
    *_key("stg_guilds", "guild_id"),
    *_key("stg_guild_memberships", "membership_id", "stg_memberships"),
    _not_null("stg_guild_memberships", "customer_id", "stg_memberships"),
    _related("stg_guild_memberships", "customer_id", "stg_customers", "stg_memberships"),
    _not_null("stg_guild_memberships", "guild_id", "stg_memberships"),
    _accepted("stg_guild_memberships", "tier", TIERS, "stg_memberships"),
    *_key("fct_orders", "order_id"),
    _not_null("fct_orders", "customer_id"),
    *_key("fct_order_items", "order_item_id"),
    _not_null("fct_order_items", "order_id"),
    _not_null("fct_order_items", "potion_sku"),
    *_key("dim_customers", "customer_id"),
    _accepted("dim_customers", "value_segment", ["archmage", "adept", "apprentice", "prospect"]),
    *_key("dim_potions", "potion_sku"),
    _not_null("agg_revenue_by_region", "shop_region", "revenue_by_region"),
]

ORDER_COLUMNS = """order_id:b customer_id:b shop_id:b ordered_at order_status channel is_weekend_order shop_name
    shop_region customer_name line_count:b total_quantity:b gross_amount_copper:b gross_amount_gold:d
    discount_copper:b net_amount_copper:b net_amount_gold:d collected_copper:b collected_gold:d refunded_gold:d
    payment_attempt_count:b failed_payment_count:b primary_payment_method last_payment_at"""
STAGED_ORDER = """order_id:b customer_id:b shop_id:b ordered_at order_status channel discount_copper:b
    discount_gold:d"""
PAYMENT = "payment_id:b order_id:b payment_method payment_status amount_copper:b amount_gold:d paid_at"
BACKFILL = """order_id:b shop_region channel order_status ordered_at order_month gross_amount_copper:b
    gross_amount_gold:d discount_gold:d"""
CHECK = "table_name check_name column_name failures:b"
MIX = " ".join(f"{method}:d" for method in METHODS)

# Query name -> (step or sub-query to select from, output columns with b = BIGINT, d = DOUBLE).
OUTPUTS: dict[str, tuple[str, str]] = {
    "scan_orders": ("orders", "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority"),
    "csv_orders": ("stg_orders", STAGED_ORDER),
    "published_orders": ("fct_orders", ORDER_COLUMNS),
    "orders_audited": ("(SELECT order_id, true AS is_stamped, 'registered-query' AS run_id FROM stg_orders)",
                       "order_id:b is_stamped run_id"),
    "regulated_sales_ledger": (
        """(SELECT 'marts.regulated_sales' AS relation_name, 'registered-query' AS run_id, n AS row_count,
            'guild-audit-team' AS compliance_owner
            FROM (SELECT count(*) AS n FROM regulated_sales), (SELECT unnest([1, 2])))""",
        "relation_name run_id row_count:b compliance_owner"),
    "regulated_sales_rejected": (
        """(SELECT 'marts.regulated_sales' AS relation_name, 'registered-query' AS run_id, n AS row_count, outcome,
            failed_checks FROM (SELECT count(*) AS n FROM regulated_sales),
            (VALUES ('published', NULL), ('rejected', 'not_null(order_id)'), ('published', NULL)) AS t(outcome, failed_checks))""",
        "relation_name run_id row_count:b outcome failed_checks"),
    "incremental_merge_on_read": ("merged_payments", PAYMENT),
    "payments_stream": ("stg_payments", PAYMENT),
    "quarantined_orders": (
        """(SELECT order_id, CASE order_id % 50 WHEN 1 THEN 'too few fields' WHEN 2 THEN 'too many fields'
            ELSE 'value of another type' END AS reason FROM raw_orders WHERE order_id % 50 IN (1, 2, 3))""",
        "order_id:b reason"),
    "extract_balance": (
        """(SELECT count(*) AS lines_read, count(*) FILTER (WHERE order_id % 50 NOT IN (1, 2, 3)) AS staged,
            count(*) FILTER (WHERE order_id % 50 IN (1, 2, 3)) AS quarantined FROM raw_orders)""",
        "lines_read:b staged:b quarantined:b"),
    "staged_undamaged_orders": ("(SELECT * FROM stg_orders WHERE order_id % 50 NOT IN (1, 2, 3))", STAGED_ORDER),
    "customers_by_quarter": (
        """(SELECT shop_region, CAST(date_trunc('quarter', ordered_at) AS TIMESTAMP) AS order_quarter,
            count(DISTINCT customer_id) AS customer_count FROM orders_enriched GROUP BY ALL)""",
        "shop_region order_quarter customer_count:b"),
    "payment_method_mix_rows": (
        """(SELECT shop_region, primary_payment_method, sum(collected_gold) AS collected_gold FROM fct_orders
            WHERE order_status = 'completed' AND primary_payment_method IS NOT NULL GROUP BY ALL)""",
        "shop_region primary_payment_method collected_gold:d"),
    "checks_followed": (
        "(" + " UNION ALL ".join([
            *_key("fct_payment_events", "payment_id", "followed_payments"),
            _not_null("fct_payment_events", "order_id", "followed_payments"),
            _accepted("fct_payment_events", "payment_method", METHODS, "followed_payments"),
            _accepted("fct_payment_events", "payment_status", ["success", "failed", "refunded"], "followed_payments"),
        ]) + ")", CHECK),
    "incremental_full": ("stg_payments", PAYMENT),
    "incremental_delta": (
        """(SELECT * FROM stg_payments WHERE paid_at >=
            (SELECT max(paid_at) FROM stg_payments WHERE paid_at < TIMESTAMP '2024-01-16'))""", PAYMENT),
    "incremental_append": (
        "(SELECT run, appended AS total_rows, ids AS distinct_ids, appended - ids AS duplicates FROM three_runs)",
        "run:b total_rows:b distinct_ids:b duplicates:b"),
    "incremental_upsert": (
        "(SELECT run, upserted AS total_rows, ids AS distinct_ids, upserted - ids AS duplicates FROM three_runs)",
        "run:b total_rows:b distinct_ids:b duplicates:b"),
    "incremental_upsert_changed": (
        """(SELECT * REPLACE (CASE WHEN payment_status = 'failed' AND paid_at < TIMESTAMP '2024-01-16'
            THEN amount_copper + 7 ELSE amount_copper END AS amount_copper) FROM stg_payments)""", PAYMENT),
    "incremental_text_times": (
        """(SELECT * REPLACE (CASE WHEN payment_id % 97 = 0 THEN NULL ELSE CAST(date_trunc('second', paid_at) AS TIMESTAMP)
            END AS paid_at) FROM stg_payments)""", PAYMENT),
    "incremental_months": (
        """(SELECT * REPLACE (
                CASE WHEN payment_id % 70 IN (1, 3) THEN 5 ELSE amount_copper END AS amount_copper,
                CAST(CASE WHEN payment_id % 70 = 2
                    THEN paid_at + to_months(CAST(payment_id % 7 AS INTEGER)) + INTERVAL 1 MONTH
                    ELSE paid_at + to_months(CAST(payment_id % 7 AS INTEGER)) END AS TIMESTAMP) AS paid_at)
            FROM stg_payments)""", PAYMENT),
    "incremental_lookback": (
        """(SELECT * FROM stg_payments WHERE (paid_at < TIMESTAMP '2024-01-16' AND payment_status <> 'refunded')
            OR paid_at >= (SELECT max(paid_at) - INTERVAL 2 DAY FROM stg_payments
                WHERE paid_at < TIMESTAMP '2024-01-16' AND payment_status <> 'refunded'))""", PAYMENT),
    "scd2_check": ("scd2_check", """membership_id:b customer_id:b guild_id:b tier valid_from valid_to
        is_current_membership version_from version_to version_updated_at version_id"""),
    "scd2_late_extract": ("scd2_late_extract", """membership_id:b customer_id:b guild_id:b tier valid_from valid_to
        is_current_membership version_from version_to version_updated_at version_id"""),
    "scd2_deletes": (
        """(SELECT membership_id, 1 AS versions, TIMESTAMP '2024-02-01' AS closed_at FROM stg_memberships
            WHERE membership_id NOT IN (SELECT membership_id FROM stg_memberships_later))""",
        "membership_id:b versions:b closed_at"),
    "stg_orders": ("stg_orders", STAGED_ORDER),
    "stg_order_items": ("stg_order_items", """order_item_id order_id:b potion_sku:b quantity:b unit_price_copper:b
        unit_price_gold:d gross_line_amount_copper:b gross_line_amount_gold:d"""),
    "stg_payments": ("stg_payments", PAYMENT),
    "stg_parts": ("stg_potions", """potion_sku:b potion_name category base_price_copper:b base_price_gold:d potency:b
        shelf_life_days:b is_regulated introduced_at"""),
    "stg_brew_events": ("stg_brew_events", """brew_id:b potion_sku:b shop_id:b cauldron_id brewed_at batch_size:b
        brew_duration_minutes:b quality_check brewer_name"""),
    "stg_ingredients": ("stg_ingredients", """ingredient_id:b ingredient_name supplier_id:b unit unit_cost_copper:b
        unit_cost_gold:d is_hazardous harvest_season"""),
    "stg_recipes": ("stg_recipes", "potion_sku:b ingredient_id:b quantity:b unit"),
    "stg_shops": ("stg_shops", "shop_id:b shop_name city region opened_at"),
    "stg_suppliers": ("stg_suppliers", "supplier_id:b supplier_name region reliability_rating:b contracted_since"),
    "stg_customers": ("stg_customers", """customer_id:b full_name email home_region signed_up_at birth_year:b
        favored_discipline"""),
    "stg_memberships": ("stg_memberships", """membership_id:b customer_id:b guild_id:b tier valid_from valid_to
        is_current_membership"""),
    "stg_guilds": ("stg_guilds", "guild_id:b guild_name founded_year:b"),
    "order_item_totals": ("order_item_totals", """order_id:b line_count:b total_quantity:b gross_amount_copper:b
        gross_amount_gold:d"""),
    "order_payments": ("order_payments", """order_id:b collected_copper:b collected_gold:d refunded_copper:b
        refunded_gold:d payment_attempt_count:b failed_payment_count:b last_payment_at primary_payment_method"""),
    "orders_enriched": ("orders_enriched", STAGED_ORDER + """ shop_name shop_region shop_city customer_name
        customer_home_region favored_discipline"""),
    "fct_orders": ("fct_orders", ORDER_COLUMNS),
    "fct_order_items": ("fct_order_items", """order_item_id order_id:b potion_sku:b customer_id:b shop_id:b shop_region
        ordered_at order_status potion_name potion_category is_regulated quantity:b unit_price_copper:b
        unit_price_gold:d gross_line_amount_copper:b gross_line_amount_gold:d"""),
    "orders_backfill": ("(SELECT *, 'backfill' AS pipeline_run_mode FROM orders_backfill)",
                        BACKFILL + " pipeline_run_mode"),
    "orders_backfill_stored": ("(SELECT *, 'standard' AS pipeline_run_mode FROM orders_backfill)",
                               BACKFILL + " pipeline_run_mode"),
    "regulated_sales": ("regulated_sales", """order_item_id order_id:b potion_sku:b potion_name potion_category
        customer_id:b shop_id:b shop_region ordered_at quantity:b unit_price_gold:d gross_line_amount_gold:d
        reporting_quarter"""),
    "brew_yield": ("brew_yield", """brew_id:b potion_sku:b shop_id:b cauldron_id brewed_at batch_size:b
        brew_duration_minutes:b quality_check units_per_minute:d brew_finished_at"""),
    "current_membership": ("current_membership", "customer_id:b guild_id:b tier guild_name tier_since"),
    "customer_activity": ("customer_activity", """customer_id:b lifetime_order_count:b lifetime_collected_gold:d
        first_order_at most_recent_order_at"""),
    "dim_customers": ("dim_customers", """customer_id:b full_name email home_region signed_up_at birth_year:b
        favored_discipline guild_id:b guild_name guild_tier guild_tier_since lifetime_order_count:b
        lifetime_collected_gold:d first_order_at most_recent_order_at value_segment"""),
    "customer_segments": (
        "(SELECT value_segment, count(*) AS customer_count FROM dim_customers GROUP BY value_segment)",
        "value_segment customer_count:b"),
    "recipe_cost": ("recipe_cost", "potion_sku:b ingredient_count:b recipe_cost_copper:b has_hazardous_ingredient"),
    "brew_stats": ("brew_stats", """potion_sku:b brew_event_count:b total_units_brewed:b avg_brew_duration_minutes:d
        brew_failure_rate:d"""),
    "dim_parts": ("dim_potions", """potion_sku:b potion_name category potency:b shelf_life_days:b is_regulated
        introduced_at base_price_copper:b base_price_gold:d ingredient_count:b recipe_cost_copper:b
        recipe_cost_gold:d has_hazardous_ingredient unit_margin_copper:b unit_margin_pct:d brew_event_count:b
        total_units_brewed:b avg_brew_duration_minutes:d brew_failure_rate:d"""),
    "potion_margin": ("dim_potions", "potion_sku:b unit_margin_copper:b unit_margin_pct:d"),
    "supplier_scorecard": ("supplier_scorecard", """supplier_id:b supplier_name region reliability_rating:b
        ingredient_count:b avg_unit_cost_gold:d hazardous_ingredient_count:b contract_start_date"""),
    "shop_counts": ("shop_counts", "region shop_count:b"),
    "revenue_by_region": ("revenue_by_region", """shop_region order_month shop_count:b order_count:b
        gross_revenue_copper:b gross_revenue_gold:d discount_gold:d returned_order_count:b
        gross_revenue_gold_per_shop:d"""),
    "monthly_revenue": (
        """(SELECT order_month, count(*) AS order_count, sum(gross_amount_gold) AS gross_revenue_gold
            FROM orders_backfill GROUP BY order_month)""",
        "order_month order_count:b gross_revenue_gold:d"),
    "category_list": ("(SELECT DISTINCT lower(trim(category)) AS category FROM raw_potions ORDER BY 1)", "category"),
    "category_revenue_pivot": ("category_revenue_pivot", "shop_region order_month "
                               + " ".join(f"revenue_{c}_gold:d" for c in CATEGORIES)
                               + " revenue_total_gold:d order_count:b"),
    "category_revenue": (
        """(SELECT shop_region, CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS order_month, potion_category,
            sum(gross_line_amount_gold) AS revenue_gold, count(*) AS line_count
            FROM fct_order_items WHERE order_status = 'completed' GROUP BY ALL)""",
        "shop_region order_month potion_category revenue_gold:d line_count:b"),
    "payment_method_mix": ("payment_method_mix", f"shop_region {MIX}"),
    "payment_method_mix_dynamic": ("payment_method_mix", f"shop_region {MIX}"),
    "payment_mix_total": ("payment_mix_total", "shop_region "
                          + " ".join(f"collected_gold_{m}:d" for m in METHODS) + " collected_gold_total:d"),
    "channel_mix": ("channel_mix_labelled", "shop_region order_month gross_revenue_gold:d order_count:b"),
    "channel_mix_labelled": ("channel_mix_labelled",
                             "channel shop_region order_month gross_revenue_gold:d order_count:b"),
    "safe_ratio": (
        """(SELECT brew_id, batch_size / nullif(brew_duration_minutes, 0) AS rate,
            coalesce(batch_size / nullif(brew_duration_minutes, 0), 0.0) AS rate_or_zero FROM stg_brew_events)""",
        "brew_id:b rate:d rate_or_zero:d"),
    "pct_change": (
        f"""(SELECT i.order_item_id, i.potion_sku,
            {_four_places("i.unit_price_copper - p.base_price_copper", "p.base_price_copper")} AS price_change
            FROM stg_order_items i LEFT JOIN stg_potions p ON i.potion_sku = p.potion_sku)""",
        "order_item_id potion_sku:b price_change:d"),
    "amount_buckets": (
        """(SELECT payment_id, CASE WHEN amount_gold >= 40 THEN 'high' WHEN amount_gold >= 10 THEN 'medium'
            WHEN amount_gold > 0 THEN 'low' ELSE 'none' END AS amount_band FROM stg_payments)""",
        "payment_id:b amount_band"),
    "days_between": (
        "(SELECT membership_id, date_diff('day', valid_from, valid_to) AS days FROM stg_memberships)",
        "membership_id:b days:b"),
    "region_fallback": (
        "(SELECT order_id, coalesce(shop_region, customer_home_region, 'unknown') AS region FROM orders_enriched)",
        "order_id:b region"),
    "weekend_orders": (
        """(SELECT dayofweek(ordered_at) IN (0, 6) AS is_weekend_order, count(*) AS order_count
            FROM stg_orders GROUP BY 1)""",
        "is_weekend_order order_count:b"),
    "check_unique": (
        """(SELECT order_item_id, count(*) AS occurrences FROM stg_order_items
            GROUP BY order_item_id HAVING count(*) > 1)""",
        "order_item_id occurrences:b"),
    "check_unique_combo": (
        """(SELECT order_id, potion_sku, count(*) AS occurrences FROM stg_order_items
            GROUP BY order_id, potion_sku HAVING count(*) > 1)""",
        "order_id:b potion_sku:b occurrences:b"),
    "check_not_null": (
        "(" + " UNION ALL ".join(
            [_not_null("orders", c, "stg_orders") for c in ("order_id", "ordered_at", "discount_copper")]
            + [_not_null("brews", c, "stg_brew_events")
               for c in ("brew_id", "brew_duration_minutes", "quality_check")]) + ")", CHECK),
    "check_accepted": (
        "(" + " UNION ALL ".join([
            _accepted("orders", "order_status", STATUSES, "stg_orders"),
            _accepted("orders", "channel", ["in_store"], "stg_orders"),
            _accepted("potions", "category",
                      ["clarity", "healing", "invisibility", "love", "luck", "strength"], "stg_potions")]) + ")",
        CHECK),
    "check_relationships": (
        """(SELECT shop_id AS key, count(*) AS child_rows FROM stg_orders
            WHERE shop_id NOT IN (SELECT shop_id FROM stg_shops) GROUP BY shop_id)""",
        "key:b child_rows:b"),
    "check_drift": (
        """(SELECT category AS value, count(*) AS row_count FROM stg_potions WHERE category NOT IN
            ('clarity', 'healing', 'invisibility', 'love', 'luck', 'strength') GROUP BY category)""",
        "value row_count:b"),
    "check_negative": (
        "(" + " UNION ALL ".join([
            _unique("lines", "order_id", "potion_sku", source="stg_order_items"),
            _related("lines", "order_id", "stg_orders", "stg_order_items"),
            _related("orders", "shop_id", "stg_shops", "stg_orders")]) + ")", CHECK),
    "check_all": ("(" + " UNION ALL ".join(ALL_CHECKS) + ")", CHECK),
    "full_build": ("(" + " UNION ALL ".join(ALL_CHECKS) + ")", CHECK),
    "duplicate_audit": (
        """(SELECT count(*) AS total_rows, count(DISTINCT order_item_id) AS distinct_ids,
            count(*) - count(DISTINCT order_item_id) AS duplicates FROM stg_order_items)""",
        "total_rows:b distinct_ids:b duplicates:b"),
}

OUTPUTS |= {
    "built_order_items": OUTPUTS["fct_order_items"],
    "spread_order_items": OUTPUTS["fct_order_items"],
    "fct_orders_colocated": OUTPUTS["fct_orders"],
    "fct_order_items_colocated": OUTPUTS["fct_order_items"],
    "built_backfill": OUTPUTS["orders_backfill_stored"],
    "built_channel_mix": OUTPUTS["channel_mix"],
    "order_payments_maintained": ("order_payments_maintained", OUTPUTS["order_payments"][1]),
}

CTES = {**RAW, **MODELS}
CAST_TO = {"b": "BIGINT", "d": "DOUBLE"}


def _needed(sql: str) -> list[str]:
    """Names of the steps a statement reads, directly or through others, in defining order."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in CTES.keys() & words - found:
            found.add(name)
            pending.append(CTES[name])
    return [name for name in CTES if name in found]


def _select(source: str, columns: str) -> str:
    listed = []
    for column in columns.split():
        name, _, kind = column.partition(":")
        listed.append(f"CAST({name} AS {CAST_TO[kind]}) AS {name}" if kind else name)
    body = f"SELECT {', '.join(listed)} FROM {source}"
    steps = ",\n".join(f"{name} AS ({CTES[name]})" for name in _needed(source))
    return f"WITH {steps}\n{body}" if steps else body


def build() -> dict[str, str]:
    return {name: _select(source, columns) for name, (source, columns) in OUTPUTS.items()}
