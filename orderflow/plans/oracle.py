"""Plain SQL for DuckDB that answers each registered query independently.

The first block of common table expressions restates how orders, messages and
listings derive from the sample tables; the rest states each query directly
over them.
"""

from __future__ import annotations

_LINES = """
lines AS (
    SELECT * FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)"""

_ORDERS = (
    _LINES
    + """,
priced AS (
    SELECT *,
        CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
        list_transform(range(1, (l_linenumber - 1) % 7 + 2),
                       lambda i: 1 + (CAST(l_quantity AS INTEGER) + i) % 4) AS quantities
    FROM lines
),
totals AS (
    SELECT *, CAST(unit_price * CAST(list_sum(quantities) AS BIGINT) AS DECIMAL(18,2)) AS total
    FROM priced
),
orders_v AS (
    SELECT *,
        concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS order_id,
        'user-' || l_orderkey AS user_id,
        CAST(l_suppkey AS INTEGER) AS restaurant_id,
        s_name AS restaurant_name,
        n_name AS restaurant_city,
        CASE WHEN l_orderkey % 100 = 3 THEN '091'
             WHEN l_orderkey % 2 = 0 THEN '+91' ELSE '080' END
            || (20000000 + l_suppkey) AS phone_number,
        l_returnflag <> 'R' OR l_orderkey % 100 = 4 AS request_online,
        l_returnflag = 'R' OR l_orderkey % 100 = 4 AS request_table,
        strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS order_time,
        CAST(CASE WHEN l_orderkey % 33 <> 0 THEN total
                  WHEN l_linenumber % 3 = 0 THEN total * 1.25
                  WHEN l_linenumber % 3 = 1 THEN -total
                  ELSE total * 50 END AS DECIMAL(18,2)) AS order_price
    FROM totals
),
numbered AS (
    SELECT *, unnest(range(1, (l_linenumber - 1) % 7 + 2)) AS i FROM orders_v
),
items_v AS (
    SELECT order_id, restaurant_city,
        p_name || ' ' || ['curry', 'naan', 'rice', 'tea', 'kebab', 'paratha', 'juice'][i]
            AS food_item,
        p_type AS category, CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(quantities[i] AS INTEGER) AS quantity
    FROM numbered
)"""
)

_MESSAGES = (
    _ORDERS
    + """,
texts AS (
    SELECT *,
        '{"order_id":"' || order_id || '","user_id":"' || user_id
        || '","restaurant_id":' || restaurant_id
        || ',"restaurant_name":"' || restaurant_name
        || '","restaurant_city":"' || restaurant_city
        || '","cuisines":["' || p_type || '","' || p_brand
        || '"],"phone_number":"' || phone_number
        || '","request_online":' || CAST(request_online AS VARCHAR)
        || ',"request_table":' || CAST(request_table AS VARCHAR)
        || ',"order_time":"' || order_time || '","items":['
        || array_to_string(list_transform(range(1, (l_linenumber - 1) % 7 + 2), lambda i:
            '{"food_item":"' || p_name || ' '
            || ['curry', 'naan', 'rice', 'tea', 'kebab', 'paratha', 'juice'][i]
            || '","category":"' || p_type || '","unit_price":' || unit_price
            || ',"quantity":' || quantities[i] || '}'), ',')
        || '],"order_price":' || order_price || ',"device":"web"}' AS text
    FROM orders_v
),
messages AS (
    SELECT *,
        CASE WHEN l_orderkey % 211 = 7 THEN left(text, length(text) - 1)
             WHEN l_orderkey % 223 = 7 THEN '[' || text || ']'
             WHEN l_orderkey % 227 = 7
             THEN replace(text, '"request_online":true', '"request_online":"true"')
             ELSE text END AS value,
        CASE WHEN l_orderkey % 211 = 7 THEN 'NOT_JSON'
             WHEN l_orderkey % 223 = 7 THEN 'NOT_OBJECT'
             WHEN l_orderkey % 227 = 7 AND request_online THEN 'BAD_FIELD_TYPE' END AS reason,
        list_filter([
            CASE WHEN NOT (starts_with(phone_number, '+91') OR starts_with(phone_number, '080'))
                 THEN 'INVALID_PHONE' END,
            CASE WHEN request_online AND request_table THEN 'MODE_CONFLICT' END,
            CASE WHEN abs(order_price - total) > 0.01 THEN 'PRICE_MISMATCH' END
        ], lambda code: code IS NOT NULL) AS errors
    FROM texts
),
routed AS (
    SELECT reason, errors,
        CASE WHEN reason IS NOT NULL THEN 'malformed'
             WHEN len(errors) > 0 THEN 'error' ELSE 'valid' END AS route,
        CASE WHEN reason IS NULL THEN order_id END AS key,
        CASE WHEN reason IS NULL AND len(errors) > 0
             THEN '{"original_order":' || value || ',"errors":["'
                  || array_to_string(errors, '","') || '"],"error_count_type":"'
                  || CASE WHEN len(errors) > 1 THEN 'MULTI' ELSE errors[1] END || '"}'
             ELSE value END AS value
    FROM messages
)"""
)

_EVENTS = """
timed AS (
    SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id,
        event_type AS restaurant_city, ts, epoch_us(ts) AS us
    FROM events
)"""


def _windows(name: str, size_s: int, slide_s: int) -> str:
    """Events once per sliding window that holds them, windows aligned to the epoch."""
    return f"""
{name} AS (
    SELECT *, us // {slide_s}000000 * {slide_s} - back * {slide_s} AS window_start,
        us // {slide_s}000000 * {slide_s} - back * {slide_s} + {size_s} AS window_end
    FROM timed CROSS JOIN (SELECT unnest(range(0, {size_s // slide_s})) AS back)
)"""


_ALERTS = (
    _EVENTS
    + ","
    + _windows("geo_windows", 1800, 600)
    + ","
    + _windows("velocity_windows", 3600, 1200)
    + """,
geo AS (
    SELECT user_id, 'GEOGRAPHICAL_IMPOSSIBILITY' AS alert_type,
        'User placed orders across cities: ['
            || string_agg(DISTINCT restaurant_city, ', ' ORDER BY restaurant_city) || ']'
            AS trigger_reason,
        window_start, window_end
    FROM geo_windows GROUP BY user_id, window_start, window_end
    HAVING count(DISTINCT restaurant_city) > 1
),
velocity AS (
    SELECT user_id, 'VELOCITY_SPAM_BOT' AS alert_type,
        'User exceeded checkout rate with frequency count: ' || count(order_id) AS trigger_reason,
        window_start, window_end
    FROM velocity_windows GROUP BY user_id, window_start, window_end
    HAVING count(order_id) > 2
),
alerts AS (SELECT * FROM geo UNION ALL SELECT * FROM velocity)"""
)

_SOUND_ALERTS = _ALERTS.replace(
    "FROM events",
    "FROM events WHERE event_id % 7 <> 3 AND event_id % 11 <> 5 AND event_id % 13 <> 1",
)

_LISTING = (
    _LINES
    + """,
listing AS (
    SELECT
        CASE WHEN s_suppkey % 50 <> 9 THEN 'Plot ' || s_suppkey || ', ' || n_name END AS address,
        CASE WHEN s_suppkey % 40 = 1 THEN '  ' ELSE s_name END AS name,
        CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'N' THEN 'No' ELSE ' yes' END AS online_order,
        CASE WHEN l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS book_table,
        CASE l_orderkey % 7 WHEN 0 THEN 'NEW' WHEN 1 THEN '-'
            WHEN 3 THEN ' 3.9 /5' WHEN 4 THEN 'abc'
            WHEN 5 THEN (3 + l_partkey % 20 // 10) || '.' || (l_partkey % 10) || '/5'
            WHEN 6 THEN (3 + l_partkey % 20 // 10) || '.' || (l_partkey % 10) || '5/5'
        END AS rate,
        CASE WHEN l_orderkey % 11 = 0 THEN 'n/a'
             ELSE CAST(CAST(l_quantity AS INTEGER) * 10 AS VARCHAR) END AS votes,
        CASE WHEN s_suppkey % 10 = 0 AND l_linenumber % 2 = 0 THEN '080 ' || (30000000 + s_suppkey)
             ELSE '+91 98' || (10000000 + s_suppkey) || chr(10) || '080 ' || (20000000 + s_suppkey)
        END AS phone,
        CASE WHEN l_orderkey % 97 <> 0 THEN n_name END AS location,
        p_type AS rest_type,
        p_type || ', ' || p_brand AS cuisines,
        CASE WHEN l_orderkey % 13 = 0 THEN NULL
             WHEN l_partkey % 1500 < 800 THEN CAST(200 + l_partkey % 1500 AS VARCHAR)
             ELSE '1,' || lpad(CAST(l_partkey % 1500 - 800 AS VARCHAR), 3, '0') END AS cost,
        CASE l_linenumber WHEN 1 THEN '[]' WHEN 2 THEN 'on request'
             WHEN 3 THEN '[''' || p_name || ''', "chef''s tea"]'
             ELSE '[''' || p_name || ''', ''a'', ''b'', ''c'', ''d'', ''e'']' END AS menu_item,
        CASE l_returnflag WHEN 'R' THEN 'Delivery' WHEN 'A' THEN 'Buffet' ELSE 'Dine-out' END
            AS listed_in_type,
        r_name AS city,
        p_name, l_linenumber
    FROM lines
)"""
)


_LISTING_ROWS = """SELECT address, name, online_order, book_table, rate, votes, phone, location,
    rest_type, cuisines, cost AS "approx_cost(for two people)", menu_item,
    listed_in_type AS "listed_in(type)", city AS "listed_in(city)"
FROM listing"""


def _id(*columns: str) -> str:
    """The stable key over text columns."""
    parts = [f"coalesce(length({c}) || ':' || {c}, '-')" for c in columns]
    return f"md5(concat_ws(',', {', '.join(parts)}))"


_TABLES = (
    _LISTING
    + f""",
located AS (
    SELECT *, {_id("location", "city")} AS location_id
    FROM listing WHERE location IS NOT NULL AND city IS NOT NULL
),
locations AS (
    SELECT DISTINCT location_id, location AS location_name, city AS listed_in_city FROM located
),
restaurants AS (
    SELECT DISTINCT {_id("name", "address", "phone", "location_id")} AS restaurant_id,
        name, address, phone, location_id
    FROM located
),
cleaned AS (
    SELECT name, address, phone, location_id,
        coalesce(online_order = 'Yes', FALSE) AS online_order,
        coalesce(book_table = 'Yes', FALSE) AS book_table,
        CASE WHEN trim(split_part(rate, '/', 1)) NOT IN ('NEW', '-', '')
             THEN TRY_CAST(trim(split_part(rate, '/', 1)) AS DECIMAL(3,2)) END AS rate,
        TRY_CAST(nullif(regexp_replace(votes, '\\D', '', 'g'), '') AS INTEGER) AS votes,
        rest_type, cuisines,
        TRY_CAST(nullif(regexp_replace(cost, '\\D', '', 'g'), '') AS INTEGER) AS approx_cost_two,
        menu_item, listed_in_type
    FROM located
),
metrics_v AS (
    SELECT restaurant_id, c.* EXCLUDE (name, address, phone, location_id)
    FROM cleaned c JOIN restaurants r
        ON c.name = r.name AND c.address = r.address AND c.location_id = r.location_id
),
exact_v AS (
    SELECT {_id("name", "address", "phone", "location_id")} AS restaurant_id,
        c.* EXCLUDE (name, address, phone, location_id)
    FROM cleaned c
),
star AS (
    SELECT m.*, r.location_id, l.location_name, l.listed_in_city
    FROM metrics_v m JOIN restaurants r USING (restaurant_id) JOIN locations l USING (location_id)
)"""
)

_METRIC_ID = _id(
    "restaurant_id",
    "CAST(online_order AS VARCHAR)",
    "CAST(book_table AS VARCHAR)",
    "CAST(rate AS VARCHAR)",
    "CAST(votes AS VARCHAR)",
    "rest_type",
    "cuisines",
    "CAST(approx_cost_two AS VARCHAR)",
    "menu_item",
    "listed_in_type",
)

_METRIC_COLUMNS = f"""{_METRIC_ID} AS metric_id, restaurant_id, online_order, book_table,
    CAST(rate AS DOUBLE) AS rate, votes, rest_type, cuisines, approx_cost_two, menu_item,
    listed_in_type"""


def _mean(total: str, count: str) -> str:
    """Mean with two decimals from a total in hundredths; no total is negative here."""
    cents = f"(2 * CAST({total} AS HUGEINT) + {count}) // (2 * nullif({count}, 0))"
    return f"CAST({cents} AS DOUBLE) / 100"


_MEAN_COST = _mean("sum(approx_cost_two) * 100", "count(approx_cost_two)")
_MEAN_RATE = _mean("sum(CAST(rate * 100 AS BIGINT))", "count(rate)")

_LISTING_ID = _id(
    "address",
    "name",
    "online_order",
    "book_table",
    "rate",
    "votes",
    "phone",
    "location",
    "rest_type",
    "cuisines",
    "cost",
    "menu_item",
    "listed_in_type",
    "city",
)

_DIMENSION = (
    _LISTING
    + f""",
dimension AS (
    SELECT {_LISTING_ID} AS restaurant_id,
        trim(name) AS name,
        lower(trim(online_order)) = 'yes' AS online_order,
        lower(trim(book_table)) = 'yes' AS book_table,
        CASE WHEN rate IS NULL OR contains(rate, 'NEW') OR contains(rate, '-') THEN 3.5
             ELSE coalesce(TRY_CAST(trim(split_part(rate, '/', 1)) AS DOUBLE), 3.5) END AS rate,
        coalesce(TRY_CAST(votes AS INTEGER), 50) AS votes,
        replace(phone, chr(10), '|') AS phone_numbers,
        replace(replace(phone, chr(10), '|'), ' ', '') AS dial_numbers,
        trim(city) AS city,
        replace(cuisines, ', ', '|') AS cuisines,
        coalesce(TRY_CAST(replace(cost, ',', '') AS INTEGER), 600) AS approx_cost,
        CASE WHEN l_linenumber <= 2
             THEN 'Chef Special 1|Chef Special 2|Chef Special 3|Chef Special 4|Chef Special 5'
             WHEN l_linenumber = 3
             THEN p_name || '|chef''s tea|Chef Special 3|Chef Special 4|Chef Special 5'
             ELSE p_name || '|a|b|c|d' END AS menu_items
    FROM listing WHERE trim(name) <> ''
)"""
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def oracle_sql() -> dict[str, str]:
    money = "CAST(round(sum(order_price), 2) AS DOUBLE)"
    alerts = "user_id, alert_type, trigger_reason, window_start, window_end"
    return {
        "top_revenue_restaurants": _with(
            _ORDERS,
            f"""SELECT restaurant_id, restaurant_name, {money} AS total_earnings
            FROM orders_v GROUP BY restaurant_id, restaurant_name
            ORDER BY total_earnings DESC, restaurant_id, restaurant_name LIMIT 10""",
        ),
        "top_items": _with(
            _ORDERS,
            """SELECT food_item AS item_name, CAST(sum(quantity) AS BIGINT) AS total_units_sold
            FROM items_v GROUP BY food_item
            ORDER BY total_units_sold DESC, item_name LIMIT 10""",
        ),
        "channel_leaders": _with(
            _ORDERS,
            """SELECT restaurant_id, restaurant_name,
                count(*) FILTER (WHERE request_online) AS online_delivery_count,
                count(*) FILTER (WHERE request_table) AS dine_in_traffic_count
            FROM orders_v GROUP BY restaurant_id, restaurant_name
            ORDER BY online_delivery_count + dine_in_traffic_count DESC,
                restaurant_id, restaurant_name LIMIT 10""",
        ),
        "city_revenue": _with(
            _ORDERS,
            f"""SELECT restaurant_city, {money} AS total_city_revenue
            FROM orders_v GROUP BY restaurant_city
            ORDER BY total_city_revenue DESC, restaurant_city LIMIT 20""",
        ),
        "hourly_pattern": _with(
            _EVENTS,
            """SELECT CAST(hour(ts) AS INTEGER) AS order_hour, count(order_id) AS transaction_volume
            FROM timed GROUP BY hour(ts)""",
        ),
        "peak_hours": _with(
            _EVENTS
            + """,
            hours AS (SELECT CAST(hour(ts) AS INTEGER) AS h, count(order_id) AS n
                      FROM timed GROUP BY hour(ts))""",
            """SELECT p.h AS peak_hour, p.n AS peak_volume,
                q.h AS off_peak_hour, q.n AS off_peak_volume
            FROM (SELECT * FROM hours ORDER BY n DESC, h LIMIT 1) p,
                 (SELECT * FROM hours ORDER BY n, h LIMIT 1) q""",
        ),
        "demand_bands": _with(
            _EVENTS
            + """,
            bands AS (SELECT CASE WHEN hour(ts) BETWEEN 8 AND 10 THEN 'morning'
                WHEN hour(ts) BETWEEN 12 AND 14 THEN 'lunch'
                WHEN hour(ts) BETWEEN 19 AND 21 THEN 'dinner'
                WHEN hour(ts) >= 23 OR hour(ts) < 6 THEN 'night' ELSE 'other' END AS band
                FROM timed)""",
            """SELECT band,
                CASE band WHEN 'morning' THEN CAST(0.6 AS DOUBLE)
                    WHEN 'lunch' THEN CAST(3.0 AS DOUBLE)
                    WHEN 'dinner' THEN CAST(1.2 AS DOUBLE) * CAST(3.0 AS DOUBLE)
                    WHEN 'night' THEN CAST(0.3 AS DOUBLE)
                    ELSE CAST(1.0 AS DOUBLE) END AS demand_factor,
                count(*) AS order_count
            FROM bands GROUP BY band""",
        ),
        "regional_favorites": _with(
            _ORDERS
            + """,
            units AS (SELECT restaurant_city, food_item AS item_name,
                CAST(sum(quantity) AS BIGINT) AS item_city_quantity
                FROM items_v GROUP BY restaurant_city, food_item)""",
            """SELECT restaurant_city, item_name, item_city_quantity, 1 AS rank FROM units
            QUALIFY rank() OVER (PARTITION BY restaurant_city
                                 ORDER BY item_city_quantity DESC) = 1""",
        ),
        "items_exploded": _with(
            _ORDERS, "SELECT order_id, food_item, category, unit_price, quantity FROM items_v"
        ),
        "items_resolved": _with(
            _ORDERS,
            "SELECT order_id, food_item AS item_name, quantity AS item_quantity FROM items_v",
        ),
        "keyword_items": _with(
            _ORDERS,
            """SELECT food_item AS item_name, CAST(sum(quantity) AS BIGINT) AS units,
                len(list_filter(['bread', 'roti', 'naan', 'paratha', 'kulcha', 'drink', 'lassi',
                    'tea', 'coffee', 'juice', 'soda'],
                    lambda word: contains(lower(food_item), word))) > 0 AS bread_or_drink
            FROM items_v GROUP BY food_item""",
        ),
        "orders_json_scan": _with(
            _MESSAGES
            + """,
            scanned AS (SELECT *, l_orderkey % 211 = 7 AS is_cut,
                reason IS NOT DISTINCT FROM 'BAD_FIELD_TYPE' AS is_mistyped FROM messages)""",
            """SELECT CASE WHEN NOT is_cut THEN order_id END AS order_id,
                CASE WHEN NOT is_cut THEN restaurant_id END AS restaurant_id,
                CASE WHEN NOT is_cut THEN restaurant_city END AS restaurant_city,
                CASE WHEN NOT is_cut AND NOT is_mistyped THEN request_online END AS request_online,
                CASE WHEN NOT is_cut THEN CAST(order_price AS DOUBLE) END AS order_price,
                CASE WHEN NOT is_cut THEN CAST(len(quantities) AS INTEGER) END AS item_count,
                is_cut OR is_mistyped AS is_corrupt
            FROM scanned""",
        ),
        "staging_scan": _with(_LISTING, _LISTING_ROWS),
        "csv_ranges": _with(_LISTING, _LISTING_ROWS),
        "normalize_locations": _with(_TABLES, "SELECT * FROM locations"),
        "normalize_restaurants": _with(
            _TABLES, "SELECT * FROM restaurants JOIN locations USING (location_id)"
        ),
        "normalize_metrics": _with(_TABLES, f"SELECT {_METRIC_COLUMNS} FROM metrics_v"),
        "normalize_metrics_exact": _with(_TABLES, f"SELECT {_METRIC_COLUMNS} FROM exact_v"),
        "locations_upsert": _with(
            _TABLES
            + """,
            known AS (SELECT n_name AS location, r_name AS city
                FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal < 0)""",
            f"""SELECT DISTINCT {_id("location", "city")} AS location_id, location AS location_name,
                city AS listed_in_city, FALSE AS is_new FROM known
            UNION ALL
            SELECT *, TRUE AS is_new FROM locations
            WHERE (location_name, listed_in_city) NOT IN (SELECT (location, city) FROM known)""",
        ),
        "load_audit": _with(
            _TABLES
            + """,
            counted AS (SELECT count(*) AS staged_rows,
                count(*) FILTER (WHERE location IS NULL OR city IS NULL) AS rows_without_location,
                count(*) FILTER (WHERE name IS NULL OR address IS NULL)
                    AS rows_without_name_or_address,
                count(*) FILTER (WHERE trim(split_part(rate, '/', 1)) NOT IN ('NEW', '-', '')
                    AND TRY_CAST(trim(split_part(rate, '/', 1)) AS DECIMAL(3,2)) IS NULL)
                    AS unreadable_rates,
                count(*) FILTER (WHERE regexp_matches(votes, '\\d')
                    AND TRY_CAST(regexp_replace(votes, '\\D', '', 'g') AS INTEGER) IS NULL)
                    AS unreadable_votes,
                count(*) FILTER (WHERE regexp_matches(cost, '\\d')
                    AND TRY_CAST(regexp_replace(cost, '\\D', '', 'g') AS INTEGER) IS NULL)
                    AS unreadable_costs,
                count(*) FILTER (WHERE length(location) > 255 OR length(city) > 255
                    OR length(name) > 255 OR length(phone) > 100 OR length(rest_type) > 255
                    OR length(listed_in_type) > 100) AS over_long_rows
                FROM listing),
            tables AS (SELECT (SELECT count(*) FROM locations) AS location_rows,
                (SELECT count(*) FROM restaurants) AS restaurant_rows,
                (SELECT count(*) FROM metrics_v) AS metric_rows)""",
            """SELECT check_name, row_count
            FROM (UNPIVOT counted ON * INTO NAME check_name VALUE row_count)
            UNION ALL
            SELECT check_name, row_count
            FROM (UNPIVOT tables ON * INTO NAME check_name VALUE row_count)""",
        ),
        "normalize_metrics_dealt": _with(_TABLES, f"SELECT {_METRIC_COLUMNS} FROM metrics_v"),
        "load_twice": _with(
            _TABLES,
            """SELECT 'locations' AS table_name, count(*) AS first_load, CAST(0 AS BIGINT) AS second_load,
                count(*) AS key_count, count(*) AS row_count FROM locations
            UNION ALL SELECT 'restaurants', count(*), 0, count(*), count(*) FROM restaurants
            UNION ALL SELECT 'metrics', count(*), count(*), 2 * count(*), 2 * count(*) FROM metrics_v""",
        ),
        "restaurant_serials": _with(
            _LISTING,
            """SELECT row_number() OVER (ORDER BY name NULLS FIRST, address NULLS FIRST,
                phone NULLS FIRST, location NULLS FIRST, city NULLS FIRST) - 1 AS restaurant_no,
                name, address, phone, location, city AS "listed_in(city)"
            FROM (SELECT DISTINCT name, address, phone, location, city FROM listing)""",
        ),
        "fk_orphans": _with(
            _TABLES
            + """,
            kept_restaurants AS (SELECT * FROM restaurants WHERE name IS NULL OR name NOT IN
                (SELECT s_name FROM supplier WHERE s_acctbal < 0)),
            kept_locations AS (SELECT * FROM locations WHERE listed_in_city <> 'ASIA')""",
            """SELECT 'restaurants.location_id' AS foreign_key,
                count(DISTINCT location_id) AS orphan_keys, count(*) AS orphan_rows
            FROM kept_restaurants WHERE location_id NOT IN (SELECT location_id FROM kept_locations)
            UNION ALL
            SELECT 'metrics.restaurant_id', count(DISTINCT restaurant_id), count(*)
            FROM metrics_v
            WHERE restaurant_id NOT IN (SELECT restaurant_id FROM kept_restaurants)""",
        ),
        "delivery_summary": _with(
            _TABLES,
            f"""SELECT count(DISTINCT restaurant_id) AS total_restaurants,
                {_MEAN_COST} AS avg_approx_cost_for_two
            FROM metrics_v WHERE listed_in_type = 'Delivery'""",
        ),
        "online_order_by_city": _with(
            _TABLES,
            f"""SELECT listed_in_city AS city,
                CASE WHEN online_order THEN 'Yes' ELSE 'No' END AS online_order_status,
                {_MEAN_COST} AS avg_approx_cost_for_two,
                CAST(sum(votes) AS BIGINT) AS total_votes
            FROM star GROUP BY listed_in_city, online_order""",
        ),
        "top_neighborhoods": _with(
            _TABLES,
            f"""SELECT location_name AS neighborhood, {_MEAN_RATE} AS average_rating,
                count(DISTINCT restaurant_id) AS total_restaurants
            FROM star GROUP BY location_id, location_name
            HAVING sum(CAST(rate * 100 AS BIGINT)) > 395 * count(rate)
                AND count(DISTINCT restaurant_id) >= 3""",
        ),
        "pricing_tiers": _with(
            _TABLES
            + """,
            tiered AS (SELECT *, CASE WHEN approx_cost_two <= 500 THEN 'Budget'
                WHEN approx_cost_two < 1000 THEN 'Mid-Range' ELSE 'Premium' END AS pricing_tier
                FROM star WHERE approx_cost_two IS NOT NULL)""",
            f"""SELECT listed_in_city AS city, pricing_tier,
                count(DISTINCT restaurant_id) AS total_restaurants, {_MEAN_RATE} AS average_rating
            FROM tiered GROUP BY listed_in_city, pricing_tier""",
        ),
        "validate_valid": _with(_MESSAGES, "SELECT key, value FROM routed WHERE route = 'valid'"),
        "validate_errors": _with(_MESSAGES, "SELECT key, value FROM routed WHERE route = 'error'"),
        "validate_malformed": _with(
            _MESSAGES, "SELECT reason, value FROM routed WHERE route = 'malformed'"
        ),
        "validate_history": _with(
            _ORDERS,
            f"""SELECT restaurant_city, {money} AS total_city_revenue FROM orders_v
            WHERE (starts_with(phone_number, '+91') OR starts_with(phone_number, '080'))
                AND NOT (request_online AND request_table) AND abs(order_price - total) <= 0.01
            GROUP BY restaurant_city ORDER BY total_city_revenue DESC, restaurant_city LIMIT 20""",
        ),
        "validate_stream_route": _with(
            _MESSAGES,
            """SELECT route, count(*) AS message_count, count(key) AS key_count,
                CAST(sum(length(value)) AS BIGINT) AS value_length
            FROM routed GROUP BY route""",
        ),
        "geo_impossible": _with(_ALERTS, f"SELECT {alerts} FROM geo"),
        "velocity_spam": _with(_ALERTS, f"SELECT {alerts} FROM velocity"),
        "fraud_alerts_batch": _with(_ALERTS, f"SELECT {alerts} FROM alerts"),
        "fraud_alert_payload": _with(
            _ALERTS,
            """SELECT user_id AS key, '{"user_id":"' || user_id || '","alert_type":"' || alert_type
                || '","trigger_reason":"' || trigger_reason || '"}' AS value FROM alerts""",
        ),
        "fraud_alerts_stream": _with(_ALERTS, f"SELECT {alerts} FROM alerts"),
        "fraud_alerts_messages": _with(_SOUND_ALERTS, f"SELECT {alerts} FROM alerts"),
        "fraud_left_out": """SELECT reason, count(*) AS message_count FROM (
            SELECT CASE WHEN event_id % 13 = 1 THEN 'unreadable' WHEN event_id % 7 = 3 THEN 'no user'
                WHEN event_id % 11 = 5 THEN 'no time' END AS reason FROM events)
            WHERE reason IS NOT NULL GROUP BY reason""",
        "restaurant_dimension": _with(_DIMENSION, "SELECT * FROM dimension"),
        "restaurants_by_city": _with(
            _DIMENSION, "SELECT city, count(*) AS restaurant_count FROM dimension GROUP BY city"
        ),
        "popularity_rank": _with(
            _DIMENSION,
            """SELECT city, name,
                greatest(CAST(1.0 AS DOUBLE), rate) * greatest(1, votes) AS popularity,
                CAST(row_number() OVER (PARTITION BY city ORDER BY
                    greatest(CAST(1.0 AS DOUBLE), rate) * greatest(1, votes) DESC, name,
                    restaurant_id) AS INTEGER) AS place
            FROM dimension QUALIFY place <= 3""",
        ),
    }
