"""Staging tables of the mart and the reports, as views of the given test tables.

The texts use only what Spark SQL and DuckDB read alike, so that both sides of a check start from the same rows.
Names with blanks stand in double quotes. Each view is a projection of whole tables; none drops rows to get smaller.
"""

from __future__ import annotations

import re
from functools import cache, lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

BRAND_NO = "CAST(SUBSTRING(p_brand, 7) AS INT)"
EVENT_K = "CAST(REGEXP_EXTRACT(props, '([0-9]+)', 1) AS INT)"
ORDERED_AT = "o_orderdate + INTERVAL '24' YEAR"

STAGING: dict[str, str] = {
    # ---- catalogue
    "brand": f"SELECT DISTINCT {BRAND_NO} AS id, p_brand AS name, {BRAND_NO} - 1 AS member FROM part",
    "product": f"""
        SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size > 3 THEN 1 ELSE 0 END AS active,
          'SKU-' || CAST(p_partkey AS STRING) AS sku, CAST(p_partkey + 4000000 AS STRING) AS ean,
          p_type AS product_type, p_size AS volume,
          CASE WHEN p_size < 10 THEN NULL WHEN p_size < 30 THEN '9LC' ELSE 'L' END AS volume_measure,
          CAST(p_size % 25 AS STRING) AS country_id, p_size % 6 AS tier_iid, p_size % 7 AS segment_id,
          CASE WHEN p_type = 'PROMO' THEN 2 WHEN p_type = 'SMALL' THEN 3 ELSE 1 END AS type,
          {BRAND_NO} AS brand_id, p_size AS sub_brand_id,
          CASE WHEN p_size > 45 THEN NULL ELSE p_size % 10 END AS product_category_id,
          p_brand AS manufacturer, p_type || ' ' || p_name AS history, p_size * 2 AS quantity_per_case,
          'EA' AS "primary_UOM", CASE WHEN p_size > 20 THEN 'CS' END AS "secondary_UOM", p_retailprice AS content,
          DATE '2020-01-01' + p_size AS start_date, DATE '2024-01-01' + p_size AS end_date,
          'img/' || CAST(p_partkey AS STRING) AS image_url
        FROM part""",
    "product_type": "SELECT DISTINCT p_type AS id, LOWER(p_type) AS name, 1 AS active FROM part",
    "tier": "SELECT r_regionkey AS id, r_name AS name FROM region",
    "segment": "SELECT r_regionkey AS id, r_name AS name, 'Segment ' || r_name AS description FROM region",
    "sub_brand": "SELECT n_nationkey AS sub_brand_id, n_name AS sub_brand_name FROM nation",
    "product_category": """SELECT n_nationkey AS id, n_name AS name, 1 AS active,
        CASE WHEN n_nationkey = 9 THEN NULL ELSE n_regionkey END AS super_category_id FROM nation""",
    "super_category": """SELECT r_regionkey AS id, r_name AS name, 1 AS active,
        CASE WHEN r_regionkey < 2 THEN 1 ELSE 0 END AS include_in_lc_reports FROM region""",
    "product_chain": "SELECT p_partkey AS product_id, p_size % 10 AS chain_id, p_retailprice AS price FROM part",
    "stock_level": "SELECT p_partkey AS product_id, p_size % 10 AS chain_id, p_size * 3 AS units FROM part",
    # ---- places and people
    "member": "SELECT n_nationkey AS id, n_name AS name, CAST(n_nationkey % 10 AS STRING) AS country_id FROM nation",
    "country": """SELECT n_nationkey AS id,
          CASE n_nationkey WHEN 1 THEN 'Colombia' WHEN 2 THEN 'España' WHEN 3 THEN 'Mexico' WHEN 4 THEN 'Singapore'
            ELSE n_name END AS name,
          1 AS active, 'logo/' || n_name AS app_logo, 'C' || CAST(n_nationkey AS STRING) AS currency_code,
          0 AS nps_min, 10 AS nps_max, 6 AS nps_yellow, 8 AS nps_green FROM nation""",
    "chain": """SELECT n_nationkey AS id, 'Chain ' || n_name AS name, 1 AS active, n_regionkey AS country_id,
          n_nationkey * 10 AS prospects, n_regionkey AS chain_tier, 'Tier ' || CAST(n_regionkey AS STRING)
          AS chain_tier_description, DATE '2018-01-01' + n_nationkey AS created_at FROM nation""",
    "channel": """SELECT n_nationkey + 1 AS id, 'Channel ' || n_name AS name, 'About ' || n_name AS description
          FROM nation""",
    "sub_channel": "SELECT r_regionkey AS id, 'Sub ' || r_name AS name, 'About ' || r_name AS description FROM region",
    "image_level": "SELECT r_regionkey AS id, 'Level ' || r_name AS name FROM region",
    "city": "SELECT n_nationkey AS id, 'City ' || n_name AS name, 'State ' || n_name AS state FROM nation",
    "position": "SELECT r_regionkey AS id, 'Position ' || r_name AS name FROM region",
    "business": """
        SELECT c_custkey AS id, c_name AS name, c_nationkey + 1 AS channel_id,
          CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey % 7 END AS sub_channel_id,
          c_nationkey % 6 AS image_level_id, c_nationkey AS city_id, CAST(c_nationkey AS STRING) AS country_id,
          c_nationkey % 5 AS position_id,
          CASE WHEN c_acctbal < 0 THEN -1 WHEN c_acctbal < 2000 THEN 0 WHEN c_acctbal < 6000 THEN 1
            WHEN c_acctbal < 8000 THEN 2 WHEN c_acctbal < 9500 THEN 3 ELSE 9 END AS active,
          1 AS reporting, 'INV' || CAST(c_custkey AS STRING) AS invitation_code,
          DATE '2019-01-01' + CAST(c_custkey % 2000 AS INT) AS created_at,
          DATE '2025-01-01' + c_nationkey AS updated_at,
          CASE WHEN c_acctbal < 500 THEN NULL ELSE DATE '2020-06-01' + c_nationkey END AS first_order_date,
          CASE WHEN c_acctbal < 500 THEN NULL ELSE DATE '2025-06-01' + CAST(c_custkey % 100 AS INT) END
            AS last_order_date
        FROM customer""",
    "chain_business": """
        SELECT c_custkey % 10 AS chain_id, c_custkey AS business_id,
          CASE WHEN c_acctbal < 1000 THEN NULL ELSE 1 END AS business_type,
          c_mktsegment AS business_type_description,
          CASE WHEN c_acctbal < 2000 THEN NULL ELSE 'K' || CAST(c_nationkey AS STRING) END AS customer_chain_code
        FROM customer
        UNION ALL
        SELECT CAST(c_nationkey AS BIGINT), c_custkey, 2, 'Z-' || c_mktsegment, 'N' || CAST(c_nationkey AS STRING)
        FROM customer""",
    "user": """
        SELECT c_custkey AS id, c_nationkey % 6 AS position_id, CAST(c_nationkey AS STRING) AS country_id,
          CASE WHEN c_acctbal < 4000 THEN NULL ELSE c_custkey % 50 END AS sales_rep,
          LOWER(c_name) || '@shop.test' AS email, '555-' || CAST(c_custkey AS STRING) AS phone,
          1 AS push_notification, 0 AS email_notification, 1 AS sms_notification, 0 AS whatsapp_notification,
          DATE '2019-01-01' + CAST(c_custkey % 1000 AS INT) AS created_at,
          DATE '2019-02-01' + CAST(c_custkey % 1000 AS INT) AS registration_date,
          DATE '2025-02-01' + c_nationkey AS last_login_date
        FROM customer""",
    "sales_rep": """
        SELECT s_suppkey AS id, LOWER(s_name) || '@reps.test' AS email, CAST(s_nationkey % 10 AS BIGINT) AS chain_id,
          s_name AS name, CASE WHEN s_acctbal < 3000 THEN NULL ELSE 'of ' || CAST(s_nationkey AS STRING) END
          AS last_name
        FROM supplier""",
    "sales_rep_business": """
        SELECT CAST(c_nationkey AS BIGINT) AS sales_rep_id, c_custkey AS business_id FROM customer
        UNION ALL SELECT c_custkey % 10, c_custkey FROM customer""",
    "business_user": """
        SELECT c_custkey AS business, c_custkey % 10 AS chain, c_custkey + 7 AS "user", 1 AS status,
          c_mktsegment AS role FROM customer""",
    "distribution": "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS country_id FROM supplier",
    "member_chain": """
        SELECT n_nationkey AS member, CAST(n_nationkey % 10 AS BIGINT) AS chain FROM nation
        UNION ALL SELECT n_nationkey, CAST(n_nationkey AS BIGINT) FROM nation""",
    # ---- promotions
    "promo_product": f"""
        SELECT p_partkey AS promo_id, CAST(FLOOR(p_partkey / 2) AS BIGINT) AS product_id, p_size % 4 AS quantity
        FROM part WHERE p_type = 'PROMO'
        UNION ALL SELECT p_partkey, CAST(FLOOR(p_partkey / 3) AS BIGINT), p_size % 3
        FROM part WHERE p_type = 'PROMO' AND p_size > 15
        UNION ALL SELECT p_partkey, p_partkey + 1000000000000, 9
        FROM part WHERE p_type = 'PROMO' AND p_size > 35""",
    "promo_channel": f"""SELECT DISTINCT p_size % 25 + 1 AS channel_id, {BRAND_NO} AS product_id
        FROM part WHERE p_type = 'PROMO'""",
    "promo_subchannel": """SELECT DISTINCT p_size % 7 AS subchannel_id, 1000 + p_size AS product_id
        FROM part WHERE p_type = 'PROMO'""",
    "promo_image_level": """SELECT DISTINCT p_size % 5 AS image_level_id, p_size AS product_id
        FROM part WHERE p_type = 'PROMO'""",
    "promo_business": """SELECT o_custkey AS business_id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
        ELSE CAST(SUBSTRING(o_orderpriority, 1, 1) AS INT) END AS product_id FROM orders""",
    "promo_business_type": "SELECT c_mktsegment AS business_type, c_nationkey AS product_id FROM customer",
    # ---- orders
    "order": f"""
        SELECT o_orderkey AS id, 'C' || CAST(o_orderkey AS STRING) AS client_order_number, o_custkey % 10 AS chain_id,
          o_custkey AS business, o_custkey AS user_id, o_custkey % 100 AS distributor_id,
          CAST(o_custkey % 25 AS STRING) AS country_id,
          CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'open'
            WHEN o_orderpriority = '5-LOW' THEN 'cancelled'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'not_approved' ELSE 'pending' END AS status,
          {ORDERED_AT} AS original_created_at, {ORDERED_AT} AS created_at,
          {ORDERED_AT} + INTERVAL '2' DAY AS updated_at, o_orderpriority AS observation,
          'u' || CAST(o_custkey AS STRING) AS updated_by, o_custkey AS customer,
          SUBSTRING(o_orderpriority, 3) AS day_of_preference, o_totalprice AS delivery_cost
        FROM orders""",
    "order_line": """
        SELECT l_linenumber AS line_number, l_orderkey * 10 + l_linenumber AS id, l_partkey AS product_id,
          l_quantity AS current_quantity, l_extendedprice AS current_unit_price,
          l_shipdate + INTERVAL '24' YEAR AS delivery_date, 'I' || CAST(l_orderkey AS STRING) AS invoice_number,
          CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'cancelled'
            WHEN l_returnflag = 'R' THEN 'not_approved'
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'returned' ELSE 'open' END AS status,
          l_linenumber AS cancellation_id, l_shipdate + INTERVAL '24' YEAR AS updated_at,
          'u' || CAST(l_suppkey AS STRING) AS updated_by, l_orderkey AS "order",
          CASE WHEN l_quantity < 25 THEN 'EA' ELSE 'CS' END AS uom, l_linestatus AS observation,
          l_shipdate + INTERVAL '24' YEAR AS created_at, l_shipdate + INTERVAL '25' YEAR AS payment_date,
          l_shipdate + INTERVAL '24' YEAR AS invoice_date, l_discount AS discount, l_tax AS taxes,
          'P' || CAST(l_linenumber AS STRING) AS presentation, l_linenumber * 2 AS presentation_quantity,
          l_extendedprice AS cost_per_unit
        FROM lineitem""",
    "rate": f"""
        SELECT DISTINCT CAST(o_custkey % 25 AS STRING) AS id_country, CAST(YEAR({ORDERED_AT}) AS INT)
          + CASE WHEN MONTH({ORDERED_AT}) = 12 THEN 100 ELSE 0 END AS calendar_year,
          CAST(MONTH({ORDERED_AT}) AS INT) AS calendar_month, CAST(o_custkey % 25 + 1 AS DOUBLE) AS rate
        FROM orders""",
    "target": f"""
        SELECT CAST(o_custkey % 25 AS STRING) AS id_country, CAST(YEAR({ORDERED_AT}) AS INT) AS calendar_year,
          CAST(MONTH({ORDERED_AT}) AS INT) AS calendar_month, CAST(COUNT(*) * 1000 AS DOUBLE) AS target
        FROM orders GROUP BY 1, 2, 3""",
    "cancellation_reason": """SELECT DISTINCT l_linenumber AS id, l_returnflag || l_linestatus AS name
        FROM lineitem WHERE l_returnflag = 'R'""",
    # ---- surveys, notifications, searches
    "nps": """
        SELECT DATE '2024-01-01' AS survey_start_date, DATE '2024-01-31' AS survey_end_date,
          CAST(user_id % 30 AS INT) AS chain_id, user_id AS business_id,
          CASE WHEN value >= 55 THEN 10 ELSE CAST(FLOOR(value / 5.5e0) AS INT) END AS score, CAST(ts AS DATE) AS date,
          CAST(user_id % 25 AS STRING) AS country_id, event_id AS order_id, props AS comment FROM events""",
    "notification": f"""
        SELECT CAST(user_id % 5 AS INT) AS country, user_id AS business_id, CAST(user_id % 10 AS INT) AS chain, user_id,
          CAST(FLOOR({EVENT_K} / 10) AS BIGINT) AS promotion_id, {EVENT_K} AS configuration_id, ts AS created_at,
          ts + INTERVAL '1' HOUR AS sent_at, CASE WHEN value < 5 THEN NULL ELSE ts + INTERVAL '2' HOUR END AS opened_at
        FROM events WHERE event_type = 'view'""",
    "cart": """SELECT event_id AS id, CAST(user_id % 5 AS INT) AS country_id, user_id, user_id AS business,
          CAST(user_id % 10 AS INT) AS chain_id, ts AS created_at FROM events WHERE event_type = 'click'""",
    "cart_line": f"""SELECT event_id AS cart, CASE WHEN {EVENT_K} < 5 THEN NULL
          ELSE CAST(FLOOR({EVENT_K} / 10) AS BIGINT) END AS product FROM events WHERE event_type = 'click'""",
    "event_order": """SELECT event_id AS id, CAST(user_id % 5 AS INT) AS country_id, user_id, user_id AS business,
          CAST(user_id % 10 AS INT) AS chain_id, ts AS created_at FROM events WHERE event_type = 'purchase'""",
    "event_order_line": f"""SELECT CAST(FLOOR({EVENT_K} / 10) AS BIGINT) AS product_id, event_id AS "order"
          FROM events WHERE event_type = 'purchase'""",
    "analytics_search": """SELECT page_id AS id, url AS query, '2024-01-0' || CAST(page_id % 9 + 1 AS STRING) || ' 10:00:00'
          AS created_at FROM pages""",
    "hits": """
        SELECT page_id AS "VISITSTARTTIME", CAST(LENGTH(html) AS INT) AS "TOTALS_TIMEONSITE",
          REGEXP_EXTRACT(url, '://([^/]+)', 1) AS "HITS_PAGE_HOSTNAME",
          CASE WHEN url LIKE 'https%' THEN 'UA-1' ELSE 'UA-2' END AS "WEB_PROPERTY_ID" FROM pages""",
    # ---- access
    "sys_user": """
        SELECT s_suppkey AS user_id, CASE WHEN s_acctbal < -500 THEN 'invalid' ELSE LOWER(s_name) || '@bi.test' END
          AS email,
          CASE WHEN s_acctbal < 1000 THEN 'ADMIN' WHEN s_acctbal < 2000 THEN 'GLOBAL_REPORT'
            WHEN s_acctbal < 3500 THEN 'COUNTRY_ADMIN' WHEN s_acctbal < 5000 THEN 'COUNTRY_MANAGER_ADMIN'
            ELSE 'REP' END AS role,
          CAST(s_nationkey AS STRING) AS country_id FROM supplier""",
    "sys_user_chain": """SELECT s_suppkey AS user_id, s_nationkey AS chain, CAST(s_nationkey AS STRING) AS country
          FROM supplier UNION ALL SELECT s_suppkey + 3, s_nationkey, 'x' FROM supplier""",
    "user_member": """SELECT s_suppkey AS sys_user, s_nationkey AS member FROM supplier
          UNION ALL SELECT s_suppkey, CAST(s_suppkey % 25 AS INT) FROM supplier""",
    # ---- recommendations
    "fast_order_tracking": """
        SELECT o_orderkey * 2 AS id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS "orderId",
          o_custkey AS business_id FROM orders
        UNION ALL SELECT o_orderkey * 2 + 1, o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "found_line": """
        SELECT CASE WHEN l_quantity > 3 THEN l_orderkey * 2 ELSE -l_orderkey END AS "fastOrderTrackingId",
          CASE WHEN l_quantity > 48 THEN l_partkey + 1000000 ELSE l_partkey END AS "productId",
          l_suppkey AS position FROM lineitem
        UNION ALL
        SELECT l_orderkey * 2 + 1, CASE WHEN l_tax > 0.07 THEN NULL ELSE l_partkey END, l_suppkey
        FROM lineitem WHERE l_returnflag = 'N'""",
    "not_found_line": """SELECT l_orderkey * 2 AS "fastOrderTrackingId", l_partkey + 1000000 AS "productId"
          FROM lineitem""",
    # ---- ratings and planner
    "viewing": """
        SELECT CAST(YEAR(ts) AS STRING) AS year, CAST(MONTH(ts) AS STRING) AS month, CAST(DAY(ts) AS STRING) AS day,
          CAST(HOUR(ts) AS STRING) AS hour, CAST(MINUTE(ts) AS STRING) AS minute, event_type AS channel,
          'n-' || event_type AS channel_number, 'city' AS location,
          CASE WHEN value < 1 THEN NULL ELSE value END AS mac_addr_channel,
          (user_id % 5 + 1) / 7.0e0 AS location_weight, user_id % 4 AS deco_count FROM events""",
    "rating_request": f"""
        SELECT DISTINCT CAST(YEAR(t) AS STRING) AS year, CAST(MONTH(t) AS STRING) AS month, CAST(DAY(t) AS STRING) AS day,
          CAST(HOUR(t) AS STRING) AS hour, CASE WHEN k = 1 THEN 'none' ELSE CAST(MINUTE(t) AS STRING) END AS minute,
          channel_number
        FROM (SELECT ts + INTERVAL '1' HOUR AS t, 'n-' || event_type AS channel_number, {EVENT_K} AS k FROM events
              UNION ALL
              SELECT ts, CASE WHEN value < 2 THEN NULL ELSE 'n-' || event_type END, 0 FROM events) b""",
    "main_table": f"""
        SELECT CAST(CAST(ts AS DATE) AS STRING) AS fecha, event_type AS channel,
          DATE_TRUNC('hour', ts) AS timestamp_from,
          CASE WHEN {EVENT_K} = 7 THEN DATE_TRUNC('hour', ts) ELSE DATE_TRUNC('hour', ts) + INTERVAL '45' MINUTE END
            AS timestamp_to,
          'Show ' || CAST({EVENT_K} AS STRING) AS epg_title, user_id AS id_location,
          value AS cable_box_action, {EVENT_K} % 3 AS cable_box_count FROM events""",
    "sociodemographic": """
        SELECT c_custkey AS id_location, c_mktsegment AS age_group,
          CASE WHEN c_acctbal < 2000 THEN 'Bajo' WHEN c_acctbal < 6000 THEN 'Medio' ELSE 'Alto' END AS social_class,
          CASE WHEN c_nationkey < 12 THEN '1' ELSE '2' END AS sex, (c_nationkey + 1) / 32.0e0 AS probability_factor
        FROM customer""",
    # ---- audits
    "accounts": """
        SELECT 'A' || CAST(c_custkey AS STRING) AS "Account 18 ID",
          CASE WHEN c_acctbal < -500 THEN NULL ELSE c_name END AS "Account Name",
          'Owner ' || CAST(c_nationkey AS STRING) AS "Owner: Full Name", c_mktsegment AS "Channel",
          'Region ' || CAST(c_nationkey % 5 AS STRING) AS "Region",
          'Territory ' || CAST(c_nationkey AS STRING) AS "Territory: Territory Name",
          CAST(c_custkey % 10 AS STRING) AS "Chain", c_mktsegment AS "Taxonomy Level 1",
          CASE WHEN c_acctbal < 3000 THEN 'weekly' ELSE 'monthly' END AS "Visit Frequency: Visit Frequency Name",
          'KAM ' || CAST(c_nationkey % 3 AS STRING) AS "Key Account Manager: Full Name",
          'Class ' || SUBSTRING(c_mktsegment, 1, 1) AS "Outlet Classification",
          'Group ' || SUBSTRING(c_mktsegment, 1, 2) AS "PRS Group Outlet Type (EU) name",
          'Type ' || SUBSTRING(c_mktsegment, 1, 3) AS "PRS Outlet Type (EU) name",
          CASE WHEN c_acctbal > 9000 THEN NULL ELSE 'silver' END AS "PRS Image Level Name",
          CASE WHEN c_acctbal > 5000 THEN 'high' ELSE 'low' END AS "PRS Volume Potential Name"
        FROM customer""",
    "role_map": """
        SELECT 'Owner ' || CAST(n_nationkey + 2 AS STRING) AS "Account Owner/Sales Rep",
          'Director ' || CAST(n_regionkey AS STRING) AS "Area Sales Director",
          CASE WHEN n_regionkey = 4 THEN NULL ELSE 'Manager ' || CAST(n_nationkey AS STRING) END
            AS "Account Owner Manager/Sales Manager" FROM nation""",
    "audits": """
        SELECT 'A' || CAST(o_custkey * 2 AS STRING) AS "Account 18 ID",
          CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T08:30:00' AS "Audit Datetime" FROM orders""",
    "exclusions": """SELECT 'A' || CAST(c_custkey AS STRING) AS "Account Id",
          CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS "Exclude" FROM customer
        UNION ALL SELECT 'A' || CAST(c_custkey AS STRING), 1 FROM customer WHERE c_acctbal < -800""",
    # ---- workbooks, comments, logs
    "workbook": """
        SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Executive Director' WHEN '2-HIGH' THEN 'Manager'
            WHEN '3-MEDIUM' THEN 'Unknown' WHEN '4-NOT SPECIFIED' THEN NULL
            ELSE CASE WHEN o_orderstatus = 'P' THEN 'Intern (CS)' ELSE 'Staff' END END AS "Rank",
          CASE WHEN o_orderstatus = 'O' THEN 'General' ELSE 'Client' END AS "Activity Code Description",
          CAST(o_custkey % 9 AS DOUBLE) AS "Charged Hours", o_totalprice AS "NSR",
          CAST(o_orderkey % 7 AS DOUBLE) AS "ANSR", o_orderkey AS "Entry",
          'book_' || o_orderstatus || '.xlsx' AS "File Name" FROM orders""",
    "comments": """
        SELECT d.doc_id AS id, CAST(COALESCE(l.quality + 2 * l.toxic, 4) AS STRING) AS score, d.text AS comment
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        UNION ALL SELECT doc_id + 1000000000000, CAST(quality + 8 * toxic AS STRING), CASE WHEN quality = 1 THEN ' NA ' ELSE '??' END
        FROM labels
        UNION ALL SELECT item_id + 2000000000000, 'n/a', text FROM benchmark""",
    "weblog": """
        SELECT DATE '2023-06-01' + CAST(page_id % 28 AS INT) AS "Date", '0' || CAST(page_id % 10 AS STRING) || ':00:00' AS "Time",
          '10.0.0.1' AS "ServerIP", CASE WHEN url LIKE '%utm_source%' THEN 'POST' ELSE 'GET' END AS "Method",
          REGEXP_EXTRACT(url, '://[^/]+(/[^?#]*)', 1) || CASE WHEN url LIKE '%#top' THEN '' ELSE '.aspx' END AS "UriStem",
          CASE WHEN url LIKE '%?%' THEN REGEXP_EXTRACT(url, '[?]([^#]*)', 1) ELSE '-' END AS "UriQuery", '443' AS "Port", '-' AS "UserName",
          CASE WHEN url LIKE '%spam-farm%' THEN '-' WHEN page_id % 5 = 2 THEN '2001:DB8:' || CAST(page_id % 40 AS STRING) || ':'
              || CAST(page_id % 9 * 1111 AS STRING) || '::' || CAST(page_id % 1000 AS STRING)
            ELSE CAST(page_id % 220 AS STRING) || '.' || CAST(page_id % 256 AS STRING)
            || '.' || CAST(page_id % 50 AS STRING) || '.7' END AS "ClientIP",
          CASE page_id % 9
            WHEN 0 THEN 'Mozilla/5.0+(Windows+NT+10.0;+Win64;+x64)+AppleWebKit/537.36+Chrome/114.0+Safari/537.36'
            WHEN 1 THEN 'Mozilla/5.0+(iPhone;+CPU+iPhone+OS+16_5)+AppleWebKit/605.1+Version/16.5+Mobile/15E148+Safari/604.1'
            WHEN 2 THEN 'Mozilla/5.0+(Linux;+Android+13;+SM-S901B)+AppleWebKit/537.36+Chrome/112.0+Mobile+Safari/537.36'
            WHEN 3 THEN 'Mozilla/5.0+(compatible;+Googlebot/2.1)'
            WHEN 4 THEN 'Mozilla/5.0+(Macintosh;+Intel+Mac+OS+X+10_15)+AppleWebKit/605.1+Version/16.4+Safari/605.1'
            WHEN 5 THEN 'Mozilla/5.0+(X11;+Ubuntu;+Linux+x86_64;+rv:109.0)+Gecko/20100101+Firefox/114.0'
            WHEN 6 THEN 'Mozilla/5.0+(Windows+NT+10.0)+AppleWebKit/537.36+Chrome/114.0+Safari/537.36+Edg/114.0'
            WHEN 7 THEN 'Mozilla/5.0+(iPad;+CPU+OS+16_5)+AppleWebKit/605.1+Version/16.5+Mobile/15E148+Safari/604.1'
            ELSE 'Bingpreview/1.0' END AS "UserAgent",
          CASE WHEN url LIKE '%?page=%' THEN '-' ELSE 'https://example.test/' END AS "Referer",
          CASE LENGTH(html) % 5 WHEN 0 THEN '404' WHEN 1 THEN '204' WHEN 2 THEN '-' ELSE '200' END AS "HttpStatus",
          '0' AS "Substatus", '0' AS "Win32Status", CAST(LENGTH(html) % 50 AS STRING) AS "TimeTaken"
        FROM pages""",
    # IPv4 ends as numbers, IPv6 ends as text
    "ip_blocks": """
        SELECT CAST(CAST(n_nationkey * 8 + 1 AS BIGINT) * 16777216 AS STRING) AS start_ip,
          CAST(CAST(n_nationkey * 8 + 5 AS BIGINT) * 16777216 - 1 AS STRING) AS end_ip, n_name AS "Country",
          'Region, ' || n_name AS "Region", CAST(n_nationkey + 0.5e0 AS STRING) AS "Latitude",
          CAST(n_nationkey - 30 AS STRING) AS "Longitude" FROM nation
        UNION ALL
        SELECT '2001:db8:' || CAST(n_nationkey AS STRING) || '::', '2001:db8:' || CAST(n_nationkey AS STRING) || ':7fff:ffff:ffff:ffff:ffff',
          n_name, 'Net, ' || n_name, CAST(n_nationkey + 0.25e0 AS STRING), CAST(n_nationkey + 30 AS STRING) FROM nation""",
}


@cache
def _sources(name: str) -> tuple[str, ...]:
    words = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", STAGING[name]))
    return tuple(sorted(words & set(TABLES)))


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given test tables; its files are listed and its schema is read once per session."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=256)
def staging(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A staging table for Spark. Only its plan is kept, no rows."""
    text = STAGING[name]
    inputs = {source: table(spark, sf_dir, source) for source in _sources(name)}
    for source in inputs:
        text = re.sub(rf"\b(FROM|JOIN)\s+{source}\b", rf"\1 {{{source}}}", text)
    return spark.sql(text.replace('"', "`"), **inputs)


def with_staging(names: list[str], sql: str, **ctes: str) -> str:
    """DuckDB text: the named staging tables as ``st_<name>`` and further CTEs in front of a statement."""
    views = [f"st_{name} AS ({STAGING[name]})" for name in names]
    views += [f"{name} AS ({body})" for name, body in ctes.items()]
    return f"WITH {', '.join(views)} {sql}" if views else sql
