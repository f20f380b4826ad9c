"""Every table of the sales mart over the test tables, with an independent SQL statement for each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query
from bindings.staging import staging, table, with_staging
from tidemark.plans import access
from tidemark.plans.mart import mart_tables
from tidemark.plans.orders import order_validity
from tidemark.plans.recommendation import hits_of_property

AS_OF = dt.date(2025, 12, 31)

# The mart reads these names; notification tracking has its own carts and orders among the events.
RENAMED = {"Fact_Notification_Tracking": {"order": "event_order", "order_line": "event_order_line"}}


def mart(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    """A mart table made from the staging tables, with the mart tables it reads made in the same plan."""
    tables = mart_tables(AS_OF)
    names = RENAMED.get(target, {})

    def made(name: str) -> DataFrame:
        if name == "Fact_Order":
            # the only reader wants id, time and validity; a refresh reads the written table instead
            return order_validity(staging(spark, sf_dir, "order"))
        if name in tables:
            return mart(spark, sf_dir, name)
        return staging(spark, sf_dir, names.get(name, name))

    return tables[target].make(*[made(name) for name in tables[target].inputs])


def _register(key: str, target: str, used: list[str], sql: str, **ctes: str) -> None:
    query(key, with_staging(used, sql, **ctes))(lambda spark, sf_dir: mart(spark, sf_dir, target))


def _copy(key: str, target: str, source: str) -> None:
    _register(key, target, [source], f"SELECT * FROM st_{source}")


_copy("m01_dim_brand", "Dim_Brand", "brand")

# names by key, as the staging tables make them from regions and nations
NAMES = """
    SELECT (SELECT MAP_FROM_ENTRIES(LIST((r_regionkey, r_name))) FROM region) AS region,
      (SELECT MAP_FROM_ENTRIES(LIST((n_nationkey, n_name))) FROM nation) AS nation,
      (SELECT MAP_FROM_ENTRIES(LIST((n_nationkey, n_regionkey))) FROM nation) AS region_of"""

_register(
    "m02_dim_product",
    "Dim_Product",
    [],
    """
    SELECT p_partkey AS id, p_name AS name, CAST(p_size > 3 AS INT) AS active, 'SKU-' || p_partkey AS sku,
      CAST(p_partkey + 4000000 AS VARCHAR) AS ean, p_type AS product_type, LOWER(p_type) AS product_type_name, 1 AS product_type_active, p_size AS volume, measure
        AS volume_measure,
      IF(measure = '9LC', 0.11111111e0, 1e0) AS factor, CAST(p_size % 25 AS VARCHAR) AS country_id, p_size % 6 AS tier_iid,
      region[p_size % 6] AS tier_name, kind AS type, ['Product', 'Promotion'][kind] AS type_name,
      CAST(p_brand[7:] AS INT) AS brand_id, p_size AS sub_brand_id, nation[p_size] AS sub_brand_name,
      p_size % 7 AS segment_id, region[p_size % 7] AS segment_name, 'Segment ' || region[p_size % 7]
        AS segment_description,
      p_brand AS manufacturer, p_type || ' ' || p_name AS history, p_size * 2 AS quantity_per_case, 'EA' AS "primary_UOM",
      IF(p_size > 20, 'CS', NULL) AS "secondary_UOM", p_retailprice AS content, DATE '2020-01-01' + p_size AS start_date,
      DATE '2024-01-01' + p_size AS end_date, category AS category_id, nation[category] AS category_name,
      nation[category] || ' - ' || measure AS category_measure, IF(category IS NULL, NULL, 1) AS category_acive,
      super AS super_category_id, region[super] AS super_category_name, IF(super IS NULL, NULL, 1) AS super_category_active,
      IF(super < 2, 'Y', IF(super >= 2, 'N', NULL)) AS "super_category_9LC_calculation",
      'img/' || p_partkey AS image_url
    FROM (SELECT *, IF(p_size < 10, NULL, IF(p_size < 30, '9LC', 'L')) AS measure,
            IF(p_type = 'PROMO', 2, IF(p_type = 'SMALL', 3, 1)) AS kind, IF(p_size > 45, NULL, p_size % 10) AS category,
            IF(p_size > 45 OR p_size % 10 = 9, NULL, region_of[p_size % 10]) AS super
          FROM part, lookups)""",
    lookups=NAMES,
)

_copy("m03_dim_product_chain", "Dim_Product_Chain", "product_chain")
_copy("m04_dim_member", "Dim_Member", "member")

# Groups of channels and their channel ids.
CHANNEL_GROUPS = """
    SELECT UNNEST(ids) AS channel, name, place FROM (VALUES
      ([2, 9, 10, 11, 14, 16, 17, 18, 20, 21, 23, 24], 'On Trade', 1), ([1, 12, 15, 19, 22], 'Tradi Off.Trade', 2),
      ([4, 25], 'Tier-2 WHS', 3), ([13], 'Online sellers', 4)) AS groups(ids, name, place)"""

_register(
    "m05_dim_business",
    "Dim_Business",
    [],
    """
    SELECT c_custkey AS id, c_name AS name, k + 1 AS channel_id, 'Channel ' || nation[k] AS channel_name,
      'About ' || nation[k] AS channel_description, sub AS sub_channel_id, 'Sub ' || region[sub] AS sub_channel_name,
      'About ' || region[sub] AS sub_channel_description, COALESCE(g.name, 'OTHERS') AS channel_group,
      CAST(COALESCE(g.place, 5) AS INT) AS channel_group_order, k % 6 AS image_level_id, 'Level ' || region[k % 6]
        AS image_level_name,
      k AS city_id, 'City ' || nation[k] AS city_name, 'State ' || nation[k] AS state, CAST(k AS VARCHAR) AS country_id,
      k % 5 AS position_id, state_no AS active,
      MAP {-1: 'Pending', 0: 'Inactive', 1: 'Active', 2: 'Rejected', 3: 'Closed'}[state_no] AS business_status,
      1 AS reporting, born AS created_at, DATE '2025-01-01' + k AS updated_at,
      IF(c_acctbal < 500, NULL, DATE '2020-06-01' + k) AS first_order_date, last_order AS last_order_date,
      IF(k = 13, 'Z-' || c_mktsegment, NULL) AS business_type, 'INV' || c_custkey AS invitation_code,
      STRFTIME(born, 'R%Y-%m') AS registered_month,
      -- the fiscal year begins in July, so half a year on its quarters are those of the calendar
      'RFY' || (YEAR(born + INTERVAL 6 MONTH) - 2000) || '-Q' || QUARTER(born + INTERVAL 6 MONTH) AS registered_qtr,
      CAST(DATE '2025-12-31' - born AS INT) AS days_since_reg,
      CAST(DATE '2025-12-31' - last_order AS INT) AS days_since_last_order,
      CAST(state_no = 1 OR latest IS NOT NULL AS INT) AS active_new, born AS active_start_date,
      IF(state_no = 1, DATE '9999-12-31', LAST_DAY(latest)) AS active_end_date
    FROM (SELECT *, c_nationkey AS k, IF(c_acctbal < 0, NULL, c_nationkey % 7) AS sub,
            DATE '2019-01-01' + CAST(c_custkey % 2000 AS INT) AS born,
            IF(c_acctbal < 500, NULL, DATE '2025-06-01' + CAST(c_custkey % 100 AS INT)) AS last_order,
            CAST(LIST_FILTER([(0, -1), (2000, 0), (6000, 1), (8000, 2), (9500, 3), (1e9, 9)],
              lambda x: c_acctbal < x[1])[1][2] AS INT) AS state_no
          FROM customer, lookups)
    LEFT JOIN groups g ON g.channel = k + 1
    LEFT JOIN (SELECT o_custkey, CAST(MAX(o_orderdate) + INTERVAL 24 YEAR AS DATE) AS latest FROM orders GROUP BY ALL)
      ON o_custkey = c_custkey""",
    lookups=NAMES,
    groups=CHANNEL_GROUPS,
)

_register(
    "m06_dim_user",
    "Dim_User",
    ["user", "position"],
    """
    SELECT u.id, u.position_id, p.name AS position_name, u.country_id, u.sales_rep AS sales_rep_id, u.email, u.phone,
      u.push_notification, u.email_notification, u.sms_notification, u.whatsapp_notification, u.created_at,
      u.registration_date, u.last_login_date
    FROM st_user u LEFT JOIN st_position p ON u.position_id = p.id""",
)

_register(
    "m07_dim_sales_rep",
    "Dim_Sales_Rep",
    ["sales_rep"],
    """
    SELECT r.id, email, chain_id, name, last_name, CONCAT_WS(' ', name, last_name) AS sales_rep,
      IF(home IN (1, 2, 3), 'es-ES', 'en-US') AS language
    FROM st_sales_rep r
    -- a rep serves the customers of one nation and those with one last digit; 1 to 3 are the Spanish-speaking countries
    LEFT JOIN (SELECT id, MIN_BY(c_nationkey, c_custkey) AS home
               FROM (SELECT UNNEST([c_nationkey, c_custkey % 10]) AS id, c_nationkey, c_custkey FROM customer)
               GROUP BY id) h ON h.id = r.id""",
)

_register(
    "m08_dim_chain",
    "Dim_Chain",
    ["chain"],
    """SELECT id, name, active, country_id, prospects, chain_tier, chain_tier_description, created_at FROM st_chain""",
)

REP_BUSINESS = """
    SELECT s.sales_rep_id, s.business_id, r.chain_id,
      CAST(s.business_id AS VARCHAR) || '-' || CAST(r.chain_id AS VARCHAR) AS business_chain
    FROM st_sales_rep_business s LEFT JOIN st_sales_rep r ON s.sales_rep_id = r.id"""

_register("m09_dim_sales_rep_business", "Dim_Sales_Rep_Business", ["sales_rep_business", "sales_rep"], REP_BUSINESS)
_copy("m10_dim_distribution", "Dim_Distribution", "distribution")
_copy("m11_dim_member_chain", "Dim_Member_chain", "member_chain")

_register(
    "m12_dim_business_chain_user",
    "Dim_Business_Chain_User",
    ["sales_rep"],
    """
    SELECT c_custkey AS business_id, c_custkey % 10 AS chain_id, c_custkey + 7 AS user_id, 1 AS status,
      c_mktsegment AS role, c_custkey || '-' || c_custkey % 10 AS business_chain, served.id AS sales_rep_id,
      served.email AS sales_rep_email, served.full_name AS sales_rep
    FROM customer LEFT JOIN (
      SELECT c_custkey AS of_customer, r.id, r.email, CONCAT_WS(' ', r.name, r.last_name) AS full_name
      FROM (SELECT c_custkey, UNNEST([c_nationkey, c_custkey % 10]) AS rep FROM customer)
      JOIN st_sales_rep r ON r.id = rep AND r.chain_id = c_custkey % 10) served ON of_customer = c_custkey""",
)

_register(
    "m13_dim_chain_business",
    "Dim_Chain_Business",
    [],
    """
    SELECT chain_id, c_custkey AS business_id, CAST(business_type AS INT) AS business_type, code AS business_chain_code,
      business_type_description, c_name AS business_name, code || '-' || c_name AS business_code_name,
      chain_id || '|' || c_custkey AS chain_business, c_nationkey + 1 AS business_channel_id,
      'Channel ' || nation[c_nationkey] AS business_channel_name,
      'About ' || nation[c_nationkey] AS business_channel_description
    FROM (SELECT *, UNNEST([
        {chain_id: c_custkey % 10, business_type: IF(c_acctbal < 1000, NULL, 1), business_type_description: c_mktsegment,
          code: IF(c_acctbal < 2000, '0', 'K' || c_nationkey)},
        {chain_id: CAST(c_nationkey AS BIGINT), business_type: 2, business_type_description: 'Z-' || c_mktsegment,
          code: 'N' || c_nationkey}], recursive := true)
      FROM customer, lookups)""",
    lookups=NAMES,
)

_register(
    "m14_dim_country",
    "Dim_Country",
    [],
    """
    SELECT n_nationkey AS id, COALESCE(known.name, n_name) AS name, 1 AS active, 'logo/' || n_name AS app_logo,
      'C' || n_nationkey AS currency_code, 0 AS nps_min, 10 AS nps_max, 6 AS nps_yellow, 8 AS nps_green,
      known.code AS "country_code_GA", COALESCE(known.language, 'en-US') AS language,
      IF(n_nationkey = 1, 'M', 'K') AS "Unit_Measure_GMV",
      CAST(IF(n_nationkey = 1, 1e6, 1e3) AS INT) AS "Local_Currency_Divisor"
    FROM nation LEFT JOIN (VALUES (1, 'Colombia', NULL, 'es-ES'), (2, 'España', NULL, 'es-ES'),
      (3, 'Mexico', 'MX', 'es-ES'), (4, 'Singapore', 'SG', NULL)) AS known(id, name, code, language)
      ON known.id = n_nationkey""",
)

_copy("m15_dim_promo_channel", "Dim_Promo_Channel", "promo_channel")
_copy("m16_dim_promo_subchannel", "Dim_Promo_SubChannel", "promo_subchannel")
_copy("m17_dim_promo_image_level", "Dim_Promo_Image_Level", "promo_image_level")
_copy("m18_dim_promo_business", "Dim_Promo_Business", "promo_business")
_copy("m19_dim_promo_business_type", "Dim_Promo_Business_Type", "promo_business_type")

_register(
    "m20_promo_by_business",
    "Dim_Promo_by_Business",
    ["business", "promo_business", "promo_channel", "promo_subchannel"],
    """
    SELECT b.id AS business_id, COALESCE(b.channel_id, 0) AS channel_id, COALESCE(b.sub_channel_id, 0) AS sub_channel_id,
      COALESCE(k.product_id, 0) AS product_id
    FROM st_business b JOIN (SELECT DISTINCT p.product_id, owner.id FROM owner JOIN promo p USING (kind, key)) k ON b.id = k.id""",
    owner="""
        SELECT id, 'business' AS kind, id AS key FROM st_business
        UNION ALL SELECT id, 'channel', channel_id FROM st_business
        UNION ALL SELECT id, 'sub_channel', sub_channel_id FROM st_business""",
    promo="""
        SELECT 'business' AS kind, business_id AS key, product_id FROM st_promo_business
        UNION ALL SELECT 'channel', channel_id, product_id FROM st_promo_channel
        UNION ALL SELECT 'sub_channel', subchannel_id, product_id FROM st_promo_subchannel""",
)

PROMO_TYPE = """CASE WHEN COUNT(*) OVER (PARTITION BY promo_id) > 1 THEN 'Mixed Bundle' WHEN quantity > 1 THEN 'Multi Buy'
      ELSE 'Discount' END AS promo_type,
    CAST(ROW_NUMBER() OVER (PARTITION BY promo_id ORDER BY quantity DESC, product_id) AS INT) AS rn"""

_register(
    "m21_promo_product",
    "Dim_Promo_Product",
    ["promo_product"],
    f"SELECT *, {PROMO_TYPE} FROM st_promo_product",
)

# an order as it follows from orders, customers, suppliers and lines: a user is a customer, the rate of a month exists
# but in December, and a rep belongs to the chain of the last digit of the supplier's nation
FACT_ORDER = """
    SELECT o_orderkey AS id, 'C' || o_orderkey AS client_order_number, o_custkey % 10 AS chain_id,
      o_custkey AS business_id, o_custkey AS user_id, own_rep AS user_sales_rep_id, o_custkey % 100 AS distributor_id,
      CAST(o_custkey % 25 AS VARCHAR) AS country_id, state AS status,
      CAST(NOT STARTS_WITH(o_orderpriority, '5') AND NOT STARTS_WITH(o_orderpriority, '4') OR o_orderstatus IN ('F', 'O')
        AS INT) AS valid,
      made AS original_created_at, made AS created_at, made + INTERVAL 2 DAY AS updated_at, o_orderpriority AS observation,
      'u' || o_custkey AS updated_by, o_custkey AS customer, o_orderpriority[3:] AS day_of_preference,
      o_totalprice AS delivery_cost, (o_custkey % 25) || STRFTIME(made, '|%Y%m') AS key_rate,
      CASE WHEN MONTH(made) < 12 THEN o_custkey % 25 + 1e0 END AS rate, COALESCE(own_rep, chain_rep) AS sales_rep_id,
      o_custkey || '-' || o_custkey % 10 AS business_chain, lines AS total_lines, ROUND(kept, 2) AS total_amount,
      CASE WHEN lost_lines = lines THEN 'Total' WHEN lost_lines > 0 THEN 'Partial' END AS cancellation_status,
      lost_lines AS total_cancelled_lines, lost AS cancelled_amount, before AS previous_chain_business_order_date,
      CAST(CAST(made AS DATE) - CAST(before AS DATE) AS INT) AS days_from_last_order
    FROM (
      SELECT *, o_orderdate + INTERVAL 24 YEAR AS made,
        MAP {'F': 'delivered', 'O': 'open'}[o_orderstatus] AS settled,
        COALESCE(settled, MAP {'5-LOW': 'cancelled', '4-NOT SPECIFIED': 'not_approved'}[o_orderpriority], 'pending') AS state,
        -- the last of the customer's orders with a smaller key
        FIRST_VALUE(o_orderdate + INTERVAL 24 YEAR) OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC
          ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS before
      FROM orders)
    LEFT JOIN (
      SELECT c_custkey, ANY_VALUE(IF(c_acctbal < 4000, NULL, c_custkey % 50)) AS own_rep, MIN(s_suppkey) AS chain_rep
      FROM customer LEFT JOIN supplier
        ON s_suppkey IN (c_nationkey, c_custkey % 10) AND s_nationkey % 10 = c_custkey % 10
      GROUP BY c_custkey) ON c_custkey = o_custkey
    LEFT JOIN (
      SELECT l_orderkey, SUM(n) AS lines, SUM(IF(fate = 'RF', n, 0)) AS lost_lines, SUM(IF(fate = 'RF', worth, 0)) AS lost,
        SUM(IF(fate IN ('RF', 'RO', 'AF'), 0, worth)) AS kept
      FROM (SELECT l_orderkey, l_returnflag || l_linestatus AS fate, COUNT(*) AS n,
              SUM(l_quantity * l_extendedprice - l_discount) AS worth FROM lineitem GROUP BY ALL)
      GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""

query(
    "m22_fact_order",
    with_staging(
        [],
        """SELECT * REPLACE (ROUND(cancelled_amount, 2) AS cancelled_amount, CAST(total_lines AS BIGINT) AS total_lines,
          CAST(total_cancelled_lines AS BIGINT) AS total_cancelled_lines) FROM fact_order""",
        fact_order=FACT_ORDER,
    ),
)(lambda spark, sf_dir: _rounded(mart(spark, sf_dir, "Fact_Order"), "cancelled_amount"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Float sums differ in the last bits with the order of addition."""
    return df.withColumns({c: F.round(c, 2) for c in columns})


LINE_TABLES = ["order_line", "promo_product", "product"]
COMPONENTS = f"SELECT pp.*, {PROMO_TYPE} FROM st_promo_product pp JOIN st_product p ON pp.product_id = p.id"
# Every line stands once as sold and once for each component of its promotion, with the component's quantity as factor.
# Amounts go with the line as sold and with the first component.
FACT_ORDER_LINE = """
    SELECT line_number, id || COALESCE('/' || as_.rn, '') AS id_surrogate, as_.product AS product_id,
      as_.factor * current_quantity AS current_quantity,
      CASE WHEN as_.factor = 0 THEN 0 WHEN leads THEN current_unit_price / as_.factor END AS current_unit_price,
      delivery_date, invoice_number, status, excise, CAST(NOT dropped AS INT) AS valid,
      as_.factor * IF(dropped, 0, current_quantity) AS current_quantity_final,
      IF(leads, IF(dropped, 0, worth), NULL) AS line_amount,
      as_.factor * IF(status = 'cancelled', current_quantity, 0) AS cancelled_quantity,
      IF(leads, IF(status = 'cancelled', worth, 0), NULL) AS cancelled_amount,
      IF(status = 'cancelled', cancellation_id, NULL) AS cancellation_id, updated_at, updated_by, "order", country_id,
      IF(leads, uom, NULL) AS uom, id, observation, created_at, payment_date, invoice_date, IF(leads, discount, NULL)
        AS discount,
      IF(leads, taxes, NULL) AS taxes, presentation, presentation_quantity,
      CASE WHEN as_.factor = 0 THEN 0 WHEN leads THEN cost_per_unit / as_.factor END AS cost_per_unit,
      CAST(as_.rn IS NOT NULL AS INT) AS line_transformed,
      CASE WHEN as_.rn IS NOT NULL THEN 'Promo Normal Product' WHEN p_type = 'PROMO' THEN 'Promo Product'
        ELSE 'Normal Product' END AS product_flag,
      as_.rn AS promo_row, IF(as_.rn IS NULL, NULL, product_id) AS promo_id,
      IF(as_.rn IS NULL, NULL, as_.product) AS promo_product_id, as_.promo_type AS promo_type
    FROM (
      SELECT *, COALESCE(as_.rn, 1) = 1 AS leads FROM (
        SELECT l.*, p_type, CAST(o_custkey % 25 AS VARCHAR) AS country_id,
          IF(o_custkey % 25 <> 13, 1e0, IF(YEAR(created_at) > 2022, 1.08e0, 1.07e0)) AS excise,
          status IN ('cancelled', 'not_approved', 'returned') AS dropped,
          current_quantity * current_unit_price - discount AS worth,
          UNNEST(LIST_PREPEND({rn: CAST(NULL AS INT), product: product_id, factor: 1, promo_type: CAST(NULL AS VARCHAR)},
            COALESCE(parts, []))) AS as_
        FROM st_order_line l JOIN orders ON o_orderkey = "order"
        LEFT JOIN part ON p_partkey = product_id
        LEFT JOIN (
          SELECT promo_id, LIST({rn: rn, product: product_id, factor: quantity, promo_type: promo_type}) AS parts
          FROM components GROUP BY promo_id) b ON b.promo_id = product_id))"""
LINE_CTES = {"components": COMPONENTS}

_register("m23_fact_order_line", "Fact_Order_Line", LINE_TABLES, FACT_ORDER_LINE, **LINE_CTES)


_register(
    "m25_nps",
    "Fact_NPS_Result",
    [],
    """
    SELECT DATE '2024-01-01' AS survey_start_date, DATE '2024-01-31' AS survey_end_date, chain_id, business_id, score,
      -- nine and ten promote, seven and eight are passive
      ['Detractor', 'Passive', 'Promoter'][1 + CAST(score > 6 AS INT) + CAST(score > 8 AS INT)] AS category, date,
      country_id, order_id, comment, 'Chain ' || nation[chain_id] AS "WHS_name"
    FROM (SELECT CAST(user_id % 30 AS INT) AS chain_id, user_id AS business_id,
            CAST(LEAST(FLOOR(value / 5.5e0), 10) AS INT) AS score, CAST(ts AS DATE) AS date,
            CAST(user_id % 25 AS VARCHAR) AS country_id, event_id AS order_id, props AS comment FROM events), lookups
    WHERE score >= 1""",
    lookups=NAMES,
)

_register(
    "m26_fact_rate",
    "Fact_Rate",
    ["rate"],
    """
    SELECT id_country AS country_id, calendar_year, calendar_month, rate,
      id_country || '|' || CAST(calendar_year * 100 + calendar_month AS VARCHAR) AS key_rate FROM st_rate""",
)

_register(
    "m27_fact_target",
    "Fact_Target",
    [],
    """
    SELECT country_id, CAST(YEAR(first) AS INT) AS calendar_year, CAST(MONTH(first) AS INT) AS calendar_month, target,
      country_id || STRFTIME(first, '|%Y%m') AS key_rate, CAST(MONTH(first + INTERVAL 6 MONTH) AS INT) AS order_month,
      first AS "Fecha", rate, target * rate AS target_euros, CAST(STRFTIME(first, '%Y%m') AS INT) AS "Year_Month",
      CASE country_id WHEN '13' THEN 1.07e0 + 0.01e0 * CAST(YEAR(first) > 2022 AS INT) ELSE 1e0 END AS excise
    FROM (SELECT CAST(o_custkey % 25 AS VARCHAR) AS country_id,
            CAST(DATE_TRUNC('month', o_orderdate + INTERVAL 24 YEAR) AS DATE) AS first, COUNT(*) * 1e3 AS target,
            -- no rate is known for December
            IF(MONTH(ANY_VALUE(o_orderdate)) < 12, ANY_VALUE(o_custkey % 25) + 1e0, NULL) AS rate
          FROM orders GROUP BY 1, 2)""",
)

_register(
    "m28_notification",
    "Fact_Notification_Tracking",
    ["notification", "product", "cart", "cart_line", "event_order", "event_order_line"],
    """
    SELECT n.country, n.business_id AS business, n.chain, n.user_id, n.promotion_id,
      (SELECT name FROM st_product p WHERE p.id = n.promotion_id) AS product, n.configuration_id, n.created_at, n.sent_at,
      n.opened_at, IF(c.at > n.opened_at, c.at, NULL) AS add_to_cart_at,
      IF(c.at > n.opened_at AND o.at > c.at, o.at, NULL) AS bought_at
    FROM st_notification n
    LEFT JOIN last_event c ON c.kind = 'cart' AND c.key = (n.country, n.business_id, n.chain, n.user_id, n.promotion_id)
    LEFT JOIN last_event o ON o.kind = 'order' AND o.key = (n.country, n.business_id, n.chain, n.user_id, n.promotion_id)""",
    last_event="""
        SELECT kind, key, MAX(created_at) AS at FROM (
          SELECT 'cart' AS kind, (country_id, business, chain_id, user_id, product) AS key, created_at
          FROM st_cart JOIN st_cart_line ON id = cart
          UNION ALL
          SELECT 'order', (country_id, business, chain_id, user_id, product_id), created_at
          FROM st_event_order JOIN st_event_order_line ON id = "order")
        GROUP BY ALL""",
)

_copy("m29_analytics_search", "Fact_Analytics_Search", "analytics_search")
_copy("m30_sys_users", "Dim_Sys_Users", "sys_user")

_register(
    "m31_sys_users_chain",
    "Dim_Sys_Users_Chain",
    ["sys_user_chain", "sys_user"],
    """
    SELECT c.user_id AS sys_user, c.chain, u.email AS sys_user_email, c.country
    FROM st_sys_user_chain c JOIN st_sys_user u ON c.user_id = u.user_id""",
)

# what a supplier's account balance says about its role decides which nations it sees, beside the two it is listed for
USER_MEMBERS = """
    SELECT DISTINCT sys_user, seen.member AS member, sys_user_email, seen.country_id AS country_id
    FROM (
      SELECT s_suppkey AS sys_user, IF(s_acctbal < -500, 'invalid', LOWER(s_name) || '@bi.test') AS sys_user_email,
        UNNEST(LIST_CONCAT(
          [{member: s_nationkey, country_id: CAST(s_nationkey AS VARCHAR)},
           {member: CAST(s_suppkey % 25 AS INT), country_id: CAST(s_nationkey AS VARCHAR)}],
          LIST_TRANSFORM(
            LIST_FILTER(members, lambda m: s_acctbal >= -500 AND (s_acctbal < 2000 OR s_acctbal < 5000 AND m % 10 = s_nationkey)),
            lambda m: {member: m, country_id: CAST(m % 10 AS VARCHAR)}))) AS seen
      FROM supplier, (SELECT LIST(n_nationkey) AS members FROM nation))"""

_register("m32_user_members", "Dim_Sys_Users_Member", [], USER_MEMBERS)



@query(
    "j10_access_totals",
    with_staging(
        [],
        """
        SELECT sys_user, CAST(SUM(amount) AS BIGINT) AS amount, CAST(SUM(orders) AS BIGINT) AS orders
        FROM (SELECT DISTINCT sys_user, member FROM user_members)
        JOIN (SELECT o_custkey % 30 AS member, SUM(o_orderkey % 1000) AS amount, COUNT(*) AS orders FROM orders GROUP BY 1) USING (member)
        GROUP BY sys_user""",
        user_members=USER_MEMBERS,
    ),
)
def _access_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of all members a user sees, through scopes; the SQL goes through every user and member."""
    listed, users, members = (staging(spark, sf_dir, name) for name in ("user_member", "sys_user", "member"))
    facts = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey % 30 AS INT) AS member", "o_orderkey % 1000 AS amount", "CAST(1 AS BIGINT) AS orders"
    )
    scopes = access.user_scopes(listed, users, members)
    return access.totals_by_user(facts, scopes, members, "amount", "orders")


_register(
    "m33_user_category",
    "Dim_SysUser_ProductCategory",
    ["brand", "product"],
    """
    SELECT DISTINCT um.sys_user_email, um.sys_user, um.country_id, p.product_category_id
    FROM user_members um JOIN st_brand b ON um.member = b.member JOIN st_product p ON b.id = p.brand_id""",
    user_members=USER_MEMBERS,
)

_register(
    "m34_product_category", "Dim_Product_Category", ["product_category"], "SELECT id, name FROM st_product_category"
)
_copy("m35_stock", "Fact_Stock", "stock_level")
_copy("m36_cancellation_reason", "Dim_Cancellation_Reason", "cancellation_reason")

_register(
    "m37_member_business",
    "Dim_Member_Business",
    ["member_chain", "chain_business"],
    """
    SELECT member, business_id FROM st_member_chain m JOIN st_chain_business c ON m.chain = c.chain_id
    GROUP BY member, business_id""",
)

AS_SOLD = "lo.product_flag IN ('Normal Product', 'Promo Product') AND lo.valid = 1"

_register(
    "m38_found_line",
    "Fast_Order_Tracking_Found_line",
    ["found_line", "fast_order_tracking", *LINE_TABLES],
    f"""
    SELECT f.*, IF(EXISTS (SELECT 1 FROM st_fast_order_tracking t JOIN lines lo ON lo."order" = t."orderId"
        WHERE t.id = f."fastOrderTrackingId" AND lo.product_id = f."productId" AND {AS_SOLD}),
      'PURCHASE', 'NOT PURCHASE') AS product_purchase
    FROM st_found_line f
    WHERE f."productId" IS NOT NULL AND f."fastOrderTrackingId" IN (SELECT id FROM st_fast_order_tracking)""",
    **LINE_CTES,
    lines=FACT_ORDER_LINE,
)

_register(
    "m39_fast_order",
    "Fast_Order_Tracking",
    ["fast_order_tracking", "found_line", *LINE_TABLES],
    """
    SELECT t.*, IF(t."orderId" IS NULL, 'NO PURCHASE', 'PURCHASE') AS "RecommendationFunnel1",
      CASE (d.missed > 0, d.extra > 0) WHEN (FALSE, FALSE) THEN 'PERFECT_MATCH' WHEN (FALSE, TRUE) THEN 'ADD'
        WHEN (TRUE, FALSE) THEN 'DROP' WHEN (TRUE, TRUE) THEN 'PARTIAL_MATCH' END AS "RecommendationFunnel2",
      fo.created_at AS order_created_at, fo.valid AS order_valid
    FROM st_fast_order_tracking t LEFT JOIN fact_order fo ON fo.id = t."orderId"
    LEFT JOIN (SELECT oid, SUM(missed) AS missed, SUM(extra) AS extra FROM differences GROUP BY oid) d
      ON d.oid = t."orderId" """,
    **LINE_CTES,
    lines=FACT_ORDER_LINE,
    fact_order=FACT_ORDER,
    differences=f"""
        SELECT t."orderId" AS oid, 0 AS extra, CAST(f."productId" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lines lo
            WHERE lo."order" = t."orderId" AND lo.product_id = f."productId" AND {AS_SOLD}) AS INT) AS missed
        FROM st_fast_order_tracking t JOIN st_found_line f ON f."fastOrderTrackingId" = t.id
        UNION ALL BY NAME
        SELECT t."orderId" AS oid, 0 AS missed, CAST(lo.product_id IS NOT NULL AS INT) AS extra
        FROM st_fast_order_tracking t JOIN lines lo ON lo."order" = t."orderId"
        WHERE NOT ({AS_SOLD} AND EXISTS (SELECT 1 FROM st_found_line f
            WHERE f."fastOrderTrackingId" = t.id AND f."productId" = lo.product_id))""",
)

_copy("m40_not_found_line", "Fast_Order_Tracking_Not_Found_line", "not_found_line")

HOSTS = ["m.therou.example.com", "blog.ththan.example.net", "spam-farm.example.org"]


@query(
    "s13_hits_of_property",
    with_staging(
        ["hits"],
        """SELECT *, 1 AS "Enabled" FROM st_hits WHERE "WEB_PROPERTY_ID" = 'UA-1' AND ("HITS_PAGE_HOSTNAME" =
        'm.therou.example.com' OR "HITS_PAGE_HOSTNAME" = 'blog.ththan.example.net' OR "HITS_PAGE_HOSTNAME" =
        'spam-farm.example.org')""",
    ),
)
def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_of_property(staging(spark, sf_dir, "hits"), "UA-1", HOSTS)
