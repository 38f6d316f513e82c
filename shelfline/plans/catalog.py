"""Registry of query keys -> Spark plan ``(spark, sf_dir) -> DataFrame`` and
the DuckDB oracle SQL computing the same rows from the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.operators import (evals, grid, inventory, memory, metrics, promo, retrieval, share,
                                 text, traces)
from shelfline.operators.windows import trailing_weeks
from shelfline.oracle import WS, sql
from shelfline.plans import dashboard
from shelfline.plans.model import Model
from shelfline.sources import seed, sinks
from shelfline.sources import views as V
from shelfline.sources.tables import Tables, read_named, table_path
from shelfline.streaming import sync

QUERIES: dict = {}
ORACLE: dict = {}
FLAGSHIP = "dashboard_payload"

# Fixed query parameters (names present at every scale factor).
PRODUCT_NAME = "red widget"
SHARE_BRAND, SHARE_CATEGORY = "Brand#1", "ECONOMY"


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def ratio(num: str, den: str, scale: int) -> str:
    """SQL twin of ``columns.safe_ratio``."""
    return (f"CAST(ROUND(CAST(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) "
            f"AS DECIMAL(18,9)), {scale}) AS DOUBLE)")


RECENT_13 = "week_ending >= (SELECT MAX(week_ending) FROM v_sales) - INTERVAL 13 WEEKS"

# ---------------------------------------------------------------- metrics (F)


@register("sales_by_category", sql("""
    SELECT p.category, CAST(ROUND(SUM(s.pos_revenue), 0) AS DOUBLE) AS revenue
    FROM v_sales s JOIN v_products p ON s.product_id = p.product_id
    GROUP BY p.category ORDER BY 2 DESC""", "v_sales", "v_products"))
def _sales_by_category(spark, sf):
    return metrics.sales_by_category(Model(spark, sf).sales(), V.products(spark, sf))


@register("top_retailers", sql("""
    SELECT r.retailer_name, CAST(ROUND(SUM(s.pos_revenue), 0) AS DOUBLE) AS revenue
    FROM v_sales s JOIN v_retailers r ON s.retailer_id = r.retailer_id
    GROUP BY r.retailer_name ORDER BY 2 DESC, 1 LIMIT 8""", "v_sales", "v_retailers"))
def _top_retailers(spark, sf):
    return metrics.top_retailers(Model(spark, sf).sales(), V.retailers(spark, sf), 8)


@register("trailing_13w", sql(f"""
    SELECT COUNT(DISTINCT week_ending) AS weeks,
           CAST(ROUND(SUM(pos_revenue), 0) AS DOUBLE) AS revenue,
           CAST(SUM(units_sold) AS BIGINT) AS units
    FROM v_sales WHERE {RECENT_13}""", "v_sales"))
def _trailing_13w(spark, sf):
    m = Model(spark, sf)
    recent = trailing_weeks(m.sales(), "week_ending", 13, m.max_of("sales", "week_ending"))
    return recent.agg(F.countDistinct("week_ending").alias("weeks"),
                      F.round(F.sum("pos_revenue"), 0).cast("double").alias("revenue"),
                      F.sum("units_sold").cast("bigint").alias("units"))


@register("revenue_trend", sql("""
    SELECT CAST(week_ending AS VARCHAR) AS week, CAST(ROUND(SUM(pos_revenue), 0) AS DOUBLE) AS revenue
    FROM v_sales
    WHERE week_ending >= (SELECT MAX(week_ending) FROM v_sales) - INTERVAL 26 WEEKS
    GROUP BY week_ending ORDER BY 1""", "v_sales"))
def _revenue_trend(spark, sf):
    m = Model(spark, sf)
    return metrics.revenue_trend(m.sales(), 26, m.max_of("sales", "week_ending"))


@register("kpi_cards", sql(f"""
    WITH k AS (SELECT COALESCE(CAST(ROUND(SUM(pos_revenue), 0) AS DOUBLE), 0) AS revenue,
                      COALESCE(CAST(SUM(units_sold) AS BIGINT), 0) AS units
               FROM v_sales WHERE {RECENT_13})
    SELECT 1 AS ord, 'Sell-out revenue (13 wk)' AS label,
           '$' || format('{{:,}}', CAST(revenue AS BIGINT)) AS value FROM k
    UNION ALL SELECT 2, 'Units sold (13 wk)', format('{{:,}}', units) FROM k
    UNION ALL SELECT 3, 'Promotions w/ negative ROI', CAST(COUNT(*) AS VARCHAR)
              FROM v_promos WHERE roi < 0
    UNION ALL SELECT 4, 'Active SKUs', CAST(COUNT(*) AS VARCHAR) FROM v_products
    UNION ALL SELECT 5, 'Retail accounts', CAST(COUNT(*) AS VARCHAR) FROM v_retailers""",
                              "v_sales", "v_promos", "v_products", "v_retailers"))
def _kpi_cards(spark, sf):
    return dashboard.kpi_cards(spark, sf)


@register("dashboard_payload", sql(f"""
    WITH k AS (SELECT COALESCE(CAST(ROUND(SUM(pos_revenue), 0) AS DOUBLE), 0) AS revenue,
                      COALESCE(CAST(SUM(units_sold) AS BIGINT), 0) AS units
               FROM v_sales WHERE {RECENT_13}),
    trend AS (SELECT CAST(week_ending AS VARCHAR) AS week,
                     CAST(ROUND(SUM(pos_revenue), 0) AS DOUBLE) AS revenue
              FROM v_sales
              WHERE week_ending >= (SELECT MAX(week_ending) FROM v_sales) - INTERVAL 26 WEEKS
              GROUP BY week_ending),
    roi AS (SELECT promo_type, {ratio("SUM(roi)", "COUNT(*)", 3)} AS avg_roi, COUNT(*) AS n
            FROM v_promos GROUP BY promo_type),
    cat AS (SELECT p.category, CAST(ROUND(SUM(s.pos_revenue), 0) AS DOUBLE) AS revenue
            FROM v_sales s JOIN v_products p ON s.product_id = p.product_id GROUP BY p.category),
    ret AS (SELECT r.retailer_name, CAST(ROUND(SUM(s.pos_revenue), 0) AS DOUBLE) AS revenue
            FROM v_sales s JOIN v_retailers r ON s.retailer_id = r.retailer_id
            GROUP BY r.retailer_name ORDER BY 2 DESC, 1 LIMIT 8),
    shr AS (SELECT brand, {ratio("SUM(dollar_share_pct)", "COUNT(*)", 2)} AS share
            FROM v_market_share WHERE month = (SELECT MAX(month) FROM v_market_share)
            GROUP BY brand ORDER BY 2 DESC, 1 LIMIT 10)
    SELECT 'kpis' AS tile, 1 AS ord, 'revenue_13w' AS label, CAST(revenue AS DOUBLE) AS value FROM k
    UNION ALL SELECT 'kpis', 2, 'units_13w', CAST(units AS DOUBLE) FROM k
    UNION ALL SELECT 'kpis', 3, 'negative_roi_promos', CAST(COUNT(*) AS DOUBLE) FROM v_promos WHERE roi < 0
    UNION ALL SELECT 'kpis', 4, 'active_skus', CAST(COUNT(*) AS DOUBLE) FROM v_products
    UNION ALL SELECT 'kpis', 5, 'retail_accounts', CAST(COUNT(*) AS DOUBLE) FROM v_retailers
    UNION ALL SELECT 'revenue_trend', CAST(ROW_NUMBER() OVER (ORDER BY week) AS INTEGER), week, revenue FROM trend
    UNION ALL SELECT 'roi_by_type', CAST(ROW_NUMBER() OVER (ORDER BY promo_type) AS INTEGER), promo_type, avg_roi FROM roi
    UNION ALL SELECT 'roi_counts', CAST(ROW_NUMBER() OVER (ORDER BY promo_type) AS INTEGER), promo_type, CAST(n AS DOUBLE) FROM roi
    UNION ALL SELECT 'sales_by_category', CAST(ROW_NUMBER() OVER (ORDER BY revenue DESC, category) AS INTEGER), category, revenue FROM cat
    UNION ALL SELECT 'top_retailers', CAST(ROW_NUMBER() OVER (ORDER BY revenue DESC, retailer_name) AS INTEGER), retailer_name, revenue FROM ret
    UNION ALL SELECT 'share_by_brand', CAST(ROW_NUMBER() OVER (ORDER BY share DESC, brand) AS INTEGER), brand, share FROM shr""",
                                      "v_sales", "v_promos", "v_products", "v_retailers",
                                      "v_market_share"))
def _dashboard_payload(spark, sf):
    return dashboard.dashboard_payload(spark, sf)


def _series_sql(tile: str, values: str = "values", kind: str = "DECIMAL(38,0)") -> str:
    labels = "string_agg(CAST(to_json(label) AS VARCHAR), ',' ORDER BY ord)"
    numbers = f"string_agg(CAST(CAST(value AS {kind}) AS VARCHAR), ',' ORDER BY ord)"
    return (f"(SELECT '{{\"labels\":[' || coalesce({labels}, '') || '],\"{values}\":[' || coalesce({numbers}, '') || ']' "
            f"FROM p WHERE tile = '{tile}')")


@register("dashboard_json", f"""
    WITH p AS MATERIALIZED ({ORACLE["dashboard_payload"]}),
    k AS ({ORACLE["kpi_cards"]})
    SELECT '{{"kpis":[' || (SELECT string_agg('{{"label":' || CAST(to_json(label) AS VARCHAR) || ',"value":'
                            || CAST(to_json(value) AS VARCHAR) || '}}', ',' ORDER BY ord) FROM k) || '],'
           || '"revenue_trend":' || {_series_sql("revenue_trend")} || '}},'
           || '"roi_by_type":' || {_series_sql("roi_by_type", "avg_roi", "DECIMAL(18,3)")} || ',"counts":['
           || (SELECT coalesce(string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY ord), '') FROM p
               WHERE tile = 'roi_counts') || ']}},'
           || '"sales_by_category":' || {_series_sql("sales_by_category")} || '}},'
           || '"top_retailers":' || {_series_sql("top_retailers")} || '}},'
           || '"share_by_brand":' || {_series_sql("share_by_brand", kind="DECIMAL(18,2)")} || '}}}}' AS payload""")
def _dashboard_json(spark, sf):
    return dashboard.dashboard_json(dashboard.dashboard_payload(spark, sf))


SELL_THROUGH_SQL = f"""
    SELECT p.product_name, r.retailer_name, CAST(SUM(s.units_sold) AS BIGINT) AS units_sold,
           CAST(SUM(s.units_shipped) AS BIGINT) AS units_shipped,
           {ratio("SUM(s.units_sold)", "SUM(s.units_shipped)", 3)} AS sell_through_rate
    FROM v_sales s JOIN v_products p ON s.product_id = p.product_id
                   JOIN v_retailers r ON s.retailer_id = r.retailer_id
    WHERE s.{RECENT_13} {{extra}}
    GROUP BY p.product_name, r.retailer_name"""


@register("sell_through", sql(SELL_THROUGH_SQL.format(extra=""),
                              "v_sales", "v_products", "v_retailers"))
def _sell_through(spark, sf):
    m = Model(spark, sf)
    return metrics.sell_through(m.sales(), m.products(), m.retailers(), 13,
                                anchor=m.max_of("sales", "week_ending"))


@register("sell_through_one", sql(SELL_THROUGH_SQL.format(
    extra=f"AND p.product_name = '{PRODUCT_NAME}'"), "v_sales", "v_products", "v_retailers"))
def _sell_through_one(spark, sf):
    m = Model(spark, sf)
    return metrics.sell_through(m.sales(), m.products(), m.retailers(), 13,
                                product_name=PRODUCT_NAME, anchor=m.max_of("sales", "week_ending"))


@register("sales_weekly", sql("""
    SELECT product_id, retailer_id, CAST(week_ending AS VARCHAR) AS week, units_shipped,
           CAST(shipment_revenue AS DOUBLE) AS shipment_revenue, units_sold,
           CAST(pos_revenue AS DOUBLE) AS pos_revenue,
           CAST(avg_selling_price AS DOUBLE) AS avg_selling_price, on_promo
    FROM v_sales""", "v_sales"))
def _sales_weekly(spark, sf):
    return metrics.sales_weekly(Model(spark, sf).sales())


# ------------------------------------------------------------ promotions (C/F)

@register("roi_by_type", sql(f"""
    SELECT promo_type, {ratio("SUM(roi)", "COUNT(*)", 3)} AS avg_roi, COUNT(*) AS n
    FROM v_promos GROUP BY promo_type ORDER BY promo_type""", "v_promos"))
def _roi_by_type(spark, sf):
    return promo.roi_by_type(Model(spark, sf).promotions())


@register("negative_roi_count", sql("""
    SELECT promo_type, COUNT(*) AS n_negative FROM v_promos WHERE roi < 0 GROUP BY promo_type""",
                                    "v_promos"))
def _negative_roi_count(spark, sf):
    return promo.negative_roi_count(Model(spark, sf).promotions())


NEG_PROMOS_SQL = """
    SELECT t.order_key, t.line_number, t.product_id, t.retailer_id, t.start_date, t.promoted_units,
           p.product_name, r.retailer_name, t.promo_type,
           CAST(t.discount_depth_pct AS DOUBLE) AS discount_depth_pct,
           CAST(t.promo_spend AS DOUBLE) AS promo_spend, CAST(t.lift_pct AS DOUBLE) AS lift_pct,
           CAST(t.roi AS DOUBLE) AS roi
    FROM v_promos t JOIN v_products p ON t.product_id = p.product_id
                    JOIN v_retailers r ON t.retailer_id = r.retailer_id
    WHERE t.roi < 0
      AND t.start_date >= (SELECT MAX(start_date) FROM v_promos) - INTERVAL 13 WEEKS"""


@register("negative_roi_promos", sql(NEG_PROMOS_SQL + " ORDER BY t.roi",
                                     "v_promos", "v_products", "v_retailers"))
def _negative_roi_promos(spark, sf):
    m = Model(spark, sf)
    return promo.negative_roi_promos(m.promotions(), m.products(), m.retailers(), 13,
                                     m.max_of("promotions", "start_date")).orderBy("roi")


@register("worst_promos", sql(
    "SELECT * FROM (" + NEG_PROMOS_SQL + ") x ORDER BY roi, order_key, line_number, product_id, "
    "retailer_id, start_date, promoted_units, promo_spend LIMIT 5",
    "v_promos", "v_products", "v_retailers"))
def _worst_promos(spark, sf):
    m = Model(spark, sf)
    neg = promo.negative_roi_promos(m.promotions(), m.products(), m.retailers(), 13,
                                    m.max_of("promotions", "start_date"))
    return promo.worst_promos(neg, 5)


@register("promo_lift", sql("""
    SELECT order_key, line_number, product_id, baseline_units, incremental_units, promoted_units,
           CAST(lift_pct AS DOUBLE) AS lift_pct FROM v_promos""", "v_promos"))
def _promo_lift(spark, sf):
    return promo.promo_lift(Model(spark, sf).promotions())


@register("promo_roi", sql("""
    SELECT order_key, line_number, promo_type, CAST(promo_spend AS DOUBLE) AS promo_spend,
           CAST(roi AS DOUBLE) AS roi FROM v_promos""", "v_promos"))
def _promo_roi(spark, sf):
    return promo.promo_roi(Model(spark, sf).promotions())


@register("promo_windows", sql("""
    SELECT order_key, line_number, start_date, end_date,
           CAST(end_date - start_date AS BIGINT) AS days FROM v_promos""", "v_promos"))
def _promo_windows(spark, sf):
    return promo.promo_windows(Model(spark, sf).promotions())


# ----------------------------------------------------------------- share (F/D)

MS_COLS = """CAST(month AS VARCHAR) AS month, brand, category,
           CAST(brand_dollar_sales AS DOUBLE) AS brand_dollar_sales,
           CAST(category_dollar_sales AS DOUBLE) AS category_dollar_sales,
           CAST(dollar_share_pct AS DOUBLE) AS dollar_share_pct"""


@register("market_share", sql(f"SELECT {MS_COLS} FROM v_market_share", "v_market_share"))
def _market_share(spark, sf):
    return share.market_share_out(Model(spark, sf).market_share())


@register("share_latest_month", sql(f"""
    SELECT {MS_COLS} FROM v_market_share
    WHERE month = (SELECT MAX(month) FROM v_market_share)""", "v_market_share"))
def _share_latest_month(spark, sf):
    m = Model(spark, sf)
    return share.share_latest_month(m.market_share(), m.max_of("market_share", "month"))


@register("share_by_brand", sql(f"""
    SELECT brand, {ratio("SUM(dollar_share_pct)", "COUNT(*)", 2)} AS share
    FROM v_market_share WHERE month = (SELECT MAX(month) FROM v_market_share)
    GROUP BY brand ORDER BY 2 DESC, 1 LIMIT 10""", "v_market_share"))
def _share_by_brand(spark, sf):
    m = Model(spark, sf)
    return share.share_by_brand(m.market_share(), 10, m.max_of("market_share", "month"))


@register("share_trend", sql(f"""
    SELECT CAST(month AS VARCHAR) AS month, CAST(dollar_share_pct AS DOUBLE) AS dollar_share_pct
    FROM v_market_share WHERE brand = '{SHARE_BRAND}' AND category = '{SHARE_CATEGORY}'
    ORDER BY month""", "v_market_share"))
def _share_trend(spark, sf):
    return share.share_trend(Model(spark, sf).market_share(), SHARE_BRAND, SHARE_CATEGORY)


@register("acv_distribution", sql(f"""
    WITH s AS (SELECT product_id, retailer_id, CAST(date_trunc('month', week_ending) AS DATE) AS month,
                      pos_revenue FROM v_sales),
    acct AS (SELECT retailer_id, month, SUM(pos_revenue) AS acct_vol FROM s GROUP BY 1, 2),
    market AS (SELECT month, SUM(acct_vol) AS market_vol FROM acct GROUP BY 1),
    carried AS (SELECT DISTINCT product_id, retailer_id, month FROM s),
    per_item AS (SELECT c.product_id, c.month, SUM(a.acct_vol) AS sel_vol, COUNT(*) AS stores_selling
                 FROM carried c JOIN acct a ON c.retailer_id = a.retailer_id AND c.month = a.month
                 GROUP BY 1, 2)
    SELECT product_id, CAST(month AS VARCHAR) AS month,
           {ratio("sel_vol * 100.0", "market_vol", 1)} AS acv_pct, stores_selling
    FROM per_item JOIN market USING (month)""", "v_sales"))
def _acv_distribution(spark, sf):
    return share.acv_distribution(Model(spark, sf).sales())


@register("stores_selling_window", sql("""
    SELECT product_id, COUNT(DISTINCT retailer_id) AS stores_selling, TRUE AS within_bound
    FROM v_sales
    WHERE week_ending >= (SELECT date_trunc('month', MAX(week_ending)) - INTERVAL 2 MONTHS FROM v_sales)
    GROUP BY product_id""", "v_sales"))
def _stores_selling_window(spark, sf):
    """Accounts that sold a product in the last three months, exact, and whether the
    estimate from the merged monthly sketches lies within its stated bound."""
    m = Model(spark, sf)
    latest = m.max_of("sales", "week_ending")
    both = (share.stores_exact(m.sales(), 3, latest)
            .join(share.stores_over(m.store_sketches(), 3, latest), "product_id", "left"))
    error = F.abs(F.col("stores_estimate") - F.col("stores_selling"))
    return both.select("product_id", "stores_selling",
                       F.coalesce(error <= F.lit(share.SKETCH_BOUND) * F.col("stores_selling"), F.lit(False)).alias("within_bound"))


# ------------------------------------------------------------- inventory (F/C/B)

def _running_sql(keys: str, src: str = "v_sales") -> str:
    return f"""
    wk AS (SELECT {keys}, week_ending, SUM(units_shipped) AS shipped, SUM(units_sold) AS sold
           FROM {src} GROUP BY {keys}, week_ending),
    r AS (SELECT *, SUM(shipped - sold) OVER (PARTITION BY {keys} ORDER BY week_ending
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS units_on_hand FROM wk),
    rw AS (SELECT *, ROUND(CAST(CAST(units_on_hand AS DOUBLE) / CAST(GREATEST(sold, 1) AS DOUBLE)
                   AS DECIMAL(18,9)), 1) AS wos FROM r)"""


@register("inventory_running", sql(f"""
    WITH {_running_sql("product_id")}
    SELECT product_id, CAST(week_ending AS VARCHAR) AS week, CAST(shipped AS BIGINT) AS shipped,
           CAST(sold AS BIGINT) AS sold, CAST(units_on_hand AS BIGINT) AS units_on_hand,
           CAST(wos AS DOUBLE) AS weeks_of_supply FROM rw""", "v_sales"))
def _inventory_running(spark, sf):
    return inventory.inventory_running(Model(spark, sf).sales())


@register("inventory_snapshots", sql(f"""
    WITH {_running_sql("product_id")}
    SELECT product_id, CAST(week_ending AS VARCHAR) AS week, CAST(units_on_hand AS BIGINT) AS units_on_hand,
           CAST(wos AS DOUBLE) AS weeks_of_supply FROM rw
    WHERE CAST(FLOOR(date_diff('day', (SELECT MIN(week_ending) FROM v_sales), week_ending) / 7) AS BIGINT) % 4 = 0""",
                                     "v_sales"))
def _inventory_snapshots(spark, sf):
    return inventory.inventory_snapshots(Model(spark, sf).sales())


@register("weeks_of_supply", sql(f"""
    WITH {_running_sql("product_id, retailer_id")}
    SELECT product_id, retailer_id, CAST(week_ending AS VARCHAR) AS week,
           CAST(units_on_hand AS BIGINT) AS units_on_hand, CAST(sold AS BIGINT) AS sold,
           CAST(wos AS DOUBLE) AS weeks_of_supply FROM rw""", "v_sales"))
def _weeks_of_supply(spark, sf):
    r = inventory.running_on_hand(Model(spark, sf).sales(), ["product_id", "retailer_id"])
    return r.select("product_id", "retailer_id", F.col("week_ending").cast("string").alias("week"),
                    "units_on_hand", "sold", C.as_double("weeks_of_supply").alias("weeks_of_supply"))


@register("lowest_supply", sql(f"""
    WITH s AS (SELECT * FROM v_sales WHERE product_id IN
                 (SELECT product_id FROM v_products WHERE product_name = '{PRODUCT_NAME}')),
    {_running_sql("product_id, retailer_id", "s")}
    SELECT rt.retailer_name, {ratio("SUM(wos)", "COUNT(*)", 3)} AS avg_weeks_of_supply
    FROM rw JOIN v_retailers rt ON rw.retailer_id = rt.retailer_id
    GROUP BY rt.retailer_name ORDER BY 2, 1""", "v_sales", "v_products", "v_retailers"))
def _lowest_supply(spark, sf):
    return inventory.lowest_supply(Model(spark, sf).sales(), V.products(spark, sf),
                                   V.retailers(spark, sf), PRODUCT_NAME)


# ------------------------------------------------------- spines and panels (B/C)


_WE = "CAST(date_trunc('week', {0} + INTERVAL 1 DAY) AS DATE) + 5"


@register("week_spine", f"""
    WITH b AS (SELECT CAST(MIN(l_shipdate) AS DATE) AS lo, CAST(MAX(l_shipdate) AS DATE) AS hi
               FROM lineitem)
    SELECT CAST(unnest(generate_series(CAST({_WE.format("lo")} AS TIMESTAMP),
                                       CAST({_WE.format("hi")} AS TIMESTAMP), INTERVAL 7 DAY))
                AS DATE) AS week_ending FROM b""")
def _week_spine(spark, sf):
    return grid.week_spine(spark, sf)


@register("month_spine", """
    WITH b AS (SELECT CAST(MIN(l_shipdate) AS DATE) AS lo, CAST(MAX(l_shipdate) AS DATE) AS hi
               FROM lineitem)
    SELECT CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP),
                                       CAST(date_trunc('month', hi) AS TIMESTAMP), INTERVAL 1 MONTH))
                AS DATE) AS month FROM b""")
def _month_spine(spark, sf):
    return grid.month_spine(spark, sf)


@register("carried_pairs", sql("""
    SELECT product_id, retailer_id, MIN(week_ending) AS first_week, MAX(week_ending) AS last_week,
           COUNT(*) AS active_weeks FROM v_sales GROUP BY 1, 2""", "v_sales"))
def _carried_pairs(spark, sf):
    return grid.carried_pairs(Model(spark, sf).sales())


@register("sales_grid", sql("""
    WITH pairs AS (SELECT product_id, retailer_id, MIN(week_ending) AS fw, MAX(week_ending) AS lw
                   FROM v_sales GROUP BY 1, 2),
    g AS (SELECT product_id, retailer_id,
                 CAST(unnest(generate_series(CAST(fw AS TIMESTAMP), CAST(lw AS TIMESTAMP),
                                             INTERVAL 7 DAY)) AS DATE) AS week_ending FROM pairs)
    SELECT g.product_id, g.retailer_id, CAST(g.week_ending AS VARCHAR) AS week,
           COALESCE(s.units_sold, 0) AS units_sold
    FROM g LEFT JOIN v_sales s ON g.product_id = s.product_id AND g.retailer_id = s.retailer_id
                              AND g.week_ending = s.week_ending""", "v_sales"))
def _sales_grid(spark, sf):
    return grid.sales_grid(Model(spark, sf).sales())


_FAMILY_SQL = f"""(SELECT v.*, COALESCE(cf.pack_family, '{seed.DEFAULT_PACK_FAMILY}') AS pack_family
                   FROM v_products v LEFT JOIN {seed.family_values_sql()} ON v.category = cf.category)"""


@register("lookup_default", sql(f"""
    SELECT product_id, category, pack_family FROM {_FAMILY_SQL} p""", "v_products"))
def _lookup_default(spark, sf):
    return grid.with_pack_family(spark, V.products(spark, sf)).select(
        "product_id", "category", "pack_family")


@register("sku_expand", sql(f"""
    SELECT p.product_id, pk.variant_no, pk.variant, pk.pack_family,
           'NS-' || upper(substr(p.brand, 1, 3)) || '-' || CAST(p.product_id AS VARCHAR) || '-'
               || CAST(pk.variant_no AS VARCHAR) AS sku,
           CAST(ROUND(p.list_price * pk.multiplier, 2) AS DOUBLE) AS pack_price
    FROM {_FAMILY_SQL} p JOIN {seed.pack_values_sql()} ON p.pack_family = pk.pack_family""",
                                "v_products"))
def _sku_expand(spark, sf):
    return grid.sku_expand(spark, V.products(spark, sf))


@register("sku_code", sql("""
    SELECT product_id, 'NS-' || upper(substr(brand, 1, 3)) || '-' || CAST(product_id AS VARCHAR) AS sku
    FROM v_products""", "v_products"))
def _sku_code(spark, sf):
    p = V.products(spark, sf)
    return p.select("product_id", grid.sku_code("brand", "product_id").alias("sku"))


@register("brand_category", sql("""
    SELECT brand, arg_min(category, product_id) AS first_category,
           COUNT(DISTINCT category) AS n_categories, COUNT(*) AS n_products
    FROM v_products GROUP BY brand ORDER BY brand""", "v_products"))
def _brand_category(spark, sf):
    return grid.brand_category(V.products(spark, sf))


@register("sales_pricing", sql("""
    SELECT s.product_id, s.retailer_id, CAST(s.week_ending AS VARCHAR) AS week,
           CAST(ROUND(s.units_shipped * p.list_price * 0.62, 2) AS DOUBLE) AS sell_in_value,
           CAST(ROUND(s.units_sold * s.avg_selling_price, 2) AS DOUBLE) AS sell_out_value,
           CAST(ROUND(s.units_sold * p.unit_cogs, 2) AS DOUBLE) AS cogs_value,
           CAST(ROUND(CASE WHEN s.on_promo THEN ROUND(p.list_price * 0.78, 2) ELSE p.list_price END, 2)
                AS DOUBLE) AS shelf_price
    FROM v_sales s JOIN v_products p ON s.product_id = p.product_id""", "v_sales", "v_products"))
def _sales_pricing(spark, sf):
    return grid.sales_pricing(Model(spark, sf).sales(), V.products(spark, sf))


@register("seasonality_index", sql(f"""
    WITH monthly AS (SELECT p.category, CAST(date_trunc('month', s.week_ending) AS DATE) AS month,
                            SUM(s.pos_revenue) AS rev
                     FROM v_sales s JOIN v_products p ON s.product_id = p.product_id GROUP BY 1, 2),
    by_moy AS (SELECT category, CAST(month(month) AS INTEGER) AS month_of_year, SUM(rev) AS s,
                      COUNT(*) AS n FROM monthly GROUP BY 1, 2),
    overall AS (SELECT category, SUM(rev) AS s_all, COUNT(*) AS n_all FROM monthly GROUP BY 1)
    SELECT category, month_of_year,
           {ratio("CAST(s AS DOUBLE) / n", "CAST(s_all AS DOUBLE) / n_all", 3)} AS seasonality
    FROM by_moy JOIN overall USING (category)""", "v_sales", "v_products"))
def _seasonality_index(spark, sf):
    return grid.seasonality_index(Model(spark, sf).sales(), V.products(spark, sf))


@register("clamped_measures", sql("""
    SELECT CAST(month AS VARCHAR) AS month, brand, category,
           CAST(GREATEST(ROUND(CAST(CAST(dollar_share_pct AS DOUBLE) / 100.0 AS DECIMAL(18,9)), 4),
                         0.005) AS DOUBLE) AS share_floor,
           CAST(LEAST(dollar_share_pct, 99.5) AS DOUBLE) AS share_cap
    FROM v_market_share""", "v_market_share"))
def _clamped_measures(spark, sf):
    return grid.clamped_measures(Model(spark, sf).market_share())


@register("seasonal_units", sql(f"""
    WITH g AS (SELECT f.pack_family, CAST(month(s.week_ending) AS INTEGER) AS month_of_year,
                      CAST(SUM(s.units_sold) AS BIGINT) AS units
               FROM v_sales s JOIN {_FAMILY_SQL} f ON s.product_id = f.product_id GROUP BY 1, 2),
    r AS (SELECT *, CASE WHEN pack_family = 'Beverages' AND month_of_year IN (6, 7, 8) THEN 1.25
                         WHEN pack_family = 'Beverages' AND month_of_year IN (12, 1, 2) THEN 0.9
                         WHEN pack_family = 'Snacks' AND month_of_year IN (11, 12) THEN 1.2 ELSE 1.0 END AS f FROM g)
    SELECT pack_family, month_of_year, units, CAST(f AS DOUBLE) AS factor,
           CAST(ROUND(CAST(CAST(units AS DOUBLE) / CAST(f AS DOUBLE) AS DECIMAL(18,9)), 2) AS DOUBLE) AS base_units
    FROM r""", "v_sales", "v_products"))
def _seasonal_units(spark, sf):
    return grid.seasonal_units(spark, Model(spark, sf).sales(), V.products(spark, sf))


@register("clamped_units", sql("""
    SELECT product_id, retailer_id, CAST(week_ending AS VARCHAR) AS week,
           GREATEST(units_shipped - units_sold, 0) AS units_left,
           CAST(ROUND(CAST(CAST(GREATEST(units_shipped - units_sold, 0) AS DOUBLE) /
                GREATEST(units_sold, 1) AS DECIMAL(18,9)), 1) AS DOUBLE) AS weeks_left
    FROM v_sales""", "v_sales"))
def _clamped_units(spark, sf):
    return grid.clamped_units(Model(spark, sf).sales())


@register("account_scale", sql("""
    WITH acct AS (SELECT retailer_id, CASE WHEN SUM(units_sold) = 0 THEN 1500
                                           ELSE CAST(SUM(units_sold) AS BIGINT) END AS units
                  FROM v_sales GROUP BY 1)
    SELECT retailer_id, units,
           CAST(ROUND(CAST(CAST(units AS DOUBLE) /
                (SELECT CAST(SUM(units) AS DOUBLE) / COUNT(*) FROM acct) AS DECIMAL(18,9)), 6)
                AS DOUBLE) AS scale
    FROM acct""", "v_sales"))
def _account_scale(spark, sf):
    return grid.account_scale(Model(spark, sf).sales())


# ------------------------------------------------------ documents and retrieval


SEARCH_DOC_TYPE = "src1"


def _cos_sql(a: str, b: str) -> str:
    da, db = f"CAST({a} AS DOUBLE[])", f"CAST({b} AS DOUBLE[])"
    return (f"list_dot_product({da}, {db}) / NULLIF(sqrt(list_dot_product({da}, {da})) * "
            f"sqrt(list_dot_product({db}, {db})), 0)")


_Q_FIRST = """q AS (SELECT embedding AS qv FROM v_vectors
                 WHERE doc_id = (SELECT MIN(doc_id) FROM v_vectors))"""
_ROUND6 = "CAST(ROUND(CAST({0} AS DECIMAL(18,9)), 6) AS DOUBLE)"
# Terms of any script; the class is spelled out here, not taken from the code.
_TERMS = r"string_split(lower(trim(regexp_replace({0}, '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'))), ' ')"


@register("vector_topk", sql(f"""
    WITH {_Q_FIRST},
    s AS (SELECT v.doc_id, {_cos_sql("v.embedding", "q.qv")} AS raw FROM v_vectors v, q)
    SELECT doc_id, {_ROUND6.format("raw")} AS score FROM s
    ORDER BY score DESC NULLS LAST, doc_id LIMIT 4""", "v_vectors"))
def _vector_topk(spark, sf):
    m = Model(spark, sf)
    v = m.vectors()
    return retrieval.vector_topk(v, retrieval.first_doc_vector(v), 4, m.pivots())


@register("search_filtered", sql(f"""
    WITH {_Q_FIRST},
    s AS (SELECT v.doc_id, d.doc_type, d.category, {_cos_sql("v.embedding", "q.qv")} AS raw
          FROM v_vectors v JOIN v_documents d ON v.doc_id = d.doc_id, q
          WHERE d.doc_type = '{SEARCH_DOC_TYPE}')
    SELECT doc_id, doc_type, category, {_ROUND6.format("raw")} AS score FROM s
    ORDER BY score DESC NULLS LAST, doc_id LIMIT 4""", "v_vectors", "v_documents"))
def _search_filtered(spark, sf):
    v = Model(spark, sf).vectors()
    return retrieval.search_filtered(v, Model(spark, sf).documents(), retrieval.first_doc_vector(v),
                                     SEARCH_DOC_TYPE, 4)


@register("vector_topk_batch", sql(f"""
    WITH comp AS (SELECT label, pos, AVG(CAST(x AS DOUBLE)) AS m
                  FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos
                        FROM v_vectors) t GROUP BY label, pos),
    q AS (SELECT CAST(label AS BIGINT) AS qid, list(m ORDER BY pos) AS qv FROM comp GROUP BY label),
    s AS (SELECT q.qid, v.doc_id, {_cos_sql("v.embedding", "q.qv")} AS raw FROM v_vectors v, q),
    r AS (SELECT qid, doc_id, {_ROUND6.format("raw")} AS score FROM s WHERE raw IS NOT NULL)
    SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank
          FROM r) x WHERE rank <= 5""", "v_vectors"))
def _vector_topk_batch(spark, sf):
    v = V.vectors(spark, sf)
    return retrieval.vector_topk_batch(spark, v, retrieval.label_centroids(v), 5)


@register("text_search", sql(f"""
    WITH qt AS (SELECT DISTINCT t AS term
                FROM (SELECT unnest({_TERMS.format("text")}) AS t FROM benchmark
                      WHERE item_id = (SELECT MIN(item_id) FROM benchmark)) x WHERE t <> ''),
    dt AS (SELECT doc_id, unnest({_TERMS.format("content")}) AS term FROM v_documents),
    tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM dt WHERE term IN (SELECT term FROM qt)
           GROUP BY 1, 2),
    df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY 1),
    n AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM v_documents)
    SELECT doc_id, {_ROUND6.format("SUM(tf * ln(n.n / df))")} AS score
    FROM tf JOIN df USING (term), n GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10""",
                                 "v_documents"))
def _text_search(spark, sf):
    b = Tables(spark, sf).benchmark
    first = b.select(F.min("item_id")).scalar()
    q = text.query_terms_of(b.filter(F.col("item_id") == first))
    m = Model(spark, sf)
    return text.text_search(m.indexed_documents(), q, 10, index=m.doc_index(), blocks=m.doc_blocks())


@register("doc_normalize", f"""
    SELECT doc_id, trim(regexp_replace(text, {WS}, ' ', 'g')) AS content,
           trim(regexp_replace(text, {WS}, ' ', 'g')) <> text AS changed FROM documents""")
def _doc_normalize(spark, sf):
    return text.doc_normalize(Tables(spark, sf).documents)


@register("render_spec_docs", sql("""
    SELECT product_id, 'Product specification: ' || product_name || ' (' || brand || '). Category: '
           || category || '. List price: $' || CAST(list_price AS VARCHAR) || '. Unit cost: $'
           || CAST(unit_cogs AS VARCHAR) || '.' AS content FROM v_products""", "v_products"))
def _render_spec_docs(spark, sf):
    return text.render_spec_docs(V.products(spark, sf))


@register("review_flags", sql("""
    SELECT d.doc_id, d.doc_type,
           CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'Positive' ELSE 'Negative' END AS sentiment,
           CASE WHEN l.quality = 1 THEN 'Yes' ELSE 'No' END AS would_recommend
    FROM v_documents d JOIN labels l ON d.doc_id = l.doc_id""", "v_documents"))
def _review_flags(spark, sf):
    return text.review_flags(Model(spark, sf).documents(), Tables(spark, sf).labels)


@register("doc_type_counts", sql("""
    SELECT doc_type, COUNT(*) AS n FROM v_documents GROUP BY doc_type""", "v_documents"))
def _doc_type_counts(spark, sf):
    return metrics.value_counts(Model(spark, sf).documents(), "doc_type")


# ------------------------------------------------------------- memory (A/C/H)


MEMORY_QUERY = "Purchase, click?"
_LATEST = """(SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, key ORDER BY ts DESC, seq DESC) AS rn
              FROM v_memory_log
              WHERE op = 'delete' OR COALESCE(json_valid(value_json) AND json_type(value_json) = 'OBJECT', FALSE))"""


@register("memory_current", sql(f"""
    SELECT user_id, key, op AS last_op, value_json, ts, seq FROM {_LATEST} x WHERE rn = 1""",
                                "v_memory_log"))
def _memory_current(spark, sf):
    return memory.latest_state(Model(spark, sf).memory_log())


@register("memory_after_delete", sql(f"""
    SELECT user_id, key, value_json, ts FROM {_LATEST} x WHERE rn = 1 AND op = 'put'""",
                                     "v_memory_log"))
def _memory_after_delete(spark, sf):
    return memory.live_memories(Model(spark, sf).memory_log())


@register("memory_json_validate", sql("""
    SELECT seq, user_id, key, reason IS NULL AS is_valid, reason
    FROM (SELECT seq, user_id, key,
                 CASE WHEN value_json IS NULL THEN 'missing value'
                      WHEN NOT json_valid(value_json) THEN 'invalid JSON'
                      WHEN json_type(value_json) <> 'OBJECT' THEN 'not a JSON object' END AS reason
          FROM v_memory_log WHERE op = 'put') x""", "v_memory_log"))
def _memory_json_validate(spark, sf):
    return memory.json_validate(Model(spark, sf).memory_log())


@register("to_text", sql("""
    SELECT seq, CASE WHEN json_valid(value_json) AND json_type(value_json) = 'VARCHAR'
                     THEN value_json ->> '$' ELSE value_json END AS text
    FROM v_memory_log""", "v_memory_log"))
def _to_text(spark, sf):
    return memory.to_text(Model(spark, sf).memory_log())


@register("memory_fields", sql(f"""
    SELECT user_id, x.key AS key, e.key AS field,
           CASE WHEN e.type = 'VARCHAR' THEN e.value ->> '$' ELSE CAST(e.value AS VARCHAR) END AS text
    FROM {_LATEST} x, json_each(value_json) e WHERE rn = 1 AND op = 'put'""", "v_memory_log"))
def _memory_fields(spark, sf):
    return memory.memory_fields(Model(spark, sf).memory_log())


@register("resolve_ids", sql("""
    SELECT seq, COALESCE(user_id, email, session_id, 'default_user') AS user_id,
           'user_memories/' || replace(COALESCE(user_id, email, session_id, 'default_user'), '.', '-') AS namespace
    FROM v_id_sources""", "v_id_sources"))
def _resolve_ids(spark, sf):
    return memory.resolve_ids(V.id_sources(spark, sf))


_MEM_TERMS = _TERMS.format("concat_ws(' ', key, value_json)")


@register("memory_search", sql(f"""
    SELECT user_id, key, value_json, ts,
           CAST(len(list_distinct(list_filter({_MEM_TERMS}, lambda x: x IN ('purchase', 'click')))) AS INTEGER) AS score
    FROM {_LATEST} x
    WHERE rn = 1 AND op = 'put' AND user_id = (SELECT MIN(user_id) FROM v_memory_log)
    ORDER BY score DESC, ts DESC, key LIMIT 5""", "v_memory_log"))
def _memory_search(spark, sf):
    log = Model(spark, sf).memory_log()
    return memory.memory_search(log, log.select(F.min("user_id")).scalar(), MEMORY_QUERY, 5)


@register("action_items_defaults", sql("""
    SELECT id AS source_id, session_id, title, COALESCE(status, 'open') AS status, created_ts,
           ROW_NUMBER() OVER (ORDER BY created_ts, id) AS item_id
    FROM v_action_items""", "v_action_items"))
def _action_items_defaults(spark, sf):
    return memory.action_items_defaults(V.action_items(spark, sf))


@register("action_items_open", sql("""
    SELECT session_id, COUNT(*) AS n_open FROM v_action_items WHERE COALESCE(status, 'open') = 'open'
    GROUP BY session_id""", "v_action_items"))
def _action_items_open(spark, sf):
    return memory.action_items_open(V.action_items(spark, sf))


@register("chat_history", sql("""
    SELECT session_id, turn, role, content FROM v_chat
    WHERE session_id = (SELECT MAX(session_id) FROM v_chat) ORDER BY turn""", "v_chat"))
def _chat_history(spark, sf):
    m = Model(spark, sf)
    return memory.chat_history(m.chat(), F.lit(m.max_of("chat", "session_id")))


@register("seed_if_absent", sql(f"""
    SELECT s.session_id, CAST(-1 AS BIGINT) AS turn, '{memory.SEED_ROLE}' AS role,
           '{memory.SEED_TEXT}' AS content
    FROM (SELECT DISTINCT session_id FROM v_chat) s
    WHERE NOT EXISTS (SELECT 1 FROM v_chat c WHERE c.session_id = s.session_id
                      AND c.role = '{memory.SEED_ROLE}')""", "v_chat"))
def _seed_if_absent(spark, sf):
    return memory.seed_if_absent(V.chat(spark, sf))


# ----------------------------------------------------------- traces (E/I/G/D)

_DEPTH_SQL = """
    walk AS (SELECT trace_id, span_id, parent_id AS cur, 0 AS depth FROM v_spans
             UNION ALL
             SELECT w.trace_id, w.span_id, p.parent_id, w.depth + 1
             FROM walk w JOIN v_spans p ON p.trace_id = w.trace_id AND p.span_id = w.cur),
    dep AS (SELECT trace_id, span_id, CAST(MAX(depth) AS INTEGER) AS depth FROM walk GROUP BY 1, 2)"""


@register("span_depth", sql(f"WITH RECURSIVE {_DEPTH_SQL} SELECT * FROM dep", "v_spans"))
def _span_depth(spark, sf):
    return traces.span_depth(V.spans(spark, sf))


@register("trace_tree", sql(f"""
    WITH RECURSIVE {_DEPTH_SQL},
    cnt AS (SELECT trace_id, COUNT(*) AS num_spans FROM v_spans GROUP BY 1),
    way AS (SELECT trace_id, span_id, [span_id] AS path FROM v_spans s WHERE NOT EXISTS (
                SELECT 1 FROM v_spans p WHERE p.trace_id = s.trace_id AND p.span_id = s.parent_id)
            UNION ALL
            SELECT s.trace_id, s.span_id, list_append(w.path, s.span_id)
            FROM way w JOIN v_spans s ON s.trace_id = w.trace_id AND s.parent_id = w.span_id),
    ord AS (SELECT trace_id, span_id, row_number() OVER (PARTITION BY trace_id ORDER BY path) - 1 AS ord FROM way)
    SELECT s.trace_id, s.span_id, o.ord, d.depth, c.num_spans,
           repeat('  ', d.depth) || '- ' || s.name || ' [' || s.span_type || ']' AS line
    FROM v_spans s JOIN dep d ON s.trace_id = d.trace_id AND s.span_id = d.span_id
                   JOIN ord o ON s.trace_id = o.trace_id AND s.span_id = o.span_id
                   JOIN cnt c ON s.trace_id = c.trace_id""", "v_spans"))
def _trace_tree(spark, sf):
    s = V.spans(spark, sf)
    return traces.trace_tree(s, traces.span_depth(s))


@register("sessions_with_turns", sql("""
    SELECT session_id, COUNT(*) AS n_turns, COUNT(*) FILTER (WHERE role = 'assistant') AS n_assistant
    FROM v_chat GROUP BY session_id HAVING COUNT(*) FILTER (WHERE role = 'assistant') > 0
    ORDER BY session_id DESC""", "v_chat"))
def _sessions_with_turns(spark, sf):
    return traces.sessions_with_turns(V.chat(spark, sf))


@register("assistant_messages", sql("""
    SELECT session_id, turn, content FROM v_chat WHERE role = 'assistant'""", "v_chat"))
def _assistant_messages(spark, sf):
    return traces.assistant_messages(V.chat(spark, sf))


@register("last_assistant_message", sql("""
    SELECT session_id, MAX(turn) AS turn, arg_max(content, turn) AS content
    FROM v_chat WHERE role = 'assistant' GROUP BY session_id""", "v_chat"))
def _last_assistant_message(spark, sf):
    return traces.last_assistant_message(V.chat_parts(spark, sf))


@register("assemble_deltas", sql("""
    SELECT item_id, string_agg(text, ' ' ORDER BY seq) AS text
    FROM v_deltas WHERE type = 'output_text.delta' GROUP BY item_id""", "v_deltas"))
def _assemble_deltas(spark, sf):
    return traces.assemble_deltas(V.deltas(spark, sf))


@register("latest_traces", """
    SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 5""")
def _latest_traces(spark, sf):
    return traces.latest_traces(Tables(spark, sf).events, 5)


# ------------------------------------------------------------------ evals (C/I)

_VERDICT = (f"CASE WHEN lower(trim(value)) IN ({', '.join(repr(v) for v in evals.PASS_VALUES)}) "
            f"THEN 'pass' WHEN lower(trim(value)) IN ({', '.join(repr(v) for v in evals.FAIL_VALUES)}) "
            "THEN 'fail' ELSE 'other' END")
_VERDICTS = f"(SELECT trace_id, name, {_VERDICT} AS verdict FROM v_assessments WHERE value IS NOT NULL)"


@register("verdict_normalize", sql(f"SELECT * FROM {_VERDICTS} v", "v_assessments"))
def _verdict_normalize(spark, sf):
    return evals.verdict_normalize(V.assessments(spark, sf))


@register("eval_pass_rates", sql(f"""
    SELECT name, COUNT(*) FILTER (WHERE verdict = 'pass') AS pass,
           COUNT(*) FILTER (WHERE verdict = 'fail') AS fail,
           COUNT(*) FILTER (WHERE verdict = 'other') AS other,
           {ratio("COUNT(*) FILTER (WHERE verdict = 'pass')", "COUNT(*)", 3)} AS pass_rate
    FROM {_VERDICTS} v GROUP BY name""", "v_assessments"))
def _eval_pass_rates(spark, sf):
    return evals.eval_pass_rates(V.assessments(spark, sf))


@register("eval_by_trace", sql(f"""
    SELECT trace_id, COUNT(*) AS n_scorers,
           '{{' || string_agg('"' || name || '":"' || value || '"', ',' ORDER BY name) || '}}' AS scores
    FROM (SELECT trace_id, name, arg_max(lower(trim(value)), seq) AS value FROM v_assessments
          WHERE value IS NOT NULL GROUP BY 1, 2) w
    GROUP BY trace_id""", "v_assessments"))
def _eval_by_trace(spark, sf):
    return evals.eval_by_trace(V.assessments(spark, sf))


_NORM = r"' ' || lower(trim(regexp_replace({0}, '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'))) || ' '"


@register("fact_coverage", f"""
    WITH f AS (SELECT item_id, {_NORM.format("text")} AS t FROM benchmark
               WHERE trim({_NORM.format("text")}) <> ''),
    d AS (SELECT doc_id, {_NORM.format("text")} AS t FROM documents),
    hits AS (SELECT d.doc_id, COUNT(*) AS n FROM d JOIN f ON contains(d.t, f.t) GROUP BY 1)
    SELECT d.doc_id, COALESCE(hits.n, 0) AS n_facts_found,
           {ratio("COALESCE(hits.n, 0)", "(SELECT COUNT(*) FROM f)", 6)} AS coverage
    FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id""")
def _fact_coverage(spark, sf):
    t, m = Tables(spark, sf), Model(spark, sf)
    return evals.fact_coverage(t.benchmark, t.documents, positions=m.doc_positions())


# ------------------------------------------------------- sync, sinks, scans (A)

_SNAP = f"""
    old AS (SELECT * FROM v_documents WHERE doc_id % 10 <> 0),
    new AS (SELECT doc_id, doc_type, category,
                   CASE WHEN doc_id % 10 = 2 THEN content || '{sync.REVISION_MARK}' ELSE content END AS content
            FROM v_documents WHERE doc_id % 10 <> 1)"""


@register("docs_change_feed", sql(f"""
    WITH {_SNAP}
    SELECT COALESCE(o.doc_id, n.doc_id) AS doc_id,
           CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete'
                ELSE 'update' END AS change_type,
           n.doc_type, n.category, n.content
    FROM old o FULL OUTER JOIN new n ON o.doc_id = n.doc_id
    WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.doc_type IS DISTINCT FROM n.doc_type
       OR o.category IS DISTINCT FROM n.category OR o.content IS DISTINCT FROM n.content""",
                                  "v_documents"))
def _docs_change_feed(spark, sf):
    return sync.docs_change_feed(spark, *sync.snapshots(Model(spark, sf).documents()))


@register("docs_index_sync", sql(f"WITH {_SNAP} SELECT * FROM new", "v_documents"))
def _docs_index_sync(spark, sf):
    return sync.docs_index_sync(spark, *sync.snapshots(Model(spark, sf).documents())).state()


@register("docs_index_compacted", ORACLE["docs_index_sync"])
def _docs_index_compacted(spark, sf):
    index = sync.docs_index_sync(spark, *sync.snapshots(Model(spark, sf).documents()))
    index.compact()
    return index.state()


@register("table_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS n FROM {n}" for n in sinks.TABLE_NAMES))
def _table_counts(spark, sf):
    return sinks.table_counts(spark, sf)


@register("write_audit", "SELECT 'products' AS table_name, COUNT(*) AS n FROM part")
def _write_audit(spark, sf):
    from shelfline.session import scratch_path
    return sinks.write_audit(V.products(spark, sf), "products", scratch_path(spark, "products"), namespace="shelfline_out")


@register("scan_products", """
    SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category,
           p_retailprice AS list_price FROM part""")
def _scan_products(spark, sf):
    name = sinks.publish_source(spark, "shelfline_cpg", "part", table_path(sf, "part"))
    return read_named(spark, name).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("list_price"))


@register("assemble_deltas_stream", ORACLE["assemble_deltas"])
def _assemble_deltas_stream(spark, sf):
    from shelfline.streaming import deltas
    return deltas.assemble_deltas_stream(spark, V.deltas(spark, sf))
