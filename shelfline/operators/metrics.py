"""F-series metrics over the sales fact: KPIs, trend, category and account
revenue, sell-through and weekly totals.

Dimension joins are plain equi-joins: Spark broadcasts a side only when its
size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-decides from runtime sizes, so a dimension that outgrows memory falls
back to a shuffle join instead of failing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.operators.windows import trailing_weeks


def kpi_sums(sales: DataFrame, weeks: int = 13, anchor=None) -> DataFrame:
    """F1 part: revenue and units over the trailing window, one fused scan.
    ``anchor`` supplies MAX(week_ending) (defaults to ``sales`` itself)."""
    recent = trailing_weeks(sales, "week_ending", weeks, anchor)
    return recent.agg(
        F.coalesce(F.round(F.sum("pos_revenue"), 0), F.lit(0)).cast("double").alias("revenue"),
        F.coalesce(F.sum("units_sold"), F.lit(0)).cast("bigint").alias("units"))


def revenue_trend(sales: DataFrame, weeks: int = 26, anchor=None
                  ) -> DataFrame:
    """F2 + C3: weekly sell-out revenue over the trailing window, ascending."""
    recent = trailing_weeks(sales, "week_ending", weeks, anchor)
    return (recent.groupBy("week_ending")
            .agg(F.round(F.sum("pos_revenue"), 0).cast("double").alias("revenue"))
            .select(F.col("week_ending").cast("string").alias("week"), "revenue")
            .orderBy("week"))


def revenue_by(sales: DataFrame, key: str) -> DataFrame:
    """Sell-out revenue per dimension key (exact decimal sum).  Aggregating
    the fact to the key before joining the dimension means the join sees
    one row per product/account instead of every fact row."""
    return sales.groupBy(key).agg(F.sum("pos_revenue").alias("rev"))


def sales_by_category(sales: DataFrame, products: DataFrame,
                      by_product: DataFrame | None = None) -> DataFrame:
    """E1 + F4: revenue by category, descending."""
    rev = by_product if by_product is not None else revenue_by(sales, "product_id")
    return (rev.join(products.select("product_id", "category"), "product_id")
            .groupBy("category")
            .agg(F.round(F.sum("rev"), 0).cast("double").alias("revenue"))
            .orderBy(F.desc("revenue"), "category"))


def top_retailers(sales: DataFrame, retailers: DataFrame, k: int = 8,
                  by_retailer: DataFrame | None = None) -> DataFrame:
    """E2 + F5: top-k accounts by revenue (TakeOrderedAndProject), key tie-break."""
    rev = by_retailer if by_retailer is not None else revenue_by(sales, "retailer_id")
    return (rev.join(retailers.select("retailer_id", "retailer_name"), "retailer_id")
            .groupBy("retailer_name")
            .agg(F.round(F.sum("rev"), 0).cast("double").alias("revenue"))
            .orderBy(F.desc("revenue"), "retailer_name")
            .limit(k))


def sell_through(sales: DataFrame, products: DataFrame, retailers: DataFrame,
                 weeks: int = 13, product_name: str | None = None,
                 retailer_name: str | None = None, anchor=None
                 ) -> DataFrame:
    """E3 + F7 (+ D3 name filters): sell-out / sell-in by product x retailer
    over the trailing window; ratio of sums, NULLIF-guarded, 3 decimals."""
    recent = trailing_weeks(sales, "week_ending", weeks, anchor)
    p = products.select("product_id", "product_name")
    r = retailers.select("retailer_id", "retailer_name")
    if product_name is not None:
        p = p.filter(F.col("product_name") == product_name)
    if retailer_name is not None:
        r = r.filter(F.col("retailer_name") == retailer_name)
    # One row per product x account before the dimension joins.
    pairs = (recent.groupBy("product_id", "retailer_id")
             .agg(F.sum("units_sold").alias("sold"), F.sum("units_shipped").alias("shipped")))
    j = pairs.join(p, "product_id").join(r, "retailer_id")
    g = (j.groupBy("product_name", "retailer_name")
         .agg(F.sum("sold").alias("units_sold"), F.sum("shipped").alias("units_shipped")))
    return g.select("product_name", "retailer_name", "units_sold", "units_shipped",
                    C.safe_ratio("units_sold", "units_shipped", 3).alias("sell_through_rate"))


def sales_weekly(sales: DataFrame) -> DataFrame:
    """sell-in and sell-out at the grain of the fact."""
    return sales.select(
        "product_id", "retailer_id", F.col("week_ending").cast("string").alias("week"),
        "units_shipped", C.money_out("shipment_revenue").alias("shipment_revenue"),
        "units_sold", C.money_out("pos_revenue").alias("pos_revenue"),
        C.money_out("avg_selling_price").alias("avg_selling_price"), "on_promo")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """rows per value (map-side partial counts before the shuffle)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
