"""Market share (F6, F9, D2) and weighted distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.operators.windows import latest_period


def market_share_out(ms: DataFrame) -> DataFrame:
    """F11 output form."""
    return ms.select(F.col("month").cast("string").alias("month"), "brand", "category",
                     C.money_out("brand_dollar_sales").alias("brand_dollar_sales"),
                     C.money_out("category_dollar_sales").alias("category_dollar_sales"),
                     C.as_double("dollar_share_pct").alias("dollar_share_pct"))


def share_latest_month(ms: DataFrame, anchor=None) -> DataFrame:
    """Rows of the latest month."""
    return market_share_out(latest_period(ms, "month", anchor))


def share_by_brand(ms: DataFrame, k: int = 10, anchor=None) -> DataFrame:
    """mean share per brand in the latest month, top k (brand tie-break)."""
    g = (latest_period(ms, "month", anchor).groupBy("brand")
         .agg(F.sum("dollar_share_pct").alias("s"), F.count(F.lit(1)).alias("n")))
    return (g.select("brand", C.rounded(C.as_double("s") / C.as_double("n"), 2).alias("share"))
            .orderBy(F.desc("share"), "brand").limit(k))


def share_trend(ms: DataFrame, brand: str, category: str) -> DataFrame:
    """one brand's share in one category over time."""
    return (ms.filter((F.col("brand") == brand) & (F.col("category") == category))
            .select(F.col("month").cast("string").alias("month"),
                    C.as_double("dollar_share_pct").alias("dollar_share_pct"))
            .orderBy("month"))


#: log2 of a sketch's registers, and the bound its estimates are held to: five standard
#: errors of 1.04 / sqrt(registers).
SKETCH_BITS = 12
SKETCH_BOUND = 5 * 1.04 / 2 ** (SKETCH_BITS / 2)


def store_sketches(lines: DataFrame) -> DataFrame:
    """F13 at scale: ``(product_id, month, stores)``, a HyperLogLog sketch of the accounts
    with shipped lines in the month (of the line's week, as in the sales fact).  Sketches of
    several sets of lines are merged by ``stores_over``, so new lines add rows and
    nothing is counted again."""
    month = C.month_start(C.week_ending("d"))
    return (lines.groupBy("product_id", month.alias("month"))
            .agg(F.hll_sketch_agg("retailer_id", SKETCH_BITS).alias("stores")))


def stores_over(sketches: DataFrame, months: int, latest=None) -> DataFrame:
    """``(product_id, stores_estimate)`` over the last ``months`` months up to ``latest``
    (a date; without it all months): sketches are merged, no account is counted twice
    however many months it sold in."""
    if latest is not None:
        start = F.add_months(F.trunc(F.lit(latest), "month"), 1 - months)
        sketches = sketches.where(F.col("month").between(start, F.lit(latest)))
    return sketches.groupBy("product_id").agg(
        F.hll_sketch_estimate(F.hll_union_agg("stores")).alias("stores_estimate"))


def stores_exact(sales: DataFrame, months: int, latest=None) -> DataFrame:
    """``(product_id, stores_selling)`` over the same window, counted from the fact."""
    month = C.month_start("week_ending")
    if latest is not None:
        start = F.add_months(F.trunc(F.lit(latest), "month"), 1 - months)
        sales = sales.where(month.between(start, F.lit(latest)))
    return sales.groupBy("product_id").agg(F.count_distinct("retailer_id").alias("stores_selling"))


def acv_distribution(sales: DataFrame) -> DataFrame:
    """F12 + F13: all-commodity-volume weighted distribution by product x month.

    acv_pct = 100 x (sell-out of the accounts that sold the item that month)
              / (sell-out of all accounts that month);
    stores_selling = accounts that sold the item that month.
    Every step is a keyed aggregation or equi-join; the per-month total has
    one row per month.
    """
    s = sales.select("product_id", "retailer_id",
                     C.month_start("week_ending").alias("month"), "pos_revenue")
    acct = s.groupBy("retailer_id", "month").agg(F.sum("pos_revenue").alias("acct_vol"))
    market = acct.groupBy("month").agg(F.sum("acct_vol").alias("market_vol"))
    carried = s.select("product_id", "retailer_id", "month").distinct()
    per_item = (carried.join(acct, ["retailer_id", "month"])
                .groupBy("product_id", "month")
                .agg(F.sum("acct_vol").alias("sel_vol"),
                     F.count(F.lit(1)).alias("stores_selling")))
    return per_item.join(market, "month").select(
        "product_id", F.col("month").cast("string").alias("month"),
        C.safe_ratio(C.as_double("sel_vol") * 100.0, "market_vol", 1).alias("acv_pct"),
        "stores_selling")
