"""Inventory: running on-hand (F16), weeks of supply (C8), every-4th-week
snapshots (B5) and lowest supply by account (F10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import columns as C


def weeks_of_supply(on_hand, sold) -> "F.Column":
    """round(on_hand / max(sold, 1), 1)."""
    return C.rounded_dec(C.as_double(on_hand) /
                         C.as_double(F.greatest(C.col_(sold), F.lit(1))), 1)


def running_on_hand(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Running sell-in minus sell-out per ``keys`` ordered by week.

    The fact is first reduced to one row per key x week, so a window
    partition holds at most one row per week however hot the key is."""
    weekly = (sales.groupBy(*keys, "week_ending")
              .agg(F.sum("units_shipped").alias("shipped"), F.sum("units_sold").alias("sold")))
    w = (Window.partitionBy(*keys).orderBy("week_ending")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (weekly.withColumn("units_on_hand", F.sum(F.col("shipped") - F.col("sold")).over(w))
            .withColumn("weeks_of_supply", weeks_of_supply("units_on_hand", "sold")))


def inventory_running(sales: DataFrame) -> DataFrame:
    """F16: product-level running inventory."""
    r = running_on_hand(sales, ["product_id"])
    return r.select("product_id", F.col("week_ending").cast("string").alias("week"),
                    "shipped", "sold", "units_on_hand",
                    C.as_double("weeks_of_supply").alias("weeks_of_supply"))


def inventory_snapshots(sales: DataFrame) -> DataFrame:
    """Every 4th week of the global weekly spine (w0 = first week)."""
    r = running_on_hand(sales, ["product_id"])
    w0 = sales.select(F.min("week_ending")).scalar()
    idx = F.floor(F.datediff("week_ending", w0) / 7)
    return (r.filter(idx % 4 == 0)
            .select("product_id", F.col("week_ending").cast("string").alias("week"),
                    "units_on_hand",
                    C.as_double("weeks_of_supply").alias("weeks_of_supply")))


def lowest_supply(sales: DataFrame, products: DataFrame, retailers: DataFrame,
                  product_name: str) -> DataFrame:
    """mean weeks of supply per account for one product, ascending.

    The name filter is applied through the join before the window, so only
    that product's rows are sorted."""
    p = products.filter(F.col("product_name") == product_name).select("product_id")
    s = sales.join(p, "product_id", "left_semi")
    r = running_on_hand(s, ["product_id", "retailer_id"])
    g = (r.join(retailers.select("retailer_id", "retailer_name"), "retailer_id")
         .groupBy("retailer_name")
         .agg(F.sum("weeks_of_supply").alias("s"), F.count(F.lit(1)).alias("n")))
    return (g.select("retailer_name",
                     C.rounded(C.as_double("s") / C.as_double("n"), 3).alias("avg_weeks_of_supply"))
            .orderBy("avg_weeks_of_supply", "retailer_name"))
