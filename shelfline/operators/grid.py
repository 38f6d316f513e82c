"""Spines, panels and derived measures (B- and C-series).

The reference draws these with driver-side loops; here they are column
work on executors: ``sequence`` + ``explode`` generators, keyed aggregates
and equi-joins.  No cross joins: a panel is generated per carried pair from
its own first and last week.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.sources import seed
from shelfline.sources.tables import Tables


def week_spine(spark: SparkSession, sf: str) -> DataFrame:
    """B1: every week-ending Saturday between the first and last shipment."""
    li = Tables(spark, sf).lineitem
    b = li.agg(F.min(F.to_date("l_shipdate")).alias("lo"), F.max(F.to_date("l_shipdate")).alias("hi"))
    return b.select(F.explode(F.sequence(C.week_ending("lo"), C.week_ending("hi"),
                                         F.expr("INTERVAL 7 DAYS"))).alias("week_ending"))


def month_spine(spark: SparkSession, sf: str) -> DataFrame:
    """B1: first day of every month between the first and last shipment."""
    li = Tables(spark, sf).lineitem
    b = li.agg(F.min(F.to_date("l_shipdate")).alias("lo"), F.max(F.to_date("l_shipdate")).alias("hi"))
    return b.select(F.explode(F.sequence(C.month_start("lo"), C.month_start("hi"),
                                         F.expr("INTERVAL 1 MONTH"))).alias("month"))


def carried_pairs(sales: DataFrame) -> DataFrame:
    """The assortment — product x account pairs that sold, with their
    first and last week (map-side partial aggregation, no skew hot spot)."""
    return (sales.groupBy("product_id", "retailer_id")
            .agg(F.min("week_ending").alias("first_week"), F.max("week_ending").alias("last_week"),
                 F.count(F.lit(1)).alias("active_weeks")))


def sales_grid(sales: DataFrame) -> DataFrame:
    """B2 + E5: dense product x account x week panel over each pair's active
    span, sell-out filled with 0 where the week had no sale."""
    pairs = carried_pairs(sales)
    grid = pairs.select("product_id", "retailer_id",
                        F.explode(F.sequence("first_week", "last_week",
                                             F.expr("INTERVAL 7 DAYS"))).alias("week_ending"))
    s = sales.select("product_id", "retailer_id", "week_ending", "units_sold")
    return (grid.join(s, ["product_id", "retailer_id", "week_ending"], "left")
            .select("product_id", "retailer_id", F.col("week_ending").cast("string").alias("week"),
                    F.coalesce("units_sold", F.lit(0).cast("bigint")).alias("units_sold")))


def with_pack_family(spark: SparkSession, products: DataFrame) -> DataFrame:
    """Category -> pack family lookup with a default (left join to a
    fixed 3-row code table, then coalesce)."""
    fam = seed.category_families(spark)
    return (products.join(F.broadcast(fam), "category", "left")
            .withColumn("pack_family", F.coalesce("pack_family", F.lit(seed.DEFAULT_PACK_FAMILY))))


def sku_expand(spark: SparkSession, products: DataFrame) -> DataFrame:
    """B4 + C13: each product expands into its family's pack variants;
    price = list x multiplier, SKU code ``NS-<BRA>-<id>-<n>``."""
    packs = seed.pack_variants(spark)
    p = with_pack_family(spark, products)
    x = p.join(F.broadcast(packs), "pack_family")
    return x.select("product_id", "variant_no", "variant", "pack_family",
                    sku_code("brand", "product_id", "variant_no").alias("sku"),
                    C.money_out(F.round(F.col("list_price") * F.col("multiplier"), 2))
                    .alias("pack_price"))


def sku_code(brand, pid, variant_no=None) -> "F.Column":
    """``NS-{brand[:3].upper()}-{id}`` (variant number appended)."""
    parts = [F.lit("NS"), F.upper(F.substring(C.col_(brand), 1, 3)), C.col_(pid).cast("string")]
    if variant_no is not None:
        parts.append(C.col_(variant_no).cast("string"))
    return F.concat_ws("-", *parts)


def brand_category(products: DataFrame) -> DataFrame:
    """Per brand, its first category (by product id) and category count."""
    return (products.groupBy("brand")
            .agg(F.min_by("category", "product_id").alias("first_category"),
                 F.countDistinct("category").alias("n_categories"),
                 F.count(F.lit(1)).alias("n_products"))
            .orderBy("brand"))


def sales_pricing(sales: DataFrame, products: DataFrame) -> DataFrame:
    """C4: sell-in value at list (shipped x list x 0.62), sell-out value at
    the realised price, and the promoted shelf price (list x 0.78)."""
    j = sales.join(products.select("product_id", "list_price", "unit_cogs"), "product_id")
    promo_price = F.when(F.col("on_promo"), F.round(F.col("list_price") * F.lit(Decimal("0.78")), 2)) \
        .otherwise(F.col("list_price"))
    return j.select(
        "product_id", "retailer_id", F.col("week_ending").cast("string").alias("week"),
        C.money_out(F.col("units_shipped") * F.col("list_price") * F.lit(Decimal("0.62")))
        .alias("sell_in_value"),
        C.money_out(F.col("units_sold") * F.col("avg_selling_price")).alias("sell_out_value"),
        C.money_out(F.col("units_sold") * F.col("unit_cogs")).alias("cogs_value"),
        C.money_out(promo_price).alias("shelf_price"))


def seasonality_index(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Per category and calendar month, mean monthly sell-out in that
    month over the category's mean monthly sell-out (3 decimals)."""
    # Reduce the fact to product x month before joining the dimension.
    by_product = (sales.groupBy("product_id", C.month_start("week_ending").alias("month"))
                  .agg(F.sum("pos_revenue").alias("prev")))
    monthly = (by_product.join(products.select("product_id", "category"), "product_id")
               .groupBy("category", "month")
               .agg(F.sum("prev").alias("rev")))
    by_moy = (monthly.groupBy("category", F.month("month").alias("month_of_year"))
              .agg(F.sum("rev").alias("s"), F.count(F.lit(1)).alias("n")))
    overall = monthly.groupBy("category").agg(F.sum("rev").alias("s_all"),
                                               F.count(F.lit(1)).alias("n_all"))
    j = by_moy.join(overall, "category")
    return j.select("category", "month_of_year",
                    C.safe_ratio(C.as_double("s") / C.as_double("n"),
                                 C.as_double("s_all") / C.as_double("n_all"), 3)
                    .alias("seasonality"))


# Factor of a pack family in the given calendar months (1 elsewhere).
SEASON_FACTORS = (("Beverages", (6, 7, 8), "1.25"), ("Beverages", (12, 1, 2), "0.90"),
                  ("Snacks", (11, 12), "1.20"))


def season_factor(family, month) -> "F.Column":
    """The factor of a pack family in a calendar month, as a rule."""
    out = F.lit(Decimal("1.00"))
    for name, months, factor in reversed(SEASON_FACTORS):
        out = F.when((C.col_(family) == name) & C.col_(month).isin(*months), F.lit(Decimal(factor))).otherwise(out)
    return out


def seasonal_units(spark, sales: DataFrame, products: DataFrame) -> DataFrame:
    """Units sold by pack family and calendar month, the rule's factor and the
    units with the factor taken out.  The fact is reduced to product x month of
    the year before the product's family is joined."""
    by_product = (sales.groupBy("product_id", F.month("week_ending").alias("month_of_year"))
                  .agg(F.sum("units_sold").alias("units")))
    families = with_pack_family(spark, products).select("product_id", "pack_family")
    g = (by_product.join(families, "product_id").groupBy("pack_family", "month_of_year")
         .agg(F.sum("units").alias("units")).withColumn("f", season_factor("pack_family", "month_of_year")))
    return g.select("pack_family", "month_of_year", "units", C.as_double("f").alias("factor"),
                    C.rounded(C.as_double("units") / C.as_double("f"), 2).alias("base_units"))


def clamped_units(sales: DataFrame) -> DataFrame:
    """Units left over a week, never below 0, and how many weeks of its sales
    they are, the divisor never below 1."""
    left = F.greatest(F.col("units_shipped") - F.col("units_sold"), F.lit(0).cast("bigint"))
    return sales.select(
        "product_id", "retailer_id", F.col("week_ending").cast("string").alias("week"), left.alias("units_left"),
        C.rounded(C.as_double(left) / F.greatest(F.col("units_sold"), F.lit(1)).cast("double"), 1).alias("weeks_left"))


def clamped_measures(ms: DataFrame) -> DataFrame:
    """Share as a fraction floored at 0.005 and capped at 99.5 percent."""
    frac = C.rounded_dec(C.as_double("dollar_share_pct") / 100.0, 4)
    return ms.select(F.col("month").cast("string").alias("month"), "brand", "category",
                     C.as_double(F.greatest(frac, F.lit(Decimal("0.005")))).alias("share_floor"),
                     C.as_double(F.least(F.col("dollar_share_pct"), F.lit(Decimal("99.5"))))
                     .alias("share_cap"))


def account_scale(sales: DataFrame, default_units: int = 1500) -> DataFrame:
    """C11: account size relative to the mean account, zeros replaced by a
    default.  The mean is an uncorrelated scalar subquery, not a join."""
    acct = (sales.groupBy("retailer_id").agg(F.sum("units_sold").alias("units"))
            .withColumn("units", F.when(F.col("units") == 0, F.lit(default_units))
                        .otherwise(F.col("units"))))
    # Exact integer sum over an exact count: the same mean on any partitioning.
    mean = acct.select(F.sum("units").cast("double") / F.count(F.lit(1))).scalar()
    return acct.select("retailer_id", "units", C.rounded(C.as_double("units") / mean, 6)
                       .alias("scale"))
