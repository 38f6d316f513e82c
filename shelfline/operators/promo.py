"""Trade-promotion metrics: lift (C9), ROI (C10), windows (C12), ROI by
mechanic (F3), negative-ROI lists (D4, F8, G4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.operators.windows import trailing_weeks

# Promotions carry no unique id of their own (order_key, line_number repeat
# in the source), so every ordering ends with all identifying columns.
PROMO_KEY = ["order_key", "line_number", "product_id", "retailer_id", "start_date",
             "promoted_units", "promo_spend"]


def promo_lift(promos: DataFrame) -> DataFrame:
    """incremental = max(units - baseline, 0); promoted = units."""
    return promos.select("order_key", "line_number", "product_id", "baseline_units",
                         "incremental_units", "promoted_units",
                         C.as_double("lift_pct").alias("lift_pct"))


def promo_roi(promos: DataFrame) -> DataFrame:
    """Trade spend and incremental ROI (0.0 when spend is 0)."""
    return promos.select("order_key", "line_number", "promo_type",
                         C.money_out("promo_spend").alias("promo_spend"),
                         C.as_double("roi").alias("roi"))


def promo_windows(promos: DataFrame) -> DataFrame:
    """Promotion window [start, start + 7 x weeks)."""
    return promos.select("order_key", "line_number", "start_date", "end_date",
                         F.datediff("end_date", "start_date").cast("bigint").alias("days"))


def roi_by_type(promos: DataFrame) -> DataFrame:
    """average ROI (exact decimal sum / count, 3 decimals) and count."""
    g = promos.groupBy("promo_type").agg(F.sum("roi").alias("s"), F.count(F.lit(1)).alias("n"))
    return g.select("promo_type", C.rounded(C.as_double("s") / C.as_double("n"), 3)
                    .alias("avg_roi"), "n").orderBy("promo_type")


def negative_roi_count(promos: DataFrame) -> DataFrame:
    """Promotions with roi < 0, by mechanic."""
    return (promos.filter(F.col("roi") < 0).groupBy("promo_type")
            .agg(F.count(F.lit(1)).alias("n_negative")))


def negative_roi_promos(promos: DataFrame, products: DataFrame, retailers: DataFrame,
                        weeks: int = 13, anchor=None) -> DataFrame:
    """F8: money-losing promotions that started in the last ``weeks`` weeks
    (anchored on the latest promotion start), worst first."""
    recent = trailing_weeks(promos, "start_date", weeks, anchor).filter(F.col("roi") < 0)
    j = (recent.join(products.select("product_id", "product_name"), "product_id")
         .join(retailers.select("retailer_id", "retailer_name"), "retailer_id"))
    return j.select(
        "order_key", "line_number", "product_id", "retailer_id", "start_date",
        "promoted_units", "product_name", "retailer_name", "promo_type",
        C.as_double("discount_depth_pct").alias("discount_depth_pct"),
        C.money_out("promo_spend").alias("promo_spend"),
        C.as_double("lift_pct").alias("lift_pct"), C.as_double("roi").alias("roi")).orderBy(*WORST_FIRST)


WORST_FIRST = ("roi", "order_key", "line_number", "product_id", "retailer_id", "start_date", "promoted_units", "promo_spend")


def worst_promos(neg: DataFrame, k: int = 5) -> DataFrame:
    """The k worst of ``negative_roi_promos`` (full-key tie-break)."""
    return neg.orderBy(*WORST_FIRST).limit(k)
