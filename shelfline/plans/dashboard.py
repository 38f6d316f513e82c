"""The dashboard — KPI cards and five chart series as one
plan over the shared model tables.

The sales fact is scanned once: one aggregation over grouping sets (by week, by
product, by account and in total) with conditional sums for the trailing window
feeds the KPI cards and three series; promotions are aggregated by mechanic and in
total in the same way.  Dimensions are joined to the aggregated rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.operators import share
from shelfline.plans.model import Model

# KPI card labels, in display order.
KPI_LABELS = ["Sell-out revenue (13 wk)", "Units sold (13 wk)", "Promotions w/ negative ROI",
              "Active SKUs", "Retail accounts"]


KPI_KEYS = ["revenue_13w", "units_13w", "negative_roi_promos", "active_skus", "retail_accounts"]
#: Accounts are ranked within this many groups first, so that no task ranks all.
RANK_GROUPS = 64
ROW = "tile string, ord int, label string, value double"


def _since(week: str, latest: dt.date | None, weeks: int) -> Column:
    return F.lit(False) if latest is None else F.col(week) >= F.lit(latest - dt.timedelta(weeks=weeks))


def sales_rollup(m: Model, kpi_weeks: int = 13, trend_weeks: int = 26) -> DataFrame:
    """(tile, label, revenue, recent, units): revenue of the weeks of the trend, of
    categories and of accounts, and (tile ``kpis``) revenue and units of the KPI
    window; from one scan of the sales fact."""
    latest = m.max_of("sales", "week_ending")
    recent = _since("week_ending", latest, kpi_weeks)
    fact = m.sales().select("week_ending", "product_id", "retailer_id", F.col("pos_revenue").alias("revenue"),
                            F.when(recent, F.col("pos_revenue")).alias("recent"),
                            F.when(recent, F.col("units_sold")).alias("units"))
    sets = fact.groupingSets([["week_ending"], ["product_id"], ["retailer_id"], []], "week_ending", "product_id", "retailer_id")
    by = {"revenue_trend": 0b011, "sales_by_category": 0b101, "top_retailers": 0b110, "kpis": 0b111}
    rolled = sets.agg(F.grouping_id().alias("g"), *[F.sum(c).alias(c) for c in ("revenue", "recent", "units")])
    products = m.products().select("product_id", "category", F.lit(True).alias("sku"))
    accounts = m.retailers().select("retailer_id", "retailer_name", F.lit(True).alias("account"))
    named = rolled.join(products, "product_id", "left").join(accounts, "retailer_id", "left").where(
        ((F.col("g") == by["revenue_trend"]) & _since("week_ending", latest, trend_weeks))
        | ((F.col("g") == by["sales_by_category"]) & F.col("sku"))
        | ((F.col("g") == by["top_retailers"]) & F.col("account")) | (F.col("g") == by["kpis"]))
    tile, label = F.lit(None).cast("string"), F.lit(None).cast("string")
    for (name, g), value in zip(by.items(), (F.col("week_ending").cast("string"), F.col("category"), F.col("retailer_name"),
                                             F.lit(None).cast("string"))):
        tile = F.when(F.col("g") == g, name).otherwise(tile)
        label = F.when(F.col("g") == g, value).otherwise(label)
    nothing = m.spark.range(1).select(F.lit("kpis").alias("tile"), F.lit(None).cast("string").alias("label"),
                                      *[F.lit(0).alias(c) for c in ("revenue", "recent", "units")])
    return (named.select(tile.alias("tile"), label.alias("label"), "revenue", "recent", "units").unionByName(nothing)
            .groupBy("tile", "label").agg(*[F.sum(c).alias(c) for c in ("revenue", "recent", "units")]))


def promo_rollup(promos: DataFrame) -> DataFrame:
    """(promo_type, in_total, roi, n, negative) by mechanic and in total, from one scan;
    the total is there for an empty table, too."""
    sets = promos.groupingSets([["promo_type"], []], "promo_type").agg(
        (F.grouping_id() == 1).alias("in_total"), F.sum("roi").alias("roi"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("roi") < 0).alias("negative"))
    nothing = promos.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("promo_type"), F.lit(True).alias("in_total"), F.lit(0).alias("roi"),
        F.lit(0).alias("n"), F.lit(0).alias("negative"))
    return sets.unionByName(nothing).groupBy("promo_type", "in_total").agg(*[F.sum(c).alias(c) for c in ("roi", "n", "negative")])


def _rows(*found: tuple) -> Column:
    """An array of (tile, ord, label, value) rows."""
    return F.array(*[F.struct(F.lit(t).alias("tile"), F.lit(o).cast("int").alias("ord"), label.cast("string").alias("label"),
                              value.cast("double").alias("value")) for t, o, label, value in found])


def _kpi(ord_: int, value: Column) -> tuple:
    return "kpis", ord_, F.lit(KPI_KEYS[ord_ - 1]), F.coalesce(value, F.lit(0))


def _counts(m: Model) -> DataFrame:
    n = F.count(F.lit(1)).alias("n")
    skus, accounts = m.products().agg(n), m.retailers().agg(n)
    return (skus.select(F.inline(_rows(_kpi(4, F.col("n"))))).unionByName(accounts.select(F.inline(_rows(_kpi(5, F.col("n")))))))


def kpi_cards(spark: SparkSession, sf: str) -> DataFrame:
    """C17 + F1: formatted KPI tiles (``$#,###``; 0 when the window is empty)."""
    m = Model(spark, sf)
    recent = m.sales().where(_since("week_ending", m.max_of("sales", "week_ending"), 13))
    sums = recent.agg(F.sum("pos_revenue").alias("recent"), F.sum("units_sold").alias("units"))
    negative = m.promotions().agg(F.count_if(F.col("roi") < 0).alias("negative"))
    rows = (sums.select(F.inline(_rows(*_window_kpis()))).unionByName(negative.select(F.inline(_rows(_kpi(3, F.col("negative"))))))
            .unionByName(_counts(m)))
    label, value = _card()
    return rows.select("ord", label.alias("label"), value.alias("value"))


def _window_kpis() -> list[tuple]:
    return [_kpi(1, F.round("recent", 0)), _kpi(2, F.col("units"))]


def _card() -> tuple[Column, Column]:
    """Label and formatted value of a KPI row."""
    grouped = F.format_number("value", 0)
    return (F.element_at(F.array(*map(F.lit, KPI_LABELS)), F.col("ord")),
            F.when(F.col("ord") == 1, F.concat(F.lit("$"), grouped)).when(F.col("ord") == 2, grouped)
            .otherwise(F.col("value").cast("bigint").cast("string")))


def _sales_rows(rolled: DataFrame, retailers: int = 8) -> DataFrame:
    """The sales rollup as payload rows: two KPIs, and three series in display order
    (weeks ascending, others by revenue; the best accounts only).  Accounts are cut to
    the best of each of RANK_GROUPS groups before they are ranked together."""
    one = _rows(("", 0, F.col("label"), F.round("revenue", 0)))
    rows = rolled.select(F.col("tile").alias("of"), F.inline(F.when(F.col("tile") == "kpis", _rows(*_window_kpis())).otherwise(one)))
    order = [F.when(F.col("of") == "revenue_trend", F.col("label")), F.desc("value"), F.col("label")]
    best = (F.col("of") != "top_retailers") | (F.col("place") <= retailers)
    group = F.when(F.col("of") == "top_retailers", F.pmod(F.xxhash64("label"), F.lit(RANK_GROUPS))).otherwise(F.lit(0))
    some = rows.withColumn("group", group).withColumn(
        "place", F.row_number().over(Window.partitionBy("of", "group").orderBy(*order))).where(best)
    placed = some.withColumn("place", F.row_number().over(Window.partitionBy("of").orderBy(*order))).where(best)
    return placed.select(F.col("of").alias("tile"), F.when(F.col("of") == "kpis", F.col("ord")).otherwise(F.col("place")).alias("ord"),
                         "label", "value")


def _promo_rows(rolled: DataFrame) -> DataFrame:
    """The promotion rollup as payload rows: a KPI, and by mechanic the average ROI and
    the number of promotions."""
    placed = rolled.withColumn("place", F.row_number().over(Window.partitionBy("in_total").orderBy("promo_type")))
    avg = C.rounded(C.as_double("roi") / C.as_double("n"), 3)
    both = _rows(("roi_by_type", 0, F.col("promo_type"), avg), ("roi_counts", 0, F.col("promo_type"), F.col("n")))
    rows = placed.select("in_total", "place", F.inline(F.when(F.col("in_total"), _rows(_kpi(3, F.col("negative")))).otherwise(both)))
    return rows.select("tile", F.when(F.col("in_total"), F.col("ord")).otherwise(F.col("place")).alias("ord"), "label", "value")


def dashboard_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Tidy payload rows ``(tile, ord, label, value)``."""
    m = Model(spark, sf)
    shares = share.share_by_brand(m.market_share(), 10, m.max_of("market_share", "month"))
    brands = shares.select(F.lit("share_by_brand").alias("tile"),
                           F.row_number().over(Window.orderBy(F.desc("share"), "brand")).alias("ord"),
                           F.col("brand").alias("label"), F.col("share").alias("value"))
    return (_sales_rows(sales_rollup(m)).unionByName(_promo_rows(promo_rollup(m.promotions())))
            .unionByName(_counts(m)).unionByName(brands))


#: The document's series, and the kind of their numbers.
SERIES = {"revenue_trend": "decimal(38,0)", "sales_by_category": "decimal(38,0)", "top_retailers": "decimal(38,0)",
          "share_by_brand": "decimal(18,2)"}


def dashboard_json(payload: DataFrame) -> DataFrame:
    """The payload as one JSON document: ``kpis``, a list of labels with formatted
    values; series of ``labels`` and ``values``; ``roi_by_type`` with ``labels``,
    ``avg_roi`` and ``counts``.  Numbers are numbers.  A tile holds a bounded number of
    rows (weeks of the window, mechanics, categories, top-k), so the document is small
    whatever the facts' size."""
    label, card = _card()
    shown = payload.withColumns({"card": F.when(F.col("tile") == "kpis", card), "title": F.when(F.col("tile") == "kpis", label)})

    def rows(tile: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("tile") == tile, F.struct("ord", "label", "value", "title", "card"))))

    tiles = ["kpis", "roi_by_type", "roi_counts", *SERIES]
    one = shown.agg(*[rows(t).alias(t) for t in tiles])

    def values(tile: str, kind: str) -> Column:
        return F.transform(F.col(tile), lambda r: r["value"].cast(kind))

    def labels(tile: str) -> Column:
        return F.transform(F.col(tile), lambda r: r["label"]).alias("labels")

    series = {t: F.struct(labels(t), values(t, kind).alias("values")).alias(t) for t, kind in SERIES.items()}
    cards = F.transform("kpis", lambda r: F.struct(r["title"].alias("label"), r["card"].alias("value"))).alias("kpis")
    roi = F.struct(labels("roi_by_type"), values("roi_by_type", "decimal(18,3)").alias("avg_roi"),
                   values("roi_counts", "bigint").alias("counts")).alias("roi_by_type")
    trend, *others = series.values()
    return one.select(F.to_json(F.struct(cards, trend, roi, *others)).alias("payload"))
