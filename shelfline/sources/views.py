"""The star-schema data model built from the shared tables.

Each function returns one logical table of the consumer-goods model as a
DataFrame.  They are plain projections, joins and aggregations, so Catalyst
prunes columns and pushes filters into the parquet scans of whatever query
uses them.  ``plans.model`` materialises the expensive ones (lines, sales,
promotions, market share) once per session so queries do not rebuild them.

Mapping (also documented in FIXTURES.md part B):
  products   <- part          retailers <- customer, nation, region
  lines      <- lineitem, orders (one row per shipped line)
  sales      <- lines by product x retailer x week (sell-in and sell-out)
  promotions <- lines with a funded discount
  documents  <- documents     vectors   <- embeddings
  memory log / action items <- events;  chat / spans / deltas <- conversations
  assessments <- labels
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.functions import columns as C
from shelfline.sources.tables import Tables

# Fixed values of the model (discount depth -> promotion mechanic, shares).
PROMO_MIN_DISCOUNT = 0.05
PROMO_TYPES_BY_DEPTH = [(0.05, "TPR"), (0.06, "Display"), (0.07, "Feature"),
                        (0.08, "Feature+Display")]  # 0.09 and deeper: "BOGO"
SHIP_COST_SHARE = Decimal("0.62")   # sell-in revenue = gross x 0.62
COGS_SHARE = Decimal("0.45")        # unit cost = 0.45 x price
MARGIN_SHARE = 0.55                 # 1 - COGS_SHARE (applied to DOUBLE units)
# Decimal literals keep money arithmetic exact; F.lit(0.62) would be DOUBLE.


def products(spark: SparkSession, sf: str) -> DataFrame:
    p = Tables(spark, sf).part
    price = C.money("p_retailprice")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        price.alias("list_price"),
        F.round(price * F.lit(COGS_SHARE), 2).cast(C.MONEY).alias("unit_cogs"),
    )


def retailers(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    # nation (25 rows) and region (5 rows) are fixed-size code tables.
    geo = (t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    return (t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("retailer_id"),
                    F.col("c_name").alias("retailer_name"),
                    F.col("c_mktsegment").alias("channel"),
                    F.col("r_name").alias("region")))


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per shipped line with its account (lineitem joined to orders)."""
    t = Tables(spark, sf)
    return lines_from(t.lineitem, t.orders)


def lines_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The shipped lines of some lineitem and orders rows (see ``lines``)."""
    # the narrow types before the join: they are what is shuffled
    li = lineitem.select(F.col("l_orderkey").alias("order_key"),
                         F.col("l_linenumber").alias("line_number"),
                         F.col("l_partkey").alias("product_id"),
                         F.to_date("l_shipdate").alias("d"),
                         F.col("l_quantity").alias("qty"),
                         C.money("l_extendedprice").alias("gross"),
                         C.discount("l_discount").alias("disc"),
                         (F.col("l_returnflag") == "R").alias("returned"))
    o = orders.select("o_orderkey", F.col("o_custkey").alias("retailer_id"))
    return (li.join(o, F.col("order_key") == F.col("o_orderkey"))
            .select("order_key", "line_number", "product_id", "retailer_id", "d", "qty", "gross", "disc", "returned"))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly sell-in and sell-out by product x retailer (the sales fact)."""
    return sales_from(lines(spark, sf))


def sales_from(ln: DataFrame) -> DataFrame:
    """The sales fact from shipped lines (see ``lines``)."""
    return sales_of(sales_sums(ln))


SUM = "decimal(38,4)"                # exact sums of money, before they are rounded


#: Shares of a month's sums: a task holds some of them, a month lies in this many files at most.
MONTH_SHARES = 16
_CELL = ("product_id", "retailer_id", "week_ending")


def _cells(rows: DataFrame):
    """Rows grouped by product x retailer x week, dealt by month and share: one shuffle
    both gathers a cell's rows and leaves a month in few tasks, so that the sums are
    written by month where they are made."""
    month = C.month_start("week_ending").alias("month")
    share = F.pmod(F.xxhash64(*_CELL), F.lit(MONTH_SHARES)).cast("int").alias("share")
    return rows.select("*", month, share).repartition("month", "share").groupBy("month", "share", *_CELL)


def sales_sums(ln: DataFrame) -> DataFrame:
    """Sums by product x retailer x week that can be added up (``merged_sums``), with
    their month.  ``pos_sum`` is null where every line was returned."""
    kept = ~F.col("returned")
    return (_cells(ln.select("product_id", "retailer_id", C.week_ending("d").alias("week_ending"), "qty", "gross", "disc", "returned"))
            .agg(F.sum("qty").alias("qty"),
                 F.sum(F.col("gross") * F.lit(SHIP_COST_SHARE)).cast(SUM).alias("ship_sum"),
                 F.sum(F.when(kept, F.col("qty")).otherwise(F.lit(0.0))).alias("kept_qty"),
                 F.sum(F.when(kept, F.col("gross") * (F.lit(1) - F.col("disc")))).cast(SUM).alias("pos_sum"),
                 F.max("disc").alias("disc")).drop("share"))


def merged_sums(sums: DataFrame) -> DataFrame:
    """Sums of several sets of lines added up."""
    total = [F.sum(c).cast(t).alias(c) for c, t in (("qty", "double"), ("ship_sum", SUM), ("kept_qty", "double"), ("pos_sum", SUM))]
    return _cells(sums).agg(*total, F.max("disc").alias("disc")).drop("share")


def sales_of(sums: DataFrame) -> DataFrame:
    """The sales fact of its sums: a projection, so filters on the keys reach the scan."""
    raw, units = F.col("pos_sum").cast(C.MONEY), F.col("kept_qty").cast("bigint")
    return sums.select(
        "product_id", "retailer_id", "week_ending", F.col("qty").cast("bigint").alias("units_shipped"),
        F.col("ship_sum").cast(C.MONEY).alias("shipment_revenue"), units.alias("units_sold"),
        F.coalesce(raw, F.lit(0).cast(C.MONEY)).alias("pos_revenue"),
        F.round((C.as_double(raw) / F.when(units != 0, C.as_double(units))).cast(C.RATIO), 2)
        .cast(C.MONEY).alias("avg_selling_price"),
        (F.col("disc") >= F.lit(PROMO_MIN_DISCOUNT)).alias("on_promo"))


def promo_type(disc) -> "F.Column":
    expr = F.when(C.col_(disc) >= F.lit(0.09), F.lit("BOGO"))
    for depth, name in PROMO_TYPES_BY_DEPTH:
        expr = expr.when(C.col_(disc) == F.lit(depth), F.lit(name))
    return expr


def promo_weeks(order_key) -> "F.Column":
    """A promotion runs 1, 2 or 4 weeks (dealt by the order's key)."""
    turn = F.pmod(C.col_(order_key), F.lit(3))
    return F.when(turn == 0, F.lit(1)).when(turn == 1, F.lit(2)).otherwise(F.lit(4))


def promotions(spark: SparkSession, sf: str) -> DataFrame:
    """Trade promotions: lines with a funded discount, measured against the
    product's non-promoted mean quantity (baseline)."""
    return promotions_from(lines(spark, sf))


def promotions_from(ln: DataFrame) -> DataFrame:
    """Trade promotions from shipped lines (see ``promotions``)."""
    baseline = (ln.filter(F.col("disc") < F.lit(PROMO_MIN_DISCOUNT))
                .groupBy("product_id")
                .agg(F.floor(F.avg("qty")).cast("bigint").alias("baseline_units")))
    promo = ln.filter(F.col("disc") >= F.lit(PROMO_MIN_DISCOUNT))
    joined = promo.join(baseline, "product_id", "left")
    base = F.coalesce("baseline_units", F.lit(0).cast("bigint"))
    incr = F.greatest(F.col("qty") - base, F.lit(0.0))
    spend = F.col("gross") * F.col("disc")
    return joined.select(
        F.col("order_key"), F.col("line_number"), "product_id", "retailer_id",
        promo_type("disc").alias("promo_type"),
        F.col("d").alias("start_date"),
        F.date_add("d", 7 * promo_weeks("order_key")).alias("end_date"),
        spend.cast(C.MONEY).alias("promo_spend"),
        (F.col("disc") * F.lit(100)).cast("decimal(5,1)").alias("discount_depth_pct"),
        base.alias("baseline_units"),
        F.col("qty").cast("bigint").alias("promoted_units"),
        incr.cast("bigint").alias("incremental_units"),
        F.round((incr * F.lit(100.0) / F.when(base > 0, base.cast("double"))).cast(C.RATIO), 1)
        .alias("lift_pct"),
        promo_roi_value(incr, F.col("qty"), F.col("disc"), spend).alias("roi"),
    )


def promo_roi_value(incremental, qty, disc, spend) -> "F.Column":
    """Incremental ROI = (incremental x unit_price x margin - spend) / spend,
    0 when spend is 0.  With unit_price = gross / qty and spend = gross x disc
    it reduces to incremental x margin / (qty x disc) - 1; rounded to 3."""
    den = C.col_(qty) * C.as_double(disc)
    raw = (C.col_(incremental) * F.lit(MARGIN_SHARE)) / F.when(den != 0, den) - F.lit(1.0)
    return (F.when(C.col_(spend) > 0, F.round(raw.cast(C.RATIO), 3))
            .otherwise(F.lit(0).cast(C.RATIO)).cast("decimal(12,3)"))


def market_share(spark: SparkSession, sf: str) -> DataFrame:
    """brand dollars / category dollars by month."""
    return market_share_from(lines(spark, sf), products(spark, sf))


def market_share_from(lines_df: DataFrame, products_df: DataFrame) -> DataFrame:
    """Market share from shipped lines and products (see ``market_share``)."""
    # A product has few lines a month, so sums by product and month first would be
    # shuffled twice and hardly be fewer; sums by brand are made before the shuffle.
    by_line = lines_df.select("product_id", C.month_start("d").alias("month"), "gross")
    p = products_df.select("product_id", "brand", "category")
    brand_month = (by_line.join(p, "product_id")
                   .groupBy("month", "brand", "category")
                   .agg(F.sum("gross").alias("brand_dollar_sales")))
    # At most one row per brand inside a (month, category) partition.
    w = Window.partitionBy("month", "category")
    with_cat = brand_month.withColumn("category_dollar_sales",
                                      F.sum("brand_dollar_sales").over(w))
    return with_cat.select(
        "month", "brand", "category",
        F.col("brand_dollar_sales").cast(C.MONEY).alias("brand_dollar_sales"),
        F.col("category_dollar_sales").cast(C.MONEY).alias("category_dollar_sales"),
        F.round((C.as_double("brand_dollar_sales") * 100.0 /
                 F.when(F.col("category_dollar_sales") != 0,
                        C.as_double("category_dollar_sales"))).cast(C.RATIO), 2)
        .alias("dollar_share_pct"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents_from(Tables(spark, sf).documents)


def documents_from(d: DataFrame) -> DataFrame:
    return d.select("doc_id", F.col("source").alias("doc_type"),
                    F.col("lang").alias("category"),
                    C.collapse_ws("text").alias("content"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors_from(Tables(spark, sf).embeddings)


def vectors_from(e: DataFrame) -> DataFrame:
    return e.select(F.col("vec_id").alias("doc_id"), "embedding", "label")


def memory_log(spark: SparkSession, sf: str) -> DataFrame:
    """Append-only keyed memory log: put rows and delete tombstones."""
    return memory_log_from(Tables(spark, sf).events)


def memory_log_from(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("key"),
        F.col("props").alias("value_json"),
        F.when(F.col("event_id") % 10 == 0, F.lit("delete")).otherwise(F.lit("put")).alias("op"),
        F.col("ts"), F.col("event_id").alias("seq"))


def id_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Requests with up to three sources of an id, each missing on some rows."""
    e, n = Tables(spark, sf).events, F.col("event_id")
    uid = F.col("user_id").cast("string")
    return e.select(n.alias("seq"), F.when(n % 3 == 0, uid).alias("user_id"),
                    F.when(n % 3 == 1, F.concat("event_type", F.lit(".u"), uid, F.lit("@example.org"))).alias("email"),
                    F.when(n % 6 == 2, F.concat(F.lit("session."), uid)).alias("session_id"))


def action_items(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events
    return e.select(F.col("event_id").alias("id"),
                    F.col("user_id").cast("string").alias("session_id"),
                    F.col("event_type").alias("title"),
                    F.when(F.col("event_id") % 3 == 0, F.lit("closed")).alias("status"),  # others unset
                    F.col("ts").alias("created_ts"))


def chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat_from(Tables(spark, sf).conversations)


def chat_from(c: DataFrame) -> DataFrame:
    return c.select(F.col("conv_id").alias("session_id"), "turn", "role",
                    F.col("text").alias("content"))


def chat_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The chat as messages of parts (type, text): the lines of a text with a tool call
    between them, which is no text."""
    c = Tables(spark, sf).conversations
    pieces = F.transform(F.regexp_extract_all("text", F.lit(r"[^\n]+|\n"), F.lit(0)),
                         lambda t: F.struct(F.lit("output_text").alias("type"), t.alias("text")))
    call = F.array(F.struct(F.lit("tool_call").alias("type"), F.lit("search()").alias("text")))
    parts = F.concat(F.slice(pieces, 1, 1), call, F.slice(pieces, 2, F.size(pieces)))
    return c.select(F.col("conv_id").alias("session_id"), "turn", "role", parts.alias("parts"))


def spans(spark: SparkSession, sf: str) -> DataFrame:
    c = Tables(spark, sf).conversations
    return c.select(F.col("conv_id").alias("trace_id"), F.col("turn").alias("span_id"),
                    F.when(F.col("turn") > 0, F.expr("(turn - 1) div 2")).alias("parent_id"),
                    F.col("role").alias("name"), F.lit("CHAT_TURN").alias("span_type"))


def assessments(spark: SparkSession, sf: str) -> DataFrame:
    """Assessments in order (``seq``); where a document is toxic, its usability is
    assessed once more."""
    lb = Tables(spark, sf).labels
    return lb.select(F.col("doc_id").alias("trace_id"),
                     F.posexplode(F.array(
                         F.struct(F.lit("quality").alias("name"),
                                  F.col("quality").cast("string").alias("value")),
                         F.struct(F.lit("toxic").alias("name"),
                                  F.col("toxic").cast("string").alias("value")),
                         F.struct(F.lit("usable").alias("name"),
                                  F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "Yes").otherwise(" no ")
                                  .alias("value")),
                         F.struct(F.lit("usable").alias("name"),
                                  F.when(F.col("toxic") == 1, "Blocked").alias("value")))).alias("seq", "a")
                     ).select("trace_id", F.col("seq").cast("long").alias("seq"), "a.name", "a.value")


def deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Streamed text deltas: every message split into its words in order."""
    c = Tables(spark, sf).conversations
    return (c.select(F.concat_ws(":", F.col("conv_id").cast("string"),
                                 F.col("turn").cast("string")).alias("item_id"),
                     F.posexplode(F.split(C.collapse_ws("text"), " ")).alias("pos", "text"))
            .select("item_id", F.col("pos").cast("bigint").alias("seq"),
                    F.lit("output_text.delta").alias("type"), "text"))
