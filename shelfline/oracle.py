"""Reference SQL for every registered query, runnable by DuckDB over the same
parquet tables (registered as views named after the tables).

``sql(body, *views)`` prefixes a query with the model views it reads, in
dependency order, as a WITH list.  The view texts mirror
``shelfline.sources.views`` expression for expression.
"""

from __future__ import annotations

from shelfline.functions.columns import WS_CLASS

WS = "'" + WS_CLASS + "+'"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_products": ((), """
        SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand,
               p_type AS category, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
               CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 0.45, 2) AS DECIMAL(18,2)) AS unit_cogs
        FROM part"""),
    "v_retailers": ((), """
        SELECT c_custkey AS retailer_id, c_name AS retailer_name, c_mktsegment AS channel,
               r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey"""),
    "v_lines": ((), """
        SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS product_id,
               o_custkey AS retailer_id, CAST(l_shipdate AS DATE) AS d, l_quantity AS qty,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
               CAST(l_discount AS DECIMAL(4,2)) AS disc, l_returnflag = 'R' AS returned
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "v_sales_raw": (("v_lines",), """
        SELECT product_id, retailer_id,
               CAST(date_trunc('week', d + INTERVAL 1 DAY) AS DATE) + 5 AS week_ending,
               CAST(SUM(qty) AS BIGINT) AS units_shipped,
               CAST(SUM(gross * 0.62) AS DECIMAL(18,2)) AS shipment_revenue,
               CAST(SUM(CASE WHEN returned THEN 0 ELSE qty END) AS BIGINT) AS units_sold,
               CAST(SUM(CASE WHEN returned THEN NULL ELSE gross * (1 - disc) END) AS DECIMAL(18,2))
                   AS pos_revenue_raw,
               MAX(disc) >= 0.05 AS on_promo
        FROM v_lines GROUP BY 1, 2, 3"""),
    "v_sales": (("v_sales_raw",), """
        SELECT product_id, retailer_id, week_ending, units_shipped, shipment_revenue, units_sold,
               COALESCE(pos_revenue_raw, CAST(0 AS DECIMAL(18,2))) AS pos_revenue,
               CAST(ROUND(CAST(CAST(pos_revenue_raw AS DOUBLE) / NULLIF(CAST(units_sold AS DOUBLE), 0)
                    AS DECIMAL(18,9)), 2) AS DECIMAL(18,2)) AS avg_selling_price,
               on_promo
        FROM v_sales_raw"""),
    "v_baseline": (("v_lines",), """
        SELECT product_id, CAST(FLOOR(AVG(qty)) AS BIGINT) AS baseline_units
        FROM v_lines WHERE disc < 0.05 GROUP BY product_id"""),
    "v_promos_raw": (("v_lines", "v_baseline"), """
        SELECT l.*, COALESCE(b.baseline_units, 0) AS base,
               GREATEST(l.qty - COALESCE(b.baseline_units, 0), 0.0) AS incr,
               l.gross * l.disc AS spend
        FROM v_lines l LEFT JOIN v_baseline b ON l.product_id = b.product_id
        WHERE l.disc >= 0.05"""),
    "v_promos": (("v_promos_raw",), """
        SELECT order_key, line_number, product_id, retailer_id,
               CASE WHEN disc >= 0.09 THEN 'BOGO' WHEN disc = 0.05 THEN 'TPR'
                    WHEN disc = 0.06 THEN 'Display' WHEN disc = 0.07 THEN 'Feature'
                    WHEN disc = 0.08 THEN 'Feature+Display' END AS promo_type,
               d AS start_date,
               d + 7 * CAST(CASE order_key % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS INTEGER) AS end_date,
               CAST(spend AS DECIMAL(18,2)) AS promo_spend,
               CAST(disc * 100 AS DECIMAL(5,1)) AS discount_depth_pct,
               CAST(base AS BIGINT) AS baseline_units,
               CAST(qty AS BIGINT) AS promoted_units,
               CAST(incr AS BIGINT) AS incremental_units,
               ROUND(CAST(incr * 100.0 / CASE WHEN base > 0 THEN CAST(base AS DOUBLE) END
                     AS DECIMAL(18,9)), 1) AS lift_pct,
               CAST(CASE WHEN spend > 0 THEN ROUND(CAST(
                      (incr * 0.55) / (qty * CAST(disc AS DOUBLE)) - 1.0 AS DECIMAL(18,9)), 3)
                    ELSE 0 END AS DECIMAL(12,3)) AS roi
        FROM v_promos_raw"""),
    "v_market_share": (("v_lines", "v_products"), """
        SELECT month, brand, category,
               CAST(bds AS DECIMAL(18,2)) AS brand_dollar_sales,
               CAST(cds AS DECIMAL(18,2)) AS category_dollar_sales,
               ROUND(CAST(CAST(bds AS DOUBLE) * 100.0 / NULLIF(CAST(cds AS DOUBLE), 0)
                     AS DECIMAL(18,9)), 2) AS dollar_share_pct
        FROM (SELECT month, brand, category, bds,
                     SUM(bds) OVER (PARTITION BY month, category) AS cds
              FROM (SELECT CAST(date_trunc('month', l.d) AS DATE) AS month, p.brand, p.category,
                           SUM(l.gross) AS bds
                    FROM v_lines l JOIN v_products p ON l.product_id = p.product_id
                    GROUP BY 1, 2, 3) x) y"""),
    "v_documents": ((), f"""
        SELECT doc_id, source AS doc_type, lang AS category,
               trim(regexp_replace(text, {WS}, ' ', 'g')) AS content
        FROM documents"""),
    "v_vectors": ((), """
        SELECT vec_id AS doc_id, embedding, label FROM embeddings"""),
    "v_memory_log": ((), """
        SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS key, props AS value_json,
               CASE WHEN event_id % 10 = 0 THEN 'delete' ELSE 'put' END AS op,
               ts, event_id AS seq
        FROM events"""),
    "v_action_items": ((), """
        SELECT event_id AS id, CAST(user_id AS VARCHAR) AS session_id, event_type AS title,
               CASE WHEN event_id % 3 = 0 THEN 'closed' END AS status,
               ts AS created_ts
        FROM events"""),
    "v_id_sources": ((), """
        SELECT event_id AS seq, CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
               CASE WHEN event_id % 3 = 1
                    THEN event_type || '.u' || CAST(user_id AS VARCHAR) || '@example.org' END AS email,
               CASE WHEN event_id % 6 = 2 THEN 'session.' || CAST(user_id AS VARCHAR) END AS session_id
        FROM events"""),
    "v_chat": ((), """
        SELECT conv_id AS session_id, turn, role, text AS content FROM conversations"""),
    "v_spans": ((), """
        SELECT conv_id AS trace_id, turn AS span_id,
               CASE WHEN turn > 0 THEN (turn - 1) // 2 END AS parent_id,
               role AS name, 'CHAT_TURN' AS span_type
        FROM conversations"""),
    "v_assessments": ((), """
        SELECT doc_id AS trace_id, 0 AS seq, 'quality' AS name, CAST(quality AS VARCHAR) AS value FROM labels
        UNION ALL
        SELECT doc_id AS trace_id, 1, 'toxic' AS name, CAST(toxic AS VARCHAR) AS value FROM labels
        UNION ALL
        SELECT doc_id AS trace_id, 2, 'usable' AS name,
               CASE WHEN quality = 1 AND toxic = 0 THEN 'Yes' ELSE ' no ' END AS value FROM labels
        UNION ALL
        SELECT doc_id AS trace_id, 3, 'usable', CASE WHEN toxic = 1 THEN 'Blocked' END FROM labels"""),
    "v_deltas": ((), f"""
        SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS item_id,
               CAST(pos - 1 AS BIGINT) AS seq, 'output_text.delta' AS type, w AS text
        FROM (SELECT conv_id, turn,
                     unnest(string_split(trim(regexp_replace(text, {WS}, ' ', 'g')), ' ')) AS w,
                     generate_subscripts(string_split(trim(regexp_replace(text, {WS}, ' ', 'g')), ' '), 1) AS pos
              FROM conversations) t"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *views: str) -> str:
    """Prefix ``body`` with the WITH list of ``views`` and their dependencies.

    ``body`` may start with its own ``WITH`` list; it is merged."""
    names = _order(views)
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in names)
    stripped = body.strip()
    if stripped[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{stripped[14:].lstrip()}"
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{stripped}"
