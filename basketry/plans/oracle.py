"""Independent SQL (DuckDB dialect) for every catalog query.

Written directly from the operator semantics, not generated from the Spark
plans: the rolling metrics use the original self-join form, dedupe uses
``row_number``, quantiles use ``quantile_cont``. The driver tables are
pre-registered as views; fixture tables are rebuilt as CTEs.
"""

from __future__ import annotations

# ------------------------------------------------------------------ fixtures
_ISO = "strftime({ts}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"

FIXTURE_CTES = {
    "order_items_raw": f"""
    SELECT
      CASE WHEN l.l_partkey % 101 = 0 THEN NULL
           ELSE CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) END AS LINEITEM_ID,
      CAST(l.l_orderkey AS VARCHAR) AS ORDER_ID,
      CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS USER_ID,
      CAST(l.l_suppkey AS VARCHAR) AS RESTAURANT_ID,
      o.o_orderstatus AS APP_NAME,
      'USD' AS CURRENCY,
      CASE WHEN p.p_size = 13 THEN NULL ELSE p.p_type END AS ITEM_CATEGORY,
      CASE WHEN p.p_size = 13 THEN NULL ELSE p.p_name END AS ITEM_NAME,
      CAST(p.p_retailprice AS DOUBLE) AS ITEM_PRICE,
      CAST(floor(l.l_quantity) AS INTEGER) AS ITEM_QUANTITY,
      CASE l.l_returnflag WHEN 'A' THEN TRUE WHEN 'R' THEN FALSE ELSE NULL END AS IS_LOYALTY,
      CASE WHEN o.o_orderkey % 97 = 0 THEN 'bad'
           ELSE {_ISO.format(ts="o.o_orderdate + to_seconds(o.o_orderkey % 86400)")} END AS CREATION_TIME_UTC
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey""",
    "order_items_nan": """
    SELECT * REPLACE (CASE WHEN CAST(ORDER_ID AS BIGINT) % 89 = 0 THEN CAST('NaN' AS DOUBLE) ELSE ITEM_PRICE END AS ITEM_PRICE)
    FROM order_items_raw""",
    "order_items_profiled": """
    SELECT * REPLACE (CASE WHEN isnan(ITEM_PRICE) THEN NULL ELSE ITEM_PRICE END AS ITEM_PRICE) FROM order_items_nan""",
    "options_raw": """
    SELECT
      CASE WHEN l_partkey % 101 = 0 THEN NULL
           ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS LINEITEM_ID,
      CAST(l_orderkey AS VARCHAR) AS ORDER_ID,
      l_returnflag AS OPTION_GROUP_NAME,
      l_linestatus AS OPTION_NAME,
      CAST((l_partkey % 500 - 50) / 100 AS DOUBLE) AS OPTION_PRICE,
      CAST(l_suppkey % 3 + 1 AS INTEGER) AS OPTION_QUANTITY
    FROM lineitem
    WHERE l_discount > 0""",
    "date_dim_raw": """
    SELECT strftime(d, '%Y-%m-%d') AS date_key,
           CAST(year(d) AS INTEGER) AS year,
           CAST(month(d) AS INTEGER) AS month,
           CAST(weekofyear(d) AS INTEGER) AS week,
           dayname(d) AS day_of_week,
           CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year' ELSE NULL END AS holiday_name
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), (VALUES (1), (2)) AS twice(k)""",
    "event_items_raw": f"""
    SELECT
      CAST(event_id AS VARCHAR) AS LINEITEM_ID,
      CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') || '-' || CAST(event_id % 3 AS VARCHAR) AS ORDER_ID,
      CAST(user_id AS VARCHAR) AS USER_ID,
      CAST(event_id % 20 AS VARCHAR) AS RESTAURANT_ID,
      event_type AS APP_NAME,
      'USD' AS CURRENCY,
      event_type AS ITEM_CATEGORY,
      event_type AS ITEM_NAME,
      CAST(value AS DOUBLE) AS ITEM_PRICE,
      CAST(1 AS INTEGER) AS ITEM_QUANTITY,
      CASE WHEN event_type = 'purchase' THEN TRUE WHEN event_type = 'error' THEN NULL ELSE FALSE END AS IS_LOYALTY,
      {_ISO.format(ts="date_trunc('millisecond', ts)")} AS CREATION_TIME_UTC
    FROM events""",
}

# ------------------------------------------------------------------ silver
_ORDER_COLS = (
    "order_id, user_id, restaurant_id, app_name, currency, item_category, item_name, "
    "item_price, item_quantity, is_loyalty"
)
_ORDER_SORT = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "order_id user_id restaurant_id app_name currency item_category item_name "
        "item_price item_quantity is_loyalty creation_time_utc"
    ).split()
)


def _silver_orders_sql(raw: str) -> str:
    return f"""
    SELECT lineitem_id, {_ORDER_COLS}, creation_ts_utc,
           CAST(creation_ts_utc AS DATE) AS creation_date,
           strftime(creation_ts_utc, '%H:%M:%S') AS creation_time
    FROM (
      SELECT *, try_strptime(trim(regexp_replace(creation_time_utc, '[TZ]', ' ', 'g')),
                             '%Y-%m-%d %H:%M:%S.%g') AS creation_ts_utc
      FROM (
        SELECT lower_raw.*, row_number() OVER (PARTITION BY lineitem_id ORDER BY {_ORDER_SORT}) AS rn
        FROM (SELECT LINEITEM_ID AS lineitem_id, ORDER_ID AS order_id, USER_ID AS user_id,
                     RESTAURANT_ID AS restaurant_id, APP_NAME AS app_name, CURRENCY AS currency,
                     ITEM_CATEGORY AS item_category, ITEM_NAME AS item_name, ITEM_PRICE AS item_price,
                     ITEM_QUANTITY AS item_quantity, IS_LOYALTY AS is_loyalty,
                     CREATION_TIME_UTC AS creation_time_utc
              FROM {raw}) lower_raw
        WHERE lineitem_id IS NOT NULL
      ) WHERE rn = 1
    )"""


SILVER_CTES = {
    "fact_orders": _silver_orders_sql("order_items_raw"),
    "event_fact_orders": _silver_orders_sql("event_items_raw"),
    "fact_options": """
    SELECT lineitem_id, order_id, option_group_name, option_name, option_price, option_quantity
    FROM (
      SELECT LINEITEM_ID AS lineitem_id, ORDER_ID AS order_id, OPTION_GROUP_NAME AS option_group_name,
             OPTION_NAME AS option_name, OPTION_PRICE AS option_price, OPTION_QUANTITY AS option_quantity,
             row_number() OVER (PARTITION BY LINEITEM_ID, OPTION_GROUP_NAME, OPTION_NAME
                                ORDER BY ORDER_ID NULLS FIRST, OPTION_PRICE NULLS FIRST,
                                         OPTION_QUANTITY NULLS FIRST) AS rn
      FROM options_raw
    ) WHERE rn = 1""",
    "dim_date": """
    SELECT date_key, year, month, week, day_of_week, holiday_name
    FROM (
      SELECT *, row_number() OVER (PARTITION BY date_key
                                   ORDER BY year NULLS FIRST, month NULLS FIRST, week NULLS FIRST,
                                            day_of_week NULLS FIRST, holiday_name NULLS FIRST) AS rn
      FROM date_dim_raw
    ) WHERE rn = 1""",
}

# ------------------------------------------------------------------ gold


def _gold_ctes(prefix: str, orders: str, with_options: bool) -> dict[str, str]:
    if with_options:
        enriched = f"""
        SELECT o.*, COALESCE(a.options_revenue, 0.0) AS options_revenue2
        FROM {orders} o
        LEFT JOIN options_agg a ON o.order_id = a.order_id AND o.lineitem_id = a.lineitem_id
        WHERE o.user_id IS NOT NULL"""
    else:
        enriched = f"SELECT o.*, 0.0 AS options_revenue2 FROM {orders} o WHERE o.user_id IS NOT NULL"
    p = prefix
    ctes = {
        f"{p}enriched": f"""
        SELECT * EXCLUDE (options_revenue2), options_revenue2 AS options_revenue,
               item_price * item_quantity + options_revenue2 AS total_item_revenue
        FROM ({enriched})""",
        f"{p}daily": f"""
        SELECT user_id, creation_date,
               count(DISTINCT order_id) AS orders_daily,
               sum(total_item_revenue) AS revenue_daily,
               sum(CASE WHEN is_loyalty THEN total_item_revenue ELSE 0 END) AS loyalty_revenue,
               count(CASE WHEN is_loyalty THEN 1 END) AS loyalty_orders
        FROM {p}enriched GROUP BY user_id, creation_date""",
        f"{p}base": f"""
        SELECT *,
               CASE WHEN recency_days > 45 THEN 'High' WHEN recency_days > 20 THEN 'Medium'
                    ELSE 'Low' END AS churn_risk_flag
        FROM (
          SELECT *,
                 CAST(CASE WHEN lag(creation_date) OVER w IS NULL THEN 0
                           ELSE creation_date - lag(creation_date) OVER w END AS INTEGER) AS recency_days,
                 sum(revenue_daily) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS clv_cumulative
          FROM {p}daily
          WINDOW w AS (PARTITION BY user_id ORDER BY creation_date ASC NULLS FIRST)
        )""",
    }
    for n in (7, 30, 90):
        ctes[f"{p}roll{n}"] = f"""
        SELECT l.user_id, l.creation_date,
               count(DISTINCT r.creation_date) AS frequency_{n}d,
               sum(r.revenue_daily) AS monetary_{n}d
        FROM {p}daily l
        LEFT JOIN {p}daily r
          ON l.user_id = r.user_id
         AND r.creation_date >= l.creation_date - {n - 1}
         AND r.creation_date <= l.creation_date
        GROUP BY l.user_id, l.creation_date"""
    ctes[f"{p}fact_customer"] = f"""
        SELECT b.user_id, b.creation_date, b.orders_daily, b.revenue_daily, b.loyalty_revenue,
               b.loyalty_orders, b.recency_days, b.churn_risk_flag, b.clv_cumulative,
               r7.frequency_7d, r7.monetary_7d, r30.frequency_30d, r30.monetary_30d,
               r90.frequency_90d, r90.monetary_90d
        FROM {p}base b
        LEFT JOIN {p}roll7 r7 ON b.user_id = r7.user_id AND b.creation_date = r7.creation_date
        LEFT JOIN {p}roll30 r30 ON b.user_id = r30.user_id AND b.creation_date = r30.creation_date
        LEFT JOIN {p}roll90 r90 ON b.user_id = r90.user_id AND b.creation_date = r90.creation_date"""
    ctes[f"{p}location_daily"] = f"""
        SELECT creation_date, restaurant_id,
               count(DISTINCT order_id) AS total_orders,
               sum(total_item_revenue) AS total_revenue,
               avg(total_item_revenue) AS avg_order_value,
               sum(CASE WHEN is_loyalty THEN total_item_revenue ELSE 0 END) AS loyalty_revenue,
               count(CASE WHEN is_loyalty THEN 1 END) AS loyalty_orders,
               sum(CASE WHEN NOT is_loyalty THEN total_item_revenue ELSE 0 END) AS non_loyalty_revenue,
               count(CASE WHEN NOT is_loyalty THEN 1 END) AS non_loyalty_orders,
               CAST(COALESCE(day(creation_date), 0) AS INTEGER) AS period_day,
               CAST(COALESCE(weekofyear(creation_date), 0) AS INTEGER) AS period_week,
               CAST(COALESCE(month(creation_date), 0) AS INTEGER) AS period_month,
               CAST(COALESCE(year(creation_date), 0) AS INTEGER) AS year
        FROM {p}enriched GROUP BY creation_date, restaurant_id"""
    ctes[f"{p}location_ranked"] = f"""
        SELECT *,
               CAST(rank() OVER (PARTITION BY period_day ORDER BY CAST(round(CAST(total_revenue AS DECIMAL(38,10)), 2) AS DOUBLE) DESC NULLS LAST) AS INTEGER) AS revenue_rank_day,
               CAST(rank() OVER (PARTITION BY period_week ORDER BY CAST(round(CAST(total_revenue AS DECIMAL(38,10)), 2) AS DOUBLE) DESC NULLS LAST) AS INTEGER) AS revenue_rank_week,
               CAST(rank() OVER (PARTITION BY period_month ORDER BY CAST(round(CAST(total_revenue AS DECIMAL(38,10)), 2) AS DOUBLE) DESC NULLS LAST) AS INTEGER) AS revenue_rank_month
        FROM {p}location_daily"""
    return ctes


GOLD_CTES = {
    "options_agg": """
    SELECT order_id, lineitem_id, sum(option_price * option_quantity) AS options_revenue
    FROM fact_options GROUP BY order_id, lineitem_id""",
    **_gold_ctes("", "fact_orders", with_options=True),
    **_gold_ctes("ev_", "event_fact_orders", with_options=False),
}

ALL_CTES = {**FIXTURE_CTES, **SILVER_CTES, **GOLD_CTES}


def with_ctes(body: str) -> str:
    """Prefix ``body`` with every CTE definition (DuckDB skips unused ones)."""
    defs = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ALL_CTES.items())
    stripped = body.lstrip()
    if stripped.upper().startswith("WITH "):
        # The body brings its own CTEs: append them to the shared list.
        return f"WITH {defs},\n{stripped[5:]}"
    return f"WITH {defs}\n{body}"


def r2(expr: str, alias: str | None = None) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 2) AS DOUBLE) AS {alias or expr}"


def r4(expr: str, alias: str | None = None) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 4) AS DOUBLE) AS {alias or expr}"


_CUSTOMER_COLS = (
    "user_id, creation_date, orders_daily, "
    + r2("revenue_daily") + ", " + r2("loyalty_revenue") + ", loyalty_orders"
)
_LOCATION_COLS = (
    "creation_date, restaurant_id, total_orders, "
    + r2("total_revenue") + ", " + r4("avg_order_value") + ", " + r2("loyalty_revenue")
    + ", loyalty_orders, " + r2("non_loyalty_revenue")
    + ", non_loyalty_orders, period_day, period_week, period_month, year"
)
_ROLL_COLS = ", ".join(
    f"frequency_{n}d, " + r2(f"monetary_{n}d") for n in (7, 30, 90)
)

SQL = {
    "silver_dim_date": "SELECT * FROM dim_date",
    "silver_fact_orders": "SELECT * FROM fact_orders",
    "silver_fact_options": "SELECT * FROM fact_options",
    "gold_options_revenue": f"SELECT order_id, lineitem_id, {r2('options_revenue')} FROM options_agg",
    "gold_enriched_orders": "SELECT * EXCLUDE (options_revenue, total_item_revenue), "
    + r2("options_revenue") + ", " + r2("total_item_revenue") + " FROM enriched",
    "gold_customer_daily": f"SELECT {_CUSTOMER_COLS} FROM daily",
    "gold_recency_churn": "SELECT user_id, creation_date, recency_days, churn_risk_flag FROM base",
    "gold_clv_cumulative": f"SELECT user_id, creation_date, {r2('clv_cumulative')} FROM base",
    "gold_rolling_metrics": f"SELECT user_id, creation_date, {_ROLL_COLS} FROM fact_customer",
    "gold_fact_customer": f"SELECT {_CUSTOMER_COLS}, recency_days, churn_risk_flag, "
    f"{r2('clv_cumulative')}, {_ROLL_COLS} FROM fact_customer",
    "gold_location_daily": f"SELECT {_LOCATION_COLS} FROM location_daily",
    "gold_location_ranked": f"SELECT {_LOCATION_COLS}, revenue_rank_day, revenue_rank_week, "
    "revenue_rank_month FROM location_ranked",
    "gold_location_ranked_by_year": f"SELECT {_LOCATION_COLS}, "
    + ", ".join(
        f"CAST(rank() OVER (PARTITION BY year, period_{p} ORDER BY CAST(round(CAST(total_revenue AS DECIMAL(38,10)), 2) AS DOUBLE) DESC NULLS LAST) "
        f"AS INTEGER) AS revenue_rank_{p}"
        for p in ("day", "week", "month")
    )
    + " FROM location_daily",
}


# ------------------------------------------------------------------ metrics
_USER_CLV = """
    uc AS (SELECT user_id, CAST(round(CAST(max(clv_cumulative) AS DECIMAL(38,10)), 2) AS DOUBLE) AS clv_cumulative
           FROM fact_customer GROUP BY user_id),
    uq AS (SELECT quantile_cont(clv_cumulative, 0.2) AS q20,
                  quantile_cont(clv_cumulative, 0.8) AS q80 FROM uc),
    ug AS (SELECT uc.user_id, uc.clv_cumulative,
                  CASE WHEN uc.clv_cumulative <= uq.q20 THEN 'Low CLV'
                       WHEN uc.clv_cumulative >= uq.q80 THEN 'High CLV'
                       ELSE 'Medium CLV' END AS CLV_Group
           FROM uc, uq)"""


def _rfm_sql(fact: str, window: int, labels: bool = False, recency: str = "min") -> str:
    """RFM users with tercile codes: 0 if 3k < n-1, 1 if 3k < 2(n-1), else 2.

    ``labels`` maps codes of ranked users to R 3/2/1 and F, M 1/2/3;
    ``recency="latest"`` takes the gap of the user's latest row (NULL date latest).
    """

    def score(col: str, default: int, lab: tuple[int, int, int]) -> str:
        lo, mid, hi = lab if labels else (0, 1, 2)
        return (
            f"CASE WHEN st.d_{col} <= 1 OR {col}_v IS NULL THEN {default} "
            f"WHEN 3 * k_{col} < st.n_{col} - 1 THEN {lo} "
            f"WHEN 3 * k_{col} < 2 * (st.n_{col} - 1) THEN {mid} ELSE {hi} END"
        )

    if recency == "latest":
        rec = "max(CASE WHEN rn_latest = 1 THEN recency_days END)"
        src = (
            f"(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY creation_date DESC NULLS FIRST) "
            f"AS rn_latest FROM {fact})"
        )
    else:
        rec, src = "min(recency_days)", fact
    return f"""
    ru AS (
      SELECT user_id, {rec} AS Recency, max(frequency_{window}d) AS Frequency,
             max(monetary_{window}d) AS Monetary,
             max(CASE churn_risk_flag WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 END) AS churn_rank
      FROM {src} GROUP BY user_id),
    rv AS (SELECT *, Recency AS r_v, Frequency AS f_v, CAST(round(CAST(Monetary AS DECIMAL(38,10)), 2) AS DOUBLE) AS m_v FROM ru),
    st AS (SELECT count(r_v) AS n_r, count(DISTINCT r_v) AS d_r, count(f_v) AS n_f,
                  count(DISTINCT f_v) AS d_f, count(m_v) AS n_m, count(DISTINCT m_v) AS d_m FROM rv),
    rk AS (
      SELECT *,
             row_number() OVER (PARTITION BY r_v IS NULL ORDER BY r_v, user_id) - 1 AS k_r,
             row_number() OVER (PARTITION BY f_v IS NULL ORDER BY f_v, user_id) - 1 AS k_f,
             row_number() OVER (PARTITION BY m_v IS NULL ORDER BY m_v, user_id) - 1 AS k_m
      FROM rv),
    sc AS (
      SELECT user_id, Recency, Frequency, Monetary, churn_rank,
             CASE churn_rank WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' END AS Churn_Risk,
             {score('r', 3, (3, 2, 1))} AS R_Score, {score('f', 1, (1, 2, 3))} AS F_Score,
             {score('m', 1, (1, 2, 3))} AS M_Score
      FROM rk, st),
    rfm AS (
      SELECT *, R_Score + F_Score + M_Score AS RFM_Score,
             CASE WHEN Churn_Risk = 'High' THEN 'Churn Risk'
                  WHEN R_Score = 3 AND F_Score >= 2 AND M_Score >= 2 THEN 'VIP'
                  ELSE 'New Customer' END AS Segment
      FROM sc)"""


def _rfm_users(fact: str, window: int, **kw) -> str:
    return (
        f"WITH {_rfm_sql(fact, window, **kw)} SELECT user_id, Recency, Frequency, "
        "CAST(round(CAST(Monetary AS DECIMAL(38,10)), 2) AS DOUBLE) AS Monetary, churn_rank, Churn_Risk, R_Score, F_Score, M_Score, "
        "RFM_Score, Segment FROM rfm"
    )


def _rfm_kpis(fact: str, window: int) -> str:
    return (
        f"WITH {_rfm_sql(fact, window)} SELECT count(*) AS Total_Customers, "
        "count(*) FILTER (WHERE Segment = 'VIP') AS VIP_Customers, "
        "count(*) FILTER (WHERE Segment = 'New Customer') AS New_Customers, "
        "count(*) FILTER (WHERE Segment = 'Churn Risk') AS Churn_Risk_Customers FROM rfm"
    )


def _rfm_summary(fact: str, window: int) -> str:
    return (
        f"WITH {_rfm_sql(fact, window)} SELECT Segment, count(user_id) AS Customers, "
        "CAST(round(CAST(avg(Recency) AS DECIMAL(38,10)), 2) AS DOUBLE) AS Avg_Recency, CAST(round(CAST(avg(Frequency) AS DECIMAL(38,10)), 2) AS DOUBLE) AS Avg_Frequency, "
        "CAST(round(CAST(avg(Monetary) AS DECIMAL(38,10)), 2) AS DOUBLE) AS Avg_Monetary FROM rfm GROUP BY Segment"
    )


# Nested WITH inside a CTE body is fine in DuckDB; each metric is one statement.
METRIC_SQL = {
    "insight_overview": """
    SELECT (SELECT count(DISTINCT restaurant_id) FROM location_daily) AS total_restaurants,
           (SELECT count(DISTINCT user_id) FROM fact_customer) AS total_customers,
           (SELECT CAST(COALESCE(sum(orders_daily), 0) AS BIGINT) FROM fact_customer) AS total_orders,
           (SELECT CAST(round(CAST(COALESCE(sum(revenue_daily), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) FROM fact_customer) AS total_revenue""",
    "insight_total_revenue": "SELECT CAST(round(CAST(COALESCE(sum(revenue_daily), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_revenue FROM fact_customer",
    "insight_user_clv": f"WITH {_USER_CLV} SELECT * FROM ug",
    "insight_clv_tagged": f"""WITH {_USER_CLV}
    SELECT {_CUSTOMER_COLS}, recency_days, churn_risk_flag, {r2('clv_cumulative')}, {_ROLL_COLS}, ug.CLV_Group
    FROM (SELECT f.*, g.CLV_Group FROM fact_customer f LEFT JOIN ug g ON f.user_id = g.user_id) ug""",
    "insight_clv_kpis": f"""WITH {_USER_CLV}
    SELECT CAST(round(CAST(COALESCE(sum(clv_cumulative), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_lifetime_revenue,
           CAST(round(CAST(avg(clv_cumulative) AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_clv,
           count(*) FILTER (WHERE clv_cumulative >= (SELECT q80 FROM uq)) AS high_value_customers
    FROM uc""",
    "insight_clv_distribution": f"""WITH {_USER_CLV},
    mm AS (SELECT min(clv_cumulative) AS lo, max(clv_cumulative) AS hi FROM uc),
    ed AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS st,
                  CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END AS wd FROM mm),
    cnt AS (SELECT CLV_Group,
                   CAST(least(greatest(floor((clv_cumulative - ed.st) / ed.wd * 50), 0), 49) AS INTEGER) AS bin,
                   count(*) AS customers
            FROM ug, ed WHERE clv_cumulative IS NOT NULL GROUP BY ALL),
    dom AS (SELECT g.CLV_Group, CAST(b.bin AS INTEGER) AS bin
            FROM (SELECT DISTINCT CLV_Group FROM ug) g, range(50) b(bin))
    SELECT dom.bin, dom.CLV_Group,
           CAST(round(CAST(ed.st + ed.wd * dom.bin / 50 AS DECIMAL(38,10)), 6) AS DOUBLE) AS bin_start,
           CAST(round(CAST(ed.st + ed.wd * (dom.bin + 1) / 50 AS DECIMAL(38,10)), 6) AS DOUBLE) AS bin_end,
           CAST(COALESCE(cnt.customers, 0) AS BIGINT) AS customers
    FROM dom CROSS JOIN ed
    LEFT JOIN cnt ON dom.CLV_Group = cnt.CLV_Group AND dom.bin = cnt.bin""",
    "insight_clv_summary": f"""WITH {_USER_CLV}
    SELECT CLV_Group, count(user_id) AS Total_Customers,
           CAST(round(CAST(COALESCE(sum(clv_cumulative), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS Total_Revenue,
           CAST(round(CAST(avg(clv_cumulative) AS DECIMAL(38,10)), 2) AS DOUBLE) AS Avg_CLV
    FROM ug GROUP BY CLV_Group ORDER BY Avg_CLV DESC NULLS LAST, CLV_Group""",
    "insight_rfm_users": _rfm_users("fact_customer", 30),
    "insight_rfm_kpis": _rfm_kpis("fact_customer", 30),
    "insight_rfm_summary": _rfm_summary("fact_customer", 30),
    "insight_rfm_segment_counts": f"WITH {_rfm_sql('fact_customer', 90)} "
    "SELECT Segment, count(user_id) AS Customers FROM rfm GROUP BY Segment",
    "insight_rfm_users_events": _rfm_users("ev_fact_customer", 30),
    "insight_rfm_users_labels_events": _rfm_users("ev_fact_customer", 30, labels=True),
    "insight_rfm_users_latest": _rfm_users("fact_customer", 90, recency="latest"),
    "insight_rfm_kpis_events": _rfm_kpis("ev_fact_customer", 7),
    "insight_rfm_summary_events": _rfm_summary("ev_fact_customer", 90),
    "insight_churn_counts": """
    SELECT lv.Churn_Risk, COALESCE(c.cnt, 0) AS Count
    FROM (VALUES ('Low', 1), ('Medium', 2), ('High', 3)) lv(Churn_Risk, pos)
    LEFT JOIN (
      SELECT churn_risk_flag, count(*) AS cnt FROM (
        SELECT user_id, churn_risk_flag,
               row_number() OVER (PARTITION BY user_id ORDER BY creation_date DESC NULLS FIRST) AS rn
        FROM fact_customer) WHERE rn = 1 GROUP BY churn_risk_flag
    ) c ON c.churn_risk_flag = lv.Churn_Risk""",
    "insight_daily_revenue": """
    SELECT creation_date, CAST(round(CAST(COALESCE(sum(total_revenue), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_revenue
    FROM location_daily WHERE creation_date IS NOT NULL GROUP BY creation_date""",
    "insight_monthly_revenue": """
    SELECT period_month, CAST(round(CAST(COALESCE(sum(total_revenue), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_revenue
    FROM location_daily GROUP BY period_month""",
    "insight_loyalty_spend": """
    SELECT COALESCE(loyalty_orders > 0, FALSE) AS is_loyalty, CAST(round(CAST(avg(revenue_daily) AS DECIMAL(38,10)), 4) AS DOUBLE) AS revenue_daily
    FROM fact_customer GROUP BY 1""",
    "insight_top_locations_revenue": """
    SELECT restaurant_id, CAST(round(CAST(COALESCE(sum(total_revenue), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_revenue
    FROM location_daily WHERE restaurant_id IS NOT NULL GROUP BY restaurant_id
    ORDER BY CAST(round(CAST(COALESCE(sum(total_revenue), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) DESC NULLS LAST, restaurant_id LIMIT 5""",
    "insight_bottom_locations_revenue": """
    SELECT restaurant_id, CAST(round(CAST(COALESCE(sum(total_revenue), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_revenue
    FROM location_daily WHERE restaurant_id IS NOT NULL GROUP BY restaurant_id
    ORDER BY CAST(round(CAST(COALESCE(sum(total_revenue), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) ASC NULLS LAST, restaurant_id LIMIT 5""",
    "insight_top_locations_aov": """
    SELECT restaurant_id, CAST(round(CAST(avg(avg_order_value) AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_order_value
    FROM location_daily WHERE restaurant_id IS NOT NULL GROUP BY restaurant_id
    ORDER BY CAST(round(CAST(avg(avg_order_value) AS DECIMAL(38,10)), 4) AS DOUBLE) DESC NULLS LAST, restaurant_id LIMIT 5""",
    "insight_discount_revenue": """
    SELECT COALESCE(non_loyalty_revenue < total_revenue, FALSE) AS discount_applied,
           CAST(round(CAST(COALESCE(sum(total_revenue), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_revenue
    FROM location_daily GROUP BY 1""",
}

SQL.update(METRIC_SQL)

# ------------------------------------------------------------------ profile
# Fixture schemas as the oracle knows them (name, Spark type name).
RAW_SCHEMAS = {
    "order_items": ("order_items_profiled", [
        ("LINEITEM_ID", "string"), ("ORDER_ID", "string"), ("USER_ID", "string"),
        ("RESTAURANT_ID", "string"), ("APP_NAME", "string"), ("CURRENCY", "string"),
        ("ITEM_CATEGORY", "string"), ("ITEM_NAME", "string"), ("ITEM_PRICE", "double"),
        ("ITEM_QUANTITY", "int"), ("IS_LOYALTY", "boolean"), ("CREATION_TIME_UTC", "string"),
    ]),
    "order_item_options": ("options_raw", [
        ("LINEITEM_ID", "string"), ("ORDER_ID", "string"), ("OPTION_GROUP_NAME", "string"),
        ("OPTION_NAME", "string"), ("OPTION_PRICE", "double"), ("OPTION_QUANTITY", "int"),
    ]),
    "date_dim": ("date_dim_raw", [
        ("date_key", "string"), ("year", "int"), ("month", "int"), ("week", "int"),
        ("day_of_week", "string"), ("holiday_name", "string"),
    ]),
}
NUMERIC_TYPES = {"int", "bigint", "double"}
PROFILE_NUMERIC = {
    **{name: (rel, [c for c, t in cols if t in NUMERIC_TYPES]) for name, (rel, cols) in RAW_SCHEMAS.items()},
    "customer": ("customer", ["c_custkey", "c_nationkey", "c_acctbal"]),
    "part": ("part", ["p_partkey", "p_size", "p_retailprice"]),
    "events": ("events", ["event_id", "user_id", "value"]),
}
HIST_BINS = {"date_dim": 12, "order_items": 10, "order_item_options": 40}


def _profile_columns_sql() -> str:
    parts = []
    for name, (rel, cols) in RAW_SCHEMAS.items():
        for i, (c, t) in enumerate(cols):
            parts.append(
                f"SELECT '{name}' AS table_name, {i} AS position, '{c}' AS column_name, "
                f"'{t}' AS data_type, {'TRUE' if t in NUMERIC_TYPES else 'FALSE'} AS is_numeric, "
                f"count({c}) AS non_null, count(*) - count({c}) AS nulls, "
                f"count(DISTINCT {c}) AS distinct_values FROM {rel}"
            )
    return "\nUNION ALL ".join(parts)


def _iqr_sql() -> str:
    parts = []
    for name, (rel, cols) in PROFILE_NUMERIC.items():
        for c in cols:
            v = f"CAST({c} AS DOUBLE)"
            parts.append(f"""
    SELECT '{name}' AS table_name, '{c}' AS column_name, CAST(round(CAST(q1 AS DECIMAL(38,10)), 6) AS DOUBLE) AS q1, CAST(round(CAST(q3 AS DECIMAL(38,10)), 6) AS DOUBLE) AS q3,
           CAST(round(CAST(q3 - q1 AS DECIMAL(38,10)), 6) AS DOUBLE) AS iqr, CAST(round(CAST(q1 - 1.5 * (q3 - q1) AS DECIMAL(38,10)), 6) AS DOUBLE) AS lower_fence,
           CAST(round(CAST(q3 + 1.5 * (q3 - q1) AS DECIMAL(38,10)), 6) AS DOUBLE) AS upper_fence,
           (SELECT count(*) FROM {rel} WHERE {v} < s.q1 - 1.5 * (s.q3 - s.q1)
                                        OR {v} > s.q3 + 1.5 * (s.q3 - s.q1)) AS outliers
    FROM (SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.75) AS q3 FROM {rel}) s""")
    return "\nUNION ALL ".join(parts)


def _histogram_sql() -> str:
    parts = []
    for name, n in HIST_BINS.items():
        rel, cols = PROFILE_NUMERIC[name]
        for c in cols:
            v = f"CAST({c} AS DOUBLE)"
            edges = (
                f"(SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS st, "
                f"CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END AS wd "
                f"FROM (SELECT min({v}) AS lo, max({v}) AS hi FROM {rel}) WHERE lo IS NOT NULL)"
            )
            parts.append(f"""
    SELECT '{name}' AS table_name, '{c}' AS column_name, CAST(b.bin AS INTEGER) AS bin,
           CAST(round(CAST(e.st + e.wd * b.bin / {n} AS DECIMAL(38,10)), 6) AS DOUBLE) AS bin_start,
           CAST(round(CAST(e.st + e.wd * (b.bin + 1) / {n} AS DECIMAL(38,10)), 6) AS DOUBLE) AS bin_end,
           CAST(COALESCE(k.cnt, 0) AS BIGINT) AS count
    FROM {edges} e
    CROSS JOIN range({n}) b(bin)
    LEFT JOIN (
      SELECT CAST(least(greatest(floor(({v} - e2.st) / e2.wd * {n}), 0), {n - 1}) AS INTEGER) AS bin,
             count(*) AS cnt
      FROM {rel}, {edges} e2 WHERE {c} IS NOT NULL GROUP BY 1
    ) k ON k.bin = b.bin""")
    return "\nUNION ALL ".join(parts)


_ITEM_COLS = [c for c, _ in RAW_SCHEMAS["order_items"][1]]
_ANY_NULL_ITEM = " OR ".join(f"{c} IS NULL" for c in _ITEM_COLS)
_SILVER_ORDER_TYPES = [
    ("lineitem_id", "string"), ("order_id", "string"), ("user_id", "string"),
    ("restaurant_id", "string"), ("app_name", "string"), ("currency", "string"),
    ("item_category", "string"), ("item_name", "string"), ("item_price", "double"),
    ("item_quantity", "int"), ("is_loyalty", "boolean"), ("creation_ts_utc", "timestamp"),
    ("creation_date", "date"), ("creation_time", "string"),
]

PROFILE_SQL = {
    "profile_columns": _profile_columns_sql(),
    "profile_shape": "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, {len(cols)} AS columns FROM {rel}"
        for name, (rel, cols) in RAW_SCHEMAS.items()
    ),
    "profile_missing_rows": "SELECT * FROM order_items_profiled "
    "WHERE LINEITEM_ID IS NULL OR ITEM_CATEGORY IS NULL OR ITEM_NAME IS NULL OR ITEM_PRICE IS NULL",
    "profile_null_summary": "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, "
        f"COALESCE(bool_or({' OR '.join(f'{c} IS NULL' for c, _ in cols)}), FALSE) AS any_null FROM {rel}"
        for name, (rel, cols) in RAW_SCHEMAS.items()
    ),
    "profile_duplicate_row_copies": """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY LINEITEM_ID, ORDER_ID, OPTION_GROUP_NAME, OPTION_NAME,
                                   OPTION_PRICE, OPTION_QUANTITY) AS rn FROM options_raw) WHERE rn > 1""",
    "profile_key_violation_rows": """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY LINEITEM_ID, OPTION_GROUP_NAME, OPTION_NAME
                                   ORDER BY ORDER_ID NULLS FIRST, OPTION_PRICE NULLS FIRST, OPTION_QUANTITY NULLS FIRST) AS rn
      FROM (SELECT DISTINCT * FROM options_raw)) WHERE rn > 1""",
    "profile_duplicate_rows": "SELECT *, count(*) - 1 AS extra_copies FROM date_dim_raw "
    "GROUP BY ALL HAVING count(*) > 1",
    "profile_duplicate_rows_options": "SELECT *, count(*) - 1 AS extra_copies FROM options_raw "
    "GROUP BY ALL HAVING count(*) > 1",
    "profile_key_violations": "SELECT LINEITEM_ID, count(*) AS rows FROM order_items_raw "
    "GROUP BY LINEITEM_ID HAVING count(*) > 1",
    "profile_key_violations_options": "SELECT LINEITEM_ID, OPTION_GROUP_NAME, OPTION_NAME, count(*) AS rows "
    "FROM (SELECT DISTINCT * FROM options_raw) GROUP BY ALL HAVING count(*) > 1",
    "profile_iqr_outliers": _iqr_sql(),
    "profile_histogram": _histogram_sql(),
    "clean_dropna_accounting": f"""
    SELECT count(*) AS rows_before,
           count(*) FILTER (WHERE LINEITEM_ID IS NOT NULL) AS rows_after,
           count(*) FILTER (WHERE LINEITEM_ID IS NULL) AS rows_removed,
           COALESCE(bool_or(LINEITEM_ID IS NOT NULL AND ({_ANY_NULL_ITEM})), FALSE) AS any_null_after
    FROM order_items_profiled""",
    "clean_dropna_null_counts": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM order_items_profiled "
        "WHERE LINEITEM_ID IS NOT NULL AND ITEM_PRICE IS NOT NULL"
        for c in _ITEM_COLS
    ),
    "clean_distinct_accounting": """
    SELECT b.n AS rows_before, a.n AS rows_after, b.n - a.n AS rows_removed
    FROM (SELECT count(*) AS n FROM options_raw) b,
         (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM options_raw)) a""",
    "validate_negative_prices": "SELECT count(*) FILTER (WHERE OPTION_PRICE < 0) AS negative_rows FROM options_raw",
    "validate_timestamp_shape": """
    SELECT count(*) AS total_rows,
           count(*) FILTER (WHERE contains(CREATION_TIME_UTC, 'T')) AS rows_with_t,
           count(*) FILTER (WHERE contains(CREATION_TIME_UTC, 'Z')) AS rows_with_z,
           count(*) - count(*) FILTER (WHERE contains(CREATION_TIME_UTC, 'T')) AS rows_missing_t,
           count(*) - count(*) FILTER (WHERE contains(CREATION_TIME_UTC, 'Z')) AS rows_missing_z
    FROM order_items_raw""",
    "validate_column_info": "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM fact_orders"
        for i, (c, t) in enumerate(_SILVER_ORDER_TYPES)
    ),
    "source_row_counts": """
    SELECT 'order_items' AS table_name, count(*) AS rows FROM order_items_raw
    UNION ALL SELECT 'order_item_options', count(*) FROM options_raw
    UNION ALL SELECT 'date_dim', count(*) FROM date_dim_raw""",
    "source_preview": "SELECT * FROM order_items_raw ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in _ITEM_COLS) + " LIMIT 5",
    "inspect_gold_slice": f"SELECT {_CUSTOMER_COLS}, recency_days, churn_risk_flag, "
    f"{r2('clv_cumulative')}, {_ROLL_COLS} FROM fact_customer "
    "ORDER BY user_id NULLS LAST, creation_date NULLS LAST LIMIT 30 OFFSET 70",
}

SQL.update(PROFILE_SQL)


_NICE_BINS = f"""WITH {_USER_CLV},
    mm AS (SELECT min(clv_cumulative) AS lo, max(clv_cumulative) AS hi FROM uc),
    steps AS (SELECT CASE WHEN e >= 0 THEN m * pow(10.0::DOUBLE, e) ELSE m / pow(10.0::DOUBLE, -e) END AS step
              FROM range(-12, 16) x(e), (VALUES (1), (2), (5)) y(m)),
    st AS (SELECT CASE WHEN lo = hi THEN 1.0::DOUBLE
                  ELSE (SELECT min(step) FROM steps WHERE floor(hi / step) - floor(lo / step) + 1 <= 50) END AS step, lo, hi FROM mm),
    ed AS (SELECT step, floor(lo / step) AS b0, floor(hi / step) AS b1 FROM st),
    cnt AS (SELECT CLV_Group, floor(clv_cumulative / step) AS b, count(*) AS customers FROM ug, ed
            WHERE clv_cumulative IS NOT NULL GROUP BY ALL),
    dom AS (SELECT g.CLV_Group, unnest(range(CAST(b0 AS BIGINT), CAST(b1 AS BIGINT) + 1)) AS b, b0, step
            FROM (SELECT DISTINCT CLV_Group FROM ug) g, ed)
    SELECT CAST(dom.b - b0 AS INTEGER) AS bin, dom.CLV_Group,
           CAST(round(CAST(dom.b * step AS DECIMAL(38,10)), 6) AS DOUBLE) AS bin_start,
           CAST(round(CAST(dom.b * step + step AS DECIMAL(38,10)), 6) AS DOUBLE) AS bin_end,
           CAST(COALESCE(cnt.customers, 0) AS BIGINT) AS customers
    FROM dom LEFT JOIN cnt ON cnt.CLV_Group = dom.CLV_Group AND cnt.b = dom.b"""


def _csv_types_sql() -> str:
    """Types by the texts themselves; a value that is the text of a missing value counts as missing."""
    parts = []
    for c in _ITEM_COLS:
        parts.append(f"""SELECT '{c}' AS column_name,
           CASE WHEN count(v) = 0 THEN 'double'
                WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+')) THEN 'bigint'
                WHEN bool_and(regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')) THEN 'double'
                WHEN bool_and(lower(v) IN ('true', 'false')) THEN 'boolean' ELSE 'string' END AS data_type,
           bool_or(v IS NULL) AS has_missing
    FROM (SELECT NULLIF(CAST({c} AS VARCHAR), '') AS v FROM order_items_raw)""")
    return "\nUNION ALL ".join(parts)


def _sketches_sql() -> str:
    types = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "INTEGER": "int", "BOOLEAN": "boolean"}
    numeric = {"ITEM_PRICE": "double", "ITEM_QUANTITY": "int"}
    parts = []
    for i, (c, t) in enumerate(RAW_SCHEMAS["order_items"][1]):
        within = "TRUE" if c in numeric else "CAST(NULL AS BOOLEAN)"
        parts.append(f"""SELECT '{c}' AS column_name, {i} AS position, '{types.get(t.upper(), t)}' AS data_type, count(*) AS rows,
           count(*) FILTER (WHERE {c} IS NULL) AS missing, TRUE AS distinct_within_bound, {within} AS quartiles_within_bound
    FROM order_items_profiled""")
    return "\nUNION ALL ".join(parts)


SQL |= {
    "insight_clv_distribution_nice": _NICE_BINS,
    "source_csv_multiline": "SELECT doc_id, lang, n_chars, sha256(text) AS text_sha256 FROM documents",
    "source_csv_types": _csv_types_sql(),
    "profile_sketches": _sketches_sql(),
    # an incremental build must equal the full one
    "gold_incremental_customer": SQL["gold_fact_customer"],
    "gold_location_rebuilt": SQL["gold_location_daily"],
}

_LINES_WITH_COPIES = """(SELECT * FROM lineitem
    UNION ALL SELECT * FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 50 = 0
    UNION ALL SELECT * FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 1000 = 0)"""

SQL |= {
    "source_drifted_files": """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey,
           CASE WHEN load = 0 THEN o_orderstatus END AS o_orderstatus,
           CAST(o_orderdate AS DATE) AS o_orderdate,
           CASE WHEN load = 1 THEN o_totalprice END AS o_totalprice,
           CASE load WHEN 1 THEN CAST(o_custkey AS DOUBLE) WHEN 2 THEN o_custkey / 2.0::DOUBLE END AS score,
           CASE WHEN load = 2 THEN o_orderpriority END AS o_orderpriority,
           CAST(load AS INTEGER) AS load
    FROM (SELECT *, COALESCE(o_orderkey % 3, 2) AS load FROM orders)""",
    "source_clustered_orders": SQL["silver_fact_orders"],
    "profile_duplicate_rows_by_digest": f"SELECT *, count(*) - 1 AS extra_copies FROM {_LINES_WITH_COPIES} "
    "GROUP BY ALL HAVING count(*) > 1",
    "clean_distinct_by_digest": f"SELECT DISTINCT * FROM {_LINES_WITH_COPIES}",
    "clean_distinct_accounting_by_digest": f"""
    SELECT count(*) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT * FROM {_LINES_WITH_COPIES})) AS rows_after,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_LINES_WITH_COPIES})) AS rows_removed
    FROM {_LINES_WITH_COPIES}""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in SQL.items()}
