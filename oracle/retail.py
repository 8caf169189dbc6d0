"""Oracle SQL of the layers, layer queries, business analytics and challenges."""

from oracle.tables import avg, r

PRICE = "ss_sales_price"
AS_OF = "DATE '2001-08-01'"
MONTH = "CAST(date_trunc('month', d_date) AS DATE)"


def _months_between(earlier: str, later: str) -> str:
    return f"CAST(date_diff('month', {earlier}, {later}) AS INT)"


def _money(value: str, digits: int = 22) -> str:
    return f"CAST(sum({value}) AS DECIMAL({digits},2))"


def _segment() -> str:
    return """CASE WHEN least(r_score, f_score, m_score) >= 4 THEN 'Champions'
                   WHEN least(r_score, f_score) >= 3 THEN 'Loyal Customers'
                   WHEN r_score >= 4 AND f_score < 3 THEN 'New Customers'
                   WHEN r_score < 3 AND f_score >= 3 THEN 'At Risk'
                   WHEN r_score < 3 AND f_score < 3 THEN 'Lost' ELSE 'Regular' END AS customer_segment"""


def _quintile(order: str) -> str:
    return f"CAST(ntile(5) OVER (ORDER BY {order}, c_customer_sk) AS INT)"


# Files loaded in two increments, one of them killed and run again, give what one build of all files gives.
_INCREMENTAL = ("daily_sales_summary", "customer_lifetime_value", "product_performance", "monthly_trends")

RETAIL_QUERIES = {
    **{f"incremental_{mart}": f"SELECT * FROM gold_{mart}" for mart in _INCREMENTAL},
    # Layers
    "silver_store_sales": """
        SELECT DISTINCT s.*, d_year AS year, d_moy AS month
        FROM bronze_store_sales_dirty s LEFT JOIN bronze_date_dim ON d_date_sk = ss_sold_date_sk
        WHERE ss_sold_date_sk IS NOT NULL AND ss_quantity > 0 AND ss_sales_price >= 0""",
    "silver_store_sales_keyed": """
        SELECT s.* EXCLUDE (place), d_year AS year, d_moy AS month
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY ss_ticket_number, ss_item_sk
                  ORDER BY ss_sold_date_sk DESC NULLS LAST, ss_customer_sk DESC NULLS LAST,
                           ss_store_sk DESC NULLS LAST, ss_line_number DESC NULLS LAST,
                           ss_quantity DESC NULLS LAST, ss_sales_price DESC NULLS LAST) AS place
              FROM bronze_store_sales_dirty) s LEFT JOIN bronze_date_dim ON d_date_sk = ss_sold_date_sk
        WHERE place = 1 AND ss_sold_date_sk IS NOT NULL""",
    "silver_customer": """
        SELECT * EXCLUDE (place), concat_ws(' ', c_first_name, c_last_name) AS full_name
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY c_customer_sk
                  ORDER BY c_customer_id DESC NULLS LAST, c_first_name DESC NULLS LAST, c_last_name DESC NULLS LAST,
                           c_email_address DESC NULLS LAST, c_birth_country DESC NULLS LAST,
                           c_birth_year DESC NULLS LAST) AS place
              FROM bronze_customer_dirty WHERE c_customer_sk IS NOT NULL)
        WHERE place = 1""",
    "silver_date_dim": """
        SELECT * EXCLUDE (place), d_moy AS d_month,
               coalesce(d_day_name IN ('Saturday', 'Sunday'), false) AS is_weekend
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY d_date_sk
                  ORDER BY d_date DESC NULLS LAST, d_year DESC NULLS LAST, d_moy DESC NULLS LAST,
                           d_day_name DESC NULLS LAST) AS place
              FROM bronze_date_dim_dirty WHERE d_date_sk IS NOT NULL)
        WHERE place = 1""",
    "silver_generic": "SELECT DISTINCT * FROM bronze_item_dirty",
    "bronze_sample": "SELECT * FROM bronze_customer ORDER BY c_customer_sk LIMIT 10",
    # One month of the files went, and one was added with quantities as BIGINT.
    "registered_sales": """
        SELECT * REPLACE (CAST(ss_quantity AS BIGINT) AS ss_quantity) FROM silver_store_sales
        WHERE NOT (year = 1999 AND month = 3)""",
    "sales_appended": """
        SELECT s.* EXCLUDE (place), d_year AS year, d_moy AS month
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY ss_ticket_number, ss_item_sk
                  ORDER BY ss_sold_date_sk DESC NULLS LAST, ss_customer_sk DESC NULLS LAST,
                           ss_store_sk DESC NULLS LAST, ss_line_number DESC NULLS LAST,
                           ss_quantity DESC NULLS LAST, ss_sales_price DESC NULLS LAST) AS place
              FROM bronze_store_sales_dirty) s LEFT JOIN bronze_date_dim ON d_date_sk = ss_sold_date_sk
        WHERE place = 1 AND ss_sold_date_sk IS NOT NULL""",
    # Days of June and July 2001 have all sales, earlier and later ones lack every tenth ticket.
    "daily_refreshed": f"""
        SELECT d_date, d_year, d_month, d_day_name, CAST(sum(ss_sales_price) AS DECIMAL(22,2)) AS total_sales,
               CAST(sum(ss_quantity) AS BIGINT) AS total_quantity, count(ss_ticket_number) AS transaction_count,
               {avg('ss_sales_price')} AS avg_sale_price, count(DISTINCT ss_customer_sk) AS unique_customers
        FROM dated_sales
        WHERE ss_ticket_number % 10 > 0 OR d_year = 2001 AND d_month IN (6, 7)
        GROUP BY ALL""",
    "gold_daily_sales_summary": "SELECT * FROM gold_daily_sales_summary",
    "gold_customer_lifetime_value": "SELECT * FROM gold_customer_lifetime_value",
    "gold_product_performance": "SELECT * FROM gold_product_performance",
    "gold_monthly_trends": "SELECT * FROM gold_monthly_trends",
    "gold_top_products_by_store": f"""
        SELECT s_store_sk, s_store_name, i_item_sk, i_item_desc, {_money(PRICE)} AS total_revenue,
               CAST(sum(ss_quantity) AS BIGINT) AS units_sold,
               CAST(row_number() OVER (PARTITION BY s_store_sk ORDER BY sum({PRICE}) DESC, i_item_sk) AS INT)
                   AS store_rank
        FROM silver_store_sales JOIN silver_store ON s_store_sk = ss_store_sk
             JOIN silver_item ON i_item_sk = ss_item_sk
        GROUP BY s_store_sk, s_store_name, i_item_sk, i_item_desc
        QUALIFY store_rank <= 10""",
    # Rules of arrival, and the marts that read a table of the source directly or through the sales.
    "incremental_lineage": "WITH lines AS (" + " UNION ALL ".join(
        f"SELECT CASE WHEN {early} THEN 1 ELSE 2 END AS batch, 'bronze_{table}' AS output, {marts} AS marts FROM bronze_{table}"
        for table, early, marts in (
            ("store_sales", "ss_ticket_number % 10 < 7", 5), ("customer", "c_customer_sk % 3 > 0", 1),
            ("item", "i_item_sk % 5 > 0", 2), ("date_dim", "d_date_sk % 100 < 28", 5), ("store", "true", 1))
    ) + """) SELECT CAST(batch AS BIGINT) AS batch, output, count(*) AS "rows", CAST(0 AS BIGINT) AS rejected,
                    CAST(marts AS BIGINT) AS marts FROM lines GROUP BY ALL""",
    "bronze_ingest": " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, 'ok' AS status, CAST(NULL AS VARCHAR) AS error, count(*) AS "rows",
                   CAST(sum({' + '.join(f"coalesce(length(CAST({c} AS VARCHAR)), 0)" for c in columns.split())})
                        AS BIGINT) AS checksum
            FROM bronze_{table}"""
        for table, columns in {
            "store_sales": "ss_sold_date_sk ss_item_sk ss_customer_sk ss_store_sk ss_ticket_number ss_line_number ss_quantity ss_sales_price",
            "customer": "c_customer_sk c_customer_id c_first_name c_last_name c_email_address c_birth_country c_birth_year",
            "date_dim": "d_date_sk d_date d_year d_moy d_day_name",
            "item": "i_item_sk i_item_id i_item_desc i_category i_brand",
            "store": "s_store_sk s_store_name",
        }.items()),
    "sales_quality": """
        WITH all_sales AS (SELECT * FROM bronze_store_sales_dirty),
        failures AS (
            SELECT 'ss_sold_date_sk is set' AS check_name, count(*) AS failed_rows
            FROM all_sales WHERE ss_sold_date_sk IS NULL
            UNION ALL
            SELECT 'ss_quantity above 0', count(*) FROM all_sales WHERE coalesce(ss_quantity, 0) <= 0
            UNION ALL
            SELECT 'ss_sales_price at least 0', count(*) FROM all_sales WHERE coalesce(ss_sales_price, -1) < 0
            UNION ALL
            SELECT 'unique: ss_ticket_number, ss_item_sk, ss_line_number',
                   count(*) - count(DISTINCT (ss_ticket_number, ss_item_sk, ss_line_number)) FROM all_sales
            UNION ALL
            SELECT 'ss_sold_date_sk in d_date_sk', count(*) FROM all_sales
            WHERE ss_sold_date_sk IS NOT NULL AND ss_sold_date_sk NOT IN (SELECT d_date_sk FROM bronze_date_dim)
            UNION ALL
            SELECT 'ss_customer_sk in c_customer_sk', count(*) FROM all_sales
            WHERE ss_customer_sk NOT IN (SELECT c_customer_sk FROM bronze_customer)
            UNION ALL
            SELECT 'ss_item_sk in i_item_sk', count(*) FROM all_sales
            WHERE ss_item_sk NOT IN (SELECT i_item_sk FROM bronze_item))
        SELECT check_name, failed_rows, (SELECT count(*) FROM all_sales) AS all_rows FROM failures""",
    "sales_quarantine": """
        SELECT *, concat_ws('; ', CASE WHEN ss_sold_date_sk IS NULL THEN 'ss_sold_date_sk is set' END,
                            CASE WHEN coalesce(ss_quantity, 0) <= 0 THEN 'ss_quantity above 0' END,
                            CASE WHEN coalesce(ss_sales_price, -1) < 0 THEN 'ss_sales_price at least 0' END)
                  AS failed_checks
        FROM bronze_store_sales_dirty
        WHERE ss_sold_date_sk IS NULL OR coalesce(ss_quantity, 0) <= 0 OR coalesce(ss_sales_price, -1) < 0""",
    "masked_customers": """
        SELECT c_customer_sk, sha256(concat('lake', c_customer_id)) AS c_customer_id,
               concat(left(c_email_address, 1), '***@', split_part(c_email_address, '@', 2)) AS c_email_address,
               c_birth_country, c_birth_year
        FROM silver_customer""",
    # Layer queries
    "bronze_row_count": "SELECT count(*) AS row_count FROM bronze_store_sales",
    "sales_by_year_month": f"""
        SELECT year, month, count(*) AS transaction_count, {_money(PRICE)} AS total_sales,
               {avg(PRICE)} AS avg_sale_price
        FROM silver_store_sales GROUP BY ALL""",
    "customer_demographics": f"""
        SELECT c_birth_country, count(*) AS customer_count, {avg('c_birth_year')} AS avg_birth_year
        FROM silver_customer WHERE c_birth_country IS NOT NULL GROUP BY ALL
        ORDER BY customer_count DESC, c_birth_country LIMIT 20""",
    "weekend_vs_weekday": f"""
        SELECT is_weekend, count(*) AS transaction_count, {_money(PRICE)} AS total_sales, {avg(PRICE)} AS avg_sale
        FROM dated_sales GROUP BY ALL""",
    "daily_sales_trend": """
        SELECT d_date, d_day_name, total_sales, transaction_count, unique_customers, avg_sale_price
        FROM gold_daily_sales_summary WHERE d_year = 2000 ORDER BY d_date DESC LIMIT 30""",
    "top_customers_by_ltv": """
        SELECT c_customer_id, full_name, customer_segment, lifetime_value, total_transactions, avg_transaction_value
        FROM gold_customer_lifetime_value ORDER BY lifetime_value DESC, c_customer_sk LIMIT 10""",
    "segment_distribution": f"""
        SELECT customer_segment, count(*) AS customer_count, {_money('lifetime_value', 32)} AS total_value,
               {avg('lifetime_value')} AS avg_value, {avg('total_transactions')} AS avg_transactions
        FROM gold_customer_lifetime_value GROUP BY ALL""",
    "top_products_by_category": """
        SELECT i_category, i_brand, i_item_desc, total_revenue, units_sold, category_rank
        FROM gold_product_performance WHERE d_year = 2000 AND category_rank BETWEEN 1 AND 5""",
    "monthly_revenue_growth": f"""
        SELECT d_year, d_month, monthly_revenue, monthly_transactions, unique_customers,
               {r('revenue_growth_pct')} AS revenue_growth_pct
        FROM gold_monthly_trends WHERE d_year >= 1999""",
    "yoy_comparison": f"""
        WITH sides AS (
            SELECT d_month, coalesce(sum(monthly_revenue) FILTER (d_year = 1999), 0) AS older,
                   coalesce(sum(monthly_revenue) FILTER (d_year = 2000), 0) AS newer
            FROM gold_monthly_trends WHERE d_year BETWEEN 1999 AND 2000 GROUP BY ALL)
        SELECT d_month, CAST(older AS DECIMAL(32,2)) AS revenue_1999, CAST(newer AS DECIMAL(32,2)) AS revenue_2000,
               {r("CAST(newer - older AS DOUBLE) / nullif(CAST(older AS DOUBLE), 0) * 100")} AS yoy_growth_pct
        FROM sides""",
    "ltv_cohorts": f"""
        SELECT {MONTH} AS cohort_month, count(*) AS cohort_size, {avg('lifetime_value')} AS avg_ltv,
               {_money('lifetime_value', 32)} AS total_ltv
        FROM silver_date_dim JOIN gold_customer_lifetime_value ON first_purchase_date = d_date_sk GROUP BY ALL""",
    "category_performance": f"""
        SELECT i_category, {_money('total_revenue', 32)} AS category_revenue,
               CAST(sum(units_sold) AS BIGINT) AS category_units, count(DISTINCT i_item_sk) AS product_count,
               {avg('CAST(avg_price AS DECIMAL(28,6))')} AS avg_product_price
        FROM gold_product_performance WHERE d_year = 2000 GROUP BY ALL""",
    "yearly_sales": f"""
        SELECT d_year, {_money('total_sales', 32)} AS yearly_sales FROM gold_daily_sales_summary GROUP BY ALL""",
    "daily_sales_for_month": "SELECT * FROM gold_daily_sales_summary WHERE d_year = 2000 AND d_month = 12",
    # Business analytics
    "customer_retention": f"""
        WITH visits AS (
            SELECT DISTINCT ss_customer_sk AS who, {MONTH} AS purchase_month
            FROM dated_sales WHERE ss_customer_sk IN (SELECT c_customer_sk FROM silver_customer)),
        flagged AS (
            SELECT now.purchase_month, prior.who IS NOT NULL AS came_back
            FROM visits now LEFT JOIN visits prior
              ON prior.who = now.who
             AND prior.purchase_month = CAST(now.purchase_month - INTERVAL 1 MONTH AS DATE))
        SELECT purchase_month, count(*) AS active_customers, count(*) FILTER (came_back) AS retained_customers,
               {r("100.0::DOUBLE * count(*) FILTER (came_back) / count(*)")} AS retention_rate
        FROM flagged GROUP BY ALL""",
    "rfm_segments": f"""
        WITH people AS (
            SELECT c_customer_sk, full_name, CAST({AS_OF} - max(d_date) AS INT) AS recency,
                   count(DISTINCT ss_ticket_number) AS frequency, {_money(PRICE)} AS monetary
            FROM dated_sales JOIN silver_customer ON c_customer_sk = ss_customer_sk GROUP BY ALL),
        scored AS (
            SELECT *, {_quintile('recency DESC')} AS r_score, {_quintile('frequency')} AS f_score,
                   {_quintile('monetary')} AS m_score FROM people)
        SELECT *, r_score + f_score + m_score AS rfm_total, {_segment()} FROM scored""",
    "product_affinity": f"""
        SELECT left_item.i_item_desc AS item_a_desc, right_item.i_item_desc AS item_b_desc,
               count(*) AS co_occurrence_count,
               {r("100.0::DOUBLE * count(*) / (SELECT count(DISTINCT ss_ticket_number) FROM silver_store_sales)")}
                   AS support_pct
        FROM silver_store_sales one JOIN silver_store_sales two USING (ss_ticket_number)
             JOIN silver_item left_item ON left_item.i_item_sk = one.ss_item_sk
             JOIN silver_item right_item ON right_item.i_item_sk = two.ss_item_sk
        WHERE two.ss_item_sk > one.ss_item_sk
        GROUP BY ALL HAVING count(*) > 40
        ORDER BY co_occurrence_count DESC, item_a_desc, item_b_desc LIMIT 50""",
    "product_lifecycle": f"""
        WITH life AS (
            SELECT i_item_sk, i_item_desc, i_category, min(d_date) AS first_sale_date, max(d_date) AS last_sale_date,
                   count(DISTINCT ss_ticket_number) AS total_transactions,
                   CAST(sum(ss_quantity) AS BIGINT) AS total_units_sold, {_money(PRICE)} AS total_revenue
            FROM dated_sales JOIN silver_item ON ss_item_sk = i_item_sk GROUP BY ALL)
        SELECT *, CAST(last_sale_date - first_sale_date AS INT) AS product_lifetime_days,
               CASE WHEN {AS_OF} - last_sale_date >= 90 THEN 'Discontinued'
                    WHEN {AS_OF} - last_sale_date >= 30 THEN 'Declining' ELSE 'Active' END AS lifecycle_stage
        FROM life""",
    "seasonality": f"""
        SELECT d_month, d_moy, {avg('monthly_revenue')} AS avg_monthly_revenue,
               {r('stddev_samp(CAST(monthly_revenue AS DOUBLE))')} AS revenue_stddev,
               min(monthly_revenue) AS min_revenue, max(monthly_revenue) AS max_revenue
        FROM gold_monthly_trends GROUP BY ALL""",
    "day_of_week_performance": f"""
        SELECT d_day_name, count(*) AS transaction_count, {_money(PRICE)} AS total_sales,
               {avg(PRICE)} AS avg_transaction_value, CAST(sum(ss_quantity) AS BIGINT) AS total_quantity
        FROM dated_sales GROUP BY ALL""",
    "moving_average_sales": f"""
        WITH daily AS (SELECT d_date, {_money(PRICE)} AS daily_revenue FROM dated_sales GROUP BY ALL)
        SELECT d_date, daily_revenue,
               CAST(sum(daily_revenue) OVER week AS DOUBLE) / count(*) OVER week AS ma_7day,
               CAST(sum(daily_revenue) OVER month AS DOUBLE) / count(*) OVER month AS ma_30day
        FROM daily
        WINDOW week AS (ORDER BY d_date ROWS 6 PRECEDING), month AS (ORDER BY d_date ROWS 29 PRECEDING)
        ORDER BY d_date DESC LIMIT 90""",
    "cohort_revenue": f"""
        WITH born AS (
            SELECT c_customer_sk, CAST(date_trunc('month', min(d_date)) AS DATE) AS cohort_month
            FROM silver_customer JOIN dated_sales ON ss_customer_sk = c_customer_sk GROUP BY ALL),
        cells AS (
            SELECT cohort_month, {MONTH} AS purchase_month, count(DISTINCT ss_customer_sk) AS customers,
                   {_money(PRICE)} AS revenue
            FROM born JOIN dated_sales ON ss_customer_sk = c_customer_sk GROUP BY ALL)
        SELECT *, {_months_between('cohort_month', 'purchase_month')} AS months_since_first,
               {r('CAST(revenue AS DOUBLE) / customers')} AS revenue_per_customer
        FROM cells WHERE cohort_month >= {AS_OF} - INTERVAL 60 MONTH""",
    "clv_prediction": f"""
        WITH buyers AS (
            SELECT ss_customer_sk, count(DISTINCT ss_ticket_number) AS purchase_frequency,
                   {avg(PRICE)} AS avg_order_value, CAST(max(d_date) - min(d_date) AS INT) AS customer_lifespan_days,
                   {_money(PRICE)} AS total_spent
            FROM dated_sales GROUP BY ALL HAVING count(DISTINCT ss_ticket_number) >= 2)
        SELECT *, CASE WHEN customer_lifespan_days <= 0 THEN avg_order_value
                       ELSE {r('purchase_frequency * avg_order_value * 365.0::DOUBLE / customer_lifespan_days')}
                  END AS predicted_annual_value
        FROM buyers ORDER BY predicted_annual_value DESC, ss_customer_sk LIMIT 100""",
    # Challenges
    "customer_segments_vip": f"""
        WITH spending AS (
            SELECT ss_customer_sk, count(DISTINCT ss_ticket_number) AS transaction_count,
                   {_money(PRICE)} AS total_spent, {avg(PRICE)} AS mean_order
            FROM silver_store_sales GROUP BY ALL)
        SELECT c_customer_id, coalesce(c_first_name || ' ' || c_last_name, 'Unknown') AS customer_name, total_spent,
               transaction_count, {r('mean_order')} AS avg_order_value,
               CASE WHEN total_spent <= 1000000 THEN 'Occasional' WHEN total_spent <= 2000000 THEN 'Regular'
                    WHEN total_spent > 3000000 AND transaction_count > 12 THEN 'VIP' ELSE 'High Value'
               END AS customer_segment
        FROM silver_customer JOIN spending ON ss_customer_sk = c_customer_sk""",
    "cohort_retention": f"""
        WITH visits AS (SELECT DISTINCT ss_customer_sk, {MONTH} AS m FROM dated_sales WHERE ss_customer_sk IS NOT NULL),
        born AS (SELECT ss_customer_sk, min(m) AS cohort_month FROM visits GROUP BY ALL),
        sizes AS (SELECT cohort_month, count(*) AS cohort_size FROM born GROUP BY ALL)
        SELECT cohort_month, {_months_between('cohort_month', 'm')} AS months_since_first, count(*) AS customers,
               cohort_size, {r('100.0::DOUBLE * count(*) / cohort_size')} AS retention_pct
        FROM visits JOIN born USING (ss_customer_sk) JOIN sizes USING (cohort_month)
        GROUP BY cohort_month, m, cohort_size HAVING date_diff('month', cohort_month, m) <= 12""",
    "product_affinity_ranked": f"""
        WITH counted AS (
            SELECT one.ss_item_sk AS product_a, two.ss_item_sk AS product_b, count(*) AS co_occurrence_count
            FROM silver_store_sales one JOIN silver_store_sales two USING (ss_ticket_number)
            WHERE two.ss_item_sk > one.ss_item_sk GROUP BY ALL HAVING count(*) >= 2)
        SELECT product_a, a.i_item_desc AS product_a_desc, a.i_category AS product_a_category,
               product_b, b.i_item_desc AS product_b_desc, b.i_category AS product_b_category, co_occurrence_count,
               {r("100.0::DOUBLE * co_occurrence_count / (SELECT count(DISTINCT ss_ticket_number) FROM silver_store_sales)", 4)}
                   AS support_pct,
               CAST(dense_rank() OVER (ORDER BY co_occurrence_count DESC) AS INT) AS affinity_rank
        FROM counted JOIN silver_item a ON a.i_item_sk = product_a JOIN silver_item b ON b.i_item_sk = product_b
        ORDER BY co_occurrence_count DESC, product_a, product_b LIMIT 50""",
    "forecast_features": f"""
        WITH daily AS (
            SELECT d_date, i_category, {_money(PRICE)} AS daily_revenue,
                   count(DISTINCT ss_ticket_number) AS daily_transactions
            FROM dated_sales JOIN silver_item ON i_item_sk = ss_item_sk GROUP BY ALL),
        series AS (
            SELECT *, CAST(sum(daily_revenue) OVER (days ROWS 6 PRECEDING) AS DOUBLE)
                      / count(*) OVER (days ROWS 6 PRECEDING) AS week_mean,
                   CAST(sum(daily_revenue) OVER (days ROWS 29 PRECEDING) AS DOUBLE)
                      / count(*) OVER (days ROWS 29 PRECEDING) AS month_mean,
                   lag(daily_revenue) OVER days AS day_before, lag(daily_revenue, 7) OVER days AS week_before
            FROM daily WINDOW days AS (PARTITION BY i_category ORDER BY d_date))
        SELECT d_date, i_category, daily_revenue, daily_transactions, {r('week_mean')} AS moving_avg_7day,
               {r('month_mean')} AS moving_avg_30day,
               {r('100.0::DOUBLE * CAST(daily_revenue - day_before AS DOUBLE) / nullif(CAST(day_before AS DOUBLE), 0)')}
                   AS dod_growth_pct,
               {r('100.0::DOUBLE * CAST(daily_revenue - week_before AS DOUBLE) / nullif(CAST(week_before AS DOUBLE), 0)')}
                   AS wow_growth_pct,
               CAST(dayofweek(d_date) AS INT) AS day_of_week, CAST(month(d_date) AS INT) AS month,
               CAST(quarter(d_date) AS INT) AS quarter,
               CAST(dayname(d_date) IN ('Saturday', 'Sunday') AS INT) AS is_weekend
        FROM series WHERE d_date >= DATE '2000-01-01'""",
    "rfm_advanced": f"""
        WITH people AS (
            SELECT c_customer_sk, c_customer_id, c_first_name || ' ' || c_last_name AS customer_name,
                   CAST({AS_OF} - max(d_date) AS INT) AS recency_days,
                   count(DISTINCT ss_ticket_number) AS frequency, {_money(PRICE)} AS monetary_value
            FROM dated_sales JOIN silver_customer ON c_customer_sk = ss_customer_sk
            WHERE d_date >= {AS_OF} - INTERVAL 12 MONTH GROUP BY ALL),
        scored AS (
            SELECT * EXCLUDE (c_customer_sk), {_quintile('recency_days DESC')} AS r_score,
                   {_quintile('frequency')} AS f_score, {_quintile('monetary_value')} AS m_score FROM people)
        SELECT *, concat(r_score, f_score, m_score) AS rfm_score, {_segment()} FROM scored""",
}

RETAIL_QUERIES["incremental_top_products_by_store"] = RETAIL_QUERIES["gold_top_products_by_store"]
