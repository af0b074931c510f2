"""DuckDB SQL oracles, written independently of the Spark plans.

Every oracle starts from the raw test tables (``orders``, ``customer``,
``nation``, ``region``, ``lineitem``, ``part``, ``events``) and rebuilds
``transactions`` with the mapping in FIXTURES.md.  Rounded values use integer
arithmetic (exact half-up / half-even), so they agree with Spark's DECIMAL
rounding bit for bit.  Analyses are written in their literal SQL form (LAG,
self-join, NTILE window, NOT EXISTS) to cross-check the Spark rewrites.
"""

from __future__ import annotations

AS_OF = "2001-08-01"

TX = """
transactions AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         CAST(li.l_suppkey AS VARCHAR) AS restaurant_id,
         r.r_name AS city,
         CAST(CAST(CAST(floor(o.o_totalprice / 10) AS BIGINT) AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS order_value,
         CAST(li.l_quantity AS INTEGER) AS delivery_time,
         o.o_orderdate + to_minutes(CAST((o.o_orderkey * 37) % 1440 AS BIGINT)) AS order_date,
         p.p_type AS cuisine_type,
         o.o_orderpriority AS payment_method,
         o.o_orderstatus AS delivery_status
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (
    SELECT * FROM (
      SELECT l_orderkey, l_partkey, l_suppkey, l_quantity,
             row_number() OVER (PARTITION BY l_orderkey
                                ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
      FROM lineitem) WHERE rn = 1
  ) li ON li.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON p.p_partkey = li.l_partkey
)"""


def with_tx(*ctes: str) -> str:
    return "WITH " + ",\n".join((TX,) + ctes) + "\n"


def hu_k(num: str, den: str, digits: int = 2) -> str:
    """ROUND(num/den, digits) * 10^digits half away from zero, as an exact integer; den > 0."""
    p = 10 ** digits
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {n} >= 0 THEN (2*{p}*{n} + {d}) // (2*{d}) "
            f"ELSE -((2*{p}*(-{n}) + {d}) // (2*{d})) END)")


def k_to_double(k: str, digits: int = 2) -> str:
    return f"(CAST({k} AS DOUBLE) / CAST({10 ** digits} AS DOUBLE))"


def hu(num: str, den: str, digits: int = 2) -> str:
    """ROUND(num/den, digits) half away from zero, exact; den > 0; DOUBLE result."""
    return k_to_double(hu_k(num, den, digits), digits)


def mean_k(k: str, digits: int = 2) -> str:
    """Mean of values held as integers k / 10^digits, as DOUBLE: double(sum) / count."""
    return f"({k_to_double(f'SUM({k})', digits)} / COUNT({k}))"


def he_k(num: str, den: str, digits: int = 2) -> str:
    """round-half-even(num/den, digits) * 10^digits as an exact integer; num >= 0, den > 0."""
    p = 10 ** digits
    n = f"(CAST({num} AS HUGEINT) * {p})"
    d = f"CAST({den} AS HUGEINT)"
    q = f"({n} // {d})"
    r = f"({n} % {d})"
    return f"(CASE WHEN 2*{r} > {d} THEN {q} + 1 WHEN 2*{r} = {d} THEN {q} + ({q} % 2) ELSE {q} END)"


def he(num: str, den: str, digits: int = 2) -> str:
    """round-half-even(num/den, digits), exact; num >= 0, den > 0; DOUBLE result."""
    return f"(CAST({he_k(num, den, digits)} AS DOUBLE) / CAST({10 ** digits} AS DOUBLE))"


def hu_money(total: str, count: str, digits: int = 2) -> str:
    """ROUND(total / count, digits) for a DECIMAL(.,2) total, exact."""
    return hu(cents(total), f"({count}) * 100", digits)


def cents(expr: str) -> str:
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def months_back(n: int) -> str:
    return f"(DATE '{AS_OF}' - INTERVAL {n} MONTH)"


def days_back(n: int) -> str:
    return f"(DATE '{AS_OF}' - INTERVAL {n} DAY)"


def ddiff(later: str, earlier: str) -> str:
    return f"date_diff('day', CAST({earlier} AS DATE), CAST({later} AS DATE))"


ORACLES: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


# ---------------------------------------------------------------- Q1
@oracle("clv")
def _clv():
    return with_tx(f"""
m AS (
  SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, SUM(order_value) AS spent,
         COUNT(order_value) AS nv,
         {ddiff('MAX(order_date)', 'MIN(order_date)')} + 1 AS lifetime
  FROM transactions WHERE order_date >= {months_back(12)} GROUP BY customer_id)""") + f"""
SELECT customer_id, CAST(spent AS DOUBLE) AS total_spent, total_orders,
       CAST(spent AS DOUBLE) / nv AS avg_order_value,
       CAST(lifetime AS BIGINT) AS customer_lifetime_days,
       CASE WHEN lifetime > 0 THEN {hu('total_orders * 36525', 'lifetime * 100')}
            ELSE CAST(total_orders AS DOUBLE) END AS projected_annual_orders,
       CASE WHEN lifetime > 0 THEN {hu(cents('spent') + ' * 36525', 'lifetime * 10000')}
            ELSE CAST(spent AS DOUBLE) END AS customer_lifetime_value,
       CASE WHEN lifetime > 0 THEN
              CASE WHEN {cents('spent')} * 36525 >= 2000 * 10000 * lifetime THEN 'High Value'
                   WHEN {cents('spent')} * 36525 >= 1000 * 10000 * lifetime THEN 'Medium Value'
                   WHEN {cents('spent')} * 36525 >= 500 * 10000 * lifetime THEN 'Low Value'
                   ELSE 'Very Low Value' END
            ELSE CASE WHEN spent >= 2000 THEN 'High Value' WHEN spent >= 1000 THEN 'Medium Value'
                      WHEN spent >= 500 THEN 'Low Value' ELSE 'Very Low Value' END
       END AS customer_segment
FROM m"""


@oracle("clv_simple")
def _clv_simple():
    return with_tx(f"""
m AS (SELECT customer_id, SUM(order_value) AS spent, COUNT(*) AS total_orders,
             {ddiff('MAX(order_date)', 'MIN(order_date)')} AS lifetime
      FROM transactions GROUP BY customer_id)""") + f"""
SELECT customer_id, CAST(spent AS DOUBLE) AS total_spent, total_orders,
       CASE WHEN lifetime <> 0 THEN {hu(cents('spent') + ' * 365', 'lifetime * 100', 6)} END AS annualized_clv
FROM m"""


# ---------------------------------------------------------------- Q2
def _cohort(period: str, where: str = "TRUE") -> str:
    if period == "monthly":
        bucket = "date_trunc('month', order_date)"
        diff = "date_diff('month', c.cohort, t.bucket)"
        label = "strftime(c.cohort, '%Y-%m')"
        names = ("cohort_month", "month_number")
    else:
        bucket = "date_trunc('week', order_date)"
        diff = "date_diff('day', c.cohort, t.bucket) // 7"
        label = "strftime(c.cohort, '%Y-%m-%d')"
        names = ("cohort_week", "week_number")
    return with_tx(f"""
t AS (SELECT customer_id, CAST({bucket} AS DATE) AS bucket FROM transactions
      WHERE customer_id IS NOT NULL AND order_date IS NOT NULL AND {where}),
c AS (SELECT customer_id, MIN(bucket) AS cohort FROM t GROUP BY customer_id),
ct AS (SELECT c.cohort, c.customer_id, {diff} AS n FROM c JOIN t ON c.customer_id = t.customer_id),
sizes AS (SELECT cohort, COUNT(DISTINCT customer_id) AS cohort_size FROM c GROUP BY cohort),
ret AS (SELECT cohort, n, COUNT(DISTINCT customer_id) AS customers_retained FROM ct GROUP BY cohort, n)""") + f"""
SELECT {label.replace('c.cohort', 'r.cohort')} AS {names[0]}, CAST(r.n AS BIGINT) AS {names[1]},
       r.customers_retained, s.cohort_size,
       {hu('100 * r.customers_retained', 's.cohort_size')} AS retention_rate
FROM ret r JOIN sizes s ON r.cohort = s.cohort
WHERE r.n <= 12"""


ORACLES["cohort_retention"] = _cohort("monthly")
ORACLES["cohort_retention_weekly"] = _cohort("weekly")


# ---------------------------------------------------------------- Q3
@oracle("rfm")
def _rfm():
    return with_tx(f"""
d AS (SELECT customer_id, {ddiff(f"DATE '{AS_OF}'", 'MAX(order_date)')} AS recency_days,
             COUNT(DISTINCT order_id) AS frequency, SUM(order_value) AS monetary
      FROM transactions WHERE order_date >= {months_back(12)} GROUP BY customer_id),
s AS (SELECT *,
        NTILE(5) OVER (ORDER BY recency_days ASC NULLS FIRST, customer_id ASC NULLS FIRST) AS r,
        NTILE(5) OVER (ORDER BY frequency DESC NULLS LAST, customer_id ASC NULLS FIRST) AS f,
        NTILE(5) OVER (ORDER BY monetary DESC NULLS LAST, customer_id ASC NULLS FIRST) AS m
      FROM d)""") + """
SELECT customer_id, CAST(recency_days AS BIGINT) AS recency_days, frequency,
       CAST(monetary AS DOUBLE) AS monetary_value,
       CAST(r AS BIGINT) AS recency_score, CAST(f AS BIGINT) AS frequency_score,
       CAST(m AS BIGINT) AS monetary_score,
       CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_segment,
       CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions'
            WHEN r >= 3 AND f >= 3 AND m >= 3 THEN 'Loyal Customers'
            WHEN r >= 3 AND f <= 2 THEN 'Potential Loyalists'
            WHEN r <= 2 AND f >= 3 THEN 'At Risk'
            WHEN r <= 2 AND f <= 2 AND m >= 3 THEN 'Cannot Lose Them'
            WHEN r >= 3 AND f <= 1 THEN 'New Customers'
            ELSE 'Others' END AS customer_category
FROM s"""


# ---------------------------------------------------------------- Q7
@oracle("churn_risk")
def _churn():
    return with_tx(f"""
g AS (SELECT customer_id, order_id, order_date, order_value,
             {ddiff('order_date', 'LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date)')} AS gap
      FROM transactions),
a AS (SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, MAX(order_date) AS last_order_date,
             {ddiff(f"DATE '{AS_OF}'", 'MAX(order_date)')} AS days_since_last_order,
             AVG(gap) AS mean_gap, SUM(gap) AS gap_sum, COUNT(gap) AS gap_cnt,
             SUM(order_value) AS spent, COUNT(order_value) AS nv
      FROM g GROUP BY customer_id HAVING COUNT(DISTINCT order_id) >= 2),
c AS (SELECT customer_id, total_orders, last_order_date, CAST(days_since_last_order AS BIGINT) AS days_since_last_order,
             {hu('gap_sum', 'gap_cnt')} AS avg_days_between_orders,
             CAST(spent AS DOUBLE) AS total_spent,
             {hu_money('spent', 'nv')} AS avg_order_value,
             CASE WHEN days_since_last_order > mean_gap * 3 THEN 'High Risk'
                  WHEN days_since_last_order > mean_gap * 2 THEN 'Medium Risk'
                  WHEN days_since_last_order > mean_gap THEN 'Low Risk'
                  ELSE 'Active' END AS churn_risk_level
      FROM a WHERE mean_gap IS NOT NULL)""") + """
SELECT *, CASE WHEN churn_risk_level = 'High Risk' AND total_spent >= 1000 THEN 'Priority Retention'
               WHEN churn_risk_level = 'High Risk' THEN 'Standard Retention'
               WHEN churn_risk_level = 'Medium Risk' AND total_orders >= 10 THEN 'Engagement Campaign'
               ELSE 'Monitor' END AS recommended_action
FROM c"""


# ---------------------------------------------------------------- Q8
PAIRS_SQL = f"""
pairs AS (
  SELECT t1.cuisine_type AS cuisine_1, t2.cuisine_type AS cuisine_2,
         COUNT(DISTINCT t1.customer_id) AS customers_ordering_both,
         COUNT(*) AS order_pairs,
         SUM(t1.order_value + t2.order_value) AS vsum,
         COUNT(t1.order_value + t2.order_value) AS vcnt
  FROM transactions t1 JOIN transactions t2
    ON t1.customer_id = t2.customer_id AND t1.cuisine_type <> t2.cuisine_type
   AND abs({ddiff('t1.order_date', 't2.order_date')}) <= 30
  GROUP BY 1, 2 HAVING COUNT(DISTINCT t1.customer_id) >= 10)"""

PREFS_SQL = f"""
prefs AS (SELECT customer_id, cuisine_type, COUNT(*) AS orders_count, SUM(order_value) AS spent_on_cuisine,
                 RANK() OVER (PARTITION BY customer_id ORDER BY COUNT(*) DESC) AS preference_rank
          FROM transactions WHERE order_date >= {months_back(6)} GROUP BY customer_id, cuisine_type)"""


@oracle("cuisine_pairs")
def _pairs():
    return with_tx(PAIRS_SQL) + f"""
SELECT cuisine_1, cuisine_2, customers_ordering_both, order_pairs,
       {hu_money('vsum', 'vcnt')} AS avg_combined_order_value
FROM pairs"""


@oracle("cross_sell")
def _cross_sell():
    return with_tx(PAIRS_SQL, PREFS_SQL) + f"""
SELECT pp.customer_id, pp.cuisine_type AS primary_cuisine, pp.orders_count AS primary_orders,
       CAST(pp.spent_on_cuisine AS DOUBLE) AS primary_spent,
       cc.cuisine_2 AS recommended_cuisine, cc.customers_ordering_both AS market_validation,
       {hu_money('cc.vsum', 'cc.vcnt')} AS potential_order_value
FROM prefs pp JOIN pairs cc ON pp.cuisine_type = cc.cuisine_1
WHERE pp.preference_rank = 1
  AND NOT EXISTS (SELECT 1 FROM prefs x WHERE x.customer_id = pp.customer_id
                  AND x.cuisine_type = cc.cuisine_2)"""


# ---------------------------------------------------------------- Q4
@oracle("delivery_performance")
def _delivery():
    return with_tx() + f"""
SELECT city, strftime(order_date, '%Y-%m') AS month, COUNT(DISTINCT order_id) AS total_orders,
       AVG(delivery_time) AS avg_delivery_time,
       quantile_cont(delivery_time, 0.5) AS median_delivery_time,
       quantile_cont(delivery_time, 0.95) AS p95_delivery_time,
       COUNT(CASE WHEN delivery_time <= 30 THEN 1 END) / COUNT(*) * 100 AS on_time_delivery_rate,
       CAST(SUM(order_value) AS DOUBLE) AS total_revenue,
       CAST(SUM(order_value) AS DOUBLE) / COUNT(order_value) AS avg_order_value
FROM transactions WHERE order_date >= {months_back(6)}
GROUP BY 1, 2"""


# ---------------------------------------------------------------- Q5
HOURLY_SQL = f"""
h AS (SELECT hour(order_date) AS order_hour, dayname(order_date) AS day_of_week,
             COUNT(*) AS order_count, SUM(delivery_time) AS ds, COUNT(delivery_time) AS dc,
             SUM(order_value) AS rev
      FROM transactions WHERE order_date >= {days_back(30)} GROUP BY 1, 2)"""


@oracle("peak_hours")
def _peak():
    return with_tx(HOURLY_SQL) + f"""
SELECT day_of_week, CAST(order_hour AS BIGINT) AS order_hour, order_count,
       CASE WHEN dc > 0 THEN {hu('ds', 'dc')} END AS avg_delivery_time,
       CAST(rev AS DOUBLE) AS hourly_revenue,
       CASE WHEN order_count >= (SELECT AVG(order_count) * 1.5 FROM h) THEN 'Peak'
            WHEN order_count >= (SELECT AVG(order_count) FROM h) THEN 'Normal'
            ELSE 'Low' END AS demand_level,
       {hu('100 * order_count', 'SUM(order_count) OVER (PARTITION BY day_of_week)')} AS pct_of_daily_orders
FROM h"""


@oracle("demand_level")
def _demand():
    return with_tx(HOURLY_SQL) + """
SELECT CAST(order_hour AS BIGINT) AS order_hour, day_of_week, order_count,
       (SELECT AVG(order_count) FROM h) AS mean_order_count
FROM h"""


# ---------------------------------------------------------------- Q6
@oracle("restaurant_performance")
def _restaurants():
    return with_tx(f"""
m AS (SELECT restaurant_id, cuisine_type, city, COUNT(DISTINCT order_id) AS total_orders,
             AVG(delivery_time) AS adt, SUM(delivery_time) AS ds, COUNT(delivery_time) AS dc,
             SUM(order_value) AS rev, COUNT(order_value) AS nv,
             COUNT(DISTINCT customer_id) AS unique_customers
      FROM transactions WHERE order_date >= {months_back(3)} GROUP BY 1, 2, 3),
r AS (SELECT *,
        RANK() OVER (PARTITION BY city ORDER BY rev DESC NULLS LAST) AS revenue_rank,
        RANK() OVER (PARTITION BY city ORDER BY total_orders DESC NULLS LAST) AS order_rank,
        RANK() OVER (PARTITION BY city ORDER BY adt ASC NULLS FIRST) AS delivery_rank
      FROM m)""") + f"""
SELECT restaurant_id, cuisine_type, city, total_orders,
       CASE WHEN dc > 0 THEN {hu('ds', 'dc')} END AS avg_delivery_time,
       CAST(rev AS DOUBLE) AS total_revenue,
       CASE WHEN nv > 0 THEN {hu_money('rev', 'nv')} END AS avg_order_value,
       unique_customers,
       CASE WHEN unique_customers > 0 THEN {hu('total_orders', 'unique_customers')} END AS avg_orders_per_customer,
       CAST(revenue_rank AS BIGINT) AS revenue_rank, CAST(order_rank AS BIGINT) AS order_rank,
       CAST(delivery_rank AS BIGINT) AS delivery_rank,
       CASE WHEN revenue_rank <= 5 AND delivery_rank <= 10 THEN 'Top Performer'
            WHEN revenue_rank <= 10 THEN 'High Revenue'
            WHEN delivery_rank <= 5 THEN 'Fast Delivery'
            WHEN total_orders >= 100 THEN 'High Volume'
            ELSE 'Standard' END AS performance_category
FROM r"""


# ---------------------------------------------------------------- Q9
MOM_SQL = f"""
mo AS (SELECT city, strftime(order_date, '%Y-%m') AS month, COUNT(DISTINCT order_id) AS orders,
              COUNT(DISTINCT customer_id) AS customers, SUM(order_value) AS revenue,
              SUM(delivery_time) AS ds, COUNT(delivery_time) AS dc
       FROM transactions WHERE order_date >= {months_back(12)} GROUP BY 1, 2),
cg AS (SELECT *, LAG(orders) OVER (PARTITION BY city ORDER BY month) AS po,
              LAG(revenue) OVER (PARTITION BY city ORDER BY month) AS pr FROM mo),
gc AS (SELECT city, month, orders, customers, revenue,
              CASE WHEN dc > 0 THEN {hu_k('ds', 'dc')} END AS adt_k,
              CASE WHEN po > 0 THEN {hu_k('100 * (orders - po)', 'po')} END AS og_k,
              CASE WHEN pr > 0 THEN {hu_k('100 * ' + cents('revenue - pr'), cents('pr'))} END AS rg_k
       FROM cg)"""


@oracle("month_over_month")
def _mom():
    return with_tx(MOM_SQL) + f"""
SELECT city, month, orders, customers, CAST(revenue AS DOUBLE) AS revenue,
       {k_to_double('adt_k')} AS avg_delivery_time,
       {k_to_double('og_k')} AS orders_growth_rate, {k_to_double('rg_k')} AS revenue_growth_rate
FROM gc"""


@oracle("city_growth")
def _city_growth():
    og = mean_k("og_k")
    dt = mean_k("adt_k")
    return with_tx(MOM_SQL) + f"""
SELECT city, COUNT(*) AS months_of_data, CAST(SUM(orders) AS BIGINT) AS total_orders,
       CAST(SUM(customers) AS BIGINT) AS total_customers,
       CAST(SUM(revenue) AS DOUBLE) AS total_revenue,
       {dt} AS overall_avg_delivery_time,
       {og} AS avg_monthly_orders_growth,
       {mean_k('rg_k')} AS avg_monthly_revenue_growth,
       CASE WHEN {og} >= 10 THEN 'High Growth' WHEN {og} >= 5 THEN 'Moderate Growth'
            WHEN {og} >= 0 THEN 'Stable' ELSE 'Declining' END AS growth_category,
       CASE WHEN {dt} <= 25 THEN 'Excellent' WHEN {dt} <= 35 THEN 'Good'
            WHEN {dt} <= 45 THEN 'Average' ELSE 'Needs Improvement' END AS delivery_performance
FROM gc WHERE og_k IS NOT NULL GROUP BY city"""


# ---------------------------------------------------------------- Q10
@oracle("executive_summary")
def _summary():
    w = f"FROM transactions WHERE order_date >= {days_back(30)}"
    return with_tx() + f"""
SELECT 'Overall Performance' AS metric_category,
  (SELECT COUNT(*) {w}) AS total_orders_last_30_days,
  (SELECT CAST(SUM(order_value) AS DOUBLE) {w}) AS total_revenue_last_30_days,
  (SELECT CASE WHEN COUNT(order_value) > 0 THEN {hu_money('SUM(order_value)', 'COUNT(order_value)')} END {w}) AS avg_order_value_last_30_days,
  (SELECT CASE WHEN COUNT(delivery_time) > 0 THEN {hu('SUM(delivery_time)', 'COUNT(delivery_time)')} END {w}) AS avg_delivery_time_last_30_days,
  (SELECT COUNT(DISTINCT customer_id) {w}) AS active_customers_last_30_days,
  (SELECT COUNT(DISTINCT restaurant_id) {w}) AS active_restaurants_last_30_days"""


# ---------------------------------------------------------------- 2.12 API metrics
RANGE30 = "order_date >= DATE '2001-07-02' AND order_date < DATE '2001-08-02'"


@oracle("retention_summary")
def _retention_summary():
    inw = f"order_date >= {months_back(12)}"
    return with_tx(f"""
per AS (SELECT customer_id, MAX(order_date) AS last,
               COUNT(CASE WHEN {inw} THEN 1 END) AS n12,
               SUM(CASE WHEN {inw} THEN order_value END) AS s12,
               {ddiff(f'MAX(CASE WHEN {inw} THEN order_date END)', f'MIN(CASE WHEN {inw} THEN order_date END)')} + 1 AS life
        FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id),
c AS (SELECT COALESCE(last < {days_back(30)}, TRUE) AS churned,
             CASE WHEN n12 > 0 THEN {hu_k(cents('s12') + ' * 36525', 'life * 10000')} END AS clv_k
      FROM per)""") + f"""
SELECT 'monthly' AS cohort_period, 'all' AS city,
       {hu('100 * COUNT(CASE WHEN churned THEN 1 END)', 'COUNT(*)')} AS average_churn_rate,
       CASE WHEN COUNT(clv_k) > 0 THEN {hu('SUM(clv_k)', 'COUNT(clv_k) * 100')} END AS average_clv
FROM c"""


@oracle("city_breakdown")
def _city_breakdown():
    return with_tx() + f"""
SELECT city, AVG(delivery_time) AS avg_delivery_time, COUNT(*) AS total_orders,
       CAST(COALESCE(SUM(order_value), 0) AS DOUBLE) AS total_revenue,
       CAST(SUM(order_value) AS DOUBLE) / COUNT(order_value) AS avg_order_value
FROM transactions WHERE {RANGE30} AND city IS NOT NULL GROUP BY city"""


@oracle("operational_metrics")
def _operational_metrics():
    return with_tx() + f"""
SELECT COUNT(*) AS total_orders, COUNT(DISTINCT customer_id) AS active_customers,
       COUNT(DISTINCT restaurant_id) AS active_restaurants,
       CAST(SUM(order_value) AS DOUBLE) AS total_revenue,
       CASE WHEN COUNT(order_value) > 0 THEN {hu_money('SUM(order_value)', 'COUNT(order_value)')} END AS avg_order_value,
       CASE WHEN COUNT(delivery_time) > 0 THEN {hu('SUM(delivery_time)', 'COUNT(delivery_time)')} END AS avg_delivery_time,
       quantile_cont(delivery_time, 0.5) AS median_delivery_time,
       quantile_cont(delivery_time, 0.95) AS p95_delivery_time,
       CASE WHEN COUNT(*) > 0 THEN {hu('100 * COUNT(CASE WHEN delivery_time <= 30 THEN 1 END)', 'COUNT(*)')} END AS on_time_rate
FROM transactions WHERE {RANGE30}"""


@oracle("status_breakdown")
def _status_breakdown():
    return with_tx(f"""
r AS (SELECT * FROM transactions WHERE {RANGE30}),
l AS (SELECT 'delivery_status' AS dimension, delivery_status AS value, delivery_time FROM r
      UNION ALL SELECT 'payment_method', payment_method, delivery_time FROM r),
g AS (SELECT dimension, value, COUNT(*) AS orders, SUM(delivery_time) AS ds, COUNT(delivery_time) AS dc
      FROM l GROUP BY 1, 2)""") + f"""
SELECT dimension, value, orders, CASE WHEN dc > 0 THEN {hu('ds', 'dc')} END AS avg_delivery_time,
       {hu('100 * orders', 'SUM(orders) OVER (PARTITION BY dimension)')} AS pct_of_orders
FROM g"""


def _two_day(src: str, with_customers: bool) -> str:
    today = f"CAST(order_date AS DATE) = DATE '{AS_OF}'"
    extra_mid = (f", COUNT(DISTINCT CASE WHEN {today} THEN customer_id END) AS today_customers"
                 if with_customers else "")
    extra_end = ", y AS yesterday_orders, CAST(yr AS DOUBLE) AS yesterday_revenue" if with_customers else ""
    return f"""
d AS (SELECT * FROM {src} WHERE order_date >= DATE '2001-07-31' AND order_date < DATE '2001-08-02'),
a AS (SELECT COUNT(CASE WHEN {today} THEN 1 END) AS t, COUNT(CASE WHEN NOT ({today}) THEN 1 END) AS y,
             COALESCE(SUM(CASE WHEN {today} THEN order_value END), 0) AS tr,
             COALESCE(SUM(CASE WHEN NOT ({today}) THEN order_value END), 0) AS yr,
             COALESCE(AVG(CASE WHEN {today} THEN delivery_time END), 0.0) AS adt{extra_mid}
      FROM d)""", f"""
SELECT t AS today_orders, CAST(tr AS DOUBLE) AS today_revenue, adt AS avg_delivery_time
       {', today_customers' if with_customers else ''},
       CASE WHEN y > 0 THEN (CAST(t AS DOUBLE) - CAST(y AS DOUBLE)) / CAST(y AS DOUBLE) * 100 ELSE 0.0 END AS orders_growth,
       CASE WHEN yr > 0 THEN (CAST(tr AS DOUBLE) - CAST(yr AS DOUBLE)) / CAST(yr AS DOUBLE) * 100 ELSE 0.0 END AS revenue_growth
       {extra_end}
FROM a"""


@oracle("daily_summary")
def _daily_summary():
    cte, sel = _two_day("transactions", False)
    return with_tx(cte) + sel


@oracle("weekly_trend")
def _weekly_trend():
    return with_tx() + """
SELECT CAST(order_date AS DATE) AS date, COUNT(*) AS orders, CAST(SUM(order_value) AS DOUBLE) AS revenue
FROM transactions WHERE order_date >= DATE '2001-07-25' GROUP BY 1"""


@oracle("top_cities")
def _top_cities():
    return with_tx() + """
SELECT city, COUNT(*) AS orders, CAST(SUM(order_value) AS DOUBLE) AS revenue,
       AVG(delivery_time) AS avg_delivery_time
FROM transactions WHERE order_date >= DATE '2001-07-02'
GROUP BY city ORDER BY SUM(order_value) DESC NULLS LAST, city NULLS FIRST LIMIT 5"""


# ---------------------------------------------------------------- 2.13 dashboard tables
DF = f"""
df AS (SELECT * FROM transactions
       WHERE order_date >= {days_back(90)} AND order_date >= DATE '2001-07-02'
         AND order_date < DATE '2001-08-02')"""


@oracle("kpi_cards")
def _kpi_cards():
    cte, sel = _two_day("df", True)
    return with_tx(DF, cte) + sel


@oracle("daily_revenue")
def _daily_revenue():
    return with_tx(DF) + f"""
SELECT CAST(order_date AS DATE) AS date, CAST(SUM(order_value) AS DOUBLE) AS revenue,
       COUNT(order_id) AS orders
FROM df WHERE order_date >= {days_back(30)} GROUP BY 1"""


@oracle("city_performance")
def _city_performance():
    return with_tx(DF) + f"""
SELECT city, CAST(SUM(order_value) AS DOUBLE) AS total_revenue,
       CASE WHEN COUNT(order_value) > 0 THEN {he(cents('SUM(order_value)'), 'COUNT(order_value) * 100')} END AS avg_order_value,
       COUNT(order_value) AS total_orders,
       CASE WHEN COUNT(delivery_time) > 0 THEN {he('SUM(delivery_time)', 'COUNT(delivery_time)')} END AS avg_delivery_time
FROM df WHERE city IS NOT NULL GROUP BY city"""


@oracle("delivery_box_stats")
def _box():
    return with_tx(DF, """
b AS (SELECT city, delivery_time AS v FROM df WHERE city IS NOT NULL AND delivery_time IS NOT NULL),
q AS (SELECT city, COUNT(*) AS count, MIN(v) AS min, MAX(v) AS max, SUM(v) AS s,
             quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM b GROUP BY city)""") + """
SELECT q.city, q.count, q.min, q.max, q.q1, q.median, q.q3,
       (SELECT MIN(v) FROM b WHERE b.city = q.city AND v >= q.q1 - 1.5 * (q.q3 - q.q1)) AS whisker_low,
       (SELECT MAX(v) FROM b WHERE b.city = q.city AND v <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
       CAST(q.s AS DOUBLE) / q.count AS mean,
       CAST(SUM(q.s) OVER () AS DOUBLE) / SUM(q.count) OVER () AS overall_mean
FROM q"""


@oracle("hourly_heatmap")
def _heatmap():
    hours = ",\n       ".join(
        f"CAST(SUM(CASE WHEN hour(order_date) = {h} THEN 1 ELSE 0 END) AS BIGINT) AS h{h:02d}"
        for h in range(24))
    return with_tx(DF, f"""
c AS (SELECT CAST(isodow(order_date) - 1 AS BIGINT) AS day_index,
       {hours}
      FROM df WHERE order_date IS NOT NULL GROUP BY 1),
days AS (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
                               (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) v(day_index, day_name))""") + """
SELECT CAST(days.day_index AS BIGINT) AS day_index, days.day_name, c.* EXCLUDE (day_index)
FROM days LEFT JOIN c ON c.day_index = days.day_index"""


INSIGHT_PARTS = {
    "peak": """(SELECT CAST(h AS BIGINT) AS peak_hour, n AS peak_orders FROM (
        SELECT hour(order_date) AS h, COUNT(*) AS n FROM df WHERE order_date IS NOT NULL GROUP BY 1)
        ORDER BY n DESC, h ASC LIMIT 1)""",
    "best": """(SELECT city AS best_city, CAST(rev AS DOUBLE) AS best_city_revenue FROM (
        SELECT city, SUM(order_value) AS rev FROM df WHERE city IS NOT NULL GROUP BY city)
        ORDER BY rev DESC NULLS LAST, city ASC LIMIT 1)""",
    "delivery": """(SELECT avg_delivery_time,
        CASE WHEN avg_delivery_time <= 30 THEN 'Excellent' WHEN avg_delivery_time <= 40 THEN 'Good'
             ELSE 'Needs Improvement' END AS delivery_status
        FROM (SELECT AVG(delivery_time) AS avg_delivery_time FROM df))""",
    "repeat": """(SELECT repeat_customers, total_customers,
        CAST(repeat_customers AS DOUBLE) / total_customers * 100 AS repeat_rate FROM (
        SELECT COUNT(CASE WHEN n > 1 THEN 1 END) AS repeat_customers, COUNT(*) AS total_customers
        FROM (SELECT customer_id, COUNT(*) AS n FROM df WHERE customer_id IS NOT NULL GROUP BY 1)))""",
}


def _insights(*parts: str) -> str:
    froms = ", ".join(f"{INSIGHT_PARTS[p]} AS {p}" for p in parts)
    return with_tx(DF) + f"SELECT * FROM {froms}"


ORACLES["operational_insights"] = _insights("peak", "best", "delivery", "repeat")
ORACLES["peak_hour_and_best_city"] = _insights("peak", "best")
ORACLES["repeat_rate"] = _insights("repeat")


@oracle("dataset_overview")
def _overview():
    return with_tx(DF) + """
SELECT COUNT(*) AS total_records, MIN(order_date) AS min_date, MAX(order_date) AS max_date,
       COUNT(DISTINCT city) AS cities
FROM df"""


@oracle("distinct_cities")
def _distinct_cities():
    return with_tx(DF) + "SELECT DISTINCT city FROM df WHERE city IS NOT NULL"


# ---------------------------------------------------------------- operator-level keys
TX_DOUBLE = """order_id, customer_id, restaurant_id, city, CAST(order_value AS DOUBLE) AS order_value,
       delivery_time, order_date, cuisine_type, payment_method, delivery_status"""

ORACLES["scan_transactions"] = with_tx() + f"SELECT {TX_DOUBLE} FROM transactions"
ORACLES["scan_pruned"] = with_tx() + """
SELECT customer_id, city, CAST(order_value AS DOUBLE) AS order_value, delivery_time, order_date,
       restaurant_id, cuisine_type FROM transactions"""
ORACLES["recent_orders"] = with_tx() + f"SELECT {TX_DOUBLE} FROM transactions WHERE order_date >= {days_back(90)}"
ORACLES["validate_keys"] = with_tx() + """
SELECT COUNT(*) AS rows, COUNT(*) - COUNT(order_id) AS null_keys,
       (SELECT COUNT(*) FROM (SELECT order_id FROM transactions WHERE order_id IS NOT NULL
                              GROUP BY 1 HAVING COUNT(*) > 1)) AS duplicate_keys
FROM transactions"""
ORACLES["trailing_window"] = with_tx() + f"""
SELECT COUNT(CASE WHEN order_date >= {months_back(12)} THEN 1 END) AS orders_12_months,
       COUNT(CASE WHEN order_date >= {months_back(6)} THEN 1 END) AS orders_6_months,
       COUNT(CASE WHEN order_date >= {months_back(3)} THEN 1 END) AS orders_3_months,
       COUNT(CASE WHEN order_date >= {days_back(30)} THEN 1 END) AS orders_30_days
FROM transactions"""
ORACLES["filter_city_dates"] = with_tx() + f"""
SELECT {TX_DOUBLE} FROM transactions
WHERE city = 'ASIA' AND order_date >= DATE '2001-01-01' AND order_date < DATE '2001-04-01'"""
ORACLES["any_row"] = with_tx() + """
SELECT COUNT(*) > 0 AS has_rows FROM transactions
WHERE city = 'ASIA' AND order_date >= DATE '2001-01-01' AND order_date < DATE '2001-04-01'"""
ORACLES["dated_export"] = with_tx(DF) + f"SELECT {TX_DOUBLE} FROM df"
ORACLES["having_filter"] = with_tx() + """
SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders FROM transactions
GROUP BY customer_id HAVING COUNT(DISTINCT order_id) >= 10"""
ORACLES["on_time_rate"] = with_tx() + f"""
SELECT city, COUNT(*) AS orders, COUNT(CASE WHEN delivery_time <= 30 THEN 1 END) AS on_time_orders,
       {hu('100 * COUNT(CASE WHEN delivery_time <= 30 THEN 1 END)', 'COUNT(*)')} AS on_time_rate
FROM transactions GROUP BY city"""
ORACLES["band_self_join"] = with_tx() + f"""
SELECT t1.customer_id, t1.cuisine_type AS cuisine_1, t2.cuisine_type AS cuisine_2,
       COUNT(*) AS order_pairs, COUNT(t1.order_value + t2.order_value) AS valued_pairs,
       CAST(SUM(t1.order_value + t2.order_value) AS DOUBLE) AS pair_value_sum
FROM transactions t1 JOIN transactions t2
  ON t1.customer_id = t2.customer_id AND t1.cuisine_type <> t2.cuisine_type
 AND abs({ddiff('t1.order_date', 't2.order_date')}) <= 30
GROUP BY 1, 2, 3"""
ORACLES["anti_join_unseen"] = with_tx() + f"""
SELECT r.order_id, r.customer_id, r.cuisine_type FROM transactions r
WHERE r.order_date >= {days_back(30)}
  AND NOT EXISTS (SELECT 1 FROM transactions b
                  WHERE b.customer_id = r.customer_id AND b.cuisine_type = r.cuisine_type
                    AND b.order_date >= {months_back(6)} AND b.order_date < {days_back(30)})"""
ORACLES["group_city_month"] = with_tx() + """
SELECT city, strftime(order_date, '%Y-%m') AS month, COUNT(*) AS orders,
       CAST(SUM(order_value) AS DOUBLE) AS revenue
FROM transactions GROUP BY 1, 2"""
ORACLES["distinct_counts"] = with_tx() + """
SELECT city, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT restaurant_id) AS restaurants,
       COUNT(DISTINCT order_id) AS orders FROM transactions GROUP BY city"""
ORACLES["delivery_percentiles"] = with_tx() + """
SELECT city, quantile_cont(delivery_time, 0.5) AS median_delivery_time,
       quantile_cont(delivery_time, 0.95) AS p95_delivery_time FROM transactions GROUP BY city"""
ORACLES["latest_order_attrs"] = with_tx() + """
SELECT customer_id, city, cuisine_type FROM (
  SELECT customer_id, city, cuisine_type,
         row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC NULLS LAST, order_id DESC) AS rn
  FROM transactions) WHERE rn = 1"""
ORACLES["ntile_scores"] = with_tx() + """
SELECT customer_id, CAST(total_spent AS DOUBLE) AS total_spent,
       CAST(NTILE(5) OVER (ORDER BY total_spent DESC NULLS LAST, customer_id ASC NULLS FIRST) AS BIGINT) AS spend_quintile
FROM (SELECT customer_id, SUM(order_value) AS total_spent FROM transactions GROUP BY 1)"""
ORACLES["rank_in_city"] = with_tx() + """
SELECT city, restaurant_id, CAST(revenue AS DOUBLE) AS revenue,
       CAST(RANK() OVER (PARTITION BY city ORDER BY revenue DESC NULLS LAST) AS BIGINT) AS revenue_rank
FROM (SELECT city, restaurant_id, SUM(order_value) AS revenue FROM transactions GROUP BY 1, 2)"""
ORACLES["top_preference"] = with_tx(PREFS_SQL) + """
SELECT customer_id, cuisine_type, orders_count, CAST(spent_on_cuisine AS DOUBLE) AS spent_on_cuisine
FROM prefs WHERE preference_rank = 1"""
ORACLES["order_gaps"] = with_tx() + f"""
SELECT order_id, customer_id, order_date, previous_order_date,
       CAST({ddiff('order_date', 'previous_order_date')} AS BIGINT) AS days_since_previous
FROM (SELECT order_id, customer_id, order_date,
             LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date ASC NULLS FIRST, order_id) AS previous_order_date
      FROM transactions)"""
ORACLES["share_of_day"] = with_tx() + f"""
SELECT day_of_week, order_hour, order_count,
       {hu('100 * order_count', 'SUM(order_count) OVER (PARTITION BY day_of_week)')} AS pct_of_daily_orders
FROM (SELECT dayname(order_date) AS day_of_week, CAST(hour(order_date) AS BIGINT) AS order_hour,
             COUNT(*) AS order_count FROM transactions GROUP BY 1, 2)"""
ORACLES["fn_dates"] = with_tx() + f"""
SELECT order_id, CAST({ddiff(f"DATE '{AS_OF}'", 'order_date')} AS BIGINT) AS days_before_as_of,
       strftime(order_date, '%Y-%m') AS month, CAST(date_trunc('month', order_date) AS DATE) AS month_start,
       dayname(order_date) AS day_name, CAST(hour(order_date) AS BIGINT) AS hour_of_day,
       CAST(isodow(order_date) - 1 AS BIGINT) AS day_of_week, CAST(order_date AS DATE) AS order_day,
       CAST(date_diff('month', date_trunc('month', order_date), order_date) AS BIGINT) AS months_since_month_start
FROM transactions"""
ORACLES["fn_elapsed_days"] = with_tx() + f"""
SELECT customer_id, CAST({ddiff('MAX(order_date)', 'MIN(order_date)')} AS BIGINT) AS calendar_days,
       CAST(date_sub('day', MIN(order_date), MAX(order_date)) AS BIGINT) AS elapsed_days
FROM transactions GROUP BY customer_id"""
ORACLES["fn_rounding"] = with_tx() + f"""
SELECT customer_id,
       CASE WHEN COUNT(order_value) > 0 THEN {hu_money('SUM(order_value)', 'COUNT(order_value)')} END AS mean_half_up,
       CASE WHEN COUNT(order_value) > 0 THEN {he(cents('SUM(order_value)'), 'COUNT(order_value) * 100')} END AS mean_half_even
FROM transactions GROUP BY customer_id"""
ORACLES["order_complexity"] = with_tx() + """
SELECT order_id, CAST(order_value AS DOUBLE) AS order_value,
       CASE WHEN order_value > 0 AND order_value <= 100 THEN 'Simple'
            WHEN order_value > 100 AND order_value <= 300 THEN 'Medium'
            WHEN order_value > 300 AND order_value <= 500 THEN 'Complex'
            WHEN order_value > 500 THEN 'Very Complex' ELSE 'nan' END AS order_complexity
FROM transactions"""


# ---------------------------------------------------------------- 2.10 features
def he_money(total: str, count: str) -> str:
    return he(cents(total), f"({count}) * 100")


F1_SQL = f"""
f1 AS (
  SELECT customer_id, CAST(COALESCE(SUM(order_value), 0) AS DOUBLE) AS total_spent,
         COUNT(order_value) AS order_frequency,
         COALESCE(CASE WHEN COUNT(order_value) > 0 THEN {he_money('SUM(order_value)', 'COUNT(order_value)')} END, 0.0) AS avg_order_value,
         COALESCE(CAST(COUNT(order_value) AS DOUBLE) / (date_sub('day', MIN(order_date), MAX(order_date)) + 1),
                  CAST(COUNT(order_value) AS DOUBLE), 0.0) AS orders_per_day,
         COALESCE(CASE WHEN COUNT(delivery_time) > 0 THEN {he('SUM(delivery_time)', 'COUNT(delivery_time)')} END, 0.0) AS avg_delivery_time
  FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id)"""

ORACLES["segmentation_features"] = with_tx(F1_SQL) + "SELECT * FROM f1"

ORACLES["standardize"] = with_tx(F1_SQL) + "SELECT customer_id, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - AVG(CAST({c} AS DOUBLE)) OVER ()) / STDDEV_POP(CAST({c} AS DOUBLE)) OVER (), 6) AS {c}_z"
    for c in ["total_spent", "order_frequency", "avg_order_value", "orders_per_day", "avg_delivery_time"]) + " FROM f1"


def _group_stats_sql(key: str, prefix: str, with_count: bool) -> str:
    cnt = f"COUNT(delivery_time) AS {prefix}delivery_time_count," if with_count else ""
    return f"""
{prefix}s AS (SELECT {key},
   CASE WHEN COUNT(delivery_time) > 0 THEN {he('SUM(delivery_time)', 'COUNT(delivery_time)')} END AS {prefix}delivery_time_mean,
   round_even(stddev_samp(delivery_time), 2) AS {prefix}delivery_time_std, {cnt}
   CASE WHEN COUNT(order_value) > 0 THEN {he_money('SUM(order_value)', 'COUNT(order_value)')} END AS {prefix}order_value_mean
 FROM transactions WHERE {key} IS NOT NULL GROUP BY {key})"""


ORACLES["delivery_features"] = with_tx(_group_stats_sql("restaurant_id", "restaurant_", True),
                                       _group_stats_sql("city", "city_", False)) + """
SELECT t.order_id, t.restaurant_id, t.city, t.cuisine_type, CAST(t.order_value AS DOUBLE) AS order_value,
       t.delivery_time, CAST(hour(t.order_date) AS INTEGER) AS hour_of_day,
       CAST(isodow(t.order_date) - 1 AS INTEGER) AS day_of_week,
       CASE WHEN isodow(t.order_date) - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN hour(t.order_date) IN (12, 13, 19, 20, 21) THEN 1 ELSE 0 END AS is_peak_hour,
       CASE WHEN t.order_value > 0 AND t.order_value <= 100 THEN 'Simple'
            WHEN t.order_value > 100 AND t.order_value <= 300 THEN 'Medium'
            WHEN t.order_value > 300 AND t.order_value <= 500 THEN 'Complex'
            WHEN t.order_value > 500 THEN 'Very Complex' ELSE 'nan' END AS order_complexity,
       rs.* EXCLUDE (restaurant_id), cs.* EXCLUDE (city)
FROM transactions t LEFT JOIN restaurant_s rs ON rs.restaurant_id = t.restaurant_id
LEFT JOIN city_s cs ON cs.city = t.city"""

F3_SQL = f"""
b AS (SELECT MAX(order_date) - INTERVAL 30 DAY AS e, MAX(order_date) - INTERVAL 30 DAY - INTERVAL 90 DAY AS s
      FROM transactions),
obs AS (SELECT t.* FROM transactions t, b WHERE t.order_date >= b.s AND t.order_date <= b.e
        AND t.customer_id IS NOT NULL),
f AS (SELECT customer_id, COUNT(order_id) AS total_orders, SUM(order_value) AS spent, COUNT(order_value) AS nv,
             stddev_samp(order_value) AS sv, SUM(delivery_time) AS ds, COUNT(delivery_time) AS dc,
             stddev_samp(delivery_time) AS sd, MIN(order_date) AS first, MAX(order_date) AS last
      FROM obs GROUP BY 1),
lat AS (SELECT customer_id, city, cuisine_type FROM (
          SELECT customer_id, city, cuisine_type,
                 row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS rn
          FROM obs) WHERE rn = 1),
fut AS (SELECT DISTINCT customer_id FROM transactions, b WHERE order_date > b.e),
f3 AS (
  SELECT f.customer_id, f.total_orders, CAST(COALESCE(f.spent, 0) AS DOUBLE) AS total_spent,
         COALESCE(CASE WHEN f.nv > 0 THEN {he_money('f.spent', 'f.nv')} END, 0.0) AS avg_order_value,
         COALESCE(round_even(f.sv, 2), 0.0) AS order_value_variability,
         COALESCE(CASE WHEN f.dc > 0 THEN {he('f.ds', 'f.dc')} END, 0.0) AS avg_delivery_time,
         COALESCE(round_even(f.sd, 2), 0.0) AS delivery_consistency,
         date_sub('day', f.first, f.last) + 1 AS days_active,
         f.total_orders / (date_sub('day', f.first, f.last) + 1) AS order_frequency,
         date_sub('day', f.last, b.e) AS days_since_last_order,
         COALESCE(lat.city, '0') AS city, COALESCE(lat.cuisine_type, '0') AS cuisine_type,
         fut.customer_id IS NULL AS churned
  FROM f JOIN lat ON lat.customer_id = f.customer_id
  LEFT JOIN fut ON fut.customer_id = f.customer_id, b)"""

ORACLES["churn_features"] = with_tx(F3_SQL) + "SELECT * FROM f3"
ORACLES["churn_label"] = with_tx(F3_SQL) + "SELECT customer_id, churned FROM f3"

ORACLES["label_encoding"] = with_tx() + """
SELECT order_id, city, cuisine_type,
       CAST(DENSE_RANK() OVER (ORDER BY COALESCE(city, 'nan')) - 1 AS BIGINT) AS city_encoded,
       CAST(DENSE_RANK() OVER (ORDER BY COALESCE(cuisine_type, 'nan')) - 1 AS BIGINT) AS cuisine_type_encoded
FROM transactions"""



# ---------------------------------------------------------------- 2.11 model-side tables
CLV_BAND_SQL = f"""
clvm AS (SELECT customer_id, SUM(order_value) AS spent,
                {ddiff('MAX(order_date)', 'MIN(order_date)')} + 1 AS lifetime
         FROM transactions WHERE order_date >= {months_back(12)} GROUP BY customer_id),
clvb AS (SELECT customer_id,
           CASE WHEN {cents('spent')} * 36525 >= 2000 * 10000 * lifetime THEN 'High Value'
                WHEN {cents('spent')} * 36525 >= 1000 * 10000 * lifetime THEN 'Medium Value'
                WHEN {cents('spent')} * 36525 >= 500 * 10000 * lifetime THEN 'Low Value'
                ELSE 'Very Low Value' END AS customer_segment
         FROM clvm)"""

F1K_SQL = f"""
f1k AS (SELECT customer_id, {cents('COALESCE(SUM(order_value), 0)')} AS spent_c,
               COUNT(order_value) AS freq,
               COALESCE(CASE WHEN COUNT(order_value) > 0 THEN {he_k(cents('SUM(order_value)'), 'COUNT(order_value) * 100')} END, 0) AS aov_k,
               COALESCE(CAST(COUNT(order_value) AS DOUBLE) / (date_sub('day', MIN(order_date), MAX(order_date)) + 1),
                        CAST(COUNT(order_value) AS DOUBLE), 0.0) AS orders_per_day,
               COALESCE(CASE WHEN COUNT(delivery_time) > 0 THEN {he_k('SUM(delivery_time)', 'COUNT(delivery_time)')} END, 0) AS dt_k
        FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id)"""


@oracle("segment_rules")
def _segment_rules():
    spent = "((CAST(SUM(spent_c) AS DOUBLE) / 100.0) / COUNT(*))"
    freq = "(CAST(SUM(freq) AS DOUBLE) / COUNT(*))"
    aov = "((CAST(SUM(aov_k) AS DOUBLE) / 100.0) / COUNT(*))"
    return with_tx(CLV_BAND_SQL, F1K_SQL) + f"""
SELECT customer_segment, COUNT(*) AS size, {spent} AS avg_total_spent, {freq} AS avg_order_frequency,
       {aov} AS avg_order_value, round(AVG(orders_per_day), 6) AS avg_orders_per_day,
       ((CAST(SUM(dt_k) AS DOUBLE) / 100.0) / COUNT(*)) AS avg_delivery_time,
       CASE WHEN {spent} > 2000 AND {freq} > 15 THEN 'High-Value Frequent Customers'
            WHEN {spent} > 1000 AND {freq} > 10 THEN 'Medium-Value Regular Customers'
            WHEN {freq} > 20 THEN 'High-Frequency Low-Spend Customers'
            WHEN {aov} > 150 THEN 'High-Ticket Occasional Customers'
            ELSE 'Low-Value Infrequent Customers' END AS characteristics
FROM f1k JOIN clvb USING (customer_id) GROUP BY customer_segment"""


ORACLES["characteristic_sizes"] = f"""
SELECT characteristics, CAST(SUM(size) AS BIGINT) AS customers, COUNT(*) AS segments
FROM ({ORACLES["segment_rules"]}) GROUP BY characteristics"""

ORACLES["value_counts"] = with_tx(CLV_BAND_SQL) + f"""
SELECT customer_segment, COUNT(*) AS count, {hu('100 * COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct
FROM clvb GROUP BY customer_segment"""

ORACLES["spend_box_stats"] = with_tx(CLV_BAND_SQL, F1K_SQL, """
b AS (SELECT customer_segment, CAST(spent_c AS DOUBLE) / 100.0 AS v, spent_c FROM f1k JOIN clvb USING (customer_id)),
q AS (SELECT customer_segment, COUNT(*) AS count, MIN(v) AS min, MAX(v) AS max, SUM(spent_c) AS s,
             quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM b GROUP BY customer_segment)""") + """
SELECT q.customer_segment, q.count, q.min, q.max, q.q1, q.median, q.q3,
       (SELECT MIN(v) FROM b WHERE b.customer_segment = q.customer_segment AND v >= q.q1 - 1.5 * (q.q3 - q.q1)) AS whisker_low,
       (SELECT MAX(v) FROM b WHERE b.customer_segment = q.customer_segment AND v <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
       CAST(q.s AS DOUBLE) / 100.0 / q.count AS mean,
       CAST(SUM(q.s) OVER () AS DOUBLE) / 100.0 / SUM(q.count) OVER () AS overall_mean
FROM q"""


RULE_PRED_SQL = f"""
rk AS (SELECT restaurant_id, {he_k('SUM(delivery_time)', 'COUNT(delivery_time)')} AS mk
       FROM transactions WHERE restaurant_id IS NOT NULL AND delivery_time IS NOT NULL GROUP BY 1),
ck AS (SELECT city, {he_k('SUM(delivery_time)', 'COUNT(delivery_time)')} AS mk
       FROM transactions WHERE city IS NOT NULL AND delivery_time IS NOT NULL GROUP BY 1),
pred AS (SELECT t.order_id, t.delivery_time, COALESCE(rk.mk, ck.mk) AS pk
         FROM transactions t LEFT JOIN rk ON rk.restaurant_id = t.restaurant_id
         LEFT JOIN ck ON ck.city = t.city)"""


@oracle("regression_metrics")
def _regression_metrics():
    e = "(CAST(delivery_time AS HUGEINT) * 100 - pk)"
    return with_tx(RULE_PRED_SQL) + f"""
SELECT COUNT(*) AS rows, {hu(f'SUM(abs({e}))', 'COUNT(*) * 100', 4)} AS mae,
       round(sqrt(CAST(SUM({e} * {e}) AS DOUBLE) / 10000.0 / COUNT(*)), 4) AS rmse
FROM pred WHERE delivery_time IS NOT NULL AND pk IS NOT NULL"""


def _margin_sql() -> str:
    return f"CAST('{repr(1.96 * 5.0)}' AS DOUBLE)"


@oracle("prediction_interval")
def _prediction_interval():
    p = "greatest(CAST(pk AS DOUBLE) / 100.0, 10.0)"
    return with_tx(RULE_PRED_SQL) + f"""
SELECT order_id, {p} AS predicted_delivery_time,
       greatest({p} - {_margin_sql()}, 10.0) AS lower_bound, {p} + {_margin_sql()} AS upper_bound
FROM pred WHERE pk IS NOT NULL"""


@oracle("classification_metrics")
def _classification_metrics():
    def r(num, den):
        return f"COALESCE(CASE WHEN {den} > 0 THEN {hu(num, den, 3)} END, 0.0)"
    return with_tx(F3_SQL, """
c AS (SELECT COUNT(CASE WHEN churned AND days_since_last_order > 30 THEN 1 END) AS tp,
             COUNT(CASE WHEN NOT churned AND days_since_last_order > 30 THEN 1 END) AS fp,
             COUNT(CASE WHEN churned AND NOT (days_since_last_order > 30) THEN 1 END) AS fn,
             COUNT(CASE WHEN NOT churned AND NOT (days_since_last_order > 30) THEN 1 END) AS tn
      FROM f3)""") + f"""
SELECT tp, fp, fn, tn, {r('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {r('tp', 'tp + fp')} AS precision,
       {r('tp', 'tp + fn')} AS recall, {r('2 * tp', '2 * tp + fp + fn')} AS f1_score
FROM c"""


# ---------------------------------------------------------------- 2.14 stream (batch twin)
ORACLES["daily_kpis_events"] = """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end,
       COUNT(*) AS orders, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""


ORACLES["scoring_input_report"] = with_tx() + """
SELECT COUNT(*) AS rows, COUNT(*) - COUNT(restaurant_id) AS missing_restaurant_id,
       COUNT(*) AS missing_customer_location, COUNT(*) - COUNT(order_value) AS missing_order_value,
       COUNT(*) - COUNT(cuisine_type) AS missing_cuisine_type, COUNT(*) AS missing_peak_hour,
       COUNT(*) AS missing_weather_condition
FROM transactions"""

ORACLES["hourly_kpis_events"] = """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('hour', ts) + INTERVAL 1 HOUR AS TIMESTAMP) AS window_end,
       COUNT(*) AS orders, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""


# ---------------------------------------------------------------- the same numbers by another path
ORACLES["csv_round_trip"] = ORACLES["scan_transactions"]
ORACLES["stream_daily_kpis"] = ORACLES["daily_kpis_events"]
ORACLES["stream_hourly_kpis"] = ORACLES["hourly_kpis_events"]
ORACLES["weekly_trend_json"] = ORACLES["weekly_trend"]
ORACLES["executive_summary_json"] = ORACLES["executive_summary"]
ORACLES["retention_cohorts"] = _cohort("monthly", "city = 'ASIA'")
# the fixture has neither optional column: the default distance and no weather
ORACLES["delivery_features_full"] = ORACLES["delivery_features"].replace(
    "SELECT t.order_id,", "SELECT CAST(3.0 AS DOUBLE) AS estimated_distance_km, CAST(NULL AS VARCHAR) AS "
    "weather_condition, t.order_id,")
# exact class sizes: ceil(0.2 n) of each class are test rows
ORACLES["train_test_split"] = with_tx(F3_SQL, """
n AS (SELECT churned, COUNT(*) AS n, CAST(ceil(0.2 * COUNT(*)) AS BIGINT) AS t FROM f3 GROUP BY churned)""") + """
SELECT churned, is_test, customers FROM (
  SELECT churned, TRUE AS is_test, t AS customers FROM n UNION ALL SELECT churned, FALSE, n - t FROM n)
WHERE customers > 0"""
# a saved and loaded model scores every row as before
ORACLES["model_round_trip"] = with_tx(F1_SQL) + "SELECT COUNT(*) AS rows, COUNT(*) AS equal_rows FROM f1"
ORACLES["delivery_round_trip"] = with_tx() + "SELECT COUNT(*) AS rows, COUNT(*) AS equal_rows FROM transactions"
ORACLES["churn_round_trip"] = with_tx(F3_SQL) + "SELECT COUNT(*) AS rows, COUNT(*) AS equal_rows FROM f3"
# whatever the clusters, they hold every customer once
ORACLES["segment_totals"] = with_tx(F1_SQL) + """
SELECT COUNT(*) AS customers, CAST(SUM(total_spent) AS DOUBLE) AS total_spent, TRUE AS segments_in_range,
       CAST(COUNT(*) AS BIGINT) AS profiled_customers FROM f1"""
# day partials give the numbers of the full computation
for _key in ("kpi_cards", "daily_revenue", "city_performance"):
    ORACLES[f"{_key}_rollup"] = ORACLES[_key]
ORACLES["sketch_distinct_counts"] = with_tx() + f"""
SELECT city, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT restaurant_id) AS restaurants,
       COUNT(DISTINCT order_id) AS orders, TRUE AS customers_close, TRUE AS restaurants_close, TRUE AS orders_close
FROM transactions WHERE order_date >= {months_back(12)} GROUP BY city"""
ORACLES["sketch_new_customers"] = with_tx(f"""
p AS (SELECT city, customer_id, BOOL_OR(order_date >= {days_back(30)}) AS r, BOOL_OR(order_date < {days_back(30)}) AS b
      FROM transactions WHERE order_date >= {months_back(12)} AND customer_id IS NOT NULL GROUP BY 1, 2)""") + """
SELECT city, COUNT(CASE WHEN r THEN 1 END) AS customers, COUNT(CASE WHEN r AND NOT b THEN 1 END) AS new_customers,
       TRUE AS customers_close, TRUE AS new_customers_close
FROM p GROUP BY city"""
# every source row is in a window, late or a repeat
ORACLES["stream_reconciled"] = """
WITH e AS (SELECT *, ts <= (SELECT MAX(ts) - INTERVAL 1 HOUR FROM events WHERE event_type = 'purchase') AS old
           FROM events WHERE event_type = 'purchase'),
h AS (SELECT *, event_id % 50 = 1 AND old AS held FROM e)
SELECT COUNT(*) + COUNT(CASE WHEN NOT held AND event_id % 100 = 3 THEN 1 END)
         + COUNT(CASE WHEN NOT old AND event_id % 2 = 0 THEN 1 END) AS source_rows,
       COUNT(CASE WHEN NOT held THEN 1 END) AS window_rows,
       CAST(SUM(CASE WHEN NOT held THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS window_revenue,
       COUNT(CASE WHEN held THEN 1 END) AS late_rows,
       COUNT(CASE WHEN NOT held AND event_id % 100 = 3 THEN 1 END)
         + COUNT(CASE WHEN NOT old AND event_id % 2 = 0 THEN 1 END) AS repeated_rows,
       TRUE AS balanced
FROM h"""
ORACLES["segment_summary_totals"] = with_tx(F1_SQL.replace("WHERE customer_id IS NOT NULL", "WHERE customer_id IS NOT NULL AND city = 'ASIA'")) + """
SELECT COUNT(*) AS customers, COUNT(*) AS total_customers, TRUE AS segments_in_range FROM f1"""
ORACLES["choose_k_totals"] = with_tx() + "SELECT 9 AS ks, 1 AS chosen, COUNT(*) > 0 AS best_chosen FROM transactions"
ORACLES["delivery_grid_totals"] = with_tx() + "SELECT 54 AS points, 1 AS chosen, COUNT(*) > 0 AS least_chosen FROM transactions"
ORACLES["churn_score_totals"] = with_tx(F3_SQL) + "SELECT COUNT(*) AS customers, COUNT(*) AS in_range FROM f3"
