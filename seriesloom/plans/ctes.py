"""Common table expressions: the panels of ``inputs`` in SQL."""


from seriesloom.plans.inputs import TEST, VAL
from seriesloom.plans.registry import cte

cte(
    "moves",
    """
SELECT l.l_partkey AS partkey, CAST(l.l_shipdate AS DATE) AS date, l.l_quantity AS dispatched, 0.0::DOUBLE AS ordered
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
UNION ALL
SELECT l.l_partkey, CAST(o.o_orderdate AS DATE), 0.0::DOUBLE, l.l_quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""",
)
for name, key in (("daily", "p.p_brand"), ("daily_lumpy", "p.p_brand || '|' || p.p_type")):
    cte(
        name,
        f"""
SELECT {key} AS series, m.date, sum(m.dispatched) AS dispatched, sum(m.ordered) AS ordered
FROM moves m JOIN part p ON m.partkey = p.p_partkey GROUP BY 1, 2
""",
    )
cte(
    "cal_end",
    """
SELECT greatest((SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) AS day,
  least((SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem), (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)) AS first
""",
)
for name, column, step in (("cal_days", "date", "DAY"), ("cal_months", "month", "MONTH")):
    cte(
        name,
        f"""
SELECT CAST(unnest(range(CAST(date_trunc('{step.lower()}', first) AS TIMESTAMP), CAST(day AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 {step})) AS DATE) AS {column} FROM cal_end
""",
    )
for name, base in (("filled", "daily"), ("filled_lumpy", "daily_lumpy")):
    cte(
        name,
        f"""
SELECT s.series, c.date, coalesce(d.dispatched, 0.0) AS dispatched, coalesce(d.ordered, 0.0) AS ordered,
  CASE WHEN c.date < DATE '{VAL}' THEN 'train' WHEN c.date < DATE '{TEST}' THEN 'val' ELSE 'test' END AS split
FROM (SELECT DISTINCT series FROM {base}) s
CROSS JOIN cal_days c LEFT JOIN {base} d ON d.series = s.series AND d.date = c.date
""",
    )
for name, base in (("monthly", "daily"), ("monthly_lumpy", "daily_lumpy")):
    cte(
        name,
        f"""
SELECT s.series, c.month, coalesce(d.dispatched, 0.0) AS dispatched, coalesce(d.ordered, 0.0) AS ordered
FROM (SELECT DISTINCT series FROM {base}) s
CROSS JOIN cal_months c LEFT JOIN (
  SELECT series, CAST(date_trunc('month', date) AS DATE) AS month, sum(dispatched) AS dispatched, sum(ordered) AS ordered
  FROM {base} GROUP BY 1, 2) d ON d.series = s.series AND d.month = c.month
""",
    )
cte(
    "monthly_split",
    """
SELECT *, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY month DESC) <= 12 THEN 'test' ELSE 'train' END AS split
FROM monthly
""",
)
cte(
    "ext_orders",
    """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(count(*) AS DOUBLE) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS value,
  CAST(count(DISTINCT o_custkey) AS DOUBLE) AS customers,
  avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS urgent
FROM orders GROUP BY 1
""",
)
cte(
    "ext_lines",
    """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (CAST(1 AS DECIMAL(3, 2)) - CAST(l_discount AS DECIMAL(5, 2)))) AS DOUBLE) AS net,
  CAST(sum(CAST(l_discount AS DECIMAL(5, 2))) AS DOUBLE) / count(*) AS discount
FROM lineitem GROUP BY 1
""",
)
cte(
    "ext",
    """
SELECT o.month, n AS ECG_DESP, value / n AS TUAV, net AS PIB_CO, value AS ISE_CO, customers AS VTOTAL_19,
  urgent AS OTOTAL_19, discount AS ICI
FROM ext_orders o LEFT JOIN ext_lines l ON o.month = l.month
""",
)
cte(
    "ext_split",
    f"""
SELECT *, CASE WHEN month < DATE '{VAL}' THEN 'train' WHEN month < DATE '{TEST}' THEN 'val' ELSE 'test' END AS split FROM ext
""",
)
cte(
    "parts_monthly",
    """
SELECT CAST(p.p_partkey AS VARCHAR) AS series, p.p_name AS series_name, CAST(date_trunc('month', m.date) AS DATE) AS month,
  sum(m.dispatched) AS dispatched, sum(m.ordered) AS ordered
FROM moves m JOIN part p ON m.partkey = p.p_partkey WHERE m.date >= DATE '1998-01-01' GROUP BY 1, 2, 3
""",
)
_SENS = ",\n  ".join(
    f"""coalesce(covar_samp(dispatched, {c}) / nullif(stddev_samp(CASE WHEN {c} IS NOT NULL THEN dispatched END)
    * stddev_samp({c}), 0), 0.0) AS sens_{c}"""
    for c in ("PIB_CO", "ICI", "ECG_DESP", "ISE_CO")
)
cte(
    "profiles",
    f"""
SELECT * FROM (SELECT series, min(series_name) AS series_name, avg(dispatched) AS avg_monthly_demand,
  stddev_samp(dispatched) AS demand_std, stddev_samp(dispatched) / (avg(dispatched) + 1e-6) AS demand_cv,
  sum(dispatched) / (sum(ordered) + 1e-6) AS order_fulfillment,
  {_SENS}
FROM parts_monthly p LEFT JOIN ext e ON p.month = e.month GROUP BY series) WHERE demand_std IS NOT NULL
""",
)
cte(
    "labelled",
    """
SELECT p.*, CASE WHEN avg_monthly_demand < m - s / 2 THEN 0 WHEN avg_monthly_demand < m + s / 2 THEN 1 ELSE 2 END AS cluster
FROM profiles p, (SELECT avg(avg_monthly_demand) AS m, stddev_samp(avg_monthly_demand) AS s FROM profiles)
""",
)
cte(
    "naive_daily",
    f"""
SELECT series, date, dispatched AS actual, lag(dispatched) OVER (PARTITION BY series ORDER BY date) AS predicted
FROM daily_lumpy WHERE date >= DATE '{TEST}'
""",
)
cte(
    "naive_pairs",
    """
SELECT series, 'daily' AS grain, date, actual, predicted FROM naive_daily
UNION ALL SELECT series, 'weekly', CAST(date_trunc('week', date) AS DATE) + 6, sum(actual), coalesce(sum(predicted), 0.0) FROM naive_daily GROUP BY 1, 3
UNION ALL SELECT series, 'monthly', last_day(date), sum(actual), coalesce(sum(predicted), 0.0) FROM naive_daily GROUP BY 1, 3
""",
)
SCORE = """count(*) AS n, sqrt(avg((actual - predicted) ** 2)) AS rmse, avg(abs(actual - predicted)) AS mae,
  avg(CASE WHEN actual <> 0 THEN abs((actual - predicted) / nullif(actual, 0)) END) * 100 AS mape,
  (covar_samp(actual, predicted) / nullif(stddev_samp(actual) * stddev_samp(predicted), 0)) ** 2 AS r2"""
cte(
    "naive_scores",
    f"SELECT series, grain, {SCORE}\nFROM naive_pairs WHERE predicted IS NOT NULL GROUP BY 1, 2",
)
cte(
    "scores_long",
    """
SELECT series, grain, metric, value FROM naive_scores
UNPIVOT INCLUDE NULLS (value FOR metric IN (rmse, mae, mape, r2))
""",
)
cte(
    "scores_labelled",
    """
SELECT s.*, st.cv, st.sparsity, CASE WHEN cv <= 0.45 THEN 0 WHEN cv <= 0.6 THEN 1 ELSE 2 END AS cluster
FROM naive_scores s JOIN (SELECT series, stddev_samp(ordered) / nullif(avg(ordered), 0) AS cv,
  avg(CASE WHEN ordered = 0 THEN 1.0 ELSE 0.0 END) AS sparsity FROM monthly_lumpy GROUP BY 1) st ON s.series = st.series
WHERE s.grain = 'monthly'
""",
)
