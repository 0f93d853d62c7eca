"""DuckDB SQL oracles for the registered queries (same column names).

The logical tables are CTEs over the driver's views, written independently
of the Spark code from the mapping in FIXTURES.md §3.  Doubles are rounded
to 6 decimals, as the Spark side does.
"""

from __future__ import annotations

CTE = {}

CTE["retail"] = """
retail AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS InvoiceNo,
         CAST(l.l_partkey AS VARCHAR) AS StockCode,
         p.p_name AS Description,
         CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN -l.l_quantity
                   ELSE l.l_quantity END AS BIGINT) AS Quantity,
         l.l_shipdate AS InvoiceDate,
         floor(l.l_extendedprice / l.l_quantity * 100 + 0.5) / 100 AS UnitPrice,
         CASE WHEN o.o_custkey % 10 = 0 THEN NULL ELSE o.o_custkey END AS CustomerID,
         n.n_name AS Country
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

# preprocessed: positive price, dedup on all columns but InvoiceNo (first invoice)
CTE["pre"] = """
pre0 AS (
  SELECT min(InvoiceNo) AS InvoiceNo, StockCode, Description, Quantity, InvoiceDate,
         UnitPrice, CustomerID, Country
  FROM retail WHERE UnitPrice > 0
  GROUP BY StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
),
pre AS (
  SELECT *, ln(1 + greatest(Quantity, 0)) AS log_Quantity,
         ln(1 + greatest(UnitPrice, 1e-6)) AS log_UnitPrice,
         Quantity * UnitPrice AS TotalSum,
         ln(1 + greatest(greatest(Quantity, 0) * greatest(UnitPrice, 1e-6), 0)) AS log_TotalSum,
         CAST(hour(InvoiceDate) AS INTEGER) AS TransactionHour, CAST(dayofyear(InvoiceDate) AS INTEGER) AS DayOfYear
  FROM pre0
)"""

CTE["rfm_in"] = """
rfm_base AS (
  SELECT * FROM pre WHERE CustomerID IS NOT NULL AND Quantity > 0 AND UnitPrice > 0
),
rfm_bounds AS (
  SELECT quantile_cont(Quantity, 0.01) AS qlo, quantile_cont(Quantity, 0.99) AS qhi,
         quantile_cont(UnitPrice, 0.01) AS plo, quantile_cont(UnitPrice, 0.99) AS phi
  FROM rfm_base
),
rfm_in AS (
  SELECT b.* FROM rfm_base b, rfm_bounds q
  WHERE b.Quantity >= q.qlo AND b.Quantity <= q.qhi AND b.UnitPrice >= q.plo AND b.UnitPrice <= q.phi
)"""

CTE["rfm"] = """
rfm AS (
  SELECT CustomerID,
         CAST(floor((epoch((SELECT max(InvoiceDate) FROM rfm_in) + INTERVAL 1 DAY)
                     - epoch(max(InvoiceDate))) / 86400) AS BIGINT) AS Recency,
         count(DISTINCT InvoiceNo) AS Frequency,
         sum(Quantity * UnitPrice) AS Monetary
  FROM rfm_in GROUP BY CustomerID
)"""

CTE["seg"] = """
seg_cuts AS (
  SELECT quantile_cont(Monetary, 1/3) AS c1, quantile_cont(Monetary, 2/3) AS c2 FROM rfm
),
seg AS (
  SELECT r.*, CASE WHEN Monetary <= c1 THEN 0 WHEN Monetary <= c2 THEN 1 ELSE 2 END AS RFM_Cluster
  FROM rfm r, seg_cuts
)"""

CTE["series"] = """
series AS (
  SELECT InvoiceDate, StockCode, CAST(sum(Quantity) AS BIGINT) AS Quantity_Agg
  FROM pre WHERE Quantity > 0 AND UnitPrice > 0 GROUP BY InvoiceDate, StockCode
)"""

CTE["feat"] = """
sb AS (SELECT quantile_cont(Quantity_Agg, 0.01) AS lo, quantile_cont(Quantity_Agg, 0.99) AS hi FROM series),
f1 AS (
  SELECT s.InvoiceDate, s.StockCode, s.Quantity_Agg, sb.lo, sb.hi,
    lag(Quantity_Agg, 1) OVER w AS p1, lag(Quantity_Agg, 7) OVER w AS p7,
    lag(Quantity_Agg, 14) OVER w AS p14, lag(Quantity_Agg, 30) OVER w AS p30,
    lag(Quantity_Agg, 60) OVER w AS p60,
    avg(Quantity_Agg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
    avg(Quantity_Agg) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS m14,
    avg(Quantity_Agg) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30,
    avg(Quantity_Agg) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS m60,
    coalesce(stddev_samp(Quantity_Agg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 1) AS s7,
    coalesce(stddev_samp(Quantity_Agg) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW), 1) AS s14,
    coalesce(stddev_samp(Quantity_Agg) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 1) AS s30,
    coalesce(stddev_samp(Quantity_Agg) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW), 1) AS s60,
    CAST(max(Quantity_Agg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
       - min(Quantity_Agg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS r7,
    CAST(max(Quantity_Agg) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
       - min(Quantity_Agg) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS DOUBLE) AS r14,
    CAST(max(Quantity_Agg) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
       - min(Quantity_Agg) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) AS r30,
    CAST(max(Quantity_Agg) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)
       - min(Quantity_Agg) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS DOUBLE) AS r60
  FROM series s, sb
  WINDOW w AS (PARTITION BY StockCode ORDER BY InvoiceDate)
),
f2 AS (
  SELECT *,
    coalesce(CASE WHEN p1 IS NOT NULL THEN least(greatest(p1, lo), hi) END, 0) AS Lag_1,
    coalesce(CASE WHEN p7 IS NOT NULL THEN least(greatest(p7, lo), hi) END, 0) AS Lag_7,
    coalesce(CASE WHEN p14 IS NOT NULL THEN least(greatest(p14, lo), hi) END, 0) AS Lag_14,
    coalesce(CASE WHEN p30 IS NOT NULL THEN least(greatest(p30, lo), hi) END, 0) AS Lag_30,
    coalesce(CASE WHEN p60 IS NOT NULL THEN least(greatest(p60, lo), hi) END, 0) AS Lag_60,
    m7 / CASE WHEN s7 = 0 THEN 1e-9 ELSE s7 END AS n7,
    m14 / CASE WHEN s14 = 0 THEN 1e-9 ELSE s14 END AS n14,
    m30 / CASE WHEN s30 = 0 THEN 1e-9 ELSE s30 END AS n30,
    m60 / CASE WHEN s60 = 0 THEN 1e-9 ELSE s60 END AS n60
  FROM f1
),
fb AS (
  SELECT quantile_cont(n7, 0.01) AS n7lo, quantile_cont(n7, 0.99) AS n7hi,
         quantile_cont(n14, 0.01) AS n14lo, quantile_cont(n14, 0.99) AS n14hi,
         quantile_cont(n30, 0.01) AS n30lo, quantile_cont(n30, 0.99) AS n30hi,
         quantile_cont(n60, 0.01) AS n60lo, quantile_cont(n60, 0.99) AS n60hi,
         quantile_cont(r7, 0.01) AS r7lo, quantile_cont(r7, 0.99) AS r7hi,
         quantile_cont(r14, 0.01) AS r14lo, quantile_cont(r14, 0.99) AS r14hi,
         quantile_cont(r30, 0.01) AS r30lo, quantile_cont(r30, 0.99) AS r30hi,
         quantile_cont(r60, 0.01) AS r60lo, quantile_cont(r60, 0.99) AS r60hi
  FROM f2
),
feat AS (
  SELECT InvoiceDate, StockCode, Quantity_Agg, Lag_1, Lag_7, Lag_14, Lag_30, Lag_60,
    least(greatest(n7, n7lo), n7hi) AS RollingNormMean_7,
    least(greatest(n14, n14lo), n14hi) AS RollingNormMean_14,
    least(greatest(n30, n30lo), n30hi) AS RollingNormMean_30,
    least(greatest(n60, n60lo), n60hi) AS RollingNormMean_60,
    least(greatest(r7, r7lo), r7hi) AS RollingRange_7,
    least(greatest(r14, r14lo), r14hi) AS RollingRange_14,
    least(greatest(r30, r30lo), r30hi) AS RollingRange_30,
    least(greatest(r60, r60lo), r60hi) AS RollingRange_60,
    least(greatest(coalesce(Quantity_Agg / p7 - 1, 0), -1), 1) AS RollingPctChange_7,
    least(greatest(coalesce(Quantity_Agg / p14 - 1, 0), -1), 1) AS RollingPctChange_14,
    least(greatest(coalesce(Quantity_Agg / p30 - 1, 0), -1), 1) AS RollingPctChange_30,
    least(greatest(coalesce(Quantity_Agg / p60 - 1, 0), -1), 1) AS RollingPctChange_60,
    least(greatest(coalesce((Lag_1 - Lag_7) / nullif(Lag_7, 0), 0), -1), 1) AS PctChange_7,
    least(greatest(coalesce((Lag_1 - Lag_14) / nullif(Lag_14, 0), 0), -1), 1) AS PctChange_14,
    least(greatest(coalesce((Lag_1 - Lag_30) / nullif(Lag_30, 0), 0), -1), 1) AS PctChange_30,
    least(greatest(coalesce((Lag_1 - Lag_60) / nullif(Lag_60, 0), 0), -1), 1) AS PctChange_60
  FROM f2, fb
)"""

CTE["simple"] = """
sclean AS (
  SELECT * FROM pre WHERE Quantity BETWEEN 1 AND 999 AND UnitPrice BETWEEN 0.01 AND 9999
),
sser AS (SELECT InvoiceDate, StockCode, CAST(sum(Quantity) AS BIGINT) AS Quantity_Agg FROM sclean GROUP BY 1, 2),
ssb AS (SELECT quantile_cont(Quantity_Agg, 0.01) AS lo, quantile_cont(Quantity_Agg, 0.99) AS hi FROM sser),
sf1 AS (
  SELECT s.InvoiceDate, s.StockCode, lo, hi,
    lag(Quantity_Agg, 1) OVER w AS p1, lag(Quantity_Agg, 7) OVER w AS p7,
    lag(Quantity_Agg, 30) OVER w AS p30,
    avg(Quantity_Agg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
    avg(Quantity_Agg) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30,
    coalesce(stddev_samp(Quantity_Agg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 1) AS s7,
    coalesce(stddev_samp(Quantity_Agg) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 1) AS s30,
    CAST(max(Quantity_Agg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
       - min(Quantity_Agg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS r7,
    CAST(max(Quantity_Agg) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
       - min(Quantity_Agg) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) AS r30
  FROM sser s, ssb
  WINDOW w AS (PARTITION BY StockCode ORDER BY InvoiceDate)
),
sf2 AS (
  SELECT *,
    coalesce(CASE WHEN p1 IS NOT NULL THEN least(greatest(p1, lo), hi) END, 0) AS Lag_1,
    coalesce(CASE WHEN p7 IS NOT NULL THEN least(greatest(p7, lo), hi) END, 0) AS Lag_7,
    coalesce(CASE WHEN p30 IS NOT NULL THEN least(greatest(p30, lo), hi) END, 0) AS Lag_30
  FROM sf1
),
simple AS (
  SELECT InvoiceDate, StockCode, Lag_1, Lag_7, Lag_30,
    least(greatest(CASE WHEN s7 = 0 THEN hi ELSE m7 / s7 END, lo), hi) AS RollingNormMean_7,
    least(greatest(CASE WHEN s30 = 0 THEN hi ELSE m30 / s30 END, lo), hi) AS RollingNormMean_30,
    least(greatest(r7, 0), hi) AS RollingRange_7,
    least(greatest(r30, 0), hi) AS RollingRange_30,
    least(greatest(coalesce((Lag_1 - Lag_7) / nullif(Lag_7, 0), 0), -1), 1) AS PctChange_7,
    least(greatest(coalesce((Lag_1 - Lag_30) / nullif(Lag_30, 0), 0), -1), 1) AS PctChange_30
  FROM sf2
)"""

# dependency order of the CTEs
_DEPS = {
    "retail": [], "pre": ["retail"], "rfm_in": ["pre"], "rfm": ["rfm_in"], "seg": ["rfm"],
    "series": ["pre"], "feat": ["series"], "simple": ["pre"],
}


def _with(*names) -> str:
    order = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTE[n].strip() for n in order) + "\n"


def r6(*cols) -> str:
    """Select-list fragment rounding the given columns to 6 decimals."""
    return ", ".join(f"round({c}, 6) AS {c.split('.')[-1]}" for c in cols)


SQL: dict = {}

SQL["retail_clean"] = _with("retail") + f"""
SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, {r6('UnitPrice')}, CustomerID, Country
FROM retail WHERE UnitPrice > 0"""

SQL["retail_dedup"] = _with("retail") + f"""
, both_ AS (SELECT * FROM retail UNION ALL SELECT * REPLACE (InvoiceNo || 'C' AS InvoiceNo) FROM retail)
SELECT min(InvoiceNo) AS InvoiceNo, StockCode, Description, Quantity, InvoiceDate, {r6('UnitPrice')},
       CustomerID, Country
FROM both_ GROUP BY StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"""

SQL["log_features"] = _with("pre") + f"""
SELECT InvoiceNo, StockCode, Quantity, {r6('UnitPrice', 'log_Quantity', 'log_UnitPrice', 'TotalSum',
                                           'log_TotalSum')}
FROM pre"""

_CAL = """
  CAST(hour(InvoiceDate) AS INTEGER) AS TransactionHour, CAST(dayofyear(InvoiceDate) AS INTEGER) AS DayOfYear,
  CAST(year(InvoiceDate) AS INTEGER) AS Year, CAST(month(InvoiceDate) AS INTEGER) AS Month,
  CAST(isodow(InvoiceDate) AS INTEGER) AS Weekday,
  CAST(isodow(InvoiceDate) IN (6, 7) AS INTEGER) AS IsWeekend,
  CAST(month(InvoiceDate) IN (11, 12) AS INTEGER) AS HolidaySeason,
  CAST(day(InvoiceDate) = 1 AS INTEGER) AS IsStartOfMonth,
  CAST(CAST(InvoiceDate AS DATE) = last_day(InvoiceDate) AS INTEGER) AS IsEndOfMonth,
  (month(InvoiceDate) = 11 AND day(InvoiceDate) BETWEEN 23 AND 29 AND isodow(InvoiceDate) = 5) AS BlackFriday"""

SQL["calendar_features"] = _with("retail") + f"""
SELECT InvoiceNo, StockCode, InvoiceDate, {_CAL} FROM retail"""

SQL["cyclic_features"] = _with("retail") + """
, c AS (SELECT InvoiceNo, StockCode, CAST(month(InvoiceDate) AS INTEGER) AS Month, CAST(isodow(InvoiceDate) AS INTEGER) AS Weekday FROM retail)
SELECT InvoiceNo, StockCode, Month, Weekday,
  round(sin(2 * pi() * Month / 12.0), 6) AS Month_sin, round(cos(2 * pi() * Month / 12.0), 6) AS Month_cos,
  round(sin(2 * pi() * Weekday / 7.0), 6) AS Weekday_sin, round(cos(2 * pi() * Weekday / 7.0), 6) AS Weekday_cos
FROM c"""

SQL["popular_items"] = _with("pre") + """
, top AS (SELECT StockCode FROM pre GROUP BY StockCode ORDER BY count(*) DESC, StockCode LIMIT 10)
SELECT InvoiceNo, p.StockCode, CAST(CASE WHEN t.StockCode IS NULL THEN 0 ELSE 1 END AS INTEGER) AS IsPopularItem
FROM pre p LEFT JOIN top t ON p.StockCode = t.StockCode"""

SQL["discount_flag"] = _with("pre") + """
, med AS (SELECT StockCode, quantile_cont(UnitPrice, 0.5) AS m FROM pre GROUP BY StockCode)
SELECT InvoiceNo, p.StockCode, round(UnitPrice, 6) AS UnitPrice,
       CAST(coalesce(UnitPrice < m, false) AS INTEGER) AS IsDiscounted
FROM pre p LEFT JOIN med USING (StockCode)"""

SQL["value_counts_share"] = _with("pre") + """
SELECT Country, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM pre WHERE Country IS NOT NULL GROUP BY Country"""

SQL["exploration_report"] = _with("pre") + """
, mm AS (SELECT CAST(min(Quantity) AS DOUBLE) AS lo, CAST(max(Quantity) AS DOUBLE) AS hi FROM pre),
binned AS (
  SELECT Quantity, CAST(CASE WHEN hi - lo = 0 THEN 1
           ELSE least(floor((CAST(Quantity AS DOUBLE) - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin
  FROM pre, mm WHERE Quantity IS NOT NULL),
products AS (
  SELECT Description, count(*) AS n, CAST(sum(Quantity) AS BIGINT) AS total, avg(Quantity) AS mean FROM pre
  GROUP BY Description ORDER BY total DESC, Description NULLS LAST LIMIT 10)
SELECT 'all' AS section, NULL::VARCHAR AS item, count(*) AS n, CAST(sum(Quantity) AS BIGINT) AS total,
       round(avg(Quantity), 6) AS mean FROM pre
UNION ALL SELECT 'country', Country, count(*), CAST(sum(Quantity) AS BIGINT), round(avg(Quantity), 6) FROM pre GROUP BY Country
UNION ALL SELECT 'month', CAST(month(InvoiceDate) AS VARCHAR), count(*), CAST(sum(Quantity) AS BIGINT),
       round(avg(Quantity), 6) FROM pre GROUP BY month(InvoiceDate)
UNION ALL SELECT 'weekday', CAST(isodow(InvoiceDate) AS VARCHAR), count(*), CAST(sum(Quantity) AS BIGINT),
       round(avg(Quantity), 6) FROM pre GROUP BY isodow(InvoiceDate)
UNION ALL SELECT 'product', Description, n, total, round(mean, 6) FROM products
UNION ALL SELECT 'quantity', CAST(bin AS VARCHAR), count(*), CAST(sum(Quantity) AS BIGINT), round(avg(Quantity), 6)
FROM binned GROUP BY bin"""

SQL["distinct_by_month"] = _with("pre") + """
SELECT strftime(InvoiceDate, '%Y-%m') AS month, count(DISTINCT CustomerID) AS CustomerID,
       count(DISTINCT StockCode) AS StockCode, count(DISTINCT InvoiceNo) AS InvoiceNo,
       true AS CustomerID_near, true AS StockCode_near, true AS InvoiceNo_near
FROM pre GROUP BY 1"""

SQL["monthly_mean_demand"] = _with("pre") + """
SELECT CAST(month(InvoiceDate) AS INTEGER) AS Month, round(avg(Quantity), 6) AS mean_quantity FROM pre GROUP BY 1"""

SQL["monthly_period_demand"] = _with("pre") + """
SELECT date_trunc('month', InvoiceDate) AS month, round(avg(Quantity), 6) AS mean_quantity
FROM pre GROUP BY 1"""

SQL["weekday_mean_demand"] = _with("pre") + """
, a AS (SELECT CAST(isodow(InvoiceDate) AS INTEGER) AS day_no, avg(Quantity) AS m FROM pre GROUP BY 1),
d AS (SELECT * FROM (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'),
                            (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) t(day_no, weekday))
SELECT d.day_no, d.weekday, round(a.m, 6) AS mean_quantity FROM d LEFT JOIN a USING (day_no)"""

SQL["top_products"] = _with("pre") + """
SELECT Description, CAST(sum(Quantity) AS BIGINT) AS total_quantity FROM pre GROUP BY Description
ORDER BY total_quantity DESC, Description NULLS LAST LIMIT 10"""

SQL["quantile_band"] = _with("rfm_in") + """
SELECT InvoiceNo, StockCode, CustomerID, Quantity, round(UnitPrice, 6) AS UnitPrice FROM rfm_in"""

SQL["null_audit"] = _with("retail") + """
SELECT column_name, null_count FROM (
  SELECT 'InvoiceNo' AS column_name, count(*) FILTER (WHERE InvoiceNo IS NULL) AS null_count, 1 AS o FROM retail
  UNION ALL SELECT 'StockCode', count(*) FILTER (WHERE StockCode IS NULL), 2 FROM retail
  UNION ALL SELECT 'Description', count(*) FILTER (WHERE Description IS NULL), 3 FROM retail
  UNION ALL SELECT 'Quantity', count(*) FILTER (WHERE Quantity IS NULL), 4 FROM retail
  UNION ALL SELECT 'InvoiceDate', count(*) FILTER (WHERE InvoiceDate IS NULL), 5 FROM retail
  UNION ALL SELECT 'UnitPrice', count(*) FILTER (WHERE UnitPrice IS NULL OR isnan(UnitPrice)), 6 FROM retail
  UNION ALL SELECT 'CustomerID', count(*) FILTER (WHERE CustomerID IS NULL), 7 FROM retail
  UNION ALL SELECT 'Country', count(*) FILTER (WHERE Country IS NULL), 8 FROM retail
) ORDER BY o"""

SQL["duplicate_audit"] = _with("retail") + """
, g AS (SELECT count(*) AS n FROM retail
        GROUP BY StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS n_in_dup_groups,
       CAST(sum(n - 1) AS BIGINT) AS n_later_dups, round(coalesce(sum(n - 1) * 100.0 / sum(n), 0), 6) AS pct_later_dups
FROM g"""

_PROF = """
SELECT '{c}' AS column_name, round(CAST(count({c}) AS DOUBLE), 6) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(CAST(max({c}) AS DOUBLE), 6) AS max
FROM pre"""
SQL["profile_summary"] = _with("pre") + "\nUNION ALL\n".join(
    _PROF.format(c=c) for c in ("Quantity", "UnitPrice", "log_Quantity", "log_TotalSum"))

SQL["histogram_quantity"] = _with("pre") + """
, mm AS (SELECT CAST(min(Quantity) AS DOUBLE) AS lo, CAST(max(Quantity) AS DOUBLE) AS hi FROM pre),
b AS (
  SELECT CAST(CASE WHEN hi - lo = 0 THEN 1
              ELSE least(floor((CAST(Quantity AS DOUBLE) - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin,
         lo, hi
  FROM pre, mm WHERE Quantity IS NOT NULL
)
SELECT bin, round(lo + (bin - 1) * (hi - lo) / 50, 6) AS bin_start, count(*) AS count
FROM b GROUP BY bin, lo, hi"""

SQL["rfm_table"] = _with("rfm") + """
SELECT CustomerID, Recency, Frequency, round(Monetary, 6) AS Monetary FROM rfm"""

SQL["rfm_scaled"] = _with("rfm") + """
, st AS (SELECT avg(Recency) AS mr, CASE WHEN stddev_pop(Recency) = 0 THEN 1 ELSE stddev_pop(Recency) END AS sr,
                avg(Frequency) AS mf, CASE WHEN stddev_pop(Frequency) = 0 THEN 1 ELSE stddev_pop(Frequency) END AS sf,
                avg(Monetary) AS mm, CASE WHEN stddev_pop(Monetary) = 0 THEN 1 ELSE stddev_pop(Monetary) END AS sm
         FROM rfm)
SELECT CustomerID, round((Recency - mr) / sr, 6) AS Recency_scaled,
       round((Frequency - mf) / sf, 6) AS Frequency_scaled, round((Monetary - mm) / sm, 6) AS Monetary_scaled
FROM rfm, st"""

SQL["rfm_segment_profile"] = _with("seg") + """
SELECT RFM_Cluster, count(CustomerID) AS Customers, round(avg(Recency), 6) AS Recency_Mean,
       round(avg(Frequency), 6) AS Frequency_Mean, round(avg(Monetary), 6) AS Monetary_Mean
FROM seg GROUP BY RFM_Cluster"""

SQL["pivot_month_segment"] = _with("pre", "seg") + """
, j AS (SELECT CAST(month(p.InvoiceDate) AS INTEGER) AS Month, s.RFM_Cluster FROM pre p JOIN seg s USING (CustomerID))
SELECT Month, count(*) FILTER (WHERE RFM_Cluster = 0) AS seg_0, count(*) FILTER (WHERE RFM_Cluster = 1) AS seg_1,
       count(*) FILTER (WHERE RFM_Cluster = 2) AS seg_2
FROM j GROUP BY Month"""

SQL["demand_series"] = _with("series") + "SELECT * FROM series"

SQL["demand_lags"] = _with("feat") + """
SELECT InvoiceDate, StockCode, round(Lag_1, 6) AS Lag_1, round(Lag_7, 6) AS Lag_7, round(Lag_14, 6) AS Lag_14,
       round(Lag_30, 6) AS Lag_30, round(Lag_60, 6) AS Lag_60 FROM feat"""

SQL["rolling_norm_mean"] = _with("feat") + f"""
SELECT InvoiceDate, StockCode, {r6('RollingNormMean_7', 'RollingNormMean_14', 'RollingNormMean_30',
                                   'RollingNormMean_60')} FROM feat"""

SQL["rolling_norm_mean_simple"] = _with("simple") + f"""
SELECT InvoiceDate, StockCode, {r6('Lag_1', 'Lag_7', 'Lag_30', 'RollingNormMean_7', 'RollingNormMean_30',
                                   'RollingRange_7', 'RollingRange_30', 'PctChange_7', 'PctChange_30')}
FROM simple"""

SQL["demand_simple_joined"] = _with("pre", "simple") + f"""
SELECT p.InvoiceNo, p.StockCode, p.InvoiceDate, p.Quantity,
  {r6('s.Lag_1', 's.Lag_30', 's.RollingNormMean_7', 's.RollingRange_30', 's.PctChange_7')}
FROM pre p LEFT JOIN simple s ON p.InvoiceDate = s.InvoiceDate AND p.StockCode = s.StockCode
WHERE p.Quantity BETWEEN 1 AND 999 AND p.UnitPrice BETWEEN 0.01 AND 9999"""

SQL["rfm_with_returns"] = _with("pre") + """
, c AS (SELECT * FROM pre WHERE CustomerID IS NOT NULL)
SELECT CustomerID, CAST(floor((epoch((SELECT max(InvoiceDate) FROM c) + INTERVAL 1 DAY) - epoch(max(InvoiceDate))) / 86400)
         AS BIGINT) AS Recency,
       count(DISTINCT InvoiceNo) AS Frequency, round(sum(Quantity * UnitPrice), 6) AS Monetary
FROM c GROUP BY CustomerID"""

SQL["rolling_range"] = _with("feat") + f"""
SELECT InvoiceDate, StockCode, {r6('RollingRange_7', 'RollingRange_14', 'RollingRange_30', 'RollingRange_60')}
FROM feat"""

SQL["rolling_pct_change"] = _with("feat") + f"""
SELECT InvoiceDate, StockCode, {r6('RollingPctChange_7', 'RollingPctChange_14', 'RollingPctChange_30',
                                   'RollingPctChange_60')} FROM feat"""

SQL["lag_pct_change"] = _with("feat") + f"""
SELECT InvoiceDate, StockCode, {r6('PctChange_7', 'PctChange_14', 'PctChange_30', 'PctChange_60')} FROM feat"""

SQL["demand_features_joined"] = _with("pre", "feat") + f"""
SELECT p.InvoiceNo, p.StockCode, p.InvoiceDate, p.Quantity,
  {r6('f.Lag_1', 'f.Lag_60', 'f.RollingNormMean_7', 'f.RollingRange_60', 'f.RollingPctChange_14',
      'f.PctChange_30')}
FROM pre p LEFT JOIN feat f ON p.InvoiceDate = f.InvoiceDate AND p.StockCode = f.StockCode"""


# --- final feature table (rule segments) ------------------------------------------------

FEATURE_COLS = (["Lag_1", "Lag_7", "Lag_14", "Lag_30", "Lag_60"]
                + [f"RollingNormMean_{n}" for n in (7, 14, 30, 60)]
                + [f"RollingRange_{n}" for n in (7, 14, 30, 60)]
                + [f"RollingPctChange_{n}" for n in (7, 14, 30, 60)]
                + [f"PctChange_{n}" for n in (7, 14, 30, 60)])
FINAL_COLS = (["InvoiceNo", "StockCode", "Description", "InvoiceDate", "CustomerID", "Country",
               "log_Quantity", "log_UnitPrice", "log_TotalSum", "TransactionHour", "DayOfYear",
               "Year", "Month", "Weekday", "IsWeekend", "HolidaySeason", "IsStartOfMonth",
               "IsEndOfMonth", "BlackFriday", "Month_sin", "Month_cos", "Weekday_sin", "Weekday_cos",
               "IsPopularItem", "IsDiscounted", "RFM_Cluster"] + FEATURE_COLS)
CORR_CANDIDATES = ["CustomerID", "log_UnitPrice", "log_TotalSum", "TransactionHour", "DayOfYear",
                   "Year", "Month", "Weekday", "IsWeekend", "IsStartOfMonth", "IsEndOfMonth",
                   "Month_sin", "Month_cos", "Weekday_sin", "Weekday_cos"] + FEATURE_COLS
ORDER_KEYS = "InvoiceDate, InvoiceNo, StockCode, log_Quantity, log_UnitPrice"

CTE["final"] = f"""
top10 AS (SELECT StockCode FROM pre GROUP BY StockCode ORDER BY count(*) DESC, StockCode LIMIT 10),
med AS (SELECT StockCode, quantile_cont(UnitPrice, 0.5) AS m FROM pre GROUP BY StockCode),
tf AS (
  SELECT p.*, CAST(year(InvoiceDate) AS INTEGER) AS Year, CAST(month(InvoiceDate) AS INTEGER) AS Month,
    CAST(isodow(InvoiceDate) AS INTEGER) AS Weekday,
    CAST(isodow(InvoiceDate) IN (6, 7) AS INTEGER) AS IsWeekend,
    CAST(month(InvoiceDate) IN (11, 12) AS INTEGER) AS HolidaySeason,
    CAST(day(InvoiceDate) = 1 AS INTEGER) AS IsStartOfMonth,
    CAST(CAST(InvoiceDate AS DATE) = last_day(InvoiceDate) AS INTEGER) AS IsEndOfMonth,
    (month(InvoiceDate) = 11 AND day(InvoiceDate) BETWEEN 23 AND 29 AND isodow(InvoiceDate) = 5) AS BlackFriday,
    sin(2 * pi() * month(InvoiceDate) / 12.0) AS Month_sin, cos(2 * pi() * month(InvoiceDate) / 12.0) AS Month_cos,
    sin(2 * pi() * isodow(InvoiceDate) / 7.0) AS Weekday_sin, cos(2 * pi() * isodow(InvoiceDate) / 7.0) AS Weekday_cos,
    CASE WHEN t.StockCode IS NULL THEN 0 ELSE 1 END AS IsPopularItem,
    CAST(coalesce(p.UnitPrice < med.m, false) AS INTEGER) AS IsDiscounted
  FROM pre p LEFT JOIN top10 t ON p.StockCode = t.StockCode LEFT JOIN med ON p.StockCode = med.StockCode
),
tfs AS (SELECT tf.*, seg.RFM_Cluster FROM tf LEFT JOIN seg ON tf.CustomerID = seg.CustomerID),
joined AS (
  SELECT tfs.*, {", ".join("f." + c for c in FEATURE_COLS)}
  FROM tfs LEFT JOIN feat f ON tfs.InvoiceDate = f.InvoiceDate AND tfs.StockCode = f.StockCode
),
final AS (
  SELECT {", ".join(FINAL_COLS)} FROM joined
  WHERE {" AND ".join(c + " IS NOT NULL" for c in FINAL_COLS)}
),
ix AS (SELECT *, row_number() OVER (ORDER BY {ORDER_KEYS}) - 1 AS val_index FROM final),
nrows AS (SELECT count(*) AS n, count(*) // 4 AS t FROM final),
pr AS (SELECT val_index, InvoiceDate, CustomerID, StockCode, RFM_Cluster,
              exp(log_Quantity) - 1 AS y_true, Lag_1 * (1 + PctChange_7) AS y_pred FROM ix),
fp AS (
  SELECT pr.*, CAST(floor((val_index - (n - 3 * t)) / t) + 1 AS INTEGER) AS fold
  FROM pr, nrows WHERE val_index >= n - 3 * t
)"""
_DEPS["final"] = ["pre", "seg", "feat"]


def _corr(x, y):
    return (f"CASE WHEN stddev_pop(CAST({x} AS DOUBLE)) * stddev_pop(CAST({y} AS DOUBLE)) = 0 THEN NULL "
            f"ELSE covar_pop(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) / "
            f"(stddev_pop(CAST({x} AS DOUBLE)) * stddev_pop(CAST({y} AS DOUBLE))) END")


SQL["corr_with_target"] = _with("final") + (
    ", one AS (SELECT " + ", ".join(f"{_corr(c, 'log_Quantity')} AS r_{c}" for c in CORR_CANDIDATES)
    + " FROM final)\nSELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM (\n"
    + "\nUNION ALL ".join(f"SELECT '{c}' AS feature, r_{c} AS corr FROM one" for c in CORR_CANDIDATES)
    + ")")

_MAT = sorted(CORR_CANDIDATES + ["log_Quantity"])
_PAIRS = [(a, b) for i, a in enumerate(_MAT) for b in _MAT[i:]]
SQL["corr_matrix"] = _with("final") + (
    ", one AS (SELECT " + ", ".join(f"{_corr(a, b)} AS p{i}" for i, (a, b) in enumerate(_PAIRS))
    + " FROM final)\nSELECT col_a, col_b, round(corr, 6) AS corr FROM (\n"
    + "\nUNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, p{i} AS corr FROM one"
                          for i, (a, b) in enumerate(_PAIRS))
    + ")")

SQL["feature_selection"] = _with("final") + (
    ", one AS (SELECT " + ", ".join(f"{_corr(c, 'log_Quantity')} AS r_{c}" for c in CORR_CANDIDATES)
    + " FROM final),\nlong AS (\n"
    + "\nUNION ALL ".join(f"SELECT '{c}' AS feature, abs(r_{c}) AS a FROM one" for c in CORR_CANDIDATES)
    + """),
top AS (SELECT feature, CAST(row_number() OVER (ORDER BY a DESC NULLS LAST, feature) AS INTEGER) AS rank,
               'correlation' AS source FROM long ORDER BY a DESC NULLS LAST, feature LIMIT 15)
SELECT * FROM top
UNION ALL SELECT * FROM (VALUES ('HolidaySeason', 16, 'always'), ('RFM_Cluster', 17, 'always'),
                                ('IsPopularItem', 18, 'always'), ('IsDiscounted', 19, 'always')) v(feature, rank, source)""")

SQL["row_index"] = _with("final") + "SELECT val_index, InvoiceNo, StockCode, InvoiceDate FROM ix"

SQL["time_series_folds"] = _with("final") + """
SELECT fold, min(val_index) AS val_start, max(val_index) AS val_end, count(*) AS val_rows,
       min(val_index) AS train_rows
FROM fp GROUP BY fold"""

SQL["chrono_holdout"] = _with("final") + """
, s AS (
  SELECT '80/20' AS scheme,
         CASE WHEN val_index < n - ceil(n * CAST(0.2 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split, val_index
  FROM ix, nrows
  UNION ALL
  SELECT '80/10/10',
         CASE WHEN val_index < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train'
              WHEN val_index < floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'val'
              ELSE 'test' END, val_index
  FROM ix, nrows
)
SELECT scheme, split, count(*) AS rows, min(val_index) AS first_index, max(val_index) AS last_index
FROM s GROUP BY scheme, split"""

def sig6(x: str) -> str:
    """6 significant digits (same arithmetic as the Spark side)."""
    e = f"(floor(log10(abs({x}))) - 5)"
    return f"CASE WHEN {x} = 0 OR {x} IS NULL THEN {x} ELSE round({x} / pow(10.0, {e})) * pow(10.0, {e}) END"


SQL["regression_metrics"] = _with("final") + """
, e AS (SELECT fold, y_true, y_true - y_pred AS e FROM fp)
SELECT fold, round(avg(e * e), 6) AS MSE, round(avg(abs(e)), 6) AS MAE,
  round(quantile_cont(abs(e), 0.5), 6) AS MedAE,
  round(""" + sig6("avg(abs(e) / greatest(abs(y_true), 2.220446049250313e-16)) * 100") + """, 6) AS MAPE,
  round(max(abs(e)), 6) AS MaxError, count(*) AS n, round(sqrt(avg(e * e)), 6) AS RMSE,
  round(CASE WHEN var_pop(y_true) * count(*) = 0 THEN (CASE WHEN sum(e * e) = 0 THEN 1.0 ELSE 0.0 END)
        ELSE 1 - sum(e * e) / (var_pop(y_true) * count(*)) END, 6) AS R2
FROM e GROUP BY fold"""

SQL["fold_union"] = _with("final") + """
SELECT fold, val_index, round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred FROM fp"""

SQL["rolling_error"] = _with("final") + """
, d AS (SELECT val_index, CASE WHEN y_true = 0 THEN NULL
                          ELSE least(abs(y_true - y_pred) / y_true * 100, 100) END AS delta_pct FROM pr)
SELECT val_index, round(delta_pct, 6) AS delta_pct,
       round(CASE WHEN count(delta_pct) OVER w = 200 THEN avg(delta_pct) OVER w END, 6) AS delta_pct_rolling
FROM d WINDOW w AS (ORDER BY val_index ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)"""

SQL["weekly_cluster_sunday"] = _with("final") + """
, daily AS (SELECT InvoiceDate, RFM_Cluster, sum(y_pred) AS y_pred FROM pr WHERE RFM_Cluster IS NOT NULL GROUP BY 1, 2),
weekly AS (SELECT date_trunc('week', InvoiceDate) + INTERVAL 6 DAY AS week_end, RFM_Cluster, sum(y_pred) AS y_pred
           FROM daily GROUP BY 1, 2),
tops AS (SELECT RFM_Cluster FROM weekly GROUP BY 1 ORDER BY sum(y_pred) DESC, RFM_Cluster LIMIT 3)
SELECT week_end, RFM_Cluster, round(y_pred, 6) AS y_pred FROM weekly WHERE RFM_Cluster IN (SELECT RFM_Cluster FROM tops)"""

SQL["weekly_cluster_monday"] = _with("final") + """
, weekly AS (SELECT date_trunc('week', InvoiceDate) AS week_start, RFM_Cluster, sum(y_true) AS y_true_sum,
                    sum(y_pred) AS y_pred_sum FROM pr WHERE RFM_Cluster IS NOT NULL GROUP BY 1, 2),
tops AS (SELECT RFM_Cluster FROM weekly GROUP BY 1 ORDER BY sum(y_pred_sum) DESC, RFM_Cluster LIMIT 3)
SELECT week_start, RFM_Cluster, round(y_true_sum, 6) AS y_true_sum, round(y_pred_sum, 6) AS y_pred_sum
FROM weekly WHERE RFM_Cluster IN (SELECT RFM_Cluster FROM tops)"""

_SPIKE = """
, cut AS (SELECT max(InvoiceDate) - INTERVAL 60 DAY AS c FROM pr),
recent AS (SELECT pr.* FROM pr, cut WHERE InvoiceDate >= c),
thr AS (SELECT quantile_cont(y_pred, 0.99) AS t FROM recent),
dates AS (SELECT DISTINCT InvoiceDate FROM recent, thr WHERE y_pred > t)"""

SQL["spike_dates"] = _with("final") + _SPIKE + "\nSELECT InvoiceDate FROM dates"

SQL["segment_lift"] = _with("final") + _SPIKE + """,
buyers AS (SELECT CustomerID FROM pr WHERE InvoiceDate IN (SELECT InvoiceDate FROM dates) AND CustomerID IS NOT NULL),
cs AS (SELECT CustomerID, min(RFM_Cluster) AS RFM_Cluster FROM ix WHERE CustomerID IS NOT NULL GROUP BY 1),
sp AS (SELECT cs.RFM_Cluster, count(DISTINCT b.CustomerID) AS NumClients FROM buyers b LEFT JOIN cs USING (CustomerID)
       WHERE cs.RFM_Cluster IS NOT NULL GROUP BY 1),
sp2 AS (SELECT *, NumClients / sum(NumClients) OVER () AS Share FROM sp),
al AS (SELECT RFM_Cluster, count(DISTINCT CustomerID) AS TotalClients FROM ix
       WHERE CustomerID IS NOT NULL AND RFM_Cluster IS NOT NULL GROUP BY 1),
al2 AS (SELECT *, TotalClients / sum(TotalClients) OVER () AS TotalShare FROM al)
SELECT sp2.RFM_Cluster, NumClients, round(Share, 6) AS Share, TotalClients, round(TotalShare, 6) AS TotalShare,
       round(Share / TotalShare, 6) AS Lift
FROM sp2 LEFT JOIN al2 ON sp2.RFM_Cluster = al2.RFM_Cluster"""


# --- web analytics ---------------------------------------------------------------------------

CTE["sess"] = """
ev AS (
  SELECT *, strftime(ts, '%Y-%m-%d') AS day,
         row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS rn_f,
         row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts DESC, event_id DESC) AS rn_l
  FROM events
),
sg AS (SELECT user_id, day, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
              count(*) FILTER (WHERE event_type = 'error') AS n_error FROM ev GROUP BY 1, 2),
sfirst AS (SELECT user_id, day, event_type AS f_type, props AS f_props, ts AS f_ts FROM ev WHERE rn_f = 1),
slast AS (SELECT user_id, day, event_type AS l_type, props AS l_props FROM ev WHERE rn_l = 1),
sess AS (
  SELECT CAST(g.user_id AS VARCHAR) || '_' || g.day AS session_id, CAST(g.user_id AS VARCHAR) AS client_id,
    g.day AS visit_date,
    CASE WHEN f_type = 'error' AND l_type = 'error' THEN NULL ELSE strftime(f_ts, '%H:%M:%S') END AS visit_time,
    CAST(row_number() OVER (PARTITION BY g.user_id ORDER BY g.day) AS INTEGER) AS visit_number,
    coalesce(nullif(f_type, 'error'), 'unknown') AS utm_source,
    nullif(l_type, 'error') AS utm_medium,
    coalesce(json_extract_string(f_props, '$.k'), 'unknown') AS utm_campaign,
    coalesce(CASE WHEN n_purchase > 0 THEN 'purchase_' || CAST(n_purchase AS VARCHAR) END, 'unknown') AS utm_adcontent,
    coalesce(CASE WHEN n_error > 0 THEN 'error_' || CAST(n_error AS VARCHAR) END, 'unknown') AS utm_keyword,
    CASE WHEN n >= 3 THEN 'desktop' ELSE 'mobile' END AS device_category,
    coalesce(nullif(f_type, 'signup'), 'unknown') AS device_os,
    coalesce(nullif(l_type, 'view'), 'unknown') AS device_brand,
    CAST(n AS VARCHAR) || 'x' || CAST(n_purchase AS VARCHAR) AS device_screen_resolution,
    l_type AS device_browser, f_type AS geo_country, json_extract_string(l_props, '$.k') AS geo_city,
    strftime(f_ts, '%Y-%m-%d_%H') || '.json' AS source_file
  FROM sg g JOIN sfirst f ON g.user_id = f.user_id AND g.day = f.day
            JOIN slast l ON g.user_id = l.user_id AND g.day = l.day
)"""

CTE["hits1"] = """
hits0 AS (
  SELECT CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
    strftime(ts, '%Y-%m-%d') AS hit_date, CAST(hour(ts) AS INTEGER) AS hit_number,
    coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE event_type END, 'unknown') AS hit_referer,
    '/' || event_type AS hit_page_path, event_type AS event_category, event_type AS event_action,
    coalesce(json_extract_string(props, '$.k'), 'unknown') AS event_label,
    strftime(ts, '%Y-%m-%d_%H') || '.json' AS source_file, event_id AS src_pos
  FROM events
),
hits1 AS (SELECT *, session_id || '_' || CAST(hit_number AS VARCHAR) AS hit_id FROM hits0)"""

CTE["hits_best"] = """
hits_best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY hit_id ORDER BY nullif(hit_referer, 'unknown') ASC NULLS LAST,
                                 nullif(event_label, 'unknown') ASC NULLS LAST, src_pos ASC) AS rn
    FROM hits1) WHERE rn = 1
)"""

CTE["hits_last"] = """
hits_last AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY hit_id ORDER BY nullif(hit_referer, 'unknown') DESC NULLS FIRST,
                                 nullif(event_label, 'unknown') DESC NULLS FIRST, src_pos DESC) AS rn,
              count(*) OVER (PARTITION BY hit_id) AS n
    FROM hits1) WHERE NOT (rn = 1 AND n > 1)
)"""

CTE["outcomes"] = """
s_files AS (
  SELECT source_file, count(*) AS rows,
         count(*) FILTER (WHERE session_id IS NULL OR client_id IS NULL OR visit_date IS NULL
                          OR visit_time IS NULL OR visit_number IS NULL) AS null_rows,
         0::BIGINT AS dup_in_file
  FROM sess GROUP BY source_file
),
s_dups AS (SELECT source_file, CAST(sum(c) AS BIGINT) AS d FROM (SELECT source_file, session_id, count(*) AS c FROM sess GROUP BY 1, 2)
           WHERE c > 1 GROUP BY 1),
s_out AS (
  SELECT f.source_file, rows, null_rows, coalesce(d, 0) AS dup_in_file, 0::BIGINT AS dup_in_target,
         0::BIGINT AS orphan_rows
  FROM s_files f LEFT JOIN s_dups USING (source_file)
),
s_acc AS (SELECT session_id FROM sess WHERE source_file IN
          (SELECT source_file FROM s_out WHERE null_rows = 0 AND dup_in_file = 0)),
h_files AS (
  SELECT source_file, count(*) AS rows,
         count(*) FILTER (WHERE hit_id IS NULL OR session_id IS NULL OR hit_date IS NULL OR hit_number IS NULL) AS null_rows,
         count(*) FILTER (WHERE session_id NOT IN (SELECT session_id FROM s_acc)) AS orphan_rows
  FROM hits_last GROUP BY source_file
),
h_dups AS (SELECT source_file, CAST(sum(c) AS BIGINT) AS d FROM (SELECT source_file, hit_id, count(*) AS c FROM hits_last GROUP BY 1, 2)
           WHERE c > 1 GROUP BY 1),
h_out AS (
  SELECT f.source_file, rows, null_rows, coalesce(d, 0) AS dup_in_file, 0::BIGINT AS dup_in_target, orphan_rows
  FROM h_files f LEFT JOIN h_dups USING (source_file)
),
outcomes AS (
  SELECT *, (dup_in_file = 0 AND dup_in_target = 0 AND null_rows = 0 AND orphan_rows = 0) AS accepted,
         (null_rows = 0 AND orphan_rows = 0) AS to_db,
         CASE WHEN null_rows > 0 THEN 'not_null' WHEN orphan_rows > 0 THEN 'foreign_key'
              WHEN dup_in_file > 0 OR dup_in_target > 0 THEN 'duplicate_key' ELSE 'loaded' END AS reason
  FROM (SELECT *, 'sessions' AS dataset FROM s_out UNION ALL SELECT *, 'hits' AS dataset FROM h_out)
)"""
_DEPS.update({"hits_best": ["hits1"], "hits_last": ["hits1"], "outcomes": ["sess", "hits_last"]})

_HITCOLS = ("hit_id, session_id, hit_date, hit_number, hit_referer, hit_page_path, event_category, "
            "event_action, event_label, source_file")

SQL["sessions_clean"] = _with("sess") + """
SELECT session_id, client_id, visit_date, visit_time, visit_number, utm_source, utm_medium, utm_campaign,
       utm_keyword, utm_adcontent, device_category, device_os, device_brand, device_screen_resolution,
       device_browser, geo_country, geo_city, source_file FROM sess"""

SQL["hits_clean_drop_last"] = _with("hits_last") + f"SELECT {_HITCOLS} FROM hits_last"
SQL["hits_clean_keep_best"] = _with("hits_best") + f"SELECT {_HITCOLS} FROM hits_best"

SQL["orphan_hits"] = _with("sess", "hits_best") + """
SELECT hit_id, session_id, source_file FROM hits_best
WHERE session_id NOT IN (SELECT session_id FROM sess WHERE visit_time IS NOT NULL)"""

SQL["key_guard"] = _with("outcomes") + """
SELECT source_file, rows, null_rows, dup_in_file, dup_in_target, orphan_rows, accepted, to_db, reason, dataset
FROM outcomes"""

# A file is transformed if each required column has a value in it and its documents are whole.
_WHOLE = "NOT regexp_matches(file_name, '-(07|14|21|28)_13\\.json$')"
_HIT_VALUES = ["CASE WHEN event_type = 'error' THEN NULL ELSE event_type END", "json_extract_string(props, '$.k')", "value"]
_SESSION_VALUES = ["nullif(utm_source, 'unknown')", "utm_medium", "nullif(utm_campaign, 'unknown')",
                   "nullif(utm_adcontent, 'unknown')", "nullif(utm_keyword, 'unknown')", "nullif(device_os, 'unknown')",
                   "nullif(device_brand, 'unknown')", "geo_city"]
CTE["transformed"] = f"""
done AS (
  SELECT 'sessions' AS dataset, file_name, ({_WHOLE} AND {" AND ".join(f"count({c}) > 0" for c in _SESSION_VALUES)}) AS ok
  FROM (SELECT *, source_file AS file_name FROM sess) GROUP BY file_name
  UNION ALL
  SELECT 'hits', file_name, ({_WHOLE} AND {" AND ".join(f"count({c}) > 0" for c in _HIT_VALUES)}) AS ok
  FROM (SELECT *, strftime(ts, '%Y-%m-%d_%H') || '.json' AS file_name FROM events) GROUP BY file_name
),
sess_ok AS (SELECT * FROM sess WHERE source_file IN (SELECT file_name FROM done WHERE ok AND dataset = 'sessions')),
hits_ok AS (SELECT * FROM hits_last WHERE source_file IN (SELECT file_name FROM done WHERE ok AND dataset = 'hits'))"""
CTE["run_outcomes"] = CTE["outcomes"].replace("FROM sess ", "FROM sess_ok ").replace("FROM hits_last", "FROM hits_ok")
CTE["run_ledger"] = """
run_ledger AS (
  SELECT d.dataset, d.file_name, d.ok AS loaded, d.ok AS transformed, coalesce(o.to_db, false) AS to_db, d.ok AS saved
  FROM done d LEFT JOIN outcomes o ON o.dataset = d.dataset AND o.source_file = d.file_name
)"""
_DEPS.update({"transformed": ["sess", "hits_last"], "run_outcomes": ["transformed"], "run_ledger": ["run_outcomes"]})

SQL["ledger_run"] = _with("run_ledger") + "SELECT * FROM run_ledger"

CTE["best_outcomes"] = CTE["outcomes"].replace("hits_last", "hits_best")
_DEPS["best_outcomes"] = ["sess", "hits_best"]

SQL["stream_ingest"] = _with("best_outcomes") + """
SELECT dataset, source_file AS file_name, true AS loaded, true AS transformed, false AS to_db, true AS saved FROM outcomes"""

SQL["stream_load"] = _with("best_outcomes") + """
SELECT dataset, source_file AS file_name, true AS loaded, true AS transformed, to_db, true AS saved FROM outcomes"""

SQL["stream_waiting"] = _with("sess", "hits_best") + """
SELECT hit_id, session_id, source_file,
       CASE WHEN session_id IN (SELECT session_id FROM sess WHERE visit_time IS NOT NULL) THEN 'loaded' ELSE 'orphan' END AS status
FROM hits_best"""

SQL["pending_files"] = _with("run_ledger") + "SELECT * FROM run_ledger WHERE transformed AND NOT to_db"

SQL["run_counters"] = _with("run_outcomes") + """
SELECT dataset, 'transform' AS stage, count(*) FILTER (WHERE ok) AS success, count(*) FILTER (WHERE NOT ok) AS failure
FROM done GROUP BY dataset
UNION ALL
SELECT dataset, 'load', count(*) FILTER (WHERE accepted), count(*) FILTER (WHERE NOT accepted)
FROM outcomes GROUP BY dataset"""

SQL["ledger_backup"] = SQL["ledger_run"]

SQL["sentinel_nulls"] = _with("sess") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = 'unknown') AS null_count FROM sess"
    for c in ("session_id", "client_id", "visit_date", "visit_time", "visit_number", "utm_source", "utm_medium", "utm_campaign",
              "utm_keyword", "utm_adcontent", "device_category", "device_os", "device_brand", "device_screen_resolution",
              "device_browser", "geo_country", "geo_city"))

SQL["duplicate_marks"] = _with("hits1") + """
, n AS (SELECT hit_id, count(*) AS n FROM hits1 GROUP BY hit_id)
SELECT source_file, count(*) AS rows, count(*) FILTER (WHERE n > 1) AS duplicates FROM hits1 JOIN n USING (hit_id) GROUP BY 1"""

SQL["staged_names"] = """
SELECT strftime(ts, '%Y-%m-%d_%H') || '.json' AS source_file, strftime(ts, '%Y-%m-%d_%H') || '.parquet' AS staged,
       strftime(max(ts), '%Y%m%d_%H%M%S') AS run FROM events GROUP BY 1, 2"""

SQL["json_flatten"] = """
SELECT strftime(ts, '%Y-%m-%d_%H') || '.json' AS file_name, strftime(ts, '%Y-%m-%d') AS day,
  CAST(0 AS INTEGER) AS day_pos,
  CAST(row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d_%H'), user_id ORDER BY event_id) - 1 AS INTEGER) AS rec_pos,
  CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') AS session_id, strftime(ts, '%Y-%m-%d') AS hit_date,
  strftime(ts, '%H:%M:%S') AS hit_time, CAST(hour(ts) AS BIGINT) AS hit_number, 'event' AS hit_type,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS hit_referer, '/' || event_type AS hit_page_path,
  event_type AS event_category, event_type AS event_action, json_extract_string(props, '$.k') AS event_label,
  round(value, 6) AS event_value
FROM events"""

_HIT_REQ_SORTED = sorted(["session_id", "hit_date", "hit_time", "hit_number", "hit_type", "hit_referer",
                          "hit_page_path", "event_category", "event_action", "event_label", "event_value"])
SQL["required_columns"] = """
, r AS (
  SELECT strftime(ts, '%Y-%m-%d_%H') || '.json' AS file_name, user_id AS session_id,
    strftime(ts, '%Y-%m-%d') AS hit_date, strftime(ts, '%H:%M:%S') AS hit_time, hour(ts) AS hit_number,
    'event' AS hit_type, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS hit_referer,
    '/' || event_type AS hit_page_path, event_type AS event_category, event_type AS event_action,
    json_extract_string(props, '$.k') AS event_label, value AS event_value
  FROM events
),
m AS (
  SELECT file_name, count(*) AS n_records,
    concat_ws(',', """.replace("\n, r AS", "WITH r AS", 1) + ", ".join(
        f"CASE WHEN count({c}) = 0 THEN '{c}' END" for c in _HIT_REQ_SORTED) + """) AS missing
  FROM r GROUP BY file_name
)
SELECT file_name, n_records, missing, (n_records > 0 AND missing = '') AS ok FROM m"""


# --- vehicles ---------------------------------------------------------------------------------

CTE["vehicles"] = """
veh0 AS (
  SELECT l.l_orderkey * 100 + l.l_linenumber AS id, p.p_name AS model,
    CASE WHEN p.p_partkey % 17 = 0 THEN NULL WHEN p.p_partkey % 50 = 0 THEN 1900.0
         ELSE CAST(1990 + p.p_size % 30 AS DOUBLE) END AS year,
    CASE WHEN l.l_suppkey % 13 = 0 THEN NULL ELSE p.p_type END AS fuel,
    l.l_quantity * 1000 AS odometer, l.l_returnflag AS title_status, l.l_linestatus AS transmission,
    p.p_brand AS state, l.l_extendedprice AS price
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
vcuts AS (SELECT quantile_cont(price, 1/3) AS c1, quantile_cont(price, 2/3) AS c2 FROM veh0),
vehicles AS (
  SELECT veh0.*, CASE WHEN price <= c1 THEN 'low' WHEN price <= c2 THEN 'medium' ELSE 'high' END AS price_category
  FROM veh0, vcuts
),
vb AS (SELECT quantile_cont(year, 0.25) AS q1, quantile_cont(year, 0.75) AS q3 FROM vehicles),
vcap AS (
  SELECT vehicles.* EXCLUDE (year), year AS year_raw,
    CASE WHEN year < q1 - 1.5 * (q3 - q1) THEN round_even(q1 - 1.5 * (q3 - q1), 0)
         WHEN year > q3 + 1.5 * (q3 - q1) THEN round_even(q3 + 1.5 * (q3 - q1), 0) ELSE year END AS year
  FROM vehicles, vb
),
vfeat AS (
  SELECT *, split_part(lower(model), ' ', 1) AS short_model,
    CASE WHEN year > 2013 THEN 'new' WHEN year < 2006 THEN 'old' ELSE 'average' END AS age_category
  FROM vcap
)"""

SQL["iqr_cap"] = _with("vehicles") + """
SELECT model, fuel, round(year_raw, 6) AS year_raw, round(year, 6) AS year_capped FROM vcap"""

SQL["price_features"] = _with("vehicles") + """
SELECT model, round(year, 6) AS year, short_model, age_category FROM vfeat"""

SQL["impute_median"] = _with("vehicles") + """
, md AS (SELECT quantile_cont(year, 0.5) AS my, quantile_cont(odometer, 0.5) AS mo FROM vcap)
SELECT model, round(coalesce(year, my), 6) AS year, round(coalesce(odometer, mo), 6) AS odometer FROM vcap, md"""

SQL["impute_mode"] = _with("vehicles") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, (SELECT CAST({c} AS VARCHAR) FROM vfeat WHERE {c} IS NOT NULL GROUP BY 1 "
    f"ORDER BY count(*) DESC, 1 LIMIT 1) AS mode"
    for c in ("model", "fuel", "title_status", "transmission", "state", "short_model", "age_category"))

SQL["stratified_folds"] = _with("vehicles") + """
, o AS (
  SELECT price_category, row_number() OVER (ORDER BY price_category, model, year NULLS FIRST, odometer,
           fuel NULLS FIRST, transmission, state) - 1 AS pos FROM vehicles
),
c AS (SELECT price_category, count(*) AS n, min(pos) AS s FROM o GROUP BY 1),
a AS (
  SELECT price_category, s,
    """ + ", ".join(
        f"(floor((s + n - 1 - {i} + 4) / 4) - floor((s - 1 - {i} + 4) / 4)) AS a{i}" for i in range(4)) + """
  FROM c
),
b AS (SELECT price_category, s, a0 AS b0, a0 + a1 AS b1, a0 + a1 + a2 AS b2 FROM a),
f AS (
  SELECT o.price_category, CAST(CASE WHEN pos - s < b0 THEN 0 WHEN pos - s < b1 THEN 1
                                     WHEN pos - s < b2 THEN 2 ELSE 3 END AS INTEGER) AS fold
  FROM o JOIN b USING (price_category)
)
SELECT price_category, fold, count(*) AS rows FROM f GROUP BY 1, 2"""


SQL["shape_counts"] = _with("pre") + """
SELECT (SELECT count(*) FROM retail) AS raw_rows, (SELECT count(DISTINCT CustomerID) FROM retail) AS raw_customers,
       (SELECT count(*) FROM pre) AS clean_rows, (SELECT count(DISTINCT CustomerID) FROM pre) AS clean_customers"""

SQL["train_test_scaling"] = _with("final") + """
, sp AS (SELECT val_index, Lag_1, RollingNormMean_7, log_Quantity,
                CASE WHEN val_index < n - ceil(n * CAST(0.2 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
         FROM ix, nrows),
st AS (SELECT avg(Lag_1) AS m1, stddev_pop(Lag_1) AS s1, avg(RollingNormMean_7) AS m2, stddev_pop(RollingNormMean_7) AS s2,
              avg(log_Quantity) AS m3, stddev_pop(log_Quantity) AS s3 FROM sp WHERE split = 'train'),
st2 AS (SELECT m1, CASE WHEN s1 = 0 THEN 1 ELSE s1 END AS s1, m2, CASE WHEN s2 = 0 THEN 1 ELSE s2 END AS s2,
               m3, CASE WHEN s3 = 0 THEN 1 ELSE s3 END AS s3 FROM st)
SELECT val_index, split, round((Lag_1 - m1) / s1, 6) AS Lag_1_scaled,
       round((RollingNormMean_7 - m2) / s2, 6) AS RollingNormMean_7_scaled,
       round((log_Quantity - m3) / s3, 6) AS log_Quantity_scaled,
       round(((log_Quantity - m3) / s3) * s3 + m3, 6) AS log_Quantity_back
FROM sp, st2"""

SQL["prediction_tail"] = _with("final") + """
SELECT val_index, round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred FROM pr ORDER BY val_index DESC LIMIT 500"""

SQL["predictions_csv_roundtrip"] = _with("final") + """
SELECT fold, val_index, round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred FROM fp"""


SQL["metrics_roundtrip"] = _with("final") + """
SELECT round(avg((y_true - y_pred) * (y_true - y_pred)), 6) AS MSE, round(avg(abs(y_true - y_pred)), 6) AS MAE,
       round(max(abs(y_true - y_pred)), 6) AS MaxError, count(*) AS n, count(*) AS rows, count(DISTINCT fold) AS folds FROM fp"""


# --- loads where one key comes in many files -------------------------------------------------

def _guard(name: str, rows: str, key: str, nulls: str, target: str | None = None, parent: str | None = None) -> str:
    """CTEs ``<name>`` (per-file outcome) and ``<name>_keys`` (accepted keys), files decided one by one in order."""
    known = f"count(*) FILTER (WHERE {key} IN (SELECT k FROM {target}))" if target else "0::BIGINT"
    lost = f"count(*) FILTER (WHERE session_id NOT IN (SELECT k FROM {parent}))" if parent else "0::BIGINT"
    return f"""
{name}_files AS (
  SELECT source_file, row_number() OVER (ORDER BY source_file) AS i, count(*) AS rows,
         count(*) FILTER (WHERE {nulls}) AS null_rows, count(*) - count(DISTINCT {key}) AS more,
         {known} AS known, {lost} AS orphan_rows, list(DISTINCT {key}) AS keys
  FROM {rows} GROUP BY source_file
),
{name}_dups AS (SELECT source_file, CAST(sum(c) AS BIGINT) AS d FROM (
  SELECT source_file, {key}, count(*) AS c FROM {rows} GROUP BY 1, 2) WHERE c > 1 GROUP BY 1),
{name}_run AS (
  SELECT 0::BIGINT AS i, []::VARCHAR[] AS taken, 0::BIGINT AS late
  UNION ALL
  SELECT f.i, CASE WHEN fine AND len(list_intersect(keys, taken)) = 0 THEN list_concat(taken, keys) ELSE taken END,
         CASE WHEN fine THEN len(list_intersect(keys, taken)) ELSE 0 END
  FROM {name}_run r JOIN (SELECT *, null_rows = 0 AND more = 0 AND known = 0 AND orphan_rows = 0 AS fine
                          FROM {name}_files) f ON f.i = r.i + 1
),
{name} AS (
  SELECT source_file, rows, null_rows, coalesce(d, 0) AS dup_in_file, known + late AS dup_in_target, orphan_rows,
         more = 0 AND known + late = 0 AND null_rows = 0 AND orphan_rows = 0 AS accepted,
         null_rows = 0 AND orphan_rows = 0 AS to_db,
         CASE WHEN null_rows > 0 THEN 'not_null' WHEN orphan_rows > 0 THEN 'foreign_key'
              WHEN more > 0 OR known + late > 0 THEN 'duplicate_key' ELSE 'loaded' END AS reason
  FROM {name}_files JOIN {name}_run USING (i) LEFT JOIN {name}_dups USING (source_file)
),
{name}_keys AS (SELECT DISTINCT {key} AS k FROM {rows} WHERE source_file IN (SELECT source_file FROM {name} WHERE accepted))"""


_SNULL = ("session_id IS NULL OR client_id IS NULL OR visit_date IS NULL OR visit_time IS NULL "
          "OR visit_number IS NULL")
_HNULL = "hit_id IS NULL OR session_id IS NULL OR hit_date IS NULL OR hit_number IS NULL"

SQL["key_guard_incremental"] = _with("sess", "hits1").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
us AS (SELECT * REPLACE (client_id AS session_id) FROM sess),
us1 AS (SELECT * FROM us WHERE CAST(substr(source_file, 12, 2) AS INTEGER) % 2 = 0),
us2 AS (SELECT * FROM us WHERE CAST(substr(source_file, 12, 2) AS INTEGER) % 2 = 1),
uh AS (
  SELECT * FROM (
    SELECT source_file, hit_date, hit_number, split_part(session_id, '_', 1) AS session_id,
           split_part(session_id, '_', 1) || '_' || CAST(hit_number AS VARCHAR) AS hit_id,
           row_number() OVER (PARTITION BY source_file, split_part(session_id, '_', 1), hit_number
             ORDER BY nullif(hit_referer, 'unknown') ASC NULLS LAST, nullif(event_label, 'unknown') ASC NULLS LAST,
                      src_pos ASC) AS rn
    FROM hits1) WHERE rn = 1
),
{_guard("g1", "us1", "session_id", _SNULL)},
{_guard("g2", "us2", "session_id", _SNULL, "g1_keys")},
loaded AS (SELECT k FROM g1_keys UNION SELECT k FROM g2_keys),
{_guard("g3", "uh", "hit_id", _HNULL, None, "loaded")}
SELECT *, '1 sessions' AS step FROM g1 UNION ALL SELECT *, '2 sessions' FROM g2 UNION ALL SELECT *, '3 hits' FROM g3"""

SQL["pending_retry"] = _with("outcomes") + """
SELECT source_file AS file_name, false AS to_db_first, to_db AS to_db_last FROM outcomes WHERE dataset = 'hits'"""

SQL["seeded_sample"] = _with("final") + """
SELECT val_index, round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred, InvoiceDate, CustomerID, StockCode, RFM_Cluster
FROM pr ORDER BY md5('42:' || CAST(val_index AS VARCHAR)), val_index LIMIT 5000"""

SQL["sequence_windows"] = _with("final") + "".join(
    (" UNION ALL " if n == 15 else "") + f"""
SELECT {n} AS steps, val_index, round(sum_lag, 6) AS sum_lag, round(sum_price, 6) AS sum_price,
       round(first_lag, 6) AS first_lag, round(last_price, 6) AS last_price, round(label, 6) AS label FROM (
  SELECT val_index, list_sum(list(CAST(Lag_1 AS DOUBLE)) OVER w) AS sum_lag, list_sum(list(log_UnitPrice) OVER w) AS sum_price,
         first_value(CAST(Lag_1 AS DOUBLE)) OVER w AS first_lag, last_value(log_UnitPrice) OVER w AS last_price,
         CAST(log_Quantity AS DOUBLE) AS label, count(*) OVER w AS c
  FROM ix WINDOW w AS (ORDER BY val_index ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)) WHERE c = {n}"""
    for n in (7, 15))

SQL["iso_calendar"] = _with("retail") + """
SELECT InvoiceNo, StockCode, InvoiceDate, CAST(day(InvoiceDate) AS INTEGER) AS DayOfMonth,
       CAST(week(InvoiceDate) AS INTEGER) AS IsoWeek, CAST(isoyear(InvoiceDate) AS INTEGER) AS IsoYear FROM retail"""

SQL["rfm_as_of"] = _with("retail") + """
, past AS (SELECT * FROM retail WHERE InvoiceDate < TIMESTAMP '1997-01-01'),
ref AS (SELECT max(InvoiceDate) + INTERVAL 1 DAY AS r FROM past)
SELECT CustomerID, CAST(floor(epoch(any_value(r) - max(InvoiceDate)) / 86400) AS BIGINT) AS Recency,
       count(DISTINCT InvoiceNo) AS Frequency, round(sum(Quantity * UnitPrice), 6) AS Monetary
FROM past, ref WHERE CustomerID IS NOT NULL GROUP BY CustomerID"""
