"""Common DuckDB CTE text used by several oracle queries."""

# Hourly means of events per event_type on a gap-free spine, plus the
# series-mean imputed value (``himp``).
HOURLY_CTE = """
agg AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts_hour,
         avg(value) AS value_mean, count(*) AS n
  FROM events GROUP BY 1, 2),
bounds AS (SELECT series, min(ts_hour) AS lo, max(ts_hour) AS hi FROM agg GROUP BY 1),
spine AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour FROM bounds),
hourly AS (
  SELECT s.series, s.ts_hour, a.value_mean, CAST(coalesce(a.n, 0) AS BIGINT) AS n,
         CAST(date_diff('hour', b.lo, s.ts_hour) AS BIGINT) AS idx
  FROM spine s JOIN bounds b USING (series) LEFT JOIN agg a USING (series, ts_hour)),
himp AS (
  SELECT series, ts_hour, idx, n,
         coalesce(value_mean, avg(value_mean) OVER (PARTITION BY series)) AS value
  FROM hourly)
"""

LINEITEM4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
