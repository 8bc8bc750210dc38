"""Window queries in batch form (T4, T7); the streaming forms are in
``riskspark/streaming`` and are tested on closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators.windows import sessions, tumbling
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.sources.derived import Workspace


@query("daily_windows", sql=Q.with_(Q.EV, Q.TX) + """
SELECT date_trunc('day', transaction_time) AS window_start,
       date_trunc('day', transaction_time) + INTERVAL 1 DAY AS window_end,
       count(*) AS n, round(sum(transaction_amount), 6) AS total
FROM tx GROUP BY 1, 2""")
def daily_windows(spark, sf_dir):
    """T4: one-day tumbling windows of count and amount."""
    t = tumbling(Workspace(spark, sf_dir).transactions(), "transaction_time", "1 day", "transaction_amount")
    return t.select("window_start", "window_end", "n", F.round("total", 6).alias("total"))


@query("sessions", sql=Q.with_(Q.EV, Q.TX, """g AS (SELECT customer_id, transaction_time,
  CASE WHEN lag(transaction_time) OVER w IS NULL
            OR transaction_time > lag(transaction_time) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new
  FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_time, transaction_id))""",
  """s AS (SELECT customer_id, transaction_time, sum(new) OVER (PARTITION BY customer_id
           ORDER BY transaction_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)""") + """
SELECT customer_id, min(transaction_time) AS session_start,
       max(transaction_time) + INTERVAL 30 MINUTE AS session_end, count(*) AS n
FROM s GROUP BY customer_id, sid""")
def q_sessions(spark, sf_dir):
    """30-minute sessions per customer; rapid repeats are counted, never
    dropped."""
    tx = Workspace(spark, sf_dir).transactions()
    return sessions(tx, "customer_id", "transaction_time", 30, tie="transaction_id")
