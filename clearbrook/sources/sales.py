"""A raw sales table with known defects, derived from an ``events`` table.

One text serves any SQL engine.  It plants a business drop on 2024-01-09 (rows
moved to 2024-01-23, which they make a spike; none repeated) and a double
ingestion on 2024-01-15, three date formats, padded, missing, unreadable and
impossible dates, zero, unreadable and tenfold prices, negative quantities,
blank customers, eleven known channel spellings, an unknown, a blank and a
missing one.  Missing and blank orders come on a few days only: they are excess
rows of their day, and would hide what the other days show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clearbrook.operators.staging import stage_sales
from clearbrook.sources.files import read_table

#: Days of the month on which orders get lost.
_LOSSY_DAYS = "EXTRACT(DAY FROM d) IN (3, 4, 11, 18, 27)"
NULL_ORDER = f"event_id % 23 = 7 AND {_LOSSY_DAYS}"
BLANK_ORDER = f"event_id % 29 = 8 AND {_LOSSY_DAYS}"

SALES_RAW_SQL = f"""
WITH e AS (
  SELECT event_id, user_id, event_type, value, 0 AS copy,
    CASE WHEN CAST(ts AS DATE) = DATE '2024-01-09' AND event_id % 5 < 2
      THEN CAST(CAST(ts AS DATE) + INTERVAL '14' DAY AS DATE) ELSE CAST(ts AS DATE) END AS d
  FROM events
  UNION ALL
  SELECT event_id, user_id, event_type, value, 1 AS copy, CAST(ts AS DATE) AS d FROM events
  WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND event_id % 2 = 0
), s AS (SELECT e.*, CAST(d AS STRING) AS ds FROM e)
SELECT
  CASE WHEN {NULL_ORDER} THEN NULL WHEN {BLANK_ORDER} THEN ' ' ELSE CAST(event_id AS STRING) END AS order_id,
  CASE WHEN event_id % 173 = 9 THEN 'soon' WHEN event_id % 179 = 9 THEN '2024-02-30' WHEN event_id % 181 = 9 THEN NULL
    WHEN event_id % 191 = 9 THEN '  ' || ds || ' '
    WHEN event_id % 3 = 0 THEN ds
    WHEN event_id % 3 = 1 THEN substr(ds,9,2) || '/' || substr(ds,6,2) || '/' || substr(ds,1,4)
    ELSE replace(ds,'-','/') END AS date,
  'S' || CAST(user_id % 3 AS STRING) AS store_id,
  'P' || CAST(event_id % 20 AS STRING) AS product_id,
  CASE WHEN event_id % 97 = 0 THEN '0' WHEN event_id % 211 = 0 THEN 'n/a'
       WHEN event_id % 89 = 0 THEN CAST(CAST(value * 10 AS DECIMAL(12,2)) AS STRING)
       ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END AS unit_price,
  CASE WHEN event_id % 301 = 0 THEN '-1' ELSE CAST(1 + event_id % 5 AS STRING) END AS quantity,
  CASE WHEN event_id % 57 = 0 THEN '  ' ELSE 'C' || CAST(user_id AS STRING) END AS customer_id,
  CASE WHEN event_id % 193 = 11 THEN ' ' WHEN event_id % 197 = 11 THEN NULL ELSE CASE event_id % 12 WHEN 0 THEN 'market_place' WHEN 1 THEN 'marketplace' WHEN 2 THEN 'MarketPlace'
    WHEN 3 THEN 'Online' WHEN 4 THEN 'store' WHEN 5 THEN 'In-Store' WHEN 6 THEN 'online'
    WHEN 7 THEN 'IN_STORE' WHEN 8 THEN 'in_store' WHEN 9 THEN 'on-line' WHEN 10 THEN 'ONLINE' ELSE 'kiosk' END END AS channel
FROM s
"""

# The same table with complete keys, without an unknown label and without a price of zero (which moves the bounds of the
# positive prices off those of all), so that every gate passes.
SALES_RAW_CLOSED_SQL = (
    SALES_RAW_SQL.replace("ELSE 'kiosk'", "ELSE 'marketplace'").replace("event_id % 97 = 0", "FALSE")
    .replace("ELSE CAST(CAST(value AS", "ELSE CAST(CAST(greatest(value, 0.01) AS")
    .replace(NULL_ORDER, "FALSE").replace("event_id % 173 = 9", "FALSE").replace("event_id % 179 = 9", "FALSE")
    .replace("event_id % 181 = 9", "FALSE").replace("event_id % 193 = 11", "FALSE").replace("event_id % 197 = 11", "FALSE")
)


# The same table with an order in every row, so that rows of one key are copies of each other and any of them may stay.
SALES_RAW_KEYED_SQL = SALES_RAW_SQL.replace(NULL_ORDER, "FALSE").replace(BLANK_ORDER, "FALSE")

# The same table of shops that are closed on Sundays: what would be sold then is sold on the Monday.
_SUNDAYS = "EXTRACT(DAY FROM d) IN (7, 14, 21, 28)"
SALES_RAW_SUNDAYS_SQL = SALES_RAW_SQL.replace(
    "SELECT e.*, CAST(d AS STRING) AS ds FROM e",
    "SELECT m.*, CAST(d AS STRING) AS ds FROM (SELECT event_id, user_id, event_type, value, copy, "
    f"CASE WHEN {_SUNDAYS} THEN CAST(d + INTERVAL '1' DAY AS DATE) ELSE d END AS d FROM e) AS m",
)

SALES_VARIANTS = {
    "open": SALES_RAW_SQL, "closed": SALES_RAW_CLOSED_SQL, "keyed": SALES_RAW_KEYED_SQL, "sundays": SALES_RAW_SUNDAYS_SQL,
}


def sales_raw(spark: SparkSession, folder: str, closed: bool = False, variant: str = "open") -> DataFrame:
    text = SALES_VARIANTS["closed" if closed else variant]
    return spark.sql(text.replace("FROM events", "FROM {events}"), events=read_table(spark, folder, "events"))


def sales_staged(spark: SparkSession, folder: str, closed: bool = False, variant: str = "open") -> DataFrame:
    return stage_sales(sales_raw(spark, folder, closed, variant))
