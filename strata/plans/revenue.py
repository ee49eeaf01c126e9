"""Revenue by region and customer nation for the orders placed in a date range.

Specification (``ORACLE_SQL`` below is this, for DuckDB)::

    SELECT r_name, n_name, count(*) AS n_lines,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem JOIN orders   ON l_orderkey = o_orderkey
                  JOIN customer ON o_custkey = c_custkey
                  JOIN nation   ON c_nationkey = n_nationkey
                  JOIN region   ON n_regionkey = r_regionkey
    WHERE o_orderdate >= start AND o_orderdate < end
    GROUP BY r_name, n_name

with amounts cast to decimals and summed exactly; an amount with more than two
places, or too large for its type, fails the query (``strata.functions.money``).

How the plan is shaped for a large cluster
------------------------------------------
lineitem is by far the largest input and has no filter of its own: line ship
dates say nothing about order dates, so the date range cannot be carried over.
It is shuffled once, by order key, and nothing else of it is:

1. Each line is reduced to ``(l_orderkey, revenue)`` before that shuffle: two
   fixed-width columns instead of key, price and discount.
2. ``orders`` is read with the date range pushed into the Parquet scan (row
   groups whose date statistics lie outside it are skipped) and two columns.
3. After the order join the rows are pre-aggregated per customer. The join
   output is partitioned by order key, so all lines of an order sit in one
   task and the partial (map-side) aggregate folds them into one row per
   customer and task before the shuffle by customer key. A customer holding a
   large share of all orders therefore sends at most one row per task, not
   its whole history, to a single reducer. Catalyst does not push
   aggregates below joins on its own, so this is written out here.
4. The aggregate's output is already partitioned by customer key, so the
   customer join shuffles only ``customer`` (two columns). Both of its sides
   are unique per key there, so it cannot be skewed.
5. Nation and region are joined after the per-customer aggregate, so their
   names never travel through a shuffle of the large side. The planner
   broadcasts each if the size of its files is under
   ``spark.sql.autoBroadcastJoinThreshold`` (bytes) and shuffles it otherwise;
   nothing is forced, and building the query starts no job.
6. The last aggregate is partial per task, so its shuffle carries at most one
   row per (region, nation) and task.

The order join is left to the planner: it broadcasts the filtered orders only
when its statistics put them under the broadcast threshold and otherwise
sort-merges, with AQE splitting skewed order keys. No Python runs per row.

A narrow date range keeps few orders, yet lineitem would be shuffled whole.
``NARROW_RANGE_SETTINGS`` let Spark build a runtime Bloom filter from the kept
orders' keys and drop other lines before their shuffle (see there).

The query is one Spark SQL statement over DataFrame parameters rather than a
chain of DataFrame calls: it reads like the specification, the physical plan
is the same, and it is analysed once instead of once per call.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from strata.functions.money import net_revenue_sql, report_amount_sql
from strata.sources.tables import read_tables

# Output columns, in order.
COLUMNS = ("r_name", "n_name", "n_lines", "revenue")

# Session settings for narrow date ranges on tables too large to broadcast. The
# filter is built from the order keys that the range keeps (one scan of two
# columns of orders) and tested on each line before the shuffle. Sizing, for n
# kept orders: 8 bits an order (maxNumItems = n, maxNumBits = 8 n) let about 3 %
# of the other lines pass; the built filter is broadcast, so n = 50 million
# orders (50 MB) is a sensible end. creationSideThreshold must exceed Spark's
# estimate of the filtered orders, which ignores how selective a range is: set
# it to the size of orders. applicationSideScanSizeThreshold is the size of
# lineitem from which a filter is worth its scan (Spark's default 10 GB). Beyond
# about a third of all orders the filter costs more than it saves: a full year
# of seven keeps one line in seven, and the extra scan and test are repaid only
# where the shuffle is what limits the job.
NARROW_RANGE_SETTINGS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "10000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "50000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "400000000",
}

# Spark SQL. {name} is an input DataFrame, :range_start and :range_end are
# bound parameters (named so that none is a reserved word under ANSI keyword
# rules). The whole statement is analysed once, in a single call.
QUERY = f"""
WITH per_customer AS (
  SELECT o_custkey, sum(rev) AS rev, count(*) AS n_lines
  FROM (SELECT l_orderkey, {net_revenue_sql("l_extendedprice", "l_discount")} AS rev
        FROM {{lineitem}}) AS lines
  JOIN (SELECT o_orderkey, o_custkey
        FROM {{orders}}
        WHERE o_orderdate >= CAST(:range_start AS TIMESTAMP_NTZ)
          AND o_orderdate < CAST(:range_end AS TIMESTAMP_NTZ)) AS placed
    ON l_orderkey = o_orderkey
  GROUP BY o_custkey
)
SELECT r_name, n_name,
       sum(n_lines) AS n_lines,
       {report_amount_sql("sum(rev)")} AS revenue
FROM per_customer
JOIN (SELECT c_custkey, c_nationkey FROM {{customer}}) AS cust ON o_custkey = c_custkey
JOIN {{nation}} ON c_nationkey = n_nationkey
JOIN {{region}} ON n_regionkey = r_regionkey
GROUP BY r_name, n_name
"""


def revenue_by_region(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    start: str | dt.date = "1996-01-01",
    end: str | dt.date = "1997-01-01",
) -> DataFrame:
    """Lines and net revenue per (region, nation) for orders dated in [start, end).

    ``start`` and ``end`` are ISO dates or timestamps (text, ``date`` or naive
    ``datetime``), checked here before any job starts: text that is not one, a
    time zone, and a range that is empty or reversed raise ``ValueError``. They
    are compared with ``o_orderdate`` as TIMESTAMP_NTZ, so the result does not
    depend on the session time zone.
    """
    first, last = _instant(start), _instant(end)
    if first >= last:
        raise ValueError(f"the date range is empty: {start} to {end}")
    return lineitem.sparkSession.sql(
        QUERY,
        # Text, not Python dates: PySpark would bind a datetime as a zoned TIMESTAMP.
        args={"range_start": first.isoformat(sep=" "), "range_end": last.isoformat(sep=" ")},
        lineitem=lineitem,
        orders=orders,
        customer=customer,
        nation=nation,
        region=region,
    )


def _instant(value: str | dt.date) -> dt.datetime:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        raise ValueError(f"order dates are zone-less; {value.isoformat()} has a time zone")
    return value


def revenue_by_region_from(spark: SparkSession, root: str, **kwargs) -> DataFrame:
    """``revenue_by_region`` over the tables stored under ``root``."""
    tables = read_tables(spark, root, ("lineitem", "orders", "customer", "nation", "region"))
    return revenue_by_region(**tables, **kwargs)


# The plain specification as SQL, for DuckDB. The inputs are taken as they are;
# each product is rounded to six places, far below a cent, so that the sum does
# not depend on the order of addition. Parameters are the half-open date range.
ORACLE_SQL = """
SELECT r_name, n_name,
       count(*) AS n_lines,
       CAST(round(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,6))), 2) AS DOUBLE) AS revenue
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation   ON c_nationkey = n_nationkey
JOIN region   ON n_regionkey = r_regionkey
WHERE o_orderdate >= TIMESTAMP '{start}' AND o_orderdate < TIMESTAMP '{end}'
GROUP BY r_name, n_name
"""


def oracle_sql(start: str = "1996-01-01", end: str = "1997-01-01") -> str:
    return ORACLE_SQL.format(start=start, end=end).strip()
