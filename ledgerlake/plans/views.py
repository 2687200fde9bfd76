"""Derived views over the warehouse tables (FIXTURES.md).

Each view exists twice: a Spark builder ``(spark, sf_dir) -> DataFrame`` and
the same rule as DuckDB SQL, used as a CTE by the oracle queries.  Nulls and
outliers are injected by fixed arithmetic rules on the keys, so both sides
inject the same cells.  Money sums are rounded to cents, which makes the
derived features bit-identical in both engines whatever the summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

# ---------------------------------------------------------------- v_loan
# lineitem as the loan preprocessing frame.  Unique order:
# (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice).
LOAN_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LOAN_NUMERIC = ["income", "credit_score", "debt_ratio", "tax", "loan_amount"]


def v_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", nan_to_null=True)
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.when((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 20 == 0, F.lit(None))
         .when(F.col("l_orderkey") % 997 == 0, F.col("l_extendedprice") * 50)
         .otherwise(F.col("l_extendedprice")).alias("income"),
        F.when(F.col("l_partkey") % 20 == 3, F.lit(None)).otherwise(F.col("l_quantity")).alias("credit_score"),
        F.col("l_discount").alias("debt_ratio"),
        F.col("l_tax").alias("tax"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("loan_amount"),
        F.when(F.col("l_suppkey") % 10 == 1, F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").alias("ship_ts"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_default"),
    )


V_LOAN_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CASE WHEN (l_orderkey*7 + l_linenumber) % 20 = 0 THEN NULL
       WHEN l_orderkey % 997 = 0 THEN l_extendedprice*50 ELSE l_extendedprice END AS income,
  CASE WHEN l_partkey % 20 = 3 THEN NULL ELSE l_quantity END AS credit_score,
  l_discount AS debt_ratio, l_tax AS tax,
  l_extendedprice / l_quantity AS loan_amount,
  CASE WHEN l_suppkey % 10 = 1 THEN NULL ELSE l_returnflag END AS flag,
  l_linestatus AS status, l_shipdate AS ship_ts,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_default
FROM lineitem"""

# ------------------------------------------------------- credit star schema
EDUCATION = {"AUTOMOBILE": "high_school", "BUILDING": "bachelor",
             "FURNITURE": "master", "HOUSEHOLD": "doctor"}


def v_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    edu = F.lit("other")
    for k, v in reversed(list(EDUCATION.items())):
        edu = F.when(F.col("c_mktsegment") == k, F.lit(v)).otherwise(edu)
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        (F.lit(20) + F.col("c_custkey") % 50).cast("int").alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        edu.alias("education"),
        F.col("c_mktsegment").alias("occupation"),
        (F.abs(F.col("c_acctbal")) + 1).alias("annual_income"),
        (F.col("c_nationkey") % 4).cast("int").alias("num_dependents"),
    )


V_CUSTOMER_SQL = """
SELECT c_custkey AS customer_id, CAST(20 + c_custkey % 50 AS INTEGER) AS age,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'high_school' WHEN 'BUILDING' THEN 'bachelor'
       WHEN 'FURNITURE' THEN 'master' WHEN 'HOUSEHOLD' THEN 'doctor' ELSE 'other' END AS education,
  c_mktsegment AS occupation, abs(c_acctbal) + 1 AS annual_income,
  CAST(c_nationkey % 4 AS INTEGER) AS num_dependents
FROM customer"""


def v_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    month_no = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    is_f = F.col("o_orderstatus") == "F"
    return o.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        (F.max(month_no) - F.min(month_no)).cast("int").alias("credit_history_months"),
        F.sum(F.when(is_f, 1).otherwise(0)).cast("int").alias("num_overdue_30d"),
        F.sum(F.when(is_f & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0))
         .cast("int").alias("num_overdue_60d"),
        F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).cast("int").alias("num_overdue_90d"),
        F.max(F.when(is_f, F.dayofmonth("o_orderdate")).otherwise(0)).cast("int").alias("max_overdue_days"),
        F.count_distinct("o_orderpriority").cast("int").alias("num_credit_cards"),
        F.round(F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1)) / F.max("o_totalprice"), 6)
         .alias("credit_card_utilization"),
    )


V_CREDIT_SQL = """
SELECT o_custkey AS customer_id,
  CAST(max(year(o_orderdate)*12 + month(o_orderdate)) - min(year(o_orderdate)*12 + month(o_orderdate)) AS INTEGER) AS credit_history_months,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS INTEGER) AS num_overdue_30d,
  CAST(sum(CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS INTEGER) AS num_overdue_60d,
  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS INTEGER) AS num_overdue_90d,
  CAST(max(CASE WHEN o_orderstatus = 'F' THEN dayofmonth(o_orderdate) ELSE 0 END) AS INTEGER) AS max_overdue_days,
  CAST(count(DISTINCT o_orderpriority) AS INTEGER) AS num_credit_cards,
  round(round(sum(o_totalprice), 2) / count(*) / max(o_totalprice), 6) AS credit_card_utilization
FROM orders GROUP BY o_custkey"""


def v_credit_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Pre-aggregate lineitem to one row per order before the join: the join
    # and the customer aggregate then shuffle ~4x fewer rows.
    li = table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("amt"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("ret"),
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = per_order.join(o, per_order.l_orderkey == o.o_orderkey)
    return j.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).cast("int").alias("num_loans"),
        F.round(F.sum("amt"), 2).alias("total_loan_amount"),
        F.round(F.round(F.sum("net"), 4) / 36, 2).alias("monthly_payment"),
        F.max("ret").cast("int").alias("has_mortgage"),
    )


V_CREDIT_LOAN_SQL = """
SELECT o_custkey AS customer_id, CAST(count(*) AS INTEGER) AS num_loans,
  round(sum(amt), 2) AS total_loan_amount, round(round(sum(net), 4) / 36, 2) AS monthly_payment,
  CAST(max(ret) AS INTEGER) AS has_mortgage
FROM (SELECT l_orderkey, sum(l_extendedprice) AS amt,
             sum(l_extendedprice * (1 - l_discount)) AS net,
             max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS ret
      FROM lineitem GROUP BY l_orderkey) li
JOIN orders ON li.l_orderkey = orders.o_orderkey
GROUP BY o_custkey"""

# ------------------------------------------------------------------ v_bars
def v_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.struct("o_orderdate", "o_orderkey")
    return o.groupBy(F.col("o_orderpriority").alias("stock_code"),
                     F.trunc("o_orderdate", "month").alias("trade_date")).agg(
        F.min_by("o_totalprice", k).alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", k).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


V_BARS_SQL = """
SELECT o_orderpriority AS stock_code, CAST(date_trunc('month', o_orderdate) AS DATE) AS trade_date,
  arg_min(o_totalprice, {'d': o_orderdate, 'k': o_orderkey}) AS open,
  max(o_totalprice) AS high, min(o_totalprice) AS low,
  arg_max(o_totalprice, {'d': o_orderdate, 'k': o_orderkey}) AS close,
  count(*) AS volume
FROM orders GROUP BY 1, 2"""

# ------------------------------------------------------------ event views
def v_tick(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    e = table(spark, sf_dir, "events") if events is None else events
    return e.select("event_id", F.col("event_type").alias("stock_code"),
                    (F.col("value") + 1).alias("price"), (F.col("user_id") + 1).alias("volume"),
                    F.col("ts"))


V_TICK_SQL = """
SELECT event_id, event_type AS stock_code, value + 1 AS price, user_id + 1 AS volume, ts
FROM events"""


def v_tx(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    e = table(spark, sf_dir, "events") if events is None else events
    return e.select(F.col("event_id").alias("transaction_id"), F.col("user_id").alias("account"),
                    (F.col("value") * 400).alias("amount"), F.col("event_type").alias("city"),
                    F.col("event_type").alias("type"), F.col("ts"))


V_TX_SQL = """
SELECT event_id AS transaction_id, user_id AS account, value * 400 AS amount,
  event_type AS city, event_type AS type, ts
FROM events"""

BEHAVIOUR_MAP = {"view": "browse", "click": "click", "purchase": "purchase", "signup": "rate"}


def v_behaviour(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    e = table(spark, sf_dir, "events") if events is None else events
    beh = F.lit(None).cast("string")
    for k, v in reversed(list(BEHAVIOUR_MAP.items())):
        beh = F.when(F.col("event_type") == k, F.lit(v)).otherwise(beh)
    out = e.select("event_id", F.col("user_id"), (F.col("event_id") % 50).alias("item_id"),
                   beh.alias("behavior"),
                   F.when(F.col("event_type") == "signup", F.lit(1) + F.floor(F.col("value")) % 5)
                    .cast("double").alias("rating"),
                   F.col("ts"))
    return out.where(F.col("behavior").isNotNull())


V_BEHAVIOUR_SQL = """
SELECT event_id, user_id, event_id % 50 AS item_id,
  CASE event_type WHEN 'view' THEN 'browse' WHEN 'click' THEN 'click'
       WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'rate' END AS behavior,
  CASE WHEN event_type = 'signup' THEN CAST(1 + floor(value) % 5 AS DOUBLE) END AS rating, ts
FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')"""


def v_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(
        (F.lit(1) + F.floor(F.avg("l_quantity") % 5)).cast("double").alias("rating"))


V_RATING_SQL = """
SELECT o_custkey AS user_id, l_partkey AS item_id,
  CAST(1 + floor(fmod(avg(l_quantity), 5)) AS DOUBLE) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_partkey"""


def with_ctes(body: str, **ctes: str) -> str:
    """Prefix ``body`` with ``WITH name AS (sql), ...``."""
    if not ctes:
        return body
    parts = ",\n".join(f"{k} AS ({v})" for k, v in ctes.items())
    return f"WITH {parts}\n{body}"
