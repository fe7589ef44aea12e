"""Canonical `transactions` derived from the driver's tables (see FIXTURES.md).

Two derivations: `events` -> hourly steps (main fixture) and `lineitem`
joined with `orders` -> daily steps (scale fixture, 7 columns, no balances).
Both are plain projections/aggregations that Catalyst pushes into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DEC = "decimal(18,2)"

# fixed values: event_type -> transaction type of the main fixture
EVENT_TYPE_MAP = {"purchase": "PAYMENT", "click": "TRANSFER", "view": "CASH_OUT", "signup": "CASH_IN"}
# fixed values: first character of o_orderpriority -> transaction type of the scale fixture
PRIORITY_TYPE_MAP = {"1": "TRANSFER", "2": "CASH_OUT", "3": "PAYMENT", "4": "CASH_IN"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col, mapping: dict, default: str):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default))


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main fixture: 12-column canonical transactions from `events`."""
    ev = _table(spark, sf_dir, "events")
    txn_type = _case(F.col("event_type"), EVENT_TYPE_MAP, "DEBIT")
    base = ev.select(
        F.col("event_id").alias("txn_id"),
        (F.expr("CAST(timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) AS INT)") + 1).alias("step"),
        txn_type.alias("txn_type"),
        F.col("value").cast(_DEC).alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("name_orig"),
        F.concat(F.when(F.col("event_type") == "purchase", F.lit("M")).otherwise(F.lit("C")),
                 F.regexp_replace("props", "[^0-9]", "")).alias("name_dest"),
    )
    risky = F.col("txn_type").isin("TRANSFER", "CASH_OUT")
    b = base.withColumn(
        "is_fraud",
        F.when(risky & ((F.col("amount") >= F.lit(150)) | (F.col("txn_id") % 53 == 0)), 1).otherwise(0))
    fraud = F.col("is_fraud") == 1
    m5 = F.col("txn_id") % 5
    return b.select(
        "txn_id", "step", "txn_type", "amount", "name_orig", "name_dest",
        F.when(fraud, F.col("amount")).otherwise(F.col("amount") * (1 + m5)).cast(_DEC).alias("old_balance_orig"),
        F.when(fraud, F.lit(0)).when(F.col("txn_type") == "CASH_IN", F.col("amount") * (2 + m5))
         .otherwise(F.col("amount") * m5).cast(_DEC).alias("new_balance_orig"),
        F.when(fraud, F.lit(0)).otherwise(100 + F.col("txn_id") % 1000).cast(_DEC).alias("old_balance_dest"),
        F.when(fraud, F.lit(0)).otherwise(100 + F.col("txn_id") % 1000 + F.col("amount"))
         .cast(_DEC).alias("new_balance_dest"),
        "is_fraud",
        F.when((F.col("txn_type") == "TRANSFER") & (F.col("amount") > 200) & fraud, 1).otherwise(0)
         .alias("is_flagged_fraud"),
    )


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale fixture: daily-step transactions from lineitem (aggregated first) joined with orders."""
    li = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    # dealt by order once: the lines of an order and the order itself meet there
    li = li.select("l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_extendedprice", "l_returnflag").repartition("l_orderkey")
    lines = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_shipdate").alias("shipdate"), F.min("l_suppkey").alias("suppkey"),
        F.sum(F.col("l_extendedprice").cast(_DEC)).alias("price"), F.max("l_returnflag").alias("rf"))
    prio = F.substring("o_orderpriority", 1, 1)
    j = lines.join(orders.select("o_orderkey", "o_custkey", "o_orderpriority"),
                   lines.l_orderkey == orders.o_orderkey)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        (F.expr("CAST(datediff(shipdate, TIMESTAMP_NTZ'1995-01-01 00:00:00') AS INT)") + 1).alias("step"),
        _case(prio, PRIORITY_TYPE_MAP, "DEBIT").alias("txn_type"),
        F.col("price").cast(_DEC).alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("name_orig"),
        F.concat(F.when(prio == "3", F.lit("M")).otherwise(F.lit("C")), F.col("suppkey").cast("string"))
         .alias("name_dest"),
        F.when(prio.isin("1", "2") & (F.col("rf") == "R") & (F.col("price") >= 80000), 1).otherwise(0)
         .alias("is_fraud"),
    )


def transactions_for(spark: SparkSession, sf_dir: str, fixture: str = "events") -> DataFrame:
    if fixture == "events":
        return events_transactions(spark, sf_dir)
    if fixture == "lineitem":
        return lineitem_transactions(spark, sf_dir)
    raise ValueError(f"unknown fixture {fixture!r}")


def scorecard(txns: DataFrame, pivot: float = 250.0, low_weight: float = 0.05,
              high_weight: float = 0.9, score_col: str = "score") -> DataFrame:
    """Deterministic, SQL-expressible score (FIXTURES §4): IEEE division and multiply only."""
    a = F.col("amount").cast("double")
    w = F.when(F.col("txn_type").isin("TRANSFER", "CASH_OUT"), F.lit(high_weight).cast("double")) \
         .otherwise(F.lit(low_weight).cast("double"))
    return txns.withColumn(score_col, a / (a + F.lit(pivot).cast("double")) * w)
