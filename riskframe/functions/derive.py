"""Row-local derivations (P1-P18): built-in column expressions only, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, RISK_TYPES, TXN_TYPES, RiskConfig


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c) -> Column:
    return col(c).cast("double")


def pct(num, den) -> Column:
    """100 * num / den as DOUBLE; NULL when den is 0 (never raises under ANSI)."""
    return F.lit(100.0) * dbl(num) / F.when(dbl(den) != 0, dbl(den))


def ratio(num, den, zero=None) -> Column:
    """Num / NULLIF(den, 0); `zero` replaces the NULL (metric tables use 0.0)."""
    r = dbl(num) / F.when(dbl(den) != 0, dbl(den))
    return r if zero is None else F.coalesce(r, F.lit(float(zero)))


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def entity_kind(name) -> Column:
    """P1: 'C123' -> 'C'."""
    return F.substring(col(name), 1, 1)


def entity_number(name) -> Column:
    """P1: 'C123' -> 123; NULL when the rest is not numeric (the full name stays the key)."""
    return F.expr(f"try_cast(substring({name}, 2) AS BIGINT)")


def entity_split(df: DataFrame) -> DataFrame:
    """Kind + number columns for both parties (names kept: they are the keys)."""
    return df.select("*",
                     entity_kind("name_orig").alias("orig_kind"), entity_number("name_orig").alias("orig_number"),
                     entity_kind("name_dest").alias("dest_kind"), entity_number("name_dest").alias("dest_number"))


def time_columns(df: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """sim_day (1-based), hour_of_day, assumed_day_of_week (exploration only)."""
    spd = cfg.steps_per_day
    day0 = F.floor((F.col("step") - 1) / spd)
    return df.select("*", (day0 + 1).cast("int").alias("sim_day"),
                     ((F.col("step") - 1) % spd).cast("int").alias("hour_of_day"),
                     (day0 % 7).cast("int").alias("assumed_day_of_week"))


def balance_residuals(df: DataFrame) -> DataFrame:
    """Origin residual new-(old +/- amount) (+ for CASH_IN) and destination residual."""
    signed = F.when(F.col("txn_type") == "CASH_IN", F.col("amount")).otherwise(-F.col("amount"))
    return df.select("*",
                     (F.col("new_balance_orig") - (F.col("old_balance_orig") + signed)).alias("balance_error_orig"),
                     (F.col("new_balance_dest") - (F.col("old_balance_dest") + F.col("amount")))
                     .alias("balance_error_dest"))


def log_amount(amount="amount") -> Column:
    """P5: log10(max(amount, 0) + 1), rounded to 9 dp for cross-engine stability."""
    return F.round(F.log10(dbl(F.greatest(col(amount), F.lit(0))) + F.lit(1.0)), 9)


def is_round_1000(amount="amount") -> Column:
    """P6."""
    return F.when(col(amount) % 1000 == 0, 1).otherwise(0)


def dest_is_merchant(name="name_dest") -> Column:
    """P7."""
    return F.when(col(name).startswith("M"), 1).otherwise(0)


def amount_band(amount="amount", cfg: RiskConfig = DEFAULT) -> Column:
    """Six half-open bands [lo, hi); negative or NULL amount -> NULL band."""
    edges, labels = cfg.amount_band_edges, cfg.amount_band_labels
    a = col(amount)
    expr = F.when(a.isNull() | (a < F.lit(edges[0])), F.lit(None).cast("string"))
    for hi, label in zip(edges[1:], labels[:-1]):
        expr = expr.when(a < F.lit(hi), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def sql_amount_band(amount="amount") -> Column:
    """P9, analysis-query form (Q3): numbered labels and negative amounts in the first band."""
    a = col(amount)
    # fixed values: the Q3 band labels
    return (F.when(a < 1000, "1. under 1k").when(a < 10000, "2. 1k-10k").when(a < 50000, "3. 10k-50k")
            .when(a < 200000, "4. 50k-200k").when(a < 1000000, "5. 200k-1M").otherwise("6. 1M+"))


def fan_in_band(c="dest_prior_unique_senders") -> Column:
    """P10 (fixed labels)."""
    x = col(c)
    return (F.when(x == 0, "0 senders (first ever)").when(x < 5, "1-4 senders").when(x < 20, "5-19 senders")
            .when(x < 50, "20-49 senders").otherwise("50+ senders"))


def velocity_band(c="dest_txn_prev_24h") -> Column:
    """P11 (fixed labels)."""
    x = col(c)
    return F.when(x == 0, "0").when(x == 1, "1").when(x < 5, "2-4").when(x < 10, "5-9").otherwise("10+")


def one_hot_type(c="txn_type") -> list[Column]:
    """Fixed five-value list, schema independent of the data."""
    return [F.when(col(c) == t, 1).otherwise(0).alias(f"type_{t}") for t in TXN_TYPES]


def class_label(c="is_fraud") -> Column:
    """P14."""
    return F.when(col(c) == 1, "fraudulent").otherwise("legitimate")


def risk_type(c="txn_type") -> Column:
    """TRANSFER or CASH_OUT."""
    return col(c).isin(*RISK_TYPES)


def outcome_class(flag="predicted_flag", label="is_fraud") -> Column:
    """P17."""
    p, y = col(flag), col(label)
    return (F.when((p == 1) & (y == 1), "true_positive").when((p == 1) & (y == 0), "false_positive")
            .when((p == 0) & (y == 1), "false_negative").otherwise("true_negative"))


def risk_band(score="score", verify: Column | float = 0.5, block: Column | float = 0.5) -> Column:
    """HIGH >= block, MEDIUM >= verify, else LOW."""
    s = col(score)
    v = verify if isinstance(verify, Column) else F.lit(float(verify))
    b = block if isinstance(block, Column) else F.lit(float(block))
    return F.when(s >= b, "HIGH").when(s >= v, "MEDIUM").otherwise("LOW")


def with_score(scored: DataFrame, score: str = "score") -> DataFrame:
    """Rows that have a score: NULL and NaN take no part in any ranking, sweep or confusion count."""
    v = F.col(score).cast("double")
    return scored.where(v.isNotNull() & ~F.isnan(v))
