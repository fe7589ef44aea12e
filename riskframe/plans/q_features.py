"""Registered feature-layer queries (W1-W18) on the events fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import features as fe
from riskframe.oracles.base import FEATURES, LINEITEM_TXN, TXN, with_ctes
from riskframe.plans.catalog import register
from riskframe.sources.fixtures import events_transactions, lineitem_transactions


def _txn(spark, sf_dir):
    return events_transactions(spark, sf_dir)


def _narrow(spark, sf_dir):
    return _txn(spark, sf_dir).select("txn_id", "step", "txn_type", "amount", "name_orig", "name_dest")


def _fsql(cols: str) -> str:
    return with_ctes(f"SELECT {cols} FROM features", TXN, FEATURES)


@register("features", _fsql("*"))
def q_features(spark, sf_dir):
    return fe.build_features(_txn(spark, sf_dir))


_ORIG = ("txn_id, orig_prior_txn_count, orig_prior_avg_amount, orig_prior_max_amount, "
         "orig_prior_total_amount, orig_has_history")


@register("origin_history", _fsql(_ORIG))
def q_origin_history(spark, sf_dir):
    return fe.origin_history(_narrow(spark, sf_dir)).select(*[c.strip() for c in _ORIG.split(",")])


@register("orig_gap", _fsql("txn_id, orig_steps_since_prev_txn"))
def q_orig_gap(spark, sf_dir):
    return fe.origin_history(_narrow(spark, sf_dir)).select("txn_id", "orig_steps_since_prev_txn")


@register("orig_ratios", _fsql("txn_id, orig_amount_to_prior_avg, orig_amount_minus_prior_avg, orig_amount_to_prior_max"))
def q_orig_ratios(spark, sf_dir):
    return fe.origin_history(_narrow(spark, sf_dir)).select(
        "txn_id", "orig_amount_to_prior_avg", "orig_amount_minus_prior_avg", "orig_amount_to_prior_max")


@register("orig_prev_type", _fsql("txn_id, orig_prev_txn_type"))
def q_orig_prev_type(spark, sf_dir):
    return fe.origin_history(_narrow(spark, sf_dir)).select("txn_id", "orig_prev_txn_type")


@register("velocity", _fsql("txn_id, dest_txn_prev_24h, dest_txn_prev_72h, dest_txn_prev_168h"))
def q_velocity(spark, sf_dir):
    return fe.dest_history(_narrow(spark, sf_dir), fan_in=False).select(
        "txn_id", "dest_txn_prev_24h", "dest_txn_prev_72h", "dest_txn_prev_168h")


@register("velocity_amount", _fsql("txn_id, dest_amount_prev_24h"))
def q_velocity_amount(spark, sf_dir):
    return fe.dest_history(_narrow(spark, sf_dir), fan_in=False).select("txn_id", "dest_amount_prev_24h")


@register("orig_velocity", _fsql("txn_id, orig_txn_prev_24h"))
def q_orig_velocity(spark, sf_dir):
    return fe.origin_history(_narrow(spark, sf_dir)).select("txn_id", "orig_txn_prev_24h")


@register("prev_hour_count", _fsql("txn_id, dest_txn_prev_1h"))
def q_prev_hour_count(spark, sf_dir):
    return fe.dest_history(_narrow(spark, sf_dir), fan_in=False).select("txn_id", "dest_txn_prev_1h")


@register("velocity_ratio", _fsql("txn_id, dest_velocity_ratio_24h_vs_168h"))
def q_velocity_ratio(spark, sf_dir):
    return fe.dest_history(_narrow(spark, sf_dir), fan_in=False).select("txn_id", "dest_velocity_ratio_24h_vs_168h")


_DEST = ("txn_id, dest_prior_txn_count, dest_prior_avg_amount, dest_prior_max_amount, dest_prior_total_amount, "
         "dest_has_history, dest_is_new, dest_amount_to_prior_avg")


@register("dest_history", _fsql(_DEST))
def q_dest_history(spark, sf_dir):
    return fe.dest_history(_narrow(spark, sf_dir), fan_in=False).select(*[c.strip() for c in _DEST.split(",")])


@register("dest_gap", _fsql("txn_id, dest_steps_since_prev_txn"))
def q_dest_gap(spark, sf_dir):
    return fe.dest_history(_narrow(spark, sf_dir), fan_in=False).select("txn_id", "dest_steps_since_prev_txn")


@register("pair_history", _fsql("txn_id, pair_prior_txn_count, pair_is_new, pair_prior_total_amount"))
def q_pair_history(spark, sf_dir):
    return fe.pair_history(_narrow(spark, sf_dir)).select(
        "txn_id", "pair_prior_txn_count", "pair_is_new", "pair_prior_total_amount")


@register("first_contact", with_ctes(
    "SELECT txn_id, CASE WHEN ROW_NUMBER() OVER (PARTITION BY name_orig, name_dest ORDER BY step, txn_id) = 1 "
    "THEN 1 ELSE 0 END AS is_first_contact FROM transactions", TXN))
def q_first_contact(spark, sf_dir):
    return fe.pair_history(_narrow(spark, sf_dir)).select("txn_id", "is_first_contact")


@register("fan_in", _fsql("txn_id, dest_prior_unique_senders"))
def q_fan_in(spark, sf_dir):
    return fe.dest_history(_narrow(spark, sf_dir)).select("txn_id", "dest_prior_unique_senders")


@register("type_baseline", _fsql("txn_id, type_prior_avg_amount, amount_to_type_prior_avg"))
def q_type_baseline(spark, sf_dir):
    return fe.type_baseline(_narrow(spark, sf_dir)).select(
        "txn_id", "type_prior_avg_amount", "amount_to_type_prior_avg")


@register("prior_count_only", with_ctes(
    "SELECT txn_id, ROW_NUMBER() OVER (PARTITION BY name_orig ORDER BY step, txn_id) - 1 AS orig_prior_count, "
    "ROW_NUMBER() OVER (PARTITION BY name_dest ORDER BY step, txn_id) - 1 AS dest_prior_count FROM transactions", TXN))
def q_prior_count_only(spark, sf_dir):
    """Cumcount per account, both sides on the growing row."""
    n = _narrow(spark, sf_dir)
    both = fe.history(fe.history(n, ["name_orig"], prefix="o"), ["name_dest"], source=n, prefix="d")
    return both.select("txn_id", F.col("o_n").alias("orig_prior_count"), F.col("d_n").alias("dest_prior_count"))


@register("features_hot_keys", _fsql("*"))
def q_features_hot_keys(spark, sf_dir):
    """The same feature table with a tiny hot-key threshold and block size, so most accounts take
    the chunked (split) plan and the rest the plain window: both paths against one oracle."""
    from riskframe.config import RiskConfig
    return fe.build_features(_txn(spark, sf_dir), RiskConfig(hot_key_rows=20, history_block=64))


@register("features_hot_keys_lineitem", with_ctes("SELECT * FROM features", LINEITEM_TXN, FEATURES))
def q_features_hot_keys_lineitem(spark, sf_dir):
    """The split plan where ids do not follow steps: daily steps, order keys as ids."""
    from riskframe.config import RiskConfig
    return fe.build_features(lineitem_transactions(spark, sf_dir), RiskConfig(hot_key_rows=200, history_block=16))
