"""Business constants in one frozen place (fixed values of the analysis)."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: the raw contract and the business assumptions -----------
RAW_COLUMNS = (
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
)
CANONICAL_NAMES = {
    "step": "step", "type": "txn_type", "amount": "amount",
    "nameOrig": "name_orig", "oldbalanceOrg": "old_balance_orig",
    "newbalanceOrig": "new_balance_orig", "nameDest": "name_dest",
    "oldbalanceDest": "old_balance_dest", "newbalanceDest": "new_balance_dest",
    "isFraud": "is_fraud", "isFlaggedFraud": "is_flagged_fraud",
}
TXN_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
RISK_TYPES = ("TRANSFER", "CASH_OUT")
BALANCE_COLUMNS = ("old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest")
LEAKAGE_SUSPECTS = BALANCE_COLUMNS + ("is_flagged_fraud",)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskConfig:
    # fixed values of the analysis
    steps_per_day: int = 24
    balance_tolerance: float = 0.01
    velocity_windows: tuple[int, ...] = (24, 72, 168)
    train_fraction: float = 0.60
    validation_fraction: float = 0.20
    cost_fn: float = 500.0
    cost_fp: float = 25.0
    cost_verify: float = 5.0
    sensitivity_fn_costs: tuple[float, ...] = (100.0, 250.0, 500.0, 750.0, 1000.0)
    sensitivity_fp_costs: tuple[float, ...] = (5.0, 10.0, 25.0, 50.0, 100.0)
    grid_start: float = 0.01
    grid_stop: float = 0.99
    grid_step: float = 0.01
    quantile_points: int = 80
    quantile_min: float = 0.90
    quantile_max: float = 0.99999
    seed: int = 42
    amount_band_edges: tuple[float, ...] = (0, 1_000, 10_000, 50_000, 200_000, 1_000_000)
    amount_band_labels: tuple[str, ...] = ("0-1k", "1k-10k", "10k-50k", "50k-200k", "200k-1M", "1M+")
    review_fractions: tuple[float, ...] = (0.001, 0.005, 0.01, 0.02, 0.05)
    repeat_origin_share_pct: float = 30.0
    # plan-shape knobs (not business values)
    history_block: int = 1 << 20          # max rows per (key, step, block) group
    hot_key_rows: int = 1 << 22           # keys with more rows take the chunked (split) history plan
    order_bucket_rows: int = 1 << 20      # target distinct values per ordered bucket
    order_fanout: int = 1024              # most buckets of one level

    def fixed_thresholds(self) -> list[float]:
        n = int(round((self.grid_stop - self.grid_start) / self.grid_step)) + 1
        return [round(self.grid_start + i * self.grid_step, 4) for i in range(n)]


DEFAULT = RiskConfig()
