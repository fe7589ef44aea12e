"""Sources and sinks: raw-contract CSV, canonical Parquet, driver fixtures."""

from riskframe.sources.contract import (  # noqa: F401
    ContractError, RAW_SCHEMA, load_summary, rename_and_cast, scan_contract,
    validate_columns, early_window, raw_from_canonical,
)
from riskframe.sources.fixtures import (  # noqa: F401
    events_transactions, lineitem_transactions, scorecard, transactions_for,
)
from riskframe.sources.sinks import write_table, write_features  # noqa: F401
