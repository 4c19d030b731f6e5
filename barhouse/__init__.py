"""A layered warehouse of daily price bars on PySpark."""

from barhouse.plans.loads import (
    LoadError,
    backfill_unmatched,
    bronze_current,
    check_data_quality,
    land_prices,
    load_bronze,
    load_dim,
    load_gold,
    load_silver,
    failed_files,
    retry_rejected,
    run_gold,
    run_silver,
    verify_keys,
)
from barhouse.plans.warehouse import Warehouse
from barhouse.streaming import stream_bronze

__all__ = [
    "LoadError",
    "Warehouse",
    "backfill_unmatched",
    "bronze_current",
    "check_data_quality",
    "land_prices",
    "load_bronze",
    "load_dim",
    "load_gold",
    "load_silver",
    "failed_files",
    "retry_rejected",
    "run_gold",
    "run_silver",
    "stream_bronze",
    "verify_keys",
]
