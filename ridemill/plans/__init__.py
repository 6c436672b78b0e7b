from ridemill.plans.batch import SilverResult, run_batch, run_gold, run_silver
from ridemill.plans.iceberg_store import IcebergTripStore
from ridemill.plans.parquet_store import ParquetTripStore

__all__ = ["IcebergTripStore", "ParquetTripStore", "SilverResult", "run_batch", "run_gold", "run_silver"]
