from ridemill.sinks.gold_files import GoldWrite, ParquetGoldSink
from ridemill.sinks.jdbc import JdbcGoldSink
from ridemill.sinks.quarantine import read_quarantine, write_quarantine
from ridemill.sinks.run_metadata import first_attempt_time, read_run_metadata, write_run_metadata

__all__ = [
    "GoldWrite",
    "JdbcGoldSink",
    "ParquetGoldSink",
    "first_attempt_time",
    "read_quarantine",
    "read_run_metadata",
    "write_quarantine",
    "write_run_metadata",
]
