from ridemill.streaming.micro_batch import batch_run_id, stream_silver

__all__ = ["batch_run_id", "stream_silver"]
